"""Monthly platform numbers, trending projects and recently created entities."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from granary.functions import messages, text
from granary.operators import aggregates, filters, joins, ranking


def trending_month(
    nodes: DataFrame,
    events: DataFrame,
    files: DataFrame,
    month: date | str,
    n: int = 10,
    exclude_id: int | None = None,
    stack: str = "prod",
) -> DataFrame:
    """The ``n`` public projects with most unique users in a month, with their size.

    Unique users and the last download date come from one aggregation.  The
    size join starts from the ``n`` winners, which carry their numbers along,
    so the event table is read once.  Winners without files are left out.
    """
    public = filters.public_projects(nodes, exclude_id).select("project_id")
    recent = filters.semi(
        filters.by_value(filters.in_month(events, "record_date", month), "stack", stack),
        public, ["project_id"],
    )
    per_project = recent.groupBy("project_id").agg(
        F.countDistinct("user_id").alias("n_unique_users"),
        aggregates.last_event_text(F.col("record_date")).alias("last_download_date"),
    )
    top = ranking.top_n(per_project, n, [F.desc("n_unique_users"), F.asc("project_id")])
    handles = filters.up_to_month(nodes, "created_on", month).filter("node_type = 'file'").select(
        "project_id", "file_handle_id"
    )
    sized = aggregates.project_size_gib(
        handles.join(top, "project_id"), files, ["project_id", "n_unique_users", "last_download_date"]
    )
    size = F.round("estimated_project_size_in_gib", 3)
    return ranking.rank_desc(
        sized.withColumn("estimated_project_size_in_gib", size), "n_unique_users", ["project_id"]
    )


def hosted_files(nodes: DataFrame, files: DataFrame, associations: DataFrame) -> DataFrame:
    """Distinct (id, size) of files that a node or a table cell points at.

    Both sources of ids are united and made distinct before they meet the file
    table, so no file is multiplied by the number of places that use it.
    """
    node_ids = nodes.select(F.col("file_handle_id").alias("id"))
    table_ids = filters.by_value(associations, "associatetype", "TableEntity").select(
        F.col("filehandleid").alias("id")
    )
    used = ranking.stack_distinct(node_ids.dropna(), table_ids.dropna())
    return filters.semi(files.select("id", "content_size"), used, ["id"]).distinct()


def platform_numbers(
    nodes: DataFrame,
    files: DataFrame,
    associations: DataFrame,
    access: DataFrame,
    events: DataFrame,
    month: date | str,
) -> DataFrame:
    """Hosted petabytes, active users of the month and downloads of the month, as one row."""
    return joins.one_row_table(
        aggregates.total_size(hosted_files(nodes, files, associations)),
        aggregates.monthly_active_users(access, month),
        aggregates.monthly_downloads(events, month),
    )


# Node types that are reported when they appear.
REPORTED_TYPES = ["dataset", "project"]


def content_type_text(annotations):
    """The content-type annotation as one text, from annotations kept as JSON text or variant."""
    values = F.try_variant_get(annotations, "$.annotations.contentType.value", "array<string>")
    return F.array_join(values, ", ")


def recent_entities(
    nodes: DataFrame, users: DataFrame, asof: date | datetime | str, days: int = 7,
    types: Sequence[str] = tuple(REPORTED_TYPES),
) -> DataFrame:
    """Projects and data sets created in the last days, with their creator, public ones first."""
    recent = filters.created_since(nodes, "created_on", days, asof)
    typed = filters.of_type_or_annotation(
        recent.withColumn("content_type", content_type_text(F.col("annotations"))), types
    )
    named = joins.with_profile(typed, users)
    rows = named.select(
        "name", "id", "project_id", "node_type", "content_type",
        F.to_date("created_on").alias("created_on"), "created_by",
        text.display_name(F.col("first_name"), F.col("last_name"), F.col("user_name")).alias(
            "user_name_full_name"
        ),
        "is_public",
    )
    return rows.orderBy(F.desc("is_public"), F.asc("created_on"), F.asc("id"))


def recent_lines(entities: DataFrame, entity_url: str, profile_url: str) -> DataFrame:
    """Message lines (section, rank, line); numbering runs over both sections."""
    order = [F.desc("is_public"), F.asc("created_on"), F.asc("id")]
    ranked = ranking.numbered(entities, order)
    section = F.when(F.col("is_public"), F.lit("Public datasets")).otherwise(F.lit("Private datasets"))
    lines = ranked.select(
        section.alias("section"), "rank",
        messages.entity_line(F.col("rank"), entity_url, profile_url).alias("line"),
    )
    both = joins.constant_table(
        entities.sparkSession, [("Public datasets",), ("Private datasets",)], "section string"
    )
    empty = both.join(lines.select("section").distinct(), "section", "left_anti")
    return lines.unionByName(
        empty.select("section", F.lit(0).cast("long").alias("rank"), F.lit(messages.NOTHING_FOUND).alias("line"))
    )


# The narrower column set of the public table.
PUBLIC_COLUMNS = ["id", "node_type", "created_on", "created_by"]


def public_recent(entities: DataFrame) -> DataFrame:
    return filters.public_only(entities, PUBLIC_COLUMNS)
