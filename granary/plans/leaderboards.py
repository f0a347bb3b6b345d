"""Download leaderboards for projects and groups over a day, a window or all time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from granary.functions import dates, messages, text
from granary.operators import aggregates, filters, joins, ranking

PROJECT_COLUMNS = [
    "project", "name", "downloads_per_project", "data_download_size",
    "number_of_unique_users_downloaded",
]


@dataclass(frozen=True)
class Day:
    """Events of the day that lies ``hours`` before ``asof``."""

    asof: date | str
    hours: int = 24
    collapse = False

    def apply(self, events: DataFrame) -> DataFrame:
        return filters.on_lookback_day(events, "record_date", self.hours, self.asof)


@dataclass(frozen=True)
class Trailing:
    """Events of the last ``days`` days up to and including ``asof``."""

    asof: date | str
    days: int = 30
    collapse = False

    def apply(self, events: DataFrame) -> DataFrame:
        return filters.trailing_days(events, "record_date", self.days, self.asof)


@dataclass(frozen=True)
class AllTime:
    """Every event; users come back to the same files, so events are collapsed first."""

    collapse = True

    def apply(self, events: DataFrame) -> DataFrame:
        return events


Window = Day | Trailing | AllTime


def _sized_downloads(
    events: DataFrame, project_ids: DataFrame, files: DataFrame, window: Window
) -> DataFrame:
    """Events of some projects in the window, with file sizes.

    Order matters at scale: time range in the scan, project filter against a
    small list, then the join with the large file table.  Long histories are
    collapsed per (project, file, user) before that join, which costs one
    evenly spread shuffle and spares the join all repeats; a day or a month has
    few repeats and goes straight to the join, whose skewed side may be split.
    """
    kept = window.apply(events).join(project_ids, "project_id", "left_semi")
    sizes = files.select(F.col("id").alias("file_handle_id"), "content_size")
    rows = aggregates.collapse_downloads(kept) if window.collapse else kept
    return rows.join(sizes, "file_handle_id")


def leaderboard(
    nodes: DataFrame,
    events: DataFrame,
    files: DataFrame,
    window: Window,
    exclude_id: int | None = None,
    sort_by: str = "number_of_unique_users_downloaded",
    approx: bool = False,
) -> DataFrame:
    """Downloads, bytes and unique users per public project in the window.

    The daily report sorts by unique users; the 30-day and all-time ones pass
    ``sort_by="downloads_per_project"``.  The events meet the project ids in a
    semi join, which adaptive execution broadcasts where their measured size allows.
    Names are attached after the aggregation and do not travel with the events.
    """
    projects = filters.public_projects(nodes, exclude_id).select("project_id", "name")
    sized = _sized_downloads(events, projects.select("project_id"), files, window)
    stats = aggregates.download_stats(sized, ["project_id"], approx).join(projects, "project_id")
    columns = [text.prefixed_id(F.col("project_id")).alias("project"), *PROJECT_COLUMNS[1:]]
    return ranking.rank_desc(stats.select(*columns), sort_by, ["project"])


def group_members(nodes: DataFrame, groups: Sequence[tuple[int, str]]) -> DataFrame:
    """Projects in the scope of each configured view: (group_name, file_view_id, project_id, project_name)."""
    table = joins.constant_table(
        nodes.sparkSession, [(int(v), n) for v, n in groups], "file_view_id bigint, group_name string"
    )
    views = nodes.filter(F.col("id").isin([int(v) for v, _ in groups])).select(
        F.col("id").alias("file_view_id"), "scope_ids"
    )
    scopes = joins.explode_members(views.join(table, "file_view_id"), "scope_ids", "project_id")
    projects = nodes.filter("node_type = 'project'").select(
        "project_id", F.col("name").alias("project_name")
    )
    return joins.bridge(projects, scopes, "project_id").select(
        "group_name", "file_view_id", "project_id", "project_name"
    )


def group_leaderboard(
    nodes: DataFrame,
    events: DataFrame,
    files: DataFrame,
    groups: Sequence[tuple[int, str]],
    window: Window,
    approx: bool = False,
) -> DataFrame:
    """Leaderboard per configured group of projects; a project may count in several groups.

    Events of all member projects are selected and sized once, and only then
    multiplied by group membership.
    """
    members = group_members(nodes, groups)
    keys = ["group_name", "file_view_id"]
    sized = _sized_downloads(events, members.select("project_id").distinct(), files, window)
    bridged = joins.bridge(sized, members.drop("project_name"), "project_id")
    stats = joins.with_group_totals(
        aggregates.group_download_stats(bridged, keys, approx),
        aggregates.group_project_count(members, keys),
        keys,
    )
    return stats.select(
        text.prefixed_id(F.col("file_view_id")).alias("project"),
        F.col("group_name").alias("name"),
        "projects_with_downloads",
        "total_projects",
        "downloads_per_project",
        "data_download_size",
        "number_of_unique_users_downloaded",
    )


def combined_leaderboard(public: DataFrame, groups: DataFrame) -> DataFrame:
    """Projects and groups in one list, most unique users first."""
    rows = ranking.stack(public, groups).fillna(0, ["projects_with_downloads", "total_projects"])
    return ranking.rank_desc(rows, "number_of_unique_users_downloaded", ["project", "name"])


def top_message(
    combined: DataFrame, hours: int, asof: date | str, entity_url: str, n: int = 10,
    title: str = "Top Downloaded Public Projects",
) -> DataFrame:
    """The report text as one row; only the ``n`` best entries take part."""
    order = [F.desc_nulls_last("number_of_unique_users_downloaded"), F.asc("project"), F.asc("name")]
    lines = ranking.numbered_top(combined, n, order).select(
        "rank", messages.leaderboard_line(F.col("rank"), entity_url).alias("line")
    )
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda x: x["line"]), "\n\n"
    )
    heading = f"{title} {dates.lookback_label(hours, asof)}!\n\n"
    footer = "One download is a user downloading an entity (File, Table, Views, etc) once\n"
    gap = F.when(body == "", F.lit("")).otherwise(F.lit("\n\n"))
    return lines.agg(F.concat(F.lit(heading), body, gap, F.lit(footer)).alias("message"))


def public_snapshot(combined: DataFrame, groups: Sequence[tuple[int, str]], hours: int, asof: date | str) -> DataFrame:
    """Rows kept for the public table: the combined list without the groups, with its record date."""
    ids = joins.constant_table(
        combined.sparkSession, [(f"{text.ID_PREFIX}{view}",) for view, _ in groups], "project string"
    )
    day = dates.lookback_moment(asof, hours).date()
    return filters.exclude_ids(combined, ids, "project").select(
        "project", "downloads_per_project", F.lit(day).alias("record_date"),
        "number_of_unique_users_downloaded", "data_download_size",
    )


