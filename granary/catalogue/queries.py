"""Every job and operator as a query over the given tables.

A query is a function of (session, folder).  Dates are fixed, so results can be
compared with the SQL in ``oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from granary.catalogue.tables import Tables
from granary.functions import dates, text, versions
from granary.operators import aggregates, filters, joins, quality, ranking, tiles
from granary.plans import (
    catalog, documents, ingest, intake, leaderboards, matrix, platform, reports, runs, summaries, tracking,
)
from granary.session import cut_lineage, scratch_path
from granary.sinks import files as file_sinks, tables as table_sinks
from granary.sources import delimited, documents as json_sources
from granary.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

HOME_PROJECT = 1
ASOF = date(1998, 6, 30)
MONTH = date(1998, 5, 15)
ACCESS_MONTH = date(2024, 1, 1)
RECENT_ASOF = datetime(2001, 7, 30, 12, 0, 0)
RUN_ASOF = datetime(2001, 8, 1, 0, 0, 0)
PAST_WEEK = datetime(2001, 7, 25, 0, 0, 0)
PAST_MONTH = datetime(2001, 7, 1, 0, 0, 0)
PAST_YEAR = datetime(2000, 8, 1, 0, 0, 0)
GROUPS = [(-100, "Group A"), (-98, "Group B"), (-97, "Group C")]
ENTITY_URL = "https://example.org/entity/"
PROFILE_URL = "https://example.org/profile/"
RECORD_URL = "https://example.org/records/"
OBJECT_URL = "https://objects.example.org/"
RUN_URL = "https://runs.example.org/watch/"
REASONS = ["Copyright", "@", "tion", "no such marker"]
SPECIMENS = [f"N{n}" for n in range(25)]
INGESTED_AT = datetime(2024, 2, 1, 0, 0, 0)
LAYOUT = tracking.Layout(
    cohorts=["A", "N", "R"], named_cohorts=["A", "N"], projects=["URGENT", "LOW"]
)

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# -- usage -------------------------------------------------------------------


def _leaderboard(t: Tables, window, **options) -> DataFrame:
    return leaderboards.leaderboard(
        t.nodes(), t.download_events(), t.files(), window, HOME_PROJECT, **options
    )


@query
def leaderboard_trailing30(spark: SparkSession, folder: str) -> DataFrame:
    return _leaderboard(
        Tables(spark, folder), leaderboards.Trailing(ASOF), sort_by="downloads_per_project"
    )


@query
def leaderboard_all_time(spark: SparkSession, folder: str) -> DataFrame:
    return _leaderboard(
        Tables(spark, folder), leaderboards.AllTime(), sort_by="downloads_per_project"
    )


@query
def leaderboard_day(spark: SparkSession, folder: str) -> DataFrame:
    return _leaderboard(Tables(spark, folder), leaderboards.Day(ASOF))


@query
def leaderboard_part_day(spark: SparkSession, folder: str) -> DataFrame:
    """A lookback that is not a whole number of days meets no event of day grain."""
    return _leaderboard(Tables(spark, folder), leaderboards.Day(ASOF, hours=30))


def _groups(t: Tables, window) -> DataFrame:
    return leaderboards.group_leaderboard(
        t.nodes(), t.download_events(), t.files(), GROUPS, window
    )


@query
def group_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return _groups(Tables(spark, folder), leaderboards.Trailing(ASOF, 365))


def _combined(t: Tables) -> DataFrame:
    window = leaderboards.Day(ASOF)
    return leaderboards.combined_leaderboard(_leaderboard(t, window), _groups(t, window))


@query
def combined_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return _combined(Tables(spark, folder))


@query
def top_message(spark: SparkSession, folder: str) -> DataFrame:
    return leaderboards.top_message(_combined(Tables(spark, folder)), 24, ASOF, ENTITY_URL)


@query
def public_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return leaderboards.public_snapshot(_combined(Tables(spark, folder)), GROUPS, 24, ASOF)


def _stored_usage(t: Tables, first: date, last: date, daily_from: date | None = None) -> summaries.UsageStore:
    store = summaries.UsageStore(scratch_path(t.spark, "usage-store"), daily_from)
    store.put(t.download_events(), t.files(), first, last)
    return store


@query
def summary_all_time(spark: SparkSession, folder: str) -> DataFrame:
    """The all-time board as a merge of stored months, the last of them merged from stored days."""
    t = Tables(spark, folder)
    first, last = date(1992, 1, 1), date(2002, 12, 31)
    store = _stored_usage(t, first, last, daily_from=date(2001, 10, 1))
    return summaries.leaderboard(t.nodes(), store.rows(spark, first, last), HOME_PROJECT, "downloads_per_project")


@query
def summary_trailing30(spark: SparkSession, folder: str) -> DataFrame:
    """Thirty days that begin in one month and end in the next, after three of them have been loaded again.

    The second load lacks the events of odd projects, and one day altogether.
    """
    t = Tables(spark, folder)
    store = _stored_usage(t, date(1998, 5, 1), date(1998, 6, 30))
    fewer = t.download_events().filter("project_id % 2 = 0 AND CAST(record_date AS DATE) <> DATE'1998-05-26'")
    for _ in range(2):
        store.put(fewer, t.files(), date(1998, 5, 25), date(1998, 5, 27))
    rows = store.rows(spark, date(1998, 5, 21), date(1998, 6, 19))
    return summaries.leaderboard(t.nodes(), rows, HOME_PROJECT, "downloads_per_project")


@query
def summary_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups over whole months in the middle and days at both ends."""
    t = Tables(spark, folder)
    store = _stored_usage(t, date(1998, 3, 1), date(1998, 6, 30))
    return summaries.group_leaderboard(t.nodes(), store.rows(spark, date(1998, 3, 11), date(1998, 6, 14)), GROUPS)


@query
def summary_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """Unique users of half a year exactly, and whether the united sketches come within a twentieth (or two) of that."""
    t = Tables(spark, folder)
    first, last = date(1998, 1, 1), date(1998, 6, 30)
    store = _stored_usage(t, first, last, daily_from=date(1998, 7, 1))
    rows = store.rows(spark, first, last)
    exact = summaries.totals(rows, ["project_id"]).select("project_id", F.col("number_of_unique_users_downloaded").alias("users"))
    # one sketch per project and eighth of the users, united per project
    parts = summaries.sketches(rows.withColumn("part", F.col("word") % 8), ["project_id", "part"])
    near = summaries.estimated_users(parts, ["project_id"])
    error = F.abs(F.col("estimated_users") - F.col("users"))
    return exact.join(near, "project_id").select(
        "project_id", "users", (error <= F.greatest(F.lit(2), F.col("users") * 0.05)).alias("close")
    )


@query
def trending_month_top10(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return platform.trending_month(
        t.nodes(), t.download_events(), t.files(), MONTH, exclude_id=HOME_PROJECT
    )


@query
def platform_numbers(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    numbers = platform.platform_numbers(
        t.file_nodes(), t.files(), t.associations(), t.access_events(), t.download_events(),
        ACCESS_MONTH,
    )
    downloads = aggregates.monthly_downloads(t.download_events(), MONTH)
    return joins.one_row_table(numbers.drop("downloads_last_month"), downloads)


@query
def active_users_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.monthly_active_users(Tables(spark, folder).access_events(), ACCESS_MONTH)


# -- membership --------------------------------------------------------------


@query
def latest_per_cohort(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return ranking.latest_by(t.cohort_samples(), ["COHORT"], ["MAJOR_VERSION", "MINOR_VERSION"])


@query
def global_latest(spark: SparkSession, folder: str) -> DataFrame:
    main = Tables(spark, folder).main_samples()
    version = ["MAJOR_VERSION", "MINOR_VERSION"]
    return joins.only_latest(main, ranking.latest_global(main, version), version).select(
        "SAMPLE_ID", "PATIENT_ID", "RELEASE"
    ).distinct()


def _pairs(t: Tables) -> DataFrame:
    projects = {
        "URGENT": tracking.Project(t.project_samples("1-URGENT"), patient_key="PATIENT"),
        "LOW": tracking.Project(t.project_samples("5-LOW"), patient_key="PATIENT"),
    }
    return tracking.all_pairs(
        t.main_samples(), t.cohort_samples(), projects, LAYOUT, "PANEL_SAMPLE_ID", "RECORD_ID"
    )


@query
def membership_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return tracking.membership_pairs(_pairs(Tables(spark, folder)), LAYOUT)


@query
def membership_wide(spark: SparkSession, folder: str) -> DataFrame:
    return tracking.tracking_table(_pairs(Tables(spark, folder)), LAYOUT)


@query
def membership_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of the raw cohort rows, which do repeat pairs and lack a required column."""
    rows = Tables(spark, folder).cohort_samples().withColumn(
        "IN_PATIENT_RELEASE", F.nullif(F.col("COHORT"), F.lit("R"))
    ).withColumn("EMPTY_RELEASE", F.lit(None).cast("string"))
    required = ["PANEL_SAMPLE_ID", "IN_PATIENT_RELEASE", "EMPTY_RELEASE", "NOT_THERE"]
    return quality.validate_table(rows, required, ["PANEL_SAMPLE_ID", "RECORD_ID"])


# -- entities ----------------------------------------------------------------


def _recent(t: Tables) -> DataFrame:
    return platform.recent_entities(t.entities(), t.profiles(), RECENT_ASOF, 7)


@query
def recent_entities(spark: SparkSession, folder: str) -> DataFrame:
    return _recent(Tables(spark, folder))


@query
def recent_lines(spark: SparkSession, folder: str) -> DataFrame:
    return platform.recent_lines(_recent(Tables(spark, folder)), ENTITY_URL, PROFILE_URL)


@query
def public_recent(spark: SparkSession, folder: str) -> DataFrame:
    return platform.public_recent(_recent(Tables(spark, folder)))


@query
def variant_paths(spark: SparkSession, folder: str) -> DataFrame:
    props = F.parse_json("props")
    rows = Tables(spark, folder).raw("events").select(
        "event_type", F.try_variant_get(props, "$.k", "bigint").alias("k")
    )
    return rows.groupBy("event_type").agg(F.sum("k").alias("k_sum"), F.max("k").alias("k_max"))


# -- runs --------------------------------------------------------------------


@query
def runs_per_workspace(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return runs.runs_per_workspace(t.runs(), t.workspaces(), PAST_WEEK)


@query
def workflow_share(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return runs.workflow_share(t.runs(), t.workspaces(), PAST_WEEK)


@query
def runs_per_month_avg(spark: SparkSession, folder: str) -> DataFrame:
    return runs.mean_runs_per_month(Tables(spark, folder).runs(), PAST_YEAR, RUN_ASOF)


@query
def runs_per_week_avg(spark: SparkSession, folder: str) -> DataFrame:
    return runs.mean_runs_per_week(Tables(spark, folder).runs(), PAST_YEAR, RUN_ASOF)


@query
def status_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    rows = Tables(spark, folder).runs()
    return aggregates.breakdown(rows, "status", "status_count", PAST_YEAR, RUN_ASOF)


@query
def project_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    rows = Tables(spark, folder).runs()
    return aggregates.breakdown(rows, "project_name", "runs", PAST_MONTH, RUN_ASOF)


@query
def users_total(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.users_total(Tables(spark, folder).raw("customer"))


@query
def users_active(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.users_active(Tables(spark, folder).runs(), PAST_MONTH, RUN_ASOF)


@query
def run_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the eight reports, derived from one cube, read back from the JSON of the bundle."""
    t = Tables(spark, folder)
    users = t.raw("customer").select(F.col("c_name").alias("user_name"))
    cube = cut_lineage(runs.run_cube(t.runs(), RUN_ASOF))
    bundle = file_sinks.bundle_reports(runs.reports_from_cube(cube, t.workspaces(), users))
    field = lambda *names: F.coalesce(*[F.get_json_object("row_json", f"$.{n}") for n in names])
    return bundle.select(
        "report", field("workspace", "status", "project_name").alias("name"), field("workflow").alias("workflow"),
        field("total_runs", "status_count", "runs", "total_users", "users_past_month").cast("long").alias("n"),
        F.round(field("percentage", "month_avg_past_year", "week_avg_past_year").cast("double"), 6).alias("value"),
        F.size(F.json_object_keys("row_json")).alias("n_fields"),
    )


@query
def run_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return runs.run_summaries(Tables(spark, folder).finished_runs(), RUN_URL)


@query
def failure_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return runs.failure_reasons(Tables(spark, folder).tasks(), REASONS)


# -- reports -----------------------------------------------------------------


def _usage_rows(t: Tables) -> DataFrame:
    """Parts as published records with their usage."""
    usage = t.raw("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("views"),
        F.countDistinct("l_orderkey").alias("unique_views"),
        F.sum("l_quantity").cast("long").alias("downloads"),
        F.countDistinct("l_suppkey").alias("unique_downloads"),
    )
    kind = F.when(F.col("p_size") > 25, " Resource pack").when(F.col("p_size") > 15, " COMPONENT").otherwise(" report")
    stats = F.when(
        F.col("views").isNotNull(), F.struct("views", "unique_views", "downloads", "unique_downloads")
    )
    return t.raw("part").join(usage, "p_partkey", "left").select(
        "p_partkey",
        F.struct(
            F.col("p_partkey").alias("id"),
            F.struct(
                F.concat("p_name", kind).alias("title"), F.lit("2024-01-30").alias("publication_date")
            ).alias("metadata"),
            stats.alias("stats"),
        ).alias("record"),
    )


def _usage_pages(t: Tables) -> DataFrame:
    """The records landed as files of pages; a page never holds more than its fixed size."""
    rows = _usage_rows(t)
    page = (F.floor(F.col("p_partkey") / reports.PAGE_SIZE) + 1).alias("page")
    pages = rows.groupBy(page).agg(F.array_sort(F.collect_list("record")).alias("records"))
    total = t.raw("part").agg(F.count(F.lit(1))).scalar()
    landed = pages.select("page", F.struct(F.col("records").alias("hits"), total.alias("total")).alias("hits"))
    path = scratch_path(t.spark, "pages")
    landed.write.parquet(path)
    return t.spark.read.schema(landed.schema).parquet(path)


@query
def category_report_totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = _usage_rows(Tables(spark, folder))
    records = reports.usage_columns(rows, RECORD_URL, F.col("p_partkey"))
    return reports.report_rows(records.drop("checked"))


@query
def usage_report_pages(spark: SparkSession, folder: str) -> DataFrame:
    records = reports.usage_records(_usage_pages(Tables(spark, folder)), RECORD_URL)
    return records.select("index", "title", "views", "unique_downloads", "link", "category")


@query
def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    records = reports.usage_columns(_usage_rows(Tables(spark, folder)), RECORD_URL, F.col("p_partkey"))
    return aggregates.count_by(records, "category", "n_records")


@query
def report_file_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of the written CSV reports as text: headings, details and totals."""
    t = Tables(spark, folder)
    path = scratch_path(spark, "report")
    records = reports.usage_columns(_usage_rows(t), RECORD_URL, F.col("p_partkey"))
    reports.write_reports(records.drop("checked"), path)
    names = list(reports.REPORT_HEADINGS)
    rows = spark.read.schema(", ".join(f"{c} string" for c in [*names, "category"])).csv(path)
    return rows.select("category", *[F.coalesce(c, F.lit("")).alias(c) for c in names])


@query
def record_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as records; some kinds of order make a faulty record."""
    o = Tables(spark, folder).raw("orders")
    views = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "-5")
        .when(F.col("o_orderpriority") == "2-HIGH", "true")
        .when(F.col("o_orderpriority") == "3-MEDIUM", '"7"')
        .otherwise("7")
    )
    downloads = F.when(F.col("o_orderstatus") == "P", "null").otherwise("3")
    title = F.when(F.col("o_orderstatus") == "F", "").otherwise("T")
    link = F.when(F.col("o_orderstatus") == "O", ',"link":"x"').otherwise("")
    record = F.concat(
        F.lit('{"title":"'), title, F.lit('","date":"2024-01-30","views":'), views,
        F.lit(',"unique_views":1,"downloads":'), downloads,
        F.lit(',"unique_downloads":2,"category":"report"'), link, F.lit("}"),
    )
    rows = o.select(F.col("o_orderkey").alias("index"), F.parse_json(record).alias("record"))
    return quality.validate_records(rows, "record", "index")


@query
def page_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations landed as pages of two turns; reading ends at the first short page."""
    turns = Tables(spark, folder).raw("conversations")
    pages = turns.groupBy("conv_id", (F.floor(F.col("turn") / 2) + 1).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("data")
    )
    rows = json_sources.flatten_pages(pages, "data", "page", 2, feed=["conv_id"])
    return rows.select("conv_id", "page", "position", F.col("record.turn").alias("turn"), F.col("record.role").alias("role"))


@query
def doi_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Documents landed as pages, written as NDJSON and read back."""
    t = Tables(spark, folder)
    docs = t.raw("documents").select("doc_id", "lang", "n_chars")
    pages = docs.groupBy(F.floor(F.col("doc_id") / 100).alias("page")).agg(
        F.collect_list(F.struct("doc_id", "lang", "n_chars")).alias("data")
    )
    path = scratch_path(spark, "doi")
    written = reports.doi_extract(pages, path, page_size=100)
    back = spark.read.schema("doc_id bigint, lang string, n_chars bigint").json(path)
    return back.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"),
        F.max(F.lit(written).cast("long")).alias("written"),
    )


# -- catalogue ---------------------------------------------------------------


@query
def duplicate_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as catalogue items; labelled ones are stored already."""
    t = Tables(spark, folder)
    docs = t.raw("documents")
    items = docs.select(F.col("doc_id").alias("sameAs"), F.col("text").alias("title"))
    existing = t.raw("labels").select(F.col("doc_id").alias("sameAs"))
    ignored = docs.filter("source = 'src3'").select("doc_id")
    status = catalog.intake_status(items, existing, ignored, long_titles=True)
    return status.select("sameAs", "status")


@query
def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items whose (order, line number) occurs more than once."""
    lines = Tables(spark, folder).raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return ranking.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


def _items(t: Tables) -> DataFrame:
    return t.raw("part").select(
        F.col("p_partkey").alias("index"),
        F.concat(F.lit("id-"), F.col("p_partkey").cast("string")).alias("identifier"),
        F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("label"),
        F.split("p_name", " ").alias("words"),
        "p_type", "p_size", "p_retailprice",
    )


def _mapping() -> dict[str, Column]:
    return {
        "sameAs": F.col("identifier"),
        "title": F.col("label"),
        "creator": F.lit("Maker"),
        "keywords": F.col("words"),
        "subject": F.array(F.col("p_type")),
        "collection": F.lit("parts"),
        "publisher": F.lit("Example Institute"),
        "species": F.lit(None).cast("string"),
        "source": F.lit("Example Institute"),
        "url": F.concat(F.lit(RECORD_URL), F.col("identifier")),
        "description": F.repeat(F.col("label"), 60),
        "size": F.col("p_size"),
        "price": F.col("p_retailprice"),
    }


def _rules() -> dict[str, Column]:
    return {"size in range": F.col("size").between(1, 45), "price present": F.col("price") > 901}


def _intake(t: Tables) -> tuple[DataFrame, DataFrame]:
    existing = t.raw("lineitem").filter("l_returnflag = 'R'").select(
        F.concat(F.lit("id-"), F.col("l_partkey").cast("string")).alias("sameAs")
    )
    ignored = t.raw("part").filter("p_size = 7").select(
        F.concat(F.lit("id-"), F.col("p_partkey").cast("string")).alias("id")
    )
    return catalog.catalogue_intake(_items(t), existing, ignored, _mapping(), _rules(), "index")


@query
def catalogue_intake(spark: SparkSession, folder: str) -> DataFrame:
    status, _ = _intake(Tables(spark, folder))
    kept = catalog.accepted(status)
    return kept.select("sameAs", "title", "status", F.length("description").alias("n_description"))


@query
def intake_errors(spark: SparkSession, folder: str) -> DataFrame:
    _, errors = _intake(Tables(spark, folder))
    return errors.select("item_index", "error", F.get_json_object("transformed_item", "$.sameAs").alias("sameAs"))


@query
def annotation_rows(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    status, _ = _intake(t)
    stored = t.raw("part").select(
        F.concat(F.lit("syn"), F.col("p_partkey").cast("string")).alias("id"),
        F.concat(F.lit("id-"), F.col("p_partkey").cast("string")).alias("sameAs"),
    )
    return catalog.annotation_rows(stored, catalog.accepted(status))


@query
def unmatched_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Parts never sold and customers' ids beyond the parts, by the side they occur on."""
    t = Tables(spark, folder)
    stored = t.raw("part").select(F.col("p_partkey").alias("key"))
    updates = t.raw("orders").select(F.col("o_custkey").alias("key"))
    return quality.unmatched(stored, updates, "key")


def _links(t: Tables) -> DataFrame:
    return t.raw("part").select(
        F.concat(F.lit("syn"), F.col("p_partkey").cast("string")).alias("dataset"),
        (F.col("p_size") % 3).alias("dataset_version"),
        F.concat(F.lit("syn"), F.regexp_extract("p_brand", r"(\d+)$", 1)).alias("dataset_collection"),
        F.concat(F.lit(OBJECT_URL), F.col("p_name")).alias("object_url"),
    )


def _current(t: Tables) -> DataFrame:
    """The same data sets later: cheap ones are gone, large ones have a new version or link."""
    return t.raw("part").filter("p_retailprice > 905").select(
        F.concat(F.lit("syn"), F.col("p_partkey").cast("string")).alias("dataset"),
        F.when(F.col("p_size") > 40, F.lit(9)).otherwise(F.col("p_size") % 3).alias("dataset_version"),
        F.concat(F.lit("syn"), F.regexp_extract("p_brand", r"(\d+)$", 1)).alias("dataset_collection"),
        F.concat(
            F.lit(OBJECT_URL), F.when(F.col("p_type") == "ECONOMY", "new/").otherwise(""), F.col("p_name")
        ).alias("object_url"),
    )


LINK_KEYS = ["dataset", "dataset_version", "dataset_collection"]
COLLECTIONS = ["syn1", "syn2", "syn3", "syn4", "syn5"]


@query
def link_actions(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return catalog.link_actions(_links(t), _current(t), LINK_KEYS, "object_url")


@query
def stale_links(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return catalog.stale_links(_links(t), _current(t), LINK_KEYS, COLLECTIONS)


@query
def stale_objects(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    p = t.raw("part")
    collection = F.concat(F.lit("syn"), F.regexp_extract("p_brand", r"(\d+)$", 1))
    dataset = F.concat(F.lit("syn"), F.col("p_partkey").cast("string"))
    key = documents.document_key(F.col("p_name"), dataset, F.col("p_size") % 3, collection)
    listing = p.select(
        F.when(F.col("p_type") == "PROMO", F.concat("p_name", F.lit(".txt"))).otherwise(key).alias("key")
    )
    current = p.filter("p_retailprice > 905").select(
        dataset.alias("dataset_id"),
        F.when(F.col("p_size") > 40, F.lit(9)).otherwise(F.col("p_size") % 3).alias("dataset_version"),
        collection.alias("dataset_collection"),
        F.col("p_name").alias("dataset_name"),
    )
    return catalog.stale_objects(listing, current, COLLECTIONS)


@query
def stale_minimal_objects(spark: SparkSession, folder: str) -> DataFrame:
    p = Tables(spark, folder).raw("part")
    dataset = F.concat(F.lit("syn"), F.col("p_partkey").cast("string"))
    name = F.concat_ws("_", F.split("p_name", " "))
    listing = p.select(
        F.when(F.col("p_type") == "PROMO", F.concat("p_name", F.lit(".txt")))
        .otherwise(documents.minimal_key(name, dataset)).alias("key")
    )
    current = p.filter("p_retailprice > 905").select(name.alias("dataset_name"), dataset.alias("dataset_id"))
    return catalog.stale_minimal_objects(listing, current)


def _documents(t: Tables) -> DataFrame:
    return documents.dataset_documents(
        t.datasets(), t.dataset_items(), t.file_entities(), t.versioned_nodes(),
        t.versioned_files(), ENTITY_URL,
    )


@query
def dataset_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(Tables(spark, folder)).select("object_key", "section", "line")


@query
def document_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document under its published link, in order, from the written files."""
    t = Tables(spark, folder)
    path = scratch_path(spark, "documents")
    file_sinks.write_documents(_documents(t), path)
    links = documents.document_links(t.datasets(), OBJECT_URL).select("object_url").distinct()
    found = documents.resolve(links, file_sinks.document_manifest(spark, path), OBJECT_URL)
    stored = found.filter("object_key IS NOT NULL").select("object_url", "object_key").distinct()
    lines = file_sinks.read_documents(spark, path).join(stored, "object_key")
    return lines.select("object_url", "place", "line")


@query
def minimal_files(spark: SparkSession, folder: str) -> DataFrame:
    """Minimal documents stored many to a file and found again by their keys; damaged pieces would show."""
    path = scratch_path(spark, "minimal")
    file_sinks.write_documents(documents.minimal_lines(_minimal(Tables(spark, folder))), path)
    damaged = file_sinks.damaged_documents(spark, path).select("object_key", F.lit(True).alias("damaged")).distinct()
    lines = file_sinks.read_documents(spark, path).join(damaged, "object_key", "left")
    return lines.select("object_key", "place", "line", F.coalesce("damaged", F.lit(False)).alias("damaged"))


@query
def document_links(spark: SparkSession, folder: str) -> DataFrame:
    return documents.document_links(Tables(spark, folder).datasets(), OBJECT_URL)


@query
def attachments(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return documents.attachments(
        t.dataset_items(), t.file_entities(), t.versioned_nodes(), t.versioned_files()
    ).drop("dataset_version", "dataset_collection")


def _minimal(t: Tables) -> DataFrame:
    rows = t.raw("part").select(
        F.when(F.col("p_size") != 13, F.concat(F.lit("syn"), F.col("p_partkey").cast("string"))).alias("id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("About "), "p_name")).alias("description"),
        F.when(F.col("p_size") > 20, F.col("p_brand")).alias("contributors"),
        F.when(F.col("p_size") > 30, F.lit("CC-0")).alias("license"),
    )
    return documents.minimal_documents(rows, ENTITY_URL, "Example Institute")


@query
def minimal_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _minimal(Tables(spark, folder)).select("object_key", "document")


# -- matrix ------------------------------------------------------------------


def _expression(t: Tables) -> tuple[DataFrame, DataFrame]:
    genes = t.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    rows = t.raw("lineitem").select("l_partkey", "l_suppkey", "l_extendedprice").join(genes, "l_partkey")
    target = F.concat(
        F.lit("T|G|H|V|L"), F.when(F.col("p_size") == 3, "").otherwise(F.concat(F.lit("|"), "p_brand", F.lit("|x")))
    )
    expression = rows.select(
        F.col("l_suppkey").alias("file_id"), target.alias("target_id"), F.col("l_extendedprice").alias("tpm")
    )
    mapping = t.raw("supplier").select(
        F.col("s_suppkey").alias("file_id"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("specimen"),
    )
    return expression, mapping


def _gene_tiles(t: Tables) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(t.spark, "tiles")
    matrix.write_gene_tiles(*_expression(t), path, width=8)
    return tiles.read_tiles(t.spark, path)


@query
def gene_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """The specimens' columns, put together from stored tiles."""
    stored, places = _gene_tiles(Tables(spark, folder))
    return tiles.selected(stored, places, matrix.GENE, "specimen", SPECIMENS)


@query
def gene_matrix_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The whole matrix as text, written and read back: headings once, every cell in its place."""
    stored, places = _gene_tiles(Tables(spark, folder))
    path = scratch_path(spark, "matrix")
    tiles.write_lines(tiles.lines(stored, places, matrix.GENE, "specimen"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def gene_matrix_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """The same matrix for known specimens in one step."""
    expression, mapping = _expression(Tables(spark, folder))
    return matrix.gene_matrix(expression, mapping, SPECIMENS)


@query
def gene_cells(spark: SparkSession, folder: str) -> DataFrame:
    expression, mapping = _expression(Tables(spark, folder))
    return matrix.expression_cells(expression, mapping)


@query
def arg_max(spark: SparkSession, folder: str) -> DataFrame:
    lines = Tables(spark, folder).raw("lineitem").select(
        "l_partkey", "l_extendedprice", "l_orderkey", "l_linenumber"
    )
    return ranking.arg_max(lines, ["l_partkey"], "l_extendedprice")


@query
def numbered(spark: SparkSession, folder: str) -> DataFrame:
    orders = Tables(spark, folder).raw("orders").select("o_orderkey", "o_totalprice")
    return ranking.numbered(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


# -- releases ----------------------------------------------------------------


def _release_names(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.date_format(d, "MM"), F.lit("."), F.day(d).cast("string"), F.lit("-consortium")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.date_format(d, "yy"), F.lit(".0-Public")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("v"), F.month(d).cast("string"), F.lit(".1-public")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.month(d).cast("string"), F.lit("_2-")))
        .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd")))
    )
    return t.raw("orders").select(F.col("o_orderkey"), name.alias("name"))


@query
def release_parse(spark: SparkSession, folder: str) -> DataFrame:
    rows = _release_names(Tables(spark, folder))
    return versions.parse_release(rows, "name", "p").select("o_orderkey", "name", "p.*")


@query
def cohort_version_parse(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("o_orderdate")
    version = F.concat(
        F.when(F.col("o_orderstatus") == "F", "Public_").when(F.col("o_orderstatus") == "O", "consortium_").otherwise("public_preview_"),
        F.date_format(d, "MM"), F.lit("_"), F.day(d).cast("string"),
    )
    rows = Tables(spark, folder).raw("orders").select("o_orderkey", version.alias("version"))
    return versions.parse_cohort_version(rows, "version", "p").select("o_orderkey", "version", "p.*")


@query
def release_paths(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(
        F.lit("Releases/Release "), F.lpad((F.col("p_size") - 1).cast("string"), 2, "0"),
        F.when(F.col("p_type") == "PROMO", "/extra").otherwise(""),
    )
    return Tables(spark, folder).raw("part").select(
        "p_partkey", path.alias("path"), versions.valid_release_path(path).alias("valid")
    )


@query
def release_store(spark: SparkSession, folder: str) -> DataFrame:
    """Stored releases after loading, loading again, and replacing one release."""
    rows = Tables(spark, folder).main_samples().select("SAMPLE_ID", "PATIENT_ID", "MAJOR_VERSION", "RELEASE")
    path = scratch_path(spark, "releases")
    first = rows.filter("MAJOR_VERSION < 2000")
    table_sinks.store_release(first, path, ["RELEASE"], overwrite_partition=False)
    # everything again: only releases that are not stored yet are added
    table_sinks.store_release(rows, path, ["RELEASE"], overwrite_partition=False)
    replaced = rows.filter("MAJOR_VERSION = 1996").withColumn("PATIENT_ID", F.lit("P"))
    table_sinks.store_release(replaced, path, ["RELEASE"], overwrite_partition=True)
    return spark.read.parquet(path).groupBy("RELEASE").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("PATIENT_ID").alias("n_patients")
    )


@query
def release_files_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """All customers delivered as folders of files whose columns differ, then ingested by cohort and release."""
    t = Tables(spark, folder)
    root = scratch_path(spark, "delivery")
    target = scratch_path(spark, "cohorts")
    customers = t.raw("customer")
    # cohort, version, columns in their order, segments
    deliveries = [
        ("brca", "public_01_2", ["record_id", "c_name", "cohort"], ["BUILDING", "MACHINERY"]),
        ("nsclc", "Consortium_2_1", ["c_acctbal", "record_id"], ["HOUSEHOLD"]),
        ("nsclc", "public_2_2", ["record_id", "c_name", "cohort"], ["FURNITURE"]),
        ("crc", "consortium_1_1", ["record_id"], ["AUTOMOBILE"]),
        ("crc", "public_preview_1_0", ["record_id"], ["AUTOMOBILE"]),
    ]
    specs = []
    for cohort, version, columns, segments in deliveries:
        place = f"{root}/{cohort}-{version}"
        kept = customers.filter(F.col("c_mktsegment").isin(segments)).withColumn("cohort", F.lit("x"))
        kept.withColumnRenamed("c_custkey", "record_id").select(*columns).write.option("header", True).csv(place)
        specs.append(delimited.ReleaseSpec(
            cohort, [place], "PANEL", version, ",", {"record_id": "bigint", "c_acctbal": "double"}, columns, folders=True
        ))
    ingest.ingest_cohorts(spark, specs, target, ingested_at=INGESTED_AT)
    stored = spark.read.parquet(target)
    return stored.select(
        "record_id", "c_name", "c_acctbal", "COHORT", "RELEASE", "RELEASE_TYPE", "MAJOR_VERSION", "MINOR_VERSION"
    )


@query
def main_release_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Orders delivered as release folders of quarters, then walked and stored by release, twice.

    Years that are not numbers become NULL.  Folders of old releases and files at other depths are left out.
    """
    root, target = scratch_path(spark, "releases-in"), scratch_path(spark, "main")
    orders = Tables(spark, folder).raw("orders")
    rows = orders.select(
        F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("SAMPLE_ID"),
        F.concat(F.lit('a "name", '), F.col("o_orderpriority")).alias("NOTE"),
        F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.year("o_orderdate").cast("string")).alias("YEAR"),
        F.quarter("o_orderdate").alias("quarter"),
    )
    file = "data_clinical_sample.txt"
    places = [(q, f"Releases/Release 17/17.{q}-{'public' if q % 2 else 'consortium'}") for q in range(1, 5)]
    for q, place in [*places, (1, "Releases/Release 05/5.1-public"), (2, "Releases/Release 18/deep/18.1-public"), (3, "Releases/Release 18")]:
        part = rows.filter(F.col("quarter") == q).drop("quarter")
        part.write.option("header", True).option("sep", "\t").option("escape", '"').csv(f"{root}/{place}/{file}")
    for overwrite in (False, False, True):
        ingest.ingest_walk(
            spark, root, target, ["SAMPLE_ID", "NOTE", "YEAR"], overwrite, {"YEAR": "int"}, ingested_at=INGESTED_AT
        )
    return spark.read.parquet(f"{target}/CLINICAL_SAMPLE").drop("INGESTED_AT")


@query
def project_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Customers delivered per market segment, two files each, one table per project; notes hold line breaks.

    The tables are written, left alone and replaced, and every project's rows come back.
    """
    root, target = scratch_path(spark, "projects-in"), scratch_path(spark, "projects")
    run = target.rsplit("-", 1)[-1]
    customers = Tables(spark, folder).raw("customer").select(
        "c_custkey", "c_name", F.concat(F.lit('line one\n"line two", '), F.col("c_mktsegment")).alias("note"), "c_mktsegment"
    )
    specs = []
    for segment in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]:
        files = [f"{root}/{segment}-{half}" for half in range(2)]
        for half, path in enumerate(files):
            part = customers.filter((F.col("c_mktsegment") == segment) & (F.col("c_custkey") % 2 == half))
            part.drop("c_mktsegment").write.option("header", True).option("escape", '"').csv(path)
        specs.append(delimited.ReleaseSpec(
            f"p_{run}_{segment.lower()}", files, "clinical", types={"c_custkey": "bigint"},
            columns=["c_custkey", "c_name", "note"], multi_line=True,
        ))
    for overwrite in (False, False, True):
        ingest.ingest_projects(spark, specs, overwrite, INGESTED_AT, strict=True, location=target)
    stored = [spark.table(f"{s.cohort}.{s.table}") for s in specs]
    segment = F.upper(F.substring_index("RELEASE", "_", -1))
    return ranking.stack(*stored).select("c_custkey", "c_name", "note", segment.alias("project"))


@query
def release_file_choice(spark: SparkSession, folder: str) -> DataFrame:
    name = (
        F.when(F.col("p_type") == "PROMO", "data_clinical_sample.txt")
        .when(F.col("p_type") == "ECONOMY", "meta_clinical_sample.txt")
        .when(F.col("p_type") == "LARGE", "cancer_panel_test_level_dataset.csv")
        .otherwise("data_CNA.txt")
    )
    listing = Tables(spark, folder).raw("part").select(F.col("p_partkey").alias("id"), name.alias("name"))
    allow = {**delimited.PORTAL_FILES, **delimited.CLINICAL_FILES, "meta_clinical_sample.txt": "NEVER"}
    return delimited.select_release_files(listing, allow, delimited.PORTAL_EXCLUDED)


@query
def recent_files(spark: SparkSession, folder: str) -> DataFrame:
    suffix = F.when(F.col("o_orderstatus") == "F", "_manifest.csv").otherwise(".csv")
    listing = Tables(spark, folder).raw("orders").select(
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), suffix).alias("name"),
        F.col("o_orderdate").alias("modified"),
    )
    found = delimited.recent_files(listing, "_manifest.csv", RUN_ASOF, hours=48)
    return found.select("name", F.date_format("modified", "yyyy-MM-dd").alias("modified"))


# -- tables ------------------------------------------------------------------


@query
def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Parts updated from line items: dearer ones get a new price, unknown ids are added."""
    t = Tables(spark, folder)
    target = t.raw("part").filter("p_size <= 40").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    source = t.raw("lineitem").filter("l_quantity >= 45").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.max("l_extendedprice").alias("p_retailprice")
    ).withColumn("p_brand", F.lit(None).cast("string"))
    return table_sinks.merge_upsert(target, source, "p_partkey")


@query
def merge_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders stored by year, with the orders of two years changed and a year added in place, twice.

    ``kept`` tells that a row lies in a file that the merge has not written.
    """
    orders = Tables(spark, folder).raw("orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("year")
    )
    path = scratch_path(spark, "merged")
    table_sinks.replace_partition(orders.filter("year <> 1999"), path, ["year"])
    before = cut_lineage(spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file")).distinct())
    change = orders.filter("(year IN (1996, 1997) AND o_orderkey % 2 = 0) OR year = 1999")
    change = change.select("o_orderkey", "year", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice") + 1).alias("o_totalprice"))
    for _ in range(2):
        table_sinks.merge_partitions(change, path, ["o_orderkey", "year"], ["year"])
    now = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"))
    return joins.membership_flag(now, before, ["file"], "kept").drop("file")


@query
def snapshot_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two daily snapshots, the second one taken twice."""
    t = Tables(spark, folder)
    counts = t.raw("supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "snapshots")
    table_sinks.append_snapshot(counts, path, date(2024, 1, 1))
    table_sinks.append_snapshot(counts.filter("s_nationkey < 5"), path, date(2024, 1, 2))
    table_sinks.append_snapshot(counts, path, date(2024, 1, 2))
    return spark.read.parquet(path).select("s_nationkey", "n", F.date_format("export_date", "yyyy-MM-dd").alias("export_date"))


@query
def table_save_rules(spark: SparkSession, folder: str) -> DataFrame:
    """A table is created once, left alone, and replaced only when asked to."""
    nation = Tables(spark, folder).raw("nation").select("n_nationkey", "n_name")
    path = scratch_path(spark, "saved")
    name = "granary_" + path.rsplit("-", 1)[-1]
    table_sinks.save_table(nation, name, path=path)
    table_sinks.save_table(nation.filter("n_nationkey < 0"), name, path=path)
    table_sinks.save_table(filters.standardize_columns(nation), name, overwrite=True, path=path)
    table_sinks.append(spark.table(name).filter("N_NATIONKEY < 5"), name, path=path)
    return spark.table(name).groupBy("N_NATIONKEY").agg(
        F.count(F.lit(1)).alias("n"), F.max("N_NAME").alias("n_name")
    ).withColumnRenamed("N_NATIONKEY", "n_nationkey")


@query
def refreshed_export(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per written file never exceed the limit."""
    path = scratch_path(spark, "export")
    orders = Tables(spark, folder).raw("orders").select("o_orderkey")
    table_sinks.refresh_and_export(orders, path, rows_per_file=50_000)
    per_file = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"), "o_orderkey"
    ).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 50_000).alias("within_limit"))


@query
def standard_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = Tables(spark, folder).raw("supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("grant"), F.col("s_nationkey").alias("group")
    )
    return filters.standardize_columns(rows)


# -- intake ------------------------------------------------------------------


@query
def new_submissions(spark: SparkSession, folder: str) -> DataFrame:
    """Open orders that none of the last six order days has taken on."""
    orders = Tables(spark, folder).raw("orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    queue = orders.select(
        F.col("o_orderkey").alias("submission_id"),
        F.when(F.col("o_orderstatus") == "O", intake.RECEIVED).otherwise("CLOSED").alias("status"),
    )
    history = orders.select(
        day.alias("run_id"),
        F.when(F.day("o_orderdate") % 2 == 0, "failed").otherwise("success").alias("state"),
        F.col("o_orderdate").alias("start_date"),
    ).distinct()
    taken = orders.select(day.alias("run_id"), F.col("o_orderkey").alias("submission_id"))
    return intake.in_progress(intake.submission_intake(queue, history, taken))


@query
def submission_manifest(spark: SparkSession, folder: str) -> DataFrame:
    orders = Tables(spark, folder).raw("orders").filter("o_orderstatus = 'O'").select("o_orderkey")
    path = file_sinks.write_manifest(orders, scratch_path(spark, "runs"), "run-1")
    rows = spark.read.schema("submission_id bigint").option("header", True).csv(path)
    return rows.agg(F.count("submission_id").alias("n"), F.sum("submission_id").alias("id_sum"))


@query
def samplesheet_rename(spark: SparkSession, folder: str) -> DataFrame:
    rows = Tables(spark, folder).raw("pages").select(
        "page_id",
        F.concat("url", F.lit("/reads_1.fastq.gz")).alias("bam"),
        F.concat(F.lit("a_2.b_1."), F.col("page_id").cast("string")).alias("bai"),
    )
    renamed = intake.prepare_samplesheet(rows, ["bam", "bai"])
    return renamed


@query
def object_renames(spark: SparkSession, folder: str) -> DataFrame:
    key = F.concat(
        F.lit("staging/x/"), F.when(F.col("p_type") == "PROMO", "other").otherwise("syn"),
        F.col("p_partkey").cast("string"), F.lit("/SRR"), F.col("p_size").cast("string"),
        F.when(F.col("p_size") % 2 == 0, "_1.fastq.gz").when(F.col("p_size") % 3 == 0, "_2.fastq.gz").otherwise("_3.fastq.gz"),
    )
    return intake.object_renames(Tables(spark, folder).raw("part").select(key.alias("key")), "staging/x/")


@query
def headerless_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Headerless sheet converted to CSV with the fixed header and read back."""
    rows = Tables(spark, folder).raw("supplier").select(
        F.col("s_suppkey").alias("a"), F.lit("XX").alias("b"), F.col("s_nationkey").alias("c"),
        F.col("s_name").alias("d"), F.concat("s_name", F.lit(".bam")).alias("e"), F.concat("s_name", F.lit(".bai")).alias("f"),
    )
    source, target = scratch_path(spark, "sheet"), scratch_path(spark, "sheet")
    rows.write.option("sep", "\t").csv(source)
    intake.convert_samplesheet(spark, source, target)
    return delimited.read_delimited(spark, target, comment=None, same_header=True)


@query
def empty_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of which nothing was delivered in the month."""
    t = Tables(spark, folder)
    delivered = filters.in_month(t.raw("lineitem"), "l_shipdate", MONTH).select(
        F.col("l_partkey").alias("source")
    )
    return quality.empty_sources(t.raw("part").select(F.col("p_partkey").alias("source")), delivered, "source")


# -- expressions -------------------------------------------------------------


@query
def size_texts(spark: SparkSession, folder: str) -> DataFrame:
    size = F.when(F.col("p_size") == 5, 0).otherwise(F.round(F.col("p_retailprice") * 1e7).cast("long"))
    return Tables(spark, folder).raw("part").select("p_partkey", text.size_text(size).alias("size"))


@query
def quoted_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = F.concat("p_name", F.lit(" ~*/é+&"), "p_brand")
    return Tables(spark, folder).raw("part").select("p_partkey", text.quote_plus(key).alias("quoted"))


@query
def week_labels(spark: SparkSession, folder: str) -> DataFrame:
    days = Tables(spark, folder).raw("orders").select("o_orderdate").distinct()
    return days.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        dates.year_week_label(F.col("o_orderdate")).alias("week"),
        dates.month_label(F.col("o_orderdate")).alias("month"),
    )


# -- streams -----------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/events.parquet"
    stream = jobs.stream_folder(spark, path, spark.read.parquet(path).schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _daily_log(spark: SparkSession, folder: str) -> DataFrame:
    counts = jobs.usage(_event_stream(spark, folder), "1 day", watermark="2 days")
    log, checkpoint = scratch_path(spark, "usage"), scratch_path(spark, "usage-checkpoint")
    jobs.run_available(counts, jobs.batch_log(log), checkpoint, "update")
    return jobs.latest_of_log(spark.read.parquet(log), ["window", "user_id"])


@query
def stream_usage_daily(spark: SparkSession, folder: str) -> DataFrame:
    report = jobs.usage_report(_daily_log(spark, folder))
    return report.select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"), "events", "unique_users"
    )


@query
def stream_usage_sliding(spark: SparkSession, folder: str) -> DataFrame:
    report = jobs.sliding_report(_daily_log(spark, folder), 7)
    return report.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "events", "unique_users")


def _landed(spark: SparkSession, rows: DataFrame, parts: int, label: str) -> str:
    """Events as a folder of ``parts`` files that arrive one after another, dealt by event id."""
    path = scratch_path(spark, label)
    for k in range(parts):
        part = rows.filter(F.col("event_id") % parts == k)
        part.repartition(1).write.mode("append").parquet(path)
    return path


@query
def stream_usage_late(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per day from four batches, and the events that came too late to be counted."""
    events = Tables(spark, folder).raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
    path, log = _landed(spark, events, 4, "late-source"), scratch_path(spark, "late")
    stream = jobs.stream_folder(spark, path, events.schema, files_per_batch=1)
    jobs.run_available(stream, jobs.usage_with_late(log, "1 day", "10 days"), scratch_path(spark, "late-checkpoint"))
    counts = jobs.usage_report(spark.read.parquet(f"{log}/counts"))
    late = spark.read.parquet(f"{log}/late").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("late"))
    counts = counts.select(F.to_date("window.start").alias("day"), "events", "unique_users")
    both = counts.join(late, "day", "full").fillna(0, ["events", "unique_users", "late"])
    return both.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "events", "unique_users", "late")


@query
def stream_intake_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Submissions taken on by nine runs, each id at most once in seven runs; the last run is repeated."""
    events = Tables(spark, folder).raw("events").select(
        "event_id", F.col("user_id").alias("submission_id"),
        F.when(F.col("event_type") == "signup", intake.RECEIVED).otherwise("CLOSED").alias("status"),
    )
    path, log = _landed(spark, events, 9, "queue"), scratch_path(spark, "taken")
    stream = jobs.stream_folder(spark, path, events.schema, files_per_batch=1)
    write = jobs.take_on(log)
    jobs.run_available(stream, write, scratch_path(spark, "queue-checkpoint"))
    write(events.filter("event_id % 9 = 8"), 8)
    return spark.read.parquet(log).select("submission_id", F.col("batch_id").cast("long").alias("run"))


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    queue = _event_stream(spark, folder).select(
        F.col("user_id").alias("submission_id"), "ts",
        F.when(F.col("event_type") == "signup", intake.RECEIVED).otherwise("CLOSED").alias("status"),
    )
    log, checkpoint = scratch_path(spark, "intake"), scratch_path(spark, "intake-checkpoint")
    jobs.run_available(jobs.new_submissions(queue, "60 days"), jobs.batch_log(log), checkpoint)
    return spark.read.parquet(log).select("submission_id")


@query
def stream_messages(spark: SparkSession, folder: str) -> DataFrame:
    queue = _event_stream(spark, folder).select(
        F.col("event_id").cast("string").alias("MessageId"),
        F.concat(F.lit('{"objectId":"syn'), F.col("event_id").cast("string"), F.lit('"}')).alias("Body"),
    )
    log, checkpoint = scratch_path(spark, "messages"), scratch_path(spark, "messages-checkpoint")
    jobs.run_available(jobs.message_lines(queue, ENTITY_URL), jobs.batch_log(log), checkpoint)
    return spark.read.parquet(log).select("id", "body")


@query
def stream_status(spark: SparkSession, folder: str) -> DataFrame:
    """Latest status of every user after signups have been taken into evaluation."""
    queue = _event_stream(spark, folder).select(
        F.col("user_id").alias("submission_id"), "ts",
        F.when(F.col("event_type") == "signup", intake.RECEIVED).otherwise("CLOSED").alias("status"),
    )
    log, checkpoint = scratch_path(spark, "status"), scratch_path(spark, "status-checkpoint")
    jobs.run_available(jobs.status_transitions(queue), jobs.batch_log(log), checkpoint)
    t = Tables(spark, folder)
    closed = t.raw("events").filter("event_type != 'signup'").select(
        F.col("user_id").alias("submission_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.lit("CLOSED").alias("status"),
    )
    return jobs.current_status(ranking.stack(spark.read.parquet(log), closed))
