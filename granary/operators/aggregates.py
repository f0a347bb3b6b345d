"""Aggregations.

Heavy inputs are collapsed map-side before anything else is shuffled.  Exact
distinct counts keep the counted value in the grouping key of the first
shuffle, so that one project or month holding most rows is spread over many
tasks and only its per-task counts meet in the end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from granary.functions import dates
from granary.operators import filters, joins

COLLAPSED = ("n_rows", "n_dated")


def collapse_downloads(events: DataFrame) -> DataFrame:
    """One row per (project, file, user) with its number of events.

    Everything the leaderboards report can be computed from this, and repeated
    downloads shrink before the file join sees them.
    """
    return events.groupBy("project_id", "file_handle_id", "user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("record_date").alias("n_dated")
    )


def download_stats(df: DataFrame, keys: Sequence[str], approx: bool = False) -> DataFrame:
    """Downloads, unique users, unique files and bytes per key.

    ``df`` holds single events or rows of ``collapse_downloads`` with the file
    size attached.  ``approx`` swaps the exact distinct counts for sketches.
    """
    collapsed = all(c in df.columns for c in COLLAPSED)
    rows = F.col("n_rows") if collapsed else F.lit(1)
    dated = F.sum("n_dated") if collapsed else F.count("record_date")
    distinct = F.approx_count_distinct if approx else F.countDistinct
    size = F.sum(F.col("content_size") * rows)
    return df.groupBy(*keys).agg(
        dated.cast("long").alias("downloads_per_project"),
        distinct("user_id").alias("number_of_unique_users_downloaded"),
        distinct("file_handle_id").alias("number_of_unique_files_downloaded"),
        F.coalesce(size, F.lit(0)).alias("data_download_size"),
    )


def group_download_stats(df: DataFrame, keys: Sequence[str], approx: bool = False) -> DataFrame:
    """As ``download_stats``, plus the number of projects with any download.

    The project count is folded in a second, small step: the first step groups
    by project as well and is needed for the other sums anyway.
    """
    distinct = F.approx_count_distinct if approx else F.countDistinct
    collapsed = all(c in df.columns for c in COLLAPSED)
    rows = F.col("n_rows") if collapsed else F.lit(1)
    dated = F.sum("n_dated") if collapsed else F.count("record_date")
    size = F.sum(F.col("content_size") * rows)
    return df.groupBy(*keys).agg(
        distinct("project_id").alias("projects_with_downloads"),
        dated.cast("long").alias("downloads_per_project"),
        distinct("user_id").alias("number_of_unique_users_downloaded"),
        distinct("file_handle_id").alias("number_of_unique_files_downloaded"),
        F.coalesce(size, F.lit(0)).alias("data_download_size"),
    )


def group_project_count(members: DataFrame, keys: Sequence[str]) -> DataFrame:
    return members.groupBy(*keys).agg(F.countDistinct("project_id").alias("total_projects"))


def monthly_active_users(events: DataFrame, month: date | str, ts: str = "record_date") -> DataFrame:
    rows = filters.in_month(events, ts, month)
    return rows.agg(F.countDistinct("user_id").alias("distinct_user_count"))


def monthly_downloads(events: DataFrame, month: date | str, ts: str = "record_date") -> DataFrame:
    rows = filters.in_month(events, ts, month)
    return rows.agg(F.count(F.lit(1)).alias("downloads_last_month"))


def total_size(files: DataFrame, power: int = 50, name: str = "size_in_petabytes") -> DataFrame:
    """Sum of file sizes in a binary unit; the byte sum stays an exact integer."""
    total = F.sum("content_size")
    return files.agg((total.cast("double") / F.lit(float(2**power))).alias(name))


def project_size_gib(nodes: DataFrame, files: DataFrame, keys: Sequence[str] = ("project_id",)) -> DataFrame:
    """Size of each project in GiB from the files its nodes point at."""
    sized = joins.nodes_with_files(nodes, files)
    total = F.sum("content_size").cast("double")
    return sized.groupBy(*keys).agg(
        (total / F.lit(float(1024**3))).alias("estimated_project_size_in_gib")
    )


def last_event_text(day: Column) -> Column:
    """Latest date as ISO text, ``N/A`` when there is none (an aggregate)."""
    return F.coalesce(F.date_format(F.max(day), "yyyy-MM-dd"), F.lit("N/A"))


def membership_wide(
    pairs: DataFrame,
    keys: Sequence[str],
    kind: str,
    release: str,
    flags: Mapping[str, str],
    names: Mapping[str, str],
) -> DataFrame:
    """Long membership rows to one row per key with flag and release-name columns.

    ``flags`` and ``names`` map an output column to the membership kind it shows.
    """
    is_kind = {k: F.col(kind) == k for k in {*flags.values(), *names.values()}}
    columns = [
        F.coalesce(F.bool_or(is_kind[k]), F.lit(False)).alias(column) for column, k in flags.items()
    ]
    columns += [
        F.max(F.when(is_kind[k], F.col(release))).alias(column) for column, k in names.items()
    ]
    return pairs.groupBy(*keys).agg(*columns)


def matrix_columns(df: DataFrame, col: str, max_columns: int) -> list:
    """The column values of a matrix, found in one pass; more than the bound is an error."""
    found = [r[0] for r in df.select(col).dropna().distinct().limit(max_columns + 1).collect()]
    if len(found) > max_columns:
        raise ValueError(
            f"more than {max_columns} columns in {col!r}; use matrix_cells for the long form"
        )
    return sorted(found)


def matrix_cells(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """Long form of the matrix: the largest value per row and column.

    Not-a-number is treated as missing, so it never wins over a number.
    """
    number = F.nanvl(F.col(value), F.lit(None).cast("double"))
    cells = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    return cells.groupBy(row, col).agg(F.max(number).alias(value))


def sample_matrix(
    df: DataFrame,
    row: str,
    col: str,
    value: str,
    values: Sequence | None = None,
    max_columns: int = 10_000,
) -> DataFrame:
    """One row per ``row`` and one column per ``col`` value, holding the largest value.

    This is the full outer merge of all samples by row, done with one shuffle
    instead of a chain of joins.  Pass ``values`` to skip the discovery pass.
    """
    if values is None:
        values = matrix_columns(df, col, max_columns)
    cells = matrix_cells(df, row, col, value)
    return cells.groupBy(row).pivot(col, list(values)).agg(F.first(value, ignorenulls=True))


def runs_per_group(runs: DataFrame, group: str, total: str = "total_runs") -> DataFrame:
    return runs.groupBy(group).agg(F.count(F.lit(1)).alias(total))


def share_within(
    counts: DataFrame, n: str, group: Sequence[str] = (), name: str = "percentage", digits: int | None = None
) -> DataFrame:
    """Percentage of each (already aggregated) count within its group, or overall.

    The totals come from an aggregate joined back rather than from a window,
    so no group has to fit one task.
    """
    def share(total: Column) -> Column:
        value = F.try_divide(F.col(n), total) * 100
        return value if digits is None else F.round(value, digits)

    if not group:
        total = counts.agg(F.sum(n)).scalar()
        return counts.withColumn(name, share(total))
    totals = counts.groupBy(*group).agg(F.sum(n).alias("_total"))
    joined = counts.join(totals, list(group))
    return joined.withColumn(name, share(F.col("_total"))).drop("_total")


def mean_runs(runs: DataFrame, label: Column, name: str, digits: int = 2) -> DataFrame:
    """Average number of rows per label."""
    per_label = runs.groupBy(label.alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    return per_label.agg(F.round(F.avg("_n"), digits).alias(name))


def breakdown(
    runs: DataFrame, column: str, n: str, since: datetime, until: datetime, ts: str = "date_created"
) -> DataFrame:
    """Completed runs per value of ``column`` with their share of all, largest first."""
    closed = filters.closed_between(runs, ts, since, until)
    counts = runs_per_group(closed, column, n)
    return share_within(counts, n, digits=2).orderBy(F.desc("percentage"), F.asc(column))


def users_total(users: DataFrame) -> DataFrame:
    return users.agg(F.count(F.lit(1)).alias("total_users"))


def users_active(runs: DataFrame, since: datetime, until: datetime, ts: str = "date_created") -> DataFrame:
    rows = filters.between(runs, ts, since, until)
    return rows.agg(F.countDistinct("user_name").alias("users_past_month"))


def totals_per(df: DataFrame, by: str, metrics: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.sum(m).alias(m) for m in metrics])


def count_by(df: DataFrame, by: str, name: str = "n") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def union_keys(df: DataFrame, map_col: str, by: Sequence[str]) -> DataFrame:
    """Distinct keys of a map column per group, one row each."""
    return df.select(*by, F.explode(F.map_keys(map_col)).alias("key")).distinct()


def distinct_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct key tuples without missing members."""
    return df.select(*columns).dropna().distinct()


def join_annotations(
    stored: DataFrame, items: DataFrame, key: str, fields: Sequence[str]
) -> DataFrame:
    """Annotation rows for stored entities, matched by key; lists become one text."""
    kinds = dict(items.dtypes)
    columns = [
        (F.array_join(f, ", ") if kinds[f].startswith("array") else F.col(f)).alias(f)
        for f in fields
    ]
    return stored.select("id", key).join(items.select(*columns), key).select("id", *fields)
