"""Latest versions, duplicates, top lists, numbering, stacking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.session import cut_lineage


def _versions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct complete versions with a mark.

    The mark is used further up on purpose: without it the optimizer drops
    this step as redundant below a maximum, and the maximum of a struct would
    sort every row instead of hashing it.  Being a maximum itself, it still
    lets outer joins that only add columns drop out.
    """
    return df.select(*columns).dropna().groupBy(*columns).agg(F.max(F.lit(1)).alias("_seen"))


def latest_by(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The highest version per key.

    Versions are made distinct first (hash aggregation, combined map-side), so
    a key holding most of the rows contributes a handful of rows to the rest.
    """
    top = _versions(df, [*keys, *order_cols]).groupBy(*keys).agg(
        F.max(F.struct(*order_cols)).alias("_top"), F.max("_seen").alias("_seen")
    )
    return top.filter("_seen = 1").select(*keys, *[F.col("_top")[c].alias(c) for c in order_cols])


def latest_global(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """The single highest version, as one row; no row for an empty table."""
    top = _versions(df, order_cols).agg(
        F.max(F.struct(*order_cols)).alias("_top"), F.max("_seen").alias("_seen")
    )
    return top.filter("_seen = 1").select(*[F.col("_top")[c].alias(c) for c in order_cols])


def _digest(keys: Sequence[str]) -> Column:
    """Fixed-length stand-in for long key values; missing members stay distinct from empty ones."""
    return F.sha2(F.to_json(F.array(*[F.col(k).cast("string") for k in keys])), 256)


def duplicate_rows(df: DataFrame, keys: Sequence[str], long_keys: bool = False) -> DataFrame:
    """Every row whose key occurs more than once (all members of the group).

    Counting combines map-side, and only the keys that repeat take part in the
    semi join; its probe side may be split when one key is hot.  With
    ``long_keys`` a digest stands in for whole texts in both shuffles.
    """
    if long_keys:
        marked = df.withColumn("_digest", _digest(keys))
        repeated = marked.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        return marked.join(repeated.select("_digest"), "_digest", "left_semi").drop("_digest")
    renamed = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    repeated = df.groupBy(*renamed).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)],
    )
    return df.join(repeated, same, "left_semi")


def arg_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The whole row with the largest value per key; equal values fall back to the other columns, largest first.

    The largest value is a hash aggregate (for values of fixed size), and a join back finds its rows.  Only these,
    and of each task only the first per key, are sorted to settle ties.  A missing key is a key of its own.
    """
    rest = [c for c in df.columns if c not in keys and c != value]
    rows = df.filter(F.col(value).isNotNull())
    top = rows.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.max(value).alias("_top"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    best = rows.join(top, same & (F.col(value) == F.col("_top"))).select(*keys, value, *rest)
    order = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in rest or [value]])
    return best.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def rank_desc(df: DataFrame, column: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sorted by a column, largest first, missing last."""
    return df.orderBy(F.col(column).desc_nulls_last(), *[F.asc(t) for t in tiebreak])


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows in order; planned as a per-task top list and one merge."""
    return df.orderBy(*order).limit(n)


def numbered_top(df: DataFrame, n: int, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """The first ``n`` rows with their rank; the window only ever sees ``n`` rows."""
    window = Window.orderBy(*order)
    return top_n(df, n, order).withColumn(name, F.row_number().over(window))


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rank", start: int = 1) -> DataFrame:
    """Consecutive numbers over all rows in the given order, without one big window.

    Rows are range-partitioned and sorted; each task numbers its own rows, and
    the task offsets come from a running sum over one row per task.  A hash of
    the row is the last sort key, so rows that tie do not all meet in one task.
    The sorted rows are checkpointed in between, so that both reads see the
    same ranges.
    """
    hashable = [f"`{c}`" for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    keys = [*order, F.xxhash64(*hashable)]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = cut_lineage(placed)
    sizes = placed.groupBy("_task").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_task", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    rows = placed.join(offsets, "_task")
    number = F.col("_before") + F.col("_place") - F.col("_first") + F.lit(start)
    return rows.withColumn(name, number).drop("_task", "_place", "_first", "_before")


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_distinct(*frames: DataFrame) -> DataFrame:
    return stack(*frames).distinct()
