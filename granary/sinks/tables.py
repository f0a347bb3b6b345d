"""Table maintenance on plain partitioned tables and folders."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from granary.operators.quality import check_options

WRITE_OPTIONS = ("format", "partition_by", "max_records_per_file", "compression", "path")


def _writer(df: DataFrame, options: dict):
    check_options(options, WRITE_OPTIONS)
    writer = df.write.format(options.get("format", "parquet"))
    if options.get("partition_by"):
        writer = writer.partitionBy(*options["partition_by"])
    if options.get("max_records_per_file"):
        writer = writer.option("maxRecordsPerFile", options["max_records_per_file"])
    for name in ("compression", "path"):
        if options.get(name):
            writer = writer.option(name, options[name])
    return writer


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def partition_exists(df: DataFrame, **values: object) -> bool:
    """Whether any row has these partition values; stops at the first one.

    Text is compared in upper case, the way partition values are written.
    """
    conditions: list[Column] = []
    for name, value in values.items():
        column = F.col(name)
        if isinstance(value, str):
            column, value = F.upper(column), value.upper()
        conditions.append(column == F.lit(value))
    return not df.filter(reduce(lambda a, b: a & b, conditions)).isEmpty()


def save_table(df: DataFrame, name: str, overwrite: bool = False, **options) -> bool:
    """Create the table, overwrite it, or skip when it exists; True when rows were written."""
    check_options(options, WRITE_OPTIONS)
    if table_exists(df.sparkSession, name) and not overwrite:
        return False
    _writer(df, options).mode("overwrite" if overwrite else "errorifexists").saveAsTable(name)
    return True


def overwrite_table(df: DataFrame, name: str, **options) -> None:
    """Full refresh."""
    _writer(df, options).mode("overwrite").saveAsTable(name)


def append(df: DataFrame, name: str, **options) -> None:
    """Append, creating the table on first use; failures are raised."""
    _writer(df, options).mode("append").saveAsTable(name)


def by_partition(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lay rows out by partition for writing.

    Rebalancing keeps every task from writing a file into every partition;
    adaptive execution merges small partitions and splits one that holds a
    large part of the rows over several tasks.
    """
    return df.hint("rebalance", *keys)


def replace_partition(
    df: DataFrame, path: str, keys: Sequence[str], finish: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Replace exactly the partitions that occur in ``df``; others stay as they are."""
    (
        by_partition(finish(df) if finish else df, keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def stored_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What is stored below ``path``, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _existing_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame | None:
    spark = df.sparkSession
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        return None
    # only partition columns are read, so no data pages are touched
    kinds = dict(df.dtypes)
    return stored.select(*[F.col(k).cast(kinds[k]).alias(k) for k in keys]).distinct()


def missing_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Rows whose partition is not stored yet: one anti join, whatever the number of stored partitions."""
    existing = _existing_partitions(df, path, keys)
    return df if existing is None else df.join(existing, list(keys), "left_anti")


def append_missing_partitions(
    df: DataFrame, path: str, keys: Sequence[str], finish: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Append partitions that are not stored yet and skip the others."""
    rows = missing_partitions(df, path, keys)
    by_partition(finish(rows) if finish else rows, keys).write.mode("append").partitionBy(*keys).parquet(path)


def store_release(
    df: DataFrame, path: str, keys: Sequence[str], overwrite_partition: bool,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """The one rule for all release families: replace, or append what is missing.

    ``finish`` is applied to the rows that are about to be written, for checks that skipped rows need not pass.
    """
    write = replace_partition if overwrite_partition else append_missing_partitions
    write(df, path, keys, finish)


def refresh_and_export(df: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Replace everything, in files of at most ``rows_per_file`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def stamped(df: DataFrame, day: date, name: str = "export_date") -> DataFrame:
    return df.withColumn(name, F.lit(day).cast("date"))


def append_snapshot(df: DataFrame, path: str, day: date, name: str = "export_date") -> None:
    """Store the rows as the snapshot of one day; running a day again replaces that day."""
    (
        stamped(df, day, name)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )


def _once(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, failing the job that reads them if a complete key occurs twice, as MERGE would.

    The check is an aggregate on the keys alone; its one number guards the first key column.
    """
    most = source.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).scalar()
    message = F.lit(f"several source rows for one key ({', '.join(keys)})")
    kind = dict(source.dtypes)[keys[0]]
    guarded = F.when(most > 1, F.raise_error(message).cast(kind)).otherwise(F.col(keys[0]))
    return source.withColumn(keys[0], guarded)


def merge_upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """New version of the target: matched rows take all source columns, new rows are added.

    Presence flags decide, so that a NULL in a matched source row overwrites.  Incomplete keys match nothing; a
    complete key that the source repeats fails the job.  Write the result to a new path, or see ``merge_partitions``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in target.columns if c not in keys]
    extra = [c for c in source.columns if c not in keys and c not in values]
    if extra:
        raise ValueError(f"source has columns the target lacks: {extra}")
    source = _once(source, keys)
    old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in values], F.lit(True).alias("_in_old"))
    new = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in source.columns if c not in keys],
        F.lit(True).alias("_in_new"),
    )
    merged = old.join(new, keys, "full")

    def column(c: str) -> Column:
        if c not in source.columns:
            return F.col(f"_old_{c}").alias(c)
        return F.when(F.col("_in_new"), F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c)

    chosen = {c: column(c) for c in values}
    return merged.select(*[F.col(c) if c in keys else chosen[c] for c in target.columns])


def touched_partitions(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows in partitions that the source has rows for.

    A semi join on the partition columns; where the source's partitions are few enough to be broadcast, it prunes the
    scan of the target.  The filter on the count marks that side as selective, which pruning asks for.
    """
    touched = source.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0")
    return target.join(touched, list(partition_by), "left_semi")


def merge_partitions(source: DataFrame, path: str, key: str | Sequence[str], partition_by: Sequence[str]) -> None:
    """Upsert into a stored partitioned table in place, rewriting the partitions the source touches and no other.

    The partition columns belong to the key, so a row never moves to another partition.  Files are replaced when the
    whole job has succeeded, and merging the same source again changes nothing, so a lost job is run again.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not set(partition_by) <= set(keys):
        raise ValueError(f"the partition columns {list(partition_by)} have to be part of the key {keys}")
    stored = source.sparkSession.read.parquet(path)
    kinds = dict(stored.dtypes)
    source = source.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in source.columns])
    merged = merge_upsert(touched_partitions(stored, source, partition_by), source, keys)
    replace_partition(merged, path, partition_by)


def upsert_actions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """What an upsert would do with every source row: insert, update or unchanged."""
    old = target.select(*keys, F.col(value).alias("_old"), F.lit(True).alias("_in_old"))
    joined = source.select(*keys, value).join(old, list(keys), "left")
    action = (
        F.when(F.col("_in_old").isNull(), F.lit("insert"))
        .when(F.col("_old").eqNullSafe(F.col(value)), F.lit("unchanged"))
        .otherwise(F.lit("update"))
    )
    return joined.select(*keys, value, action.alias("action"))


def apply_upsert(target: DataFrame, actions: DataFrame, keys: Sequence[str], path: str, apply: bool = False) -> DataFrame:
    """Carry out the inserts and updates into a new path; without ``apply`` only report them."""
    changes = actions.filter("action != 'unchanged'")
    if apply:
        merge_upsert(target, changes.drop("action"), keys).write.mode("overwrite").parquet(path)
    return changes


def delete_rows(target: DataFrame, stale: DataFrame, keys: Sequence[str], path: str, apply: bool = False) -> DataFrame:
    """Write the target without the stale rows to a new path; without ``apply`` only report them."""
    if apply:
        target.join(stale.select(*keys), list(keys), "left_anti").write.mode("overwrite").parquet(path)
    return stale
