"""Tables and operational databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def scan_latest(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A snapshot or event table, by catalogue name or as parquet below ``folder``."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def jdbc_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a database read; with a partition column it is read in parallel."""
    options = {"url": url, "fetchsize": str(fetch_size), **(extra or {})}
    if partition_column is None:
        return {**options, "query": query}
    if bounds is None or partitions is None:
        raise ValueError("a partitioned read needs bounds and a number of partitions")
    return {
        **options,
        "dbtable": f"({query}) report",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_jdbc_report(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """A report query run on an operational database, as a frame with its own column names."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()
