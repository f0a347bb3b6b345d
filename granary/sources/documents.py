"""Landed JSON: API pages, records, ignore lists, queue messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_pages(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One row per landed page document (one JSON document per file or per line group)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def last_page(
    pages: DataFrame, page: str, size: Column, page_size: int, feed: Sequence[str] = (),
    total: Column | None = None, first_page: int = 1,
) -> DataFrame:
    """Number of the last page a reader of the feed would have fetched.

    Fetching ends at the first page shorter than ``page_size``, or once the
    announced total is reached.  A feed with neither has no last page and
    therefore no row here.
    """
    ends = size < page_size
    if total is not None:
        ends = ends | ((F.col(page) - F.lit(first_page) + 1) * page_size >= total)
    closing = pages.filter(ends)
    return closing.groupBy(*feed).agg(F.min(page).alias("_last")) if feed else closing.agg(
        F.min(page).alias("_last")
    )


def flatten_pages(
    pages: DataFrame,
    items: str,
    page: str,
    page_size: int,
    feed: Sequence[str] = (),
    total: str | None = None,
    first_page: int = 1,
) -> DataFrame:
    """Page documents to record rows (feed, page, position, record).

    ``items`` names the array of records.  Pages after the end of the feed are
    dropped.  The end of each feed is one small aggregate, not a window over
    all its pages.
    """
    size = F.coalesce(F.size(items), F.lit(0))
    last = last_page(
        pages, page, size, page_size, feed, F.col(total) if total else None, first_page
    )
    if feed:
        kept = pages.join(last, list(feed), "left").filter(
            F.col("_last").isNull() | (F.col(page) <= F.col("_last"))
        )
    else:
        end = last.scalar()
        kept = pages.filter(end.isNull() | (F.col(page) <= end))
    return kept.select(
        *feed, F.col(page).alias("page"), F.posexplode(items).alias("position", "record")
    )


def record_index(page_size: int, first_page: int = 1) -> Column:
    """0-based index of a record in its feed; every page before the last is full."""
    return (F.col("page") - F.lit(first_page)) * F.lit(page_size) + F.col("position")


def read_ignore_list(spark: SparkSession, path: str, field: str) -> DataFrame:
    """Ids listed in an array of a JSON document; no rows when the field is absent."""
    text = spark.read.text(path, wholetext=True)
    ids = F.from_json(F.get_json_object("value", f"$.{field}"), "array<string>")
    return text.select(F.explode(F.coalesce(ids, F.array().cast("array<string>"))).alias("id"))


def parse_messages(messages: DataFrame, body: str = "Body", schema: str = "objectId string") -> DataFrame:
    """Queue messages with their JSON body as a struct."""
    return messages.withColumn("message", F.from_json(body, schema))
