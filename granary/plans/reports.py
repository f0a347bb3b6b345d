"""Usage reports with totals, and the DOI extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from granary.functions import text
from granary.operators import quality
from granary.sinks.files import write_ndjson_gz, write_report_csv
from granary.sources.documents import flatten_pages, record_index

# Report columns in order, with their headings.
REPORT_HEADINGS = {
    "title": "Title",
    "date": "Publication Date",
    "views": "Total Views",
    "unique_views": "Unique Views",
    "downloads": "Total Downloads",
    "unique_downloads": "Unique Downloads",
    "link": "Link",
}
TOTALS = "TOTALS"
PAGE_SIZE = 100


def usage_records(pages: DataFrame, record_url: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Page documents (page, hits.hits, hits.total) to flat usage records with their index.

    Every record is a variant taken from the JSON as it came, next to typed
    columns; absent statistics count as zero, wrong types stay visible to the
    checks.
    """
    staged = pages.select("page", F.col("hits.hits").alias("hits"), F.col("hits.total").alias("total"))
    rows = flatten_pages(staged, "hits", "page", page_size, total="total")
    return usage_columns(rows, record_url, record_index(page_size))


def usage_columns(rows: DataFrame, record_url: str, index: Column) -> DataFrame:
    """Typed usage columns of ``record`` rows, and the record as checked (variant)."""
    record = F.col("record")
    stats = {
        name: F.coalesce(record[f"stats"][name], F.lit(0)) for name in quality.METRIC_FIELDS
    }
    title = record["metadata"]["title"]
    columns = {
        "title": title,
        "date": record["metadata"]["publication_date"],
        **stats,
        "link": F.concat(F.lit(record_url), record["id"].cast("string")),
        "category": text.title_category(title),
    }
    flat = rows.select(index.alias("index"), *[c.alias(n) for n, c in columns.items()])
    return flat.withColumn("checked", F.to_variant_object(F.struct(*columns)))


def report_rows(records: DataFrame) -> DataFrame:
    """Detail rows and one flagged TOTALS row per category, in writing order.

    The sort key is (is_total, index).  Details and totals are two grouping sets of one aggregate, so the records are
    worked out once; a number per row keeps every detail a group of its own, equal ones too.
    """
    texts = [c for c in REPORT_HEADINGS if c not in quality.METRIC_FIELDS]
    rows = records.select("category", "index", *REPORT_HEADINGS, F.monotonically_increasing_id().alias("_row"))
    keys = ["category", "_row", "index", *texts]
    both = rows.groupingSets([[F.col("category")], [F.col(k) for k in keys]], *[F.col(k) for k in keys]).agg(
        *[F.sum(m).alias(m) for m in quality.METRIC_FIELDS], F.grouping("_row").cast("int").alias("is_total")
    )
    marks = {c: F.lit(TOTALS if c == "title" else "") for c in texts}
    shown = [
        (F.when(F.col("is_total") == 1, marks[c]).otherwise(F.col(c)) if c in marks else F.col(c)).alias(c)
        for c in REPORT_HEADINGS
    ]
    return both.select("category", "is_total", "index", *shown)


def write_reports(records: DataFrame, path: str) -> None:
    """One CSV folder per category with the report headings."""
    rows = report_rows(records).withColumnsRenamed(REPORT_HEADINGS)
    write_report_csv(rows, path, "category", ["is_total", "index"], heads=F.col("is_total") == 1)


def require_usage_records(records: DataFrame) -> None:
    quality.require_valid_records(records, "checked", "index")


def doi_records(pages: DataFrame, page_size: int = 1000, start_page: int = 0, state: str = "findable") -> DataFrame:
    """DOI objects of all landed pages, in no particular order."""
    quality.check_fetch_params(page_size, state)
    return flatten_pages(pages, "data", "page", page_size, first_page=start_page)


def doi_extract(pages: DataFrame, path: str, page_size: int = 1000, start_page: int = 0, state: str = "findable") -> int:
    """Write the DOI objects as compressed NDJSON; returns how many."""
    records = doi_records(pages, page_size, start_page, state)
    return write_ndjson_gz(records.select("record.*"), path)


