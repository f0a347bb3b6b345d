"""Report files, NDJSON, documents, matrices, manifests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from granary.session import cut_lineage


def write_ndjson_gz(df: DataFrame, path: str) -> int:
    """One compact JSON object per line, gzip; returns the row count of the same pass."""
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").option("compression", "gzip").json(path)
    return int(seen.get["n"])


def write_report_csv(
    report: DataFrame, path: str, by: str, order: Sequence[str], heads: Column
) -> None:
    """One CSV folder per category, rows in order below one line of headings; part files concatenate in name order.

    ``heads`` is true for one row of every category, which also brings the category's headings, so however many
    files a report takes, its headings stand once, at the top of the first.
    """
    shown = [c for c in report.columns if c not in (by, *order)]
    line = F.struct(F.lit(1).alias("_rank"), *[F.col(f"`{c}`").cast("string").alias(c) for c in shown])
    head = F.struct(F.lit(0).alias("_rank"), *[F.lit(c).alias(c) for c in shown])
    lines = report.select(by, *order, F.explode(F.when(heads, F.array(head, line)).otherwise(F.array(line))).alias("_line"))
    keys = [F.col(by), F.col("_line")["_rank"], *[F.col(o) for o in order]]
    (
        lines.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(by, *[F.col("_line")[c].alias(c) for c in shown])
        .write.mode("overwrite")
        .option("header", False)
        .partitionBy(by)
        .csv(path)
    )


def write_documents(lines: DataFrame, path: str, key: str = "object_key", order: Sequence[str] = ("section", "place")) -> None:
    """Documents given as ordered text fragments: text files, and a manifest that finds every document in them.

    A document is its fragments in order.  Fragments are range-partitioned and sorted, so a part file holds many small
    documents or a stretch of a large one; nothing is gathered into one row and no document needs a file of its own.
    The manifest has one row per document and part: the part's number, the first of its lines there, how many, their
    bytes, a checksum of lines and places, and the lines of the document before it.  The manifest is written last.
    """
    keys = [key, *order]
    dealt = cut_lineage(lines.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        key, "line", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)).alias("at"),
    ))
    # the checkpoint keeps tasks and their order, so a task's file has the number and the lines counted here
    dealt.select("line").write.mode("overwrite").text(f"{path}/parts")
    held = dealt.groupBy(key, "part").agg(F.min("at").alias("first"), *_line_stats(F.col("at")))
    before = F.sum("n_lines").over(Window.partitionBy(key).orderBy("part")) - F.col("n_lines")
    held.withColumn("before", before).write.mode("overwrite").parquet(f"{path}/manifest")


def _line_stats(place: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.octet_length("line")).cast("long").alias("n_bytes"),
        F.bit_xor(F.xxhash64(place, F.col("line"))).alias("checksum"),
    ]


def document_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def read_documents(spark: SparkSession, path: str, key: str = "object_key") -> DataFrame:
    """Every line of the documents of ``write_documents``: key, place (from 0), line, part and the line's number there.

    Lines are numbered by the block of the file they were read from, as files may be read in blocks.  The document a
    line belongs to is that of the last first line before it in its part.
    """
    text = spark.read.text(f"{path}/parts").select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int").alias("part"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"),
    )
    # the text is read twice and must give the same numbers, so they are stored
    text = cut_lineage(text.withColumn("id", F.monotonically_increasing_id()))
    blocks = text.groupBy("part", "block").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("part").orderBy("block")) - F.col("n")
    blocks = blocks.select("part", "block", (before - F.col("low")).alias("offset"))
    lines = text.join(blocks, ["part", "block"]).select("part", (F.col("id") + F.col("offset")).alias("at"), "line")
    begins = document_manifest(spark, path).select(key, "part", F.col("first").alias("at"), (F.col("before") - F.col("first")).alias("shift"))
    known = lines.join(begins, ["part", "at"], "left")
    # a part is what one task wrote
    since = Window.partitionBy("part").orderBy("at")
    owner = F.last(F.when(F.col(key).isNotNull(), F.struct(key, "shift")), ignorenulls=True).over(since)
    found = known.select("part", "at", "line", owner.alias("owner"))
    return found.select(F.col("owner")[key].alias(key), (F.col("at") + F.col("owner")["shift"]).alias("place"), "line", "part", "at")


def damaged_documents(spark: SparkSession, path: str, key: str = "object_key") -> DataFrame:
    """(key, part) of the pieces whose lines, bytes or checksum are not those of the manifest."""
    stats = ["n_lines", "n_bytes", "checksum"]
    now = read_documents(spark, path, key).groupBy(key, "part").agg(*_line_stats(F.col("at")))
    told = document_manifest(spark, path).select(key, "part", *[F.col(c).alias(f"_{c}") for c in stats])
    same = F.lit(True)
    for c in stats:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return told.join(now, [key, "part"], "full").filter(~same).select(key, "part")


def write_matrix(df: DataFrame, path: str, row: str) -> None:
    """Wide matrix as tab-separated text, rows in name order below one line of headings, in files that concatenate."""
    lines = df.select(F.lit(1).alias("_rank"), F.col(f"`{row}`").alias("_row"), *[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    head = df.sparkSession.range(1).select(F.lit(0).alias("_rank"), F.lit(None).cast(dict(df.dtypes)[row]).alias("_row"), *[F.lit(c).alias(c) for c in df.columns])
    rows = lines.unionByName(head).orderBy("_rank", "_row").drop("_rank", "_row")
    rows.write.mode("overwrite").option("header", False).option("sep", "\t").csv(path)


def bundle_reports(reports: Mapping[str, DataFrame]) -> DataFrame:
    """All reports as rows (report, row as JSON); report rows stay distributed."""
    frames = [
        df.select(F.lit(name).alias("report"), F.to_json(F.struct("*")).alias("row_json"))
        for name, df in reports.items()
    ]
    return reduce(DataFrame.unionAll, frames)


def write_bundle(reports: Mapping[str, DataFrame], path: str) -> None:
    bundle_reports(reports).write.mode("overwrite").partitionBy("report").text(path)


def write_manifest(ids: DataFrame, root: str, run_id: str, column: str = "submission_id") -> str:
    """One-column CSV below the path of the run; returns where it is."""
    path = f"{root.rstrip('/')}/{run_id}/submissions"
    ids.select(F.col(ids.columns[0]).alias(column)).write.mode("overwrite").option(
        "header", True
    ).csv(path)
    return path


def json_object(**fields: Column) -> Column:
    """JSON text with the fields in the given order; missing ones are left out."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))
