"""Submission intake and samplesheet preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.functions import text
from granary.operators import filters, joins, ranking
from granary.sources.delimited import read_headerless

# Queue states, run states that count, and the samplesheet header.
RECEIVED = "RECEIVED"
IN_PROGRESS = "EVALUATION_IN_PROGRESS"
COUNTED_RUN_STATES = ["success", "running"]
SAMPLESHEET_COLUMNS = ["patient", "sex", "status", "sample", "bam", "bai"]


def processed_ids(
    runs: DataFrame, taken: DataFrame, n: int = 6, key: str = "submission_id"
) -> DataFrame:
    """Ids taken on by the last ``n`` successful or running runs.

    ``runs`` has run_id, state and start_date; ``taken`` lists (run_id, id), so
    that a run with very many submissions is many rows and not one array.
    """
    counted = runs.filter(F.lower("state").isin(COUNTED_RUN_STATES))
    last = ranking.top_n(counted, n, [F.desc("start_date"), F.desc("run_id")])
    return taken.join(last.select("run_id"), "run_id", "left_semi").select(key).distinct()


def submission_intake(
    queue: DataFrame, runs: DataFrame, taken: DataFrame, n: int = 6, key: str = "submission_id"
) -> DataFrame:
    """Received submissions that none of the last runs has taken on."""
    received = filters.by_value(queue, "status", RECEIVED)
    return joins.new_ids(received, processed_ids(runs, taken, n, key), key)


def in_progress(submissions: DataFrame, key: str = "submission_id") -> DataFrame:
    """Status rows for submissions that are now being evaluated."""
    kind = dict(submissions.dtypes)[key]
    if kind not in ("string", "int", "bigint"):
        raise TypeError(f"{key} must be text or a whole number, not {kind}")
    return submissions.select(key, F.lit(IN_PROGRESS).alias("status"))


def prepare_samplesheet(
    df: DataFrame, columns: Sequence[str] = tuple(SAMPLESHEET_COLUMNS)
) -> DataFrame:
    """Read-pair names in every column renamed to the R1/R2 form."""
    return df.select(*[text.read_pair_names(F.col(c)).alias(c) for c in columns])


def convert_samplesheet(spark: SparkSession, source: str, target: str) -> None:
    """Headerless tab-separated sheet to CSV with the fixed header."""
    rows = read_headerless(spark, source, SAMPLESHEET_COLUMNS)
    rows.write.mode("overwrite").option("header", True).csv(target)


def object_renames(listing: DataFrame, root: str) -> DataFrame:
    """(key, new_key) for paired read files below the staging root."""
    renamed = listing.select("key", text.read_pair_object(F.col("key"), root).alias("new_key"))
    return renamed.filter("new_key IS NOT NULL")
