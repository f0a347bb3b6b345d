"""Release names: parsing, normalising, and the rules for acceptable paths.

Each parser returns a struct with an ``error`` field instead of failing, so
that one bad name does not stop a job; ``raise_on_error`` is the strict mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Release folders older than the split into public and consortium.
UNTYPED_RELEASES = [f"Release {number:02d}" for number in range(17)]

# Cohort versions with this prefix are previews and are not ingested.
PREVIEW_PREFIX = "public_preview"


def _as_struct(df: DataFrame, into: str, valid: Column, error: Column) -> DataFrame:
    major, minor, kind = F.col("_major"), F.col("_minor"), F.col("_kind")
    text = F.concat_ws("_", major.cast("string"), minor.cast("string"), kind)
    parsed = F.struct(
        F.when(valid, text).alias("release"),
        F.when(valid, kind).alias("release_type"),
        F.when(valid, major).alias("major_version"),
        F.when(valid, minor).alias("minor_version"),
        error.alias("error"),
    )
    return df.withColumn(into, parsed).drop("_major", "_minor", "_kind", "_parts")


def _error(message: str, name: Column) -> Column:
    return F.concat(F.lit(message), F.coalesce(name, F.lit("")))


def parse_release(df: DataFrame, name: str, into: str = "parsed") -> DataFrame:
    """``19.3-consortium`` to (``19_3_CONSORTIUM``, ``CONSORTIUM``, 19, 3).

    Two separate faults: not exactly two parts around the dash, and a first
    part that is not two numbers.  An empty type is tolerated.  The parts are
    columns of their own first, so every pattern runs once per row.
    """
    split = df.withColumn("_parts", F.split(name, "-"))
    numbers = F.replace(F.get("_parts", F.lit(0)), F.lit("."), F.lit("_"))
    pattern = r"^(\d+)_(\d+)$"
    staged = split.withColumns({
        "_major": F.regexp_extract(numbers, pattern, 1).try_cast("int"),
        "_minor": F.regexp_extract(numbers, pattern, 2).try_cast("int"),
        "_kind": F.upper(F.get("_parts", F.lit(1))),
    })
    two_parts = F.coalesce(F.size("_parts") == 2, F.lit(False))
    valid = two_parts & F.col("_major").isNotNull() & F.col("_minor").isNotNull()
    error = F.when(~two_parts, _error("Unexpected folder name format: ", F.col(name))).when(
        ~valid, _error("Unexpected version format: ", F.col(name))
    )
    return _as_struct(staged, into, valid, error)


def parse_cohort_version(df: DataFrame, version: str, into: str = "parsed") -> DataFrame:
    """``Public_02_2`` to (``2_2_PUBLIC``, ``PUBLIC``, 2, 2); case does not matter."""
    pattern = r"(?i)^(public|consortium)_(\d+)_(\d+)$"
    staged = df.withColumns({
        "_major": F.regexp_extract(version, pattern, 2).try_cast("int"),
        "_minor": F.regexp_extract(version, pattern, 3).try_cast("int"),
        "_kind": F.upper(F.regexp_extract(version, pattern, 1)),
    })
    valid = F.coalesce(
        (F.col("_kind") != "") & F.col("_major").isNotNull() & F.col("_minor").isNotNull(), F.lit(False)
    )
    error = F.when(~valid, _error("Unexpected version format: ", F.col(version)))
    return _as_struct(staged, into, valid, error)


def is_preview(version: Column) -> Column:
    return F.startswith(version, F.lit(PREVIEW_PREFIX))


def valid_release_path(path: Column, skip: Sequence[str] = tuple(UNTYPED_RELEASES)) -> Column:
    """Exactly two levels, and the second is not on the skip list."""
    parts = F.split(path, "/")
    return F.coalesce(
        (F.size(parts) == 2) & ~F.get(parts, F.lit(1)).isin(list(skip)), F.lit(False)
    )


def raise_on_error(df: DataFrame, parsed: str) -> DataFrame:
    """Fail the job at the first row whose parsed struct carries an error."""
    error = F.col(parsed)["error"]
    # the struct itself goes through the check, so that it cannot be pruned away
    checked = F.when(error.isNotNull(), F.raise_error(error)).otherwise(F.col(parsed))
    return df.withColumn(parsed, checked)
