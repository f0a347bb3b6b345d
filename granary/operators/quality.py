"""Data-quality operators.  Checks return rows; only the strict forms raise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from granary.session import literal_table

CHECK_SCHEMA = "check string, column string, n bigint"


class QualityError(ValueError):
    """One or more checks failed; the message lists all of them."""


def _may_be_null(column: str) -> bool:
    """Release-name columns may be empty; the IN_... flags may not."""
    return column.endswith("RELEASE") and not column.startswith("IN")


def validate_table(df: DataFrame, required: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """All failed checks of a table as (check, column, n); no rows means it is sound.

    Checks: the table has rows, the required columns exist, required columns
    other than release names have no missing values (n = how many), and key
    tuples are unique (n = all members of repeated groups).  Contents are only
    checked when there are any.  One aggregate pass finds nulls and rows; one
    grouping by key finds repeats.
    """
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    strict = [c for c in required if c in df.columns and not _may_be_null(c)]
    kinds = dict(df.dtypes)

    def is_missing(name: str) -> Column:
        column = F.col(f"`{name}`")
        empty = column.isNull()
        return empty | F.isnan(column) if kinds[name] in ("double", "float") else empty

    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_missing(c)).alias(f"_null_{i}") for i, c in enumerate(strict)],
    )

    def entry(check: str, column: str | None, n: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(column).cast("string").alias("column"),
            n.cast("long").alias("n"),
        )

    entries = [entry("empty", None, F.when(F.col("_rows") == 0, 1).otherwise(0))]
    entries += [entry("null", c, F.col(f"_null_{i}")) for i, c in enumerate(strict)]
    results = counts.select(F.inline(F.array(*entries)))
    if missing:
        results = results.unionAll(
            literal_table(spark, [("missing_column", c, 1) for c in missing], CHECK_SCHEMA)
        )
    present = [k for k in keys if k in df.columns]
    if present:
        repeats = df.groupBy(*present).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        results = results.unionAll(
            repeats.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).select(
                F.lit("duplicate").alias("check"), F.lit(",".join(present)).alias("column"), "n"
            )
        )
    return results.filter("n > 0")


def require_sound(checks: DataFrame, what: str = "table") -> None:
    """Raise with every failed check; the check table has one row per column at most."""
    failures = checks.orderBy("check", "column").collect()
    if failures:
        lines = [f"{r['check']} {r['column'] or ''} ({r['n']})" for r in failures]
        raise QualityError(f"{what} validation failed:\n- " + "\n- ".join(lines))


# The fields of a usage record, and those that are counts or must be filled.
RECORD_FIELDS = [
    "title", "date", "views", "unique_views", "downloads", "unique_downloads", "link", "category",
]
METRIC_FIELDS = ["views", "unique_views", "downloads", "unique_downloads"]
FILLED_FIELDS = ["title", "date", "link"]


def validate_records(df: DataFrame, record: str, index: str) -> DataFrame:
    """One row (index, error) per fault, over all records given as variants.

    Working on the variant keeps apart a field that is absent, one that is
    null, and one of the wrong type (a boolean or quoted number is not a
    count).  Fields are taken out once, and faults are plain expressions over
    them, so the whole check is one generated stage.
    """
    fields = {f: f"_field_{i}" for i, f in enumerate(RECORD_FIELDS)}
    taken = df.select(
        index, *[F.try_variant_get(record, f"$.{f}", "variant").alias(c) for f, c in fields.items()]
    )
    at = F.concat(F.lit("record "), F.col(index).cast("string"))
    absent = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(f)) for f, c in fields.items()])
    errors = [F.when(absent != "", F.concat(at, F.lit(" missing fields: "), absent))]
    for f in METRIC_FIELDS:
        whole = F.schema_of_variant(F.col(fields[f])) == "BIGINT"
        fine = whole & (F.try_variant_get(fields[f], "$", "bigint") >= 0)
        errors.append(
            F.when(
                ~F.coalesce(fine, F.lit(False)),
                F.concat(at, F.lit(f" field '{f}' is not a non-negative integer")),
            )
        )
    for f in FILLED_FIELDS:
        text = F.try_variant_get(fields[f], "$", "string")
        empty = F.coalesce(text, F.lit("")) == ""
        errors.append(F.when(empty, F.concat(at, F.lit(f" has empty '{f}'"))))
    faults = taken.select(index, F.explode(F.array(*errors)).alias("error"))
    return faults.filter("error IS NOT NULL")


def require_valid_records(df: DataFrame, record: str, index: str, shown: int = 1000) -> None:
    """Raise when there are no records or any is faulty; all faults are counted, ``shown`` listed."""
    if df.isEmpty():
        raise QualityError("validation failed: zero records")
    errors = validate_records(df, record, index)
    total = errors.count()
    if total:
        lines = [r["error"] for r in errors.orderBy(index, "error").limit(shown).collect()]
        raise QualityError(f"validation failed with {total} errors:\n- " + "\n- ".join(lines))


def empty_sources(spec: DataFrame, rows: DataFrame, source: str) -> DataFrame:
    """Expected sources that delivered no row (they are skipped, with a warning)."""
    return spec.join(rows.select(source).distinct(), source, "left_anti")


def split_by_rules(
    df: DataFrame, rules: Mapping[str, Column], index: str
) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and (index, error, item) for those that do not.

    A rule is a named boolean column; NULL counts as not satisfied.
    """
    broken = F.concat_ws(
        "; ",
        *[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()],
    )
    judged = df.withColumn("_broken", broken)
    valid = judged.filter("_broken = ''").drop("_broken")
    item = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != index]))
    errors = judged.filter("_broken != ''").select(
        F.col(index).alias("item_index"),
        F.col("_broken").alias("error"),
        item.alias("transformed_item"),
    )
    return valid, errors


def missing_fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows lacking any of the fields, with the first field that is missing or empty."""
    first = F.coalesce(*[
        F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c)) for c in columns
    ])
    return df.withColumn("missing_field", first).filter("missing_field IS NOT NULL")


def require_fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pass rows through, failing the job at the first empty field."""
    for c in columns:
        empty = F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
        message = F.lit(f"Missing or empty '{c}' in item")
        df = df.withColumn(c, F.when(empty, F.raise_error(message)).otherwise(F.col(c)))
    return df


def cardinality(df: DataFrame) -> str:
    """``none``, ``one`` or ``many``; reads two rows at most."""
    return ("none", "one", "many")[df.limit(2).count()]


def require_one_or_none(df: DataFrame, what: str = "row") -> bool:
    """False to stop (no row), True to go on (one), an error for more."""
    found = cardinality(df)
    if found == "many":
        raise QualityError(f"more than one {what} found")
    return found == "one"


def unmatched(stored: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Keys that occur only on one side, with the side they occur on."""
    left = stored.select(key).distinct().withColumn("_stored", F.lit(True))
    right = updates.select(key).distinct().withColumn("_update", F.lit(True))
    return (
        left.join(right, key, "full")
        .filter(F.col("_stored").isNull() | F.col("_update").isNull())
        .select(key, F.when(F.col("_stored"), F.lit("stored")).otherwise(F.lit("update")).alias("side"))
    )


# Limits and states of the DOI service.
MAX_PAGE_SIZE = 1000
DOI_STATES = ["findable", "registered", "draft"]


def check_fetch_params(page_size: int, state: str) -> None:
    if page_size < 1:
        raise ValueError("page_size must be at least 1")
    if page_size > MAX_PAGE_SIZE:
        raise ValueError(f"page_size cannot exceed {MAX_PAGE_SIZE}")
    if state not in DOI_STATES:
        raise ValueError(f"state must be one of {DOI_STATES}, got '{state}'")


def check_options(given: Mapping[str, object], allowed: Sequence[str]) -> None:
    """Unknown options are an error, not ignored."""
    unknown = sorted(set(given) - set(allowed))
    if unknown:
        raise ValueError(f"unknown options: {unknown}; allowed: {sorted(allowed)}")
