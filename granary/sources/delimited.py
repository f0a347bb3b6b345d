"""Delimited release files.

All values are read as text and cast in one place, because types inferred per
file drift between releases.  Lines starting with ``#`` are skipped; a ``#``
inside a line is data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from granary.functions import versions
from granary.operators.filters import drop_if_present
from granary.operators.ranking import stack
from granary.session import literal_table

# Release files that are ingested and the table each one feeds.
CLINICAL_FILES = {"cancer_panel_test_level_dataset.csv": "CANCER_PANEL_TEST_LEVEL"}
PORTAL_FILES = {"data_clinical_sample.txt": "CLINICAL_SAMPLE"}
# Portal files with these prefixes are never ingested.
PORTAL_EXCLUDED = ["data_gene_panel", "meta", "data_CNA", "case_lists", "data_seg", "tmb"]
# Fixed value: the project table whose files are tab-separated.
TAB_SEPARATED_TABLE = "cbioportal_clinical_sample"


def separator_for(file_name: str = "", table: str = "") -> str:
    """Tab for ``.txt`` and ``.tsv`` files and for the portal sample table, else comma."""
    tabbed = file_name.endswith((".txt", ".tsv")) or table == TAB_SEPARATED_TABLE
    return "\t" if tabbed else ","


def _plain_path(file: Column) -> Column:
    """The path without URL quoting, as readers take it."""
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def header_groups(spark: SparkSession, paths: Sequence[str], comment: str | None = "#") -> dict[str, list[str]]:
    """Files by their header line.

    Spark applies one header to all files of a read, so files with different
    columns have to be read apart.  One text pass finds the first line that is
    not a comment in every file; the result has one row per file.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("value"),
        _plain_path(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    lines = lines.filter((F.col("block") == 0) & (F.length(F.trim("value")) > 0))
    if comment:
        lines = lines.filter(~F.startswith("value", F.lit(comment)))
    headers = lines.withColumn("line", F.monotonically_increasing_id()).groupBy("file").agg(
        F.min_by("value", "line").alias("header")
    )
    groups: dict[str, list[str]] = {}
    for row in headers.collect():
        groups.setdefault(row["header"], []).append(row["file"])
    return {header: sorted(files) for header, files in sorted(groups.items())}


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    comment: str | None = "#",
    types: Mapping[str, str] | None = None,
    same_header: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """Header files as one frame; columns are matched by name across files.

    ``types`` maps column names (any case) to types; text that does not fit
    becomes NULL.  ``same_header`` skips the header pass when all files agree.
    ``file_column`` adds the path every row came from.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    if comment:
        reader = reader.option("comment", comment)
    groups = [paths] if same_header else list(header_groups(spark, paths, comment).values())
    if not groups:
        raise ValueError(f"no readable header in {paths}")
    frames = []
    for files in groups:
        frame = reader.csv(files)
        if file_column:
            frame = frame.select("*", _plain_path(F.col("_metadata.file_path")).alias(file_column))
        frames.append(frame)
    return cast_columns(stack(*frames), types or {})


FAULTS = {"_malformed": "boolean", "_unbalanced": "boolean", "_failed_casts": "int"}


def read_known(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str = ",",
    comment: str | None = "#",
    types: Mapping[str, str] | None = None,
    multi_line: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """Header files whose columns are known beforehand: every byte is read once, whatever the number of files.

    A file whose header does not name ``columns`` in this order (any case) fails the job.  Next to the data each row
    says what is wrong with it: ``_malformed`` (more or fewer values than columns), ``_unbalanced`` (such a row with an
    odd number of quotes, as a line break inside quotes leaves behind) and ``_failed_casts`` (how many values did not
    fit their type and became NULL).  ``multi_line`` lets quoted values hold line breaks; a file is then one task.
    """
    schema = StructType([StructField(c, StringType()) for c in [*columns, "_corrupt_record"]])
    reader = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("sep", sep)
        .option("escape", '"').option("multiLine", multi_line).option("columnNameOfCorruptRecord", "_corrupt_record")
        # rows of the wrong width are noticed only if all their values are looked at
        .option("columnPruning", False)
    )
    if comment:
        reader = reader.option("comment", comment)
    rows = reader.csv([paths] if isinstance(paths, str) else list(paths))
    wanted = {name.lower(): kind for name, kind in (types or {}).items()}
    raw = F.col("_corrupt_record")
    out, failed = [], F.lit(0)
    for c in columns:
        value = F.col(f"`{c}`")
        if c.lower() in wanted:
            fits = value.try_cast(wanted[c.lower()])
            failed = failed + (value.isNotNull() & fits.isNull()).cast("int")
            value = fits
        out.append(value.alias(c))
    quotes = F.length(raw) - F.length(F.replace(raw, F.lit('"'), F.lit("")))
    out += [
        raw.isNotNull().alias("_malformed"), F.coalesce(quotes % 2 == 1, F.lit(False)).alias("_unbalanced"),
        failed.alias("_failed_casts"),
    ]
    if file_column:
        out.append(_plain_path(F.col("_metadata.file_path")).alias(file_column))
    return rows.select(*out)


def counted_faults(rows: DataFrame, seen: Observation, strict: bool = False) -> DataFrame:
    """Rows of ``read_known`` without their marks, which ``seen`` counts in the pass that uses the rows.

    ``strict`` fails that pass at the first faulty row instead.
    """
    if strict:
        faulty = F.coalesce(F.col("_malformed") | (F.col("_failed_casts") > 0), F.lit(False))
        found = F.to_json(F.struct(*rows.columns))
        checked = F.when(faulty, F.raise_error(F.concat(F.lit("faulty row: "), found))).otherwise(F.col("_malformed"))
        rows = rows.withColumn("_malformed", checked)
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if("_malformed").alias("malformed"),
              F.count_if("_unbalanced").alias("unbalanced"), F.coalesce(F.sum("_failed_casts"), F.lit(0)).alias("failed_casts")]
    return rows.observe(seen, *counts).drop(*FAULTS)


def faults(seen: Observation) -> dict[str, int]:
    """What ``counted_faults`` has counted; all zero where the plan turned out to have no rows to look at."""
    try:
        return dict(seen.get)
    except Py4JJavaError as error:  # adaptive execution drops the counters along with an empty plan
        if "AssertionError" not in str(error.java_exception):
            raise
        return dict.fromkeys(["rows", "malformed", "unbalanced", "failed_casts"], 0)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    wanted = {name.lower(): kind for name, kind in types.items()}
    return df.withColumns({
        c: F.col(f"`{c}`").try_cast(wanted[c.lower()]) for c in df.columns if c.lower() in wanted
    }) if wanted else df


def select_release_files(
    listing: DataFrame,
    allow: Mapping[str, str],
    deny_prefixes: Sequence[str] = (),
    suffix: str = "",
    name: str = "name",
) -> DataFrame:
    """Listed files that are allowed, with the table they feed."""
    table = F.create_map(*[F.lit(part) for item in allow.items() for part in item])
    keep = F.col(name).isin(list(allow))
    for prefix in deny_prefixes:
        keep = keep & ~F.startswith(F.col(name), F.lit(prefix))
    if suffix:
        keep = keep & F.endswith(F.col(name), F.lit(suffix))
    return listing.filter(keep).withColumn("table_name", F.try_element_at(table, F.col(name)))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Listing of a folder tree (path, name, modified, size) without reading contents."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).drop("content")
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
    )


def recent_files(listing: DataFrame, suffix: str, asof, hours: int = 24) -> DataFrame:
    """Files with the suffix that were modified less than ``hours`` before ``asof``."""
    modified = F.to_timestamp("modified")
    limit = F.lit(asof).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return listing.filter(F.endswith(F.col("name"), F.lit(suffix)) & (modified > limit))


@dataclass(frozen=True)
class ReleaseSpec:
    """One configured delivery: a cohort, its version and the files that hold it."""

    cohort: str
    files: Sequence[str]
    table: str
    version: str = ""
    sep: str | None = None
    types: Mapping[str, str] = field(default_factory=dict)
    columns: Sequence[str] = ()  # known columns: files are read once, without a look at their headers before
    multi_line: bool = False  # values may hold line breaks
    folders: bool = False  # ``files`` are folders, all files in them belong to the delivery

    @property
    def separator(self) -> str:
        return self.sep or separator_for(self.files[0] if self.files else "", self.table)

    @property
    def is_preview(self) -> bool:
        return self.version.startswith(versions.PREVIEW_PREFIX)


def _same_path(path: Column) -> Column:
    """A path without its scheme, to compare given with reported paths."""
    return F.regexp_replace(path, r"^[a-z0-9]+:/+", "/")


def _owned(rows: DataFrame, same: Sequence[ReleaseSpec], parse: Callable[[DataFrame, str, str], DataFrame]) -> DataFrame:
    """Rows with the cohort and parsed version of the file, or folder, that they came from (``_file``)."""
    spark = rows.sparkSession
    owners = literal_table(
        spark,
        [(f.rstrip("/"), s.cohort, s.version) for s in same for f in s.files],
        "_owner_file string, _cohort string, _version string",
    )
    parsed = versions.raise_on_error(parse(owners, "_version", "_parsed"), "_parsed")
    owners = parsed.select(_same_path(F.col("_owner_file")).alias("_path"), "_cohort", "_parsed")
    path = _same_path(F.col("_file"))
    if same[0].folders:
        path = F.regexp_replace(path, "/[^/]*$", "")
    return rows.withColumn("_path", path).join(owners, "_path").drop("_path")


def read_release_set(
    spark: SparkSession,
    specs: Sequence[ReleaseSpec],
    parse: Callable[[DataFrame, str, str], DataFrame] = versions.parse_cohort_version,
    marks: bool = False,
) -> DataFrame:
    """All files of several deliveries of one table as one frame.

    Deliveries with known columns are read once, one scan per layout; with ``marks`` their rows keep the marks of
    ``read_known``, which are NULL for the others.  These need a pass for their headers first, and a scan per
    separator and header.  Each row finds its ``_cohort`` and ``_parsed`` version by the file it came from.  Versions
    are parsed once per file, and a bad one fails the job.  Previews are left out, and an incoming ``cohort`` column
    gives way to the configured one.
    """
    chosen = [s for s in specs if not s.is_preview and s.files]
    if not chosen:
        raise ValueError("no delivery to read")
    layouts: dict[tuple, list[ReleaseSpec]] = {}
    for s in chosen:
        kinds = tuple(sorted(s.types.items())) if s.columns else ()
        layouts.setdefault((s.separator, tuple(s.columns), s.multi_line, s.folders, kinds), []).append(s)
    frames = []
    for (sep, columns, multi_line, _, _), same in sorted(layouts.items(), key=lambda item: repr(item[0])):
        types: dict[str, str] = {}
        for s in same:
            types.update(s.types)
        paths = sorted({f for s in same for f in s.files})
        if columns:
            rows = read_known(spark, paths, columns, sep, "#", types, multi_line, "_file")
            rows = rows if marks else rows.drop(*FAULTS)
        else:
            rows = read_delimited(spark, paths, sep=sep, types=types, file_column="_file")
            rows = rows.withColumns({c: F.lit(None).cast(kind) for c, kind in FAULTS.items()}) if marks else rows
        frames.append(_owned(drop_if_present(rows, "cohort"), same, parse))
    return stack(*frames)


def release_names(stored: DataFrame, most: int = 10_000) -> list[str]:
    """The distinct releases of a stored table; none if there are more than ``most``, whose files are then all read."""
    found = stored.where("RELEASE IS NOT NULL").select("RELEASE").distinct().limit(most + 1).collect()
    return sorted(r["RELEASE"] for r in found) if len(found) <= most else []


def release_walk(
    spark: SparkSession,
    root: str,
    file_name: str,
    columns: Sequence[str],
    types: Mapping[str, str] | None = None,
    sep: str = "\t",
    multi_line: bool = False,
    stored: Sequence[str] = (),
) -> DataFrame:
    """The named file of every release folder below ``root``, as rows with ``_parsed`` and the marks of ``read_known``.

    ``root`` holds ``<top>/<release>/<folder>/<file>``; the rule for release paths is applied to ``<top>/<release>``
    and the folder's name is parsed.  Both look at the file's path only, so files that the rule leaves out are not
    opened, nor are those of the releases in ``stored``.  A folder name that cannot be parsed fails the job.
    """
    base = _same_path(F.lit(root.rstrip("/") + "/"))
    reader = read_known(spark, f"{root.rstrip('/')}/*/*/*/{file_name}", columns, sep, "#", types, multi_line, "_file")
    parts = F.split(F.substring(_same_path(F.col("_file")), F.length(base) + 1, F.lit(2**31 - 1)), "/")
    rows = reader.withColumns({
        "_top": F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))), "_folder": F.get(parts, F.lit(2)),
    })
    kept = rows.filter(versions.valid_release_path(F.col("_top")))
    parsed = versions.parse_release(kept, "_folder", "_parsed")
    if stored:
        parsed = parsed.filter(~F.coalesce(F.col("_parsed")["release"].isin(list(stored)), F.lit(False)))
    return versions.raise_on_error(parsed, "_parsed").drop("_top", "_folder", "_file")


def read_mapping(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """Lookup file with one value per key: the first one in the file."""
    rows = read_delimited(spark, path, comment=None, same_header=True).select(key, value)
    placed = rows.withColumn("_line", F.monotonically_increasing_id())
    return placed.groupBy(key).agg(F.min_by(value, "_line").alias(value))


def read_headerless(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "\t") -> DataFrame:
    """File without a header line, with the given column names."""
    ddl = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(ddl).option("sep", sep).option("header", False).csv(path)


def read_catalog(spark: SparkSession, name: str, kind: str) -> DataFrame:
    """A catalogue kept as a table (``table``) or as a CSV file (``file``)."""
    if kind == "table":
        return spark.table(name)
    if kind == "file":
        return read_delimited(spark, name, comment=None, same_header=True)
    raise TypeError(f"unsupported kind of catalogue: {kind}")
