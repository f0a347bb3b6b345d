"""Release ingestion: stacked tables that can be loaded again without repeats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from granary.functions import versions
from granary.operators import filters, quality
from granary.session import literal_table
from granary.sinks import tables
from granary.sources import delimited

MAIN_KEYS = ["RELEASE"]
COHORT_KEYS = ["COHORT", "RELEASE"]


def release_folders(listing: DataFrame, path: str = "path", folder: str = "folder") -> DataFrame:
    """Listed release folders at acceptable paths, with their parsed version.

    A folder name that cannot be parsed fails the job once its rows are used.
    """
    kept = listing.filter(versions.valid_release_path(F.col(path)))
    return versions.raise_on_error(versions.parse_release(kept, folder), "parsed")


def main_releases(rows: DataFrame, parsed: str = "_parsed", ingested_at: datetime | None = None) -> DataFrame:
    """Rows with the metadata of their main release, taken from the parsed version."""
    p = F.col(parsed)
    tagged = filters.add_release_metadata(
        rows, p["release"], p["release_type"], p["major_version"], p["minor_version"],
        ingested_at=ingested_at,
    )
    return tagged.drop(parsed)


def cohort_releases(
    rows: DataFrame, cohort: str, source_file: str, parsed: str = "_parsed",
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Rows with the metadata of their cohort release; the cohort is stored in upper case."""
    p = F.col(parsed)
    tagged = filters.add_release_metadata(
        rows, p["release"], p["release_type"], p["major_version"], p["minor_version"],
        cohort=F.col(cohort), source_file=F.col(source_file), ingested_at=ingested_at,
    )
    return tagged.drop(parsed, cohort, source_file)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def ingest_main(
    spark: SparkSession, folders: Mapping[str, str], path: str, overwrite_partition: bool = False,
    types: Mapping[str, str] | None = None, ingested_at: datetime | None = None,
) -> None:
    """Read one sample file per release folder and store them by release.

    ``folders`` maps a release folder name to its file.  All files are one scan;
    empty ones contribute no rows and so no partition.
    """
    specs = [
        delimited.ReleaseSpec("", [file], "", version=name, sep="\t", types=types or {})
        for name, file in folders.items()
    ]
    rows = delimited.read_release_set(spark, specs, versions.parse_release).drop("_file", "_cohort")
    tables.store_release(main_releases(rows, ingested_at=ingested_at), path, MAIN_KEYS, overwrite_partition)


def ingest_walk(
    spark: SparkSession, root: str, path: str, columns: Sequence[str], overwrite_partition: bool = False,
    types: Mapping[str, str] | None = None, strict: bool = False, ingested_at: datetime | None = None,
    files: Mapping[str, str] | None = None, multi_line: bool = False,
) -> dict[str, dict[str, int]]:
    """Walk the release folders below ``root`` and store the configured files by release; one scan per file name.

    ``files`` maps a file name to its table, a folder below ``path``.  Returns what was stored per table: rows,
    malformed and unbalanced rows, and values that did not fit their type.  Skipped releases are neither opened nor
    counted; the driver sees the names of the stored ones.
    """
    found = {}
    for name, table in (files or delimited.PORTAL_FILES).items():
        seen = Observation()
        place, stored = f"{path.rstrip('/')}/{table}", []
        if not overwrite_partition:  # files of releases that would be skipped need not be read
            stored = delimited.release_names(tables.stored_or_empty(spark, place, "RELEASE string"))
        rows = delimited.release_walk(spark, root, name, columns, types, multi_line=multi_line, stored=stored)
        tables.store_release(
            main_releases(rows, ingested_at=ingested_at), place, MAIN_KEYS, overwrite_partition,
            lambda df, seen=seen: delimited.counted_faults(df, seen, strict),
        )
        found[table] = delimited.faults(seen)
    return found


def ingest_cohorts(
    spark: SparkSession, specs: Sequence[delimited.ReleaseSpec], path: str,
    overwrite_partition: bool = False, ingested_at: datetime | None = None, strict: bool = False,
) -> dict[str, int]:
    """Read the configured cohort releases and store them by cohort and release.

    The same rule holds for clinical and portal files.  Returns the stored rows and the faults among them, as far as
    they come from deliveries with known columns.
    """
    seen = Observation()
    rows = delimited.read_release_set(spark, specs, marks=True).withColumn("_source_file", file_name(F.col("_file")))
    tables.store_release(
        cohort_releases(rows.drop("_file"), "_cohort", "_source_file", ingested_at=ingested_at),
        path, COHORT_KEYS, overwrite_partition, lambda df: delimited.counted_faults(df, seen, strict),
    )
    return delimited.faults(seen)


def ingest_projects(
    spark: SparkSession, specs: Sequence[delimited.ReleaseSpec], overwrite: bool = False,
    ingested_at: datetime | None = None, strict: bool = False, faults: dict[str, dict[str, int]] | None = None,
    location: str | None = None,
) -> dict[str, bool]:
    """One schema and table per project; all files of a project are stacked in one write.

    Files of projects with known columns are read once, and ``faults`` gets what was counted per table.  Tables are
    kept below ``location`` if it is given.
    """
    written = {}
    for spec in specs:
        seen = Observation()
        if spec.columns:
            rows = delimited.read_known(
                spark, list(spec.files), spec.columns, spec.separator, "#", spec.types, spec.multi_line
            )
            rows = delimited.counted_faults(rows, seen, strict)
        else:
            rows = delimited.read_delimited(spark, list(spec.files), sep=spec.separator, types=spec.types)
        rows = filters.add_release_metadata(rows, spec.cohort, ingested_at=ingested_at)
        tables.ensure_schema(spark, spec.cohort)
        name = f"{spec.cohort}.{spec.table}"
        place = {"path": f"{location.rstrip('/')}/{spec.cohort}/{spec.table}"} if location else {}
        written[name] = tables.save_table(rows, name, overwrite=overwrite, **place)
        if spec.columns and written[name] and faults is not None:
            faults[name] = delimited.faults(seen)
    return written


def refresh_catalog(spark: SparkSession, specs: Mapping[str, tuple[str, str]]) -> None:
    """Replace one table per portal; ``specs`` maps a table to (location, kind)."""
    for name, (location, kind) in specs.items():
        rows = filters.standardize_columns(delimited.read_catalog(spark, location, kind))
        tables.overwrite_table(rows, name)


def skipped_sources(specs: Sequence[delimited.ReleaseSpec], rows: DataFrame, file: str = "_file") -> DataFrame:
    """Configured files that delivered no row."""
    wanted = literal_table(
        rows.sparkSession, sorted({(f,) for s in specs for f in s.files}), f"{file} string"
    )
    return quality.empty_sources(wanted, rows, file)


