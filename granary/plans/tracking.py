"""Which samples belong to which release and project."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from granary.operators import aggregates, filters, joins, quality, ranking
from granary.sinks.tables import refresh_and_export

KEYS = ["SAMPLE_ID", "PATIENT_ID"]
KIND = "RELEASE_PROJECT_TYPE"
NAME = "RELEASE_NAME"


@dataclass(frozen=True)
class Layout:
    """Names of kinds and output columns.

    ``cohorts`` get an inclusion flag each and those in ``named_cohorts`` a
    release-name column as well; ``projects`` get an inclusion flag each.
    """

    cohorts: Sequence[str]
    projects: Sequence[str]
    named_cohorts: Sequence[str] | None = None
    main: str = "MAIN"
    cohort_prefix: str = "COHORT_"
    project_prefix: str = "SP_"

    def flags(self) -> dict[str, str]:
        columns = {f"IN_LATEST_{self.main}": self.main}
        columns |= {f"IN_{p}_PROJECT": f"{self.project_prefix}{p}" for p in self.projects}
        columns |= {
            f"IN_{self.cohort_prefix}{c}_RELEASE": f"{self.cohort_prefix}{c}" for c in self.cohorts
        }
        return columns

    def names(self) -> dict[str, str]:
        named = self.cohorts if self.named_cohorts is None else self.named_cohorts
        columns = {f"{self.main}_RELEASE": self.main}
        columns |= {
            f"{self.cohort_prefix}{c}_RELEASE": f"{self.cohort_prefix}{c}" for c in named
        }
        return columns

    def required(self) -> list[str]:
        return [*KEYS, *self.names(), *self.flags()]


@dataclass(frozen=True)
class Project:
    """A project table and the names of its key columns."""

    rows: DataFrame
    sample_key: str = "SAMPLE_ID"
    patient_key: str = "PATIENT_ID"


def _pairs(df: DataFrame, sample: str, patient: str, name, kind) -> DataFrame:
    return df.select(
        F.col(sample).alias("SAMPLE_ID"), F.col(patient).alias("PATIENT_ID"),
        name.alias(NAME), kind.alias(KIND),
    ).dropna(subset=KEYS)


def main_pairs(main: DataFrame, layout: Layout) -> DataFrame:
    """Pairs of the single latest main release."""
    version = ["MAJOR_VERSION", "MINOR_VERSION"]
    latest = ranking.latest_global(main, version)
    rows = joins.only_latest(main, latest, version)
    return _pairs(rows, "SAMPLE_ID", "PATIENT_ID", F.col("RELEASE"), F.lit(layout.main))


def cohort_pairs(cohorts: DataFrame, layout: Layout, sample_key: str, patient_key: str) -> DataFrame:
    """Pairs of the latest release of every cohort."""
    version = ["MAJOR_VERSION", "MINOR_VERSION"]
    latest = ranking.latest_by(cohorts, ["COHORT"], version)
    rows = joins.only_latest(cohorts, latest, ["COHORT", *version])
    kind = F.concat(F.lit(layout.cohort_prefix), F.col("COHORT").cast("string"))
    return _pairs(rows, sample_key, patient_key, F.col("RELEASE"), kind)


def project_pairs(projects: Mapping[str, Project], layout: Layout) -> list[DataFrame]:
    return [
        _pairs(p.rows, p.sample_key, p.patient_key, F.lit(name), F.lit(f"{layout.project_prefix}{name}"))
        for name, p in projects.items()
    ]


def all_pairs(
    main: DataFrame,
    cohorts: DataFrame,
    projects: Mapping[str, Project],
    layout: Layout,
    cohort_sample_key: str = "SAMPLE_ID",
    cohort_patient_key: str = "PATIENT_ID",
) -> DataFrame:
    """Every membership of every pair, not made distinct."""
    return ranking.stack(
        cohort_pairs(cohorts, layout, cohort_sample_key, cohort_patient_key),
        main_pairs(main, layout),
        *project_pairs(projects, layout),
    )


def membership_pairs(pairs: DataFrame, layout: Layout) -> DataFrame:
    """Distinct memberships with a Yes/No flag for being in the latest main release."""
    in_main = pairs.filter(F.col(KIND) == layout.main)
    return joins.membership_flag(pairs.distinct(), in_main, KEYS)


def tracking_table(pairs: DataFrame, layout: Layout) -> DataFrame:
    """One row per pair with inclusion flags and release names.

    All columns are maxima, which do not mind repeats, so the pair sets are
    not made distinct first: one shuffle by pair does it all.
    """
    wide = aggregates.membership_wide(pairs, KEYS, KIND, NAME, layout.flags(), layout.names())
    return wide.select(*KEYS, *layout.flags(), *layout.names())


def tracking_checks(table: DataFrame, layout: Layout) -> DataFrame:
    return quality.validate_table(table, layout.required(), KEYS)


def publish(table: DataFrame, layout: Layout, path: str, rows_per_file: int = 50_000) -> None:
    """Validate, then replace the published table."""
    quality.require_sound(tracking_checks(table, layout), "tracking table")
    refresh_and_export(table, path, rows_per_file)


def require_pairs(df: DataFrame) -> DataFrame:
    return filters.require_keys(df, KEYS)
