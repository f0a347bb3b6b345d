"""Filters and projections.

Time filters are written as ranges on the bare column, never as a function of
the column, so that they reach the parquet scan and prune partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from granary.functions import dates

# Column names that are reserved words in the target.
RESERVED_RENAMES = {"grant": "grants", "group": "groups"}


def standardize_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename reserved names, then upper-case every column name."""
    renames = RESERVED_RENAMES if renames is None else renames
    names = [renames.get(name, name).upper() for name in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide once upper-cased: {sorted(names)}")
    return df.toDF(*names)


def add_release_metadata(
    df: DataFrame,
    release: Column | str,
    release_type: Column | str | None = None,
    major: Column | int | None = None,
    minor: Column | int | None = None,
    cohort: Column | str | None = None,
    source_file: Column | str | None = None,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Add the fixed metadata columns; those not given are left out."""

    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    added: dict[str, Column] = {}
    if cohort is not None:
        added["COHORT"] = F.upper(column(cohort))
    added["RELEASE"] = column(release)
    if release_type is not None:
        added["RELEASE_TYPE"] = column(release_type)
    if major is not None:
        added["MAJOR_VERSION"] = column(major).cast("int")
    if minor is not None:
        added["MINOR_VERSION"] = column(minor).cast("int")
    if source_file is not None:
        added["SOURCE_FILE"] = column(source_file)
    added["INGESTED_AT"] = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return df.withColumns(added)


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name, whatever their case; absent names do not matter."""
    wanted = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in wanted])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat not-a-number as missing, as the tables downstream do."""
    fractional = (T.DoubleType, T.FloatType)
    changed = {
        f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, fractional)
    }
    return df.withColumns(changed) if changed else df


def public_projects(nodes: DataFrame, exclude_id: int | None = None) -> DataFrame:
    """Public project nodes, without the home project."""
    rows = nodes.filter(F.col("is_public") & (F.col("node_type") == "project"))
    if exclude_id is not None:
        rows = rows.filter(F.col("project_id") != exclude_id)
    return rows


def _lower_bound(df: DataFrame, column: str, value: date | datetime) -> Column:
    """A literal of the column's own type, so that the comparison is pushed down."""
    kind = df.schema[column].dataType
    return F.lit(value).cast(kind) if isinstance(kind, T.AtomicType) else F.lit(value)


def in_month(df: DataFrame, ts: str, month: date | str) -> DataFrame:
    first, following = dates.month_bounds(month)
    return df.filter(
        (F.col(ts) >= _lower_bound(df, ts, first)) & (F.col(ts) < _lower_bound(df, ts, following))
    )


def up_to_month(df: DataFrame, ts: str, month: date | str) -> DataFrame:
    """On or before the month, including all of it."""
    _, following = dates.month_bounds(month)
    return df.filter(F.col(ts) < _lower_bound(df, ts, following))


def day_range(df: DataFrame, day: str, first: date, last: date) -> DataFrame:
    """Rows of the days ``first`` to ``last``, all of the last day included."""
    end = last + timedelta(days=1)
    return df.filter((F.col(day) >= _lower_bound(df, day, first)) & (F.col(day) < _lower_bound(df, day, end)))


def trailing_days(df: DataFrame, day: str, n: int, asof: date | str) -> DataFrame:
    """Rows of the ``n`` days that end with ``asof``, all of that day included."""
    last = dates.as_date(asof)
    first = dates.lookback_moment(last, 24 * n).date()
    one = timedelta(days=1)
    return df.filter(
        (F.col(day) >= _lower_bound(df, day, first + one)) & (F.col(day) < _lower_bound(df, day, last + one))
    )


def on_lookback_day(df: DataFrame, day: str, hours: int, asof: date | str) -> DataFrame:
    """Rows of the day that begins at midnight of ``asof`` minus ``hours``.

    Hours that are not whole days name no day, so no row matches.
    """
    if hours % 24:
        return df.filter(F.lit(False))
    first = dates.lookback_moment(asof, hours).date()
    return df.filter(
        (F.col(day) >= _lower_bound(df, day, first)) & (F.col(day) < _lower_bound(df, day, first + timedelta(days=1)))
    )


def created_since(df: DataFrame, ts: str, days: int, asof: date | datetime | str) -> DataFrame:
    """Rows whose creation *date* (at midnight) is at or after ``asof - days``.

    A mid-day ``asof`` therefore leaves out the earliest date; the comparison
    becomes a range on the bare column that starts at the first full day.
    """
    limit = dates.as_datetime(asof)
    limit = dates.as_datetime(dates.lookback_moment(limit.date(), 24 * days)).replace(
        hour=limit.hour, minute=limit.minute, second=limit.second, microsecond=limit.microsecond
    )
    first_day = limit.date()
    if limit != dates.as_datetime(first_day):
        first_day = dates.lookback_moment(first_day, -24).date()
    return df.filter(F.col(ts) >= _lower_bound(df, ts, first_day))


def of_type_or_annotation(
    df: DataFrame, types: Sequence[str], annotation: str = "content_type", value: str = "dataset"
) -> DataFrame:
    """Rows of one of the node types, or annotated with the value."""
    return df.filter(F.col("node_type").isin(list(types)) | (F.col(annotation) == value))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def in_pairs(df: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Composite membership: keep rows whose key tuple occurs in ``pairs``."""
    return df.join(pairs.select(*keys), list(keys), "left_semi")


def semi(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a partner in ``other``; the partner side is reduced to its keys first."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def by_value(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def public_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter("is_public").select(*columns)


def exclude_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``ids``; rows without a key stay."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def failed(df: DataFrame) -> DataFrame:
    return by_value(df, "status", "FAILED")


def closed_between(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    """Completed runs inside an inclusive time range."""
    return df.filter(
        F.col("complete").isNotNull()
        & F.col(ts).between(_lower_bound(df, ts, start), _lower_bound(df, ts, end))
    )


def in_range(df: DataFrame, ts: str, start: datetime, end: datetime | None = None) -> Column:
    """Whether a row lies in an inclusive time range, open at the end if none is given."""
    low = F.col(ts) >= _lower_bound(df, ts, start)
    return low if end is None else low & (F.col(ts) <= _lower_bound(df, ts, end))


def between(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    return df.filter(F.col(ts).between(_lower_bound(df, ts, start), _lower_bound(df, ts, end)))


def at_or_after(df: DataFrame, ts: str, start: datetime) -> DataFrame:
    return df.filter(F.col(ts) >= _lower_bound(df, ts, start))
