"""Join operators.

No operator forces a broadcast.  Small sides are broadcast by Catalyst from
their known size or by adaptive execution from their measured size; beyond
the threshold the same join shuffles and skewed partitions are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from granary.session import literal_table


def downloads_with_files(events: DataFrame, projects: DataFrame, files: DataFrame) -> DataFrame:
    """Download events of the given projects, with the size of the downloaded file.

    The project side only filters here (one row per project), so it is reduced
    to its key; events whose file is unknown are left out.
    """
    kept = events.join(projects.select("project_id").distinct(), "project_id", "left_semi")
    sizes = files.select(F.col("id").alias("file_handle_id"), "content_size")
    return kept.join(sizes, "file_handle_id")


def nodes_with_files(nodes: DataFrame, files: DataFrame) -> DataFrame:
    """Nodes with the size of the file they point at."""
    sizes = files.select(F.col("id").alias("file_handle_id"), "content_size")
    return nodes.join(sizes, "file_handle_id")


def with_profile(entities: DataFrame, users: DataFrame) -> DataFrame:
    """Entities with their creator's profile, kept when there is none."""
    profile = users.select(
        F.col("id").alias("created_by"), "user_name", "first_name", "last_name"
    )
    return entities.join(profile, "created_by", "left")


def with_file_type(versions: DataFrame, files: DataFrame, default: str = "NOT_SET") -> DataFrame:
    """File versions with their content type, or the default when it is not known."""
    types = files.select(F.col("id").alias("file_handle_id"), "content_type")
    joined = versions.join(types, "file_handle_id", "left")
    return joined.withColumn("content_type", F.coalesce("content_type", F.lit(default)))


def with_group_totals(stats: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stats.join(totals, list(keys), "left")


def membership_flag(
    df: DataFrame,
    keys_df: DataFrame,
    keys: Sequence[str],
    flag: str = "IN_LATEST_RELEASE",
    yes: str = "Yes",
    no: str = "No",
) -> DataFrame:
    """Mark every row by whether its key tuple occurs in ``keys_df``."""
    present = keys_df.select(*keys).distinct().withColumn("_present", F.lit(True))
    joined = df.join(present, list(keys), "left")
    return joined.withColumn(
        flag, F.when(F.col("_present"), F.lit(yes)).otherwise(F.lit(no))
    ).drop("_present")


def only_latest(df: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the given versions: one semi join, whatever their number."""
    return df.join(latest.select(*keys), list(keys), "left_semi")


def one_row_table(*frames: DataFrame) -> DataFrame:
    """Put one-row results side by side.

    Every frame becomes one row of a common schema and a single aggregate
    folds the rows, so there is no product of frames in the plan.
    """
    columns = [(name, kind) for frame in frames for name, kind in frame.dtypes]
    if len({name for name, _ in columns}) != len(columns):
        raise ValueError("one_row_table needs distinct column names")
    padded = [
        frame.select(*[
            F.col(name) if name in frame.columns else F.lit(None).cast(kind).alias(name)
            for name, kind in columns
        ])
        for frame in frames
    ]
    stacked = padded[0]
    for frame in padded[1:]:
        stacked = stacked.unionAll(frame)
    return stacked.agg(*[F.max(name).alias(name) for name, _ in columns])


def explode_members(df: DataFrame, array_col: str, as_name: str) -> DataFrame:
    """One row per array member, in place of the array."""
    rest = [c for c in df.columns if c != array_col]
    return df.select(*rest, F.explode(array_col).alias(as_name))


def bridge(entities: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Entities joined to the groups they belong to; several groups give several rows."""
    return entities.join(members, key)


def constant_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A configured list as a table; its exact size is known to the planner."""
    return literal_table(spark, rows, schema)


def new_ids(df: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been processed before."""
    return df.join(processed.select(key).distinct(), key, "left_anti")


def stale_rows(links: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows without a current counterpart on the whole key."""
    return links.join(current.select(*keys).distinct(), list(keys), "left_anti")


def lookup(
    df: DataFrame, mapping: DataFrame, keys: Sequence[str], default: object | None = None
) -> DataFrame:
    """Attach mapping columns by key; ``default`` fills them where nothing matches."""
    joined = df.join(mapping, list(keys), "left")
    if default is None:
        return joined
    added = [c for c in mapping.columns if c not in keys]
    return joined.withColumns({c: F.coalesce(c, F.lit(default)) for c in added})
