"""Session settings, the shared scratch folder and lineage cutting.

Nothing here picks partition counts for the caller: adaptive execution sizes
the shuffles from what it measures.  ``RECOMMENDED_CONF`` lists the switches
the library is designed for; a cluster may set them in its own defaults.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # integer sums that do not fit are an error, never a wrong number
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def configure(builder: SparkSession.Builder, **overrides: str) -> SparkSession.Builder:
    """Apply the recommended settings, then the caller's own."""
    for key, value in {**RECOMMENDED_CONF, **overrides}.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, because a driver-local folder would
    be invisible to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="granary-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never handed out twice."""
    return f"{shared_folder(spark).rstrip('/')}/granary/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that every later use reads the same rows.

    Used where a plan reads one intermediate result more than once and a
    second evaluation would be costly or could differ.  The files live in the
    shared folder, so losing executors does not lose the result.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A few configured rows as a local relation.

    Going through Arrow makes it part of the plan with its exact size, so a
    join with it broadcasts; rows given directly would be of unknown size.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [() for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    table = pa.table(
        [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow)], schema=arrow
    )
    return spark.createDataFrame(table, schema)


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder on the file system Spark reads it from."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(jvm_path).isDirectory()
