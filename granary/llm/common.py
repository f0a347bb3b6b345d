"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

from granary.session import scratch_path

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialised(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that outlives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(scratch: DataFrame) -> None:
    """Remove the files of a ``materialised`` table; everything made from it has to be written by then."""
    jvm, conf = scratch.sparkSession._jvm, scratch.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in scratch.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(conf).delete(path, True)


ROW = "granary row"  # column of row ids


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """The rows with an id each that stays the same in every later use: ids of the data may be null or repeat.

    This copy of the texts stays until a stage's result is written, so it is packed tighter than other scratch tables.
    """
    return materialised(docs.withColumn(ROW, F.monotonically_increasing_id()), label, "zstd")


BITMAP = 32768  # rows of a bitmap, as Spark builds them


def picked(rows: DataFrame, ids: DataFrame, kind: str = "left_semi") -> DataFrame:
    """The numbered rows whose id is among ``ids``, or with ``left_anti`` those whose id is not, without a shuffle of them.

    One bit for each row, in blocks of BITMAP rows, is broadcast instead of the ids, so that texts stay where they are
    read however many ids there are.  Only the ids are shuffled.
    """
    row = f"`{ROW}`"
    bits = ids.select(F.expr(f"{row} div {BITMAP}").alias("granary block"), F.expr(f"{row} % {BITMAP}").alias("granary place"))
    bits = bits.repartition("granary block").groupBy("granary block").agg(F.bitmap_construct_agg("granary place").alias("granary bits"))
    byte = f"cast(conv(hex(substring(`granary bits`, cast({row} % {BITMAP} div 8 as int) + 1, 1)), 16, 10) as bigint)"
    held = F.expr(f"{row} div {BITMAP} = `granary block` and getbit({byte}, cast({row} % 8 as int)) = 1")
    return rows.join(F.broadcast(bits), held, kind)


AT_ONCE = 256  # rows a task holds as Python values at a time


def with_values(
    docs: DataFrame, keep: list[str], into: str, kind: DataType, made: Callable[[], Callable[..., list]], extra: list[str] | None = None
) -> DataFrame:
    """``keep`` and column ``into``, worked out from the texts of a few rows at a time.

    ``made`` is called once per task; what it returns gets a list for the texts and for each column of ``extra``.  The
    kept columns pass through as they are, so that a task holds no second copy of a batch.
    """
    read = ["text", *(extra or [])]
    names = [*dict.fromkeys([*keep, *read])]
    narrow = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = StructType([narrow.schema[c] for c in keep]).add(into, kind)
    arrow_kind = to_arrow_type(kind)

    def worked(batches):
        values = made()
        for b in batches:
            for lo in range(0, b.num_rows, AT_ONCE):
                part = b.slice(lo, AT_ONCE)
                got = values(*[part.column(names.index(c)).to_pylist() for c in read])
                kept = [part.column(names.index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(got, arrow_kind)], names=[*keep, into])

    return narrow.mapInArrow(worked, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text leaves no remainder modulo 5; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        x = x + _M1
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, remembering recent ones; the memory is emptied at a fixed size."""

    def __init__(self, remembered: int = 250_000):
        import xxhash

        self._hash = xxhash.xxh64_intdigest
        self._known: dict[str, int] = {}
        self._remembered = remembered

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self._known
        if len(known) > self._remembered:
            known.clear()
        try:
            return np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            for w in set(words):
                if w not in known:
                    known[w] = self._hash(w.encode("utf-8", "surrogatepass"))
            return np.array([known[w] for w in words], dtype=np.uint64)


def shingles(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; fewer words count as one run, none as nothing."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    width_here = min(width, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width_here + 1, np.uint64(width_here), np.uint64)
        factor = _M1
        for k in range(width_here):
            out += word_hashes[k : n - width_here + 1 + k] * factor
            factor = factor * _M2  # odd, another one for every place
        out = mix64(out)
    return np.unique(out)
