"""Bottom-k sketches of word shingles: mergeable document fingerprints."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import WordHashes, shingles

K = 128
WIDTH = 5
_BITS = 48
_WORDS = re.compile(r"\S+")


def sketch(text: str | None, hashes: WordHashes, k: int = K, width: int = WIDTH) -> np.ndarray:
    """The k smallest distinct shingle hashes, ascending; empty without words."""
    h = shingles(hashes(_WORDS.findall(text or "")), width) >> np.uint64(64 - _BITS)
    return np.unique(h[: k + 64])[:k]


def to_string(s: np.ndarray) -> str:
    return "".join(f"{int(v):012x}" for v in s)


def from_string(text: str) -> np.ndarray:
    return np.array([int(text[i : i + 12], 16) for i in range(0, len(text), 12)], dtype=np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two parts put together."""
    return np.union1d(a, b)[:k]


def distinct_count(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(s)) if len(s) < k else (k - 1) / ((float(s[-1]) + 1) / 2.0**_BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness; two empty sketches are alike, an empty and another one are not."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    both = merge(a, b, k)
    return float(np.isin(both, np.intersect1d(a, b), assume_unique=True).sum()) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated part of a's shingles that b has too."""
    if len(a) == 0:
        return 1.0
    both = merge(a, b, k)
    share = resemblance(a, b, k) * distinct_count(both, k)
    return min(1.0, share / distinct_count(a, k))


def edited_text(text: str, following: str) -> str:
    """The last quarter replaced by the first as many code points of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, tasks: int | None = None) -> DataFrame:
    """Fingerprints of whole texts and of their edited forms, in ascending (doc_id, text) order, first after last.

    A null text counts as empty, a null doc_id comes first, repeated rows follow each other.  One shuffle of the
    texts: ranges of ids, each with the first document of the next range added.  The smallest id of every range is
    found first and reaches the driver (``tasks`` numbers at most), so the added documents are picked in the scan.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tasks = tasks or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(rows.approxQuantile("doc_id", [i / tasks for i in range(1, tasks)], 0.25 / tasks) or []))
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(edges, ids[known].astype("int64").to_numpy(), side="right")
        return pd.Series(out)

    dealt = rows.withColumn("bucket", bucket_of("doc_id"))
    lowest = F.min(F.struct(F.col("doc_id"), F.col("text")))
    firsts = rows.select("doc_id").withColumn("bucket", bucket_of("doc_id")).groupBy("bucket").agg(
        F.min("doc_id").alias("low"), F.count_if(F.isnull("doc_id")).alias("none")
    ).collect()
    lows = [r["low"] for r in firsts if not r["none"] and r["low"] is not None]
    first = F.col("doc_id").isin(lows)
    if any(r["none"] for r in firsts):  # nulls come first of all, so they head their range
        first = first | F.isnull("doc_id")
    heads = dealt.where(first).groupBy("bucket").agg(lowest.alias("low")).select("bucket", "low.*")
    order = Window.orderBy(F.col("bucket").desc())  # one row per range of ids, at most `tasks`
    wrap = F.max("bucket").over(Window.partitionBy(F.lit(1)))
    heads = heads.select(
        "doc_id", "text", F.coalesce(F.lead("bucket").over(order), wrap).alias("bucket"), F.lit(1).alias("extra")
    )
    # the lead in descending order is the range before; the first range's head goes to the last range
    laid = dealt.withColumn("extra", F.lit(0)).unionByName(heads)
    laid = laid.repartition(tasks, "bucket").sortWithinPartitions("bucket", "extra", "doc_id", "text")
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def work(batches):
        hashes = WordHashes()
        held = None  # the document waiting for the next one: (bucket, id, text, sketch)
        for b in batches:
            out = []
            for doc_id, text, bucket, extra in zip(b.doc_id, b.text, b.bucket, b.extra):
                mine = sketch(text, hashes)
                if held is not None and held[0] == bucket:
                    edited = edited_text(held[2], text)
                    other = sketch(edited, hashes)
                    out.append((
                        held[1], len(held[2]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        to_string(held[3]), to_string(other), resemblance(held[3], other), resemblance(held[3], mine),
                    ))
                held = None if extra else (bucket, doc_id, text, mine)
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return laid.mapInPandas(work, schema)
