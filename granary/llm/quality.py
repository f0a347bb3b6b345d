"""Quality classifier: hashed word n-gram logistic regression with follow-the-regularised-leader updates."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from granary.llm.common import WordHashes, held_out, mix64, with_values

BITS = 18
MAX_TRAIN = 6000  # labelled rows used to fit: the bound of what reaches the driver
SCALE = 20.0
_TOKENS = re.compile(r"\w+|[^\w\s]+")


def ngram_ids(text: str | None, hashes: WordHashes, bits: int = BITS) -> np.ndarray:
    """Slots of all words, punctuation runs and pairs of them, over the whole text."""
    h = hashes(_TOKENS.findall(text or ""))
    with np.errstate(over="ignore"):
        pairs = mix64(h[:-1] * np.uint64(31) + h[1:])
    return (np.concatenate([h, pairs]) >> np.uint64(64 - bits)).astype(np.int32)


def fit_ftrl(
    rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = 4,
    alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1,
) -> tuple[np.ndarray, float]:
    """Weights and bias by per-coordinate FTRL-proximal updates; each row is a bag of slots, scaled to a fixed sum.

    Without rows of both labels the weights are zero and the bias gives the observed share.
    """
    if len(rows) == 0 or labels.min() == labels.max():
        share = float(np.clip(labels.mean() if len(rows) else 0.5, 0.01, 0.99))
        return np.zeros(1 << bits), float(np.log(share / (1 - share)))
    size = (1 << bits) + 1  # the last slot is the bias
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    bags = []
    for ids in rows:
        slot, count = np.unique(ids, return_counts=True)
        x = count * (SCALE / max(len(ids), 1))
        bags.append((np.append(slot, size - 1), np.append(x, 1.0)))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(bags)):
            i, x = bags[r]
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - labels[r]) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(size))
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Fit on at most ``max_train`` labelled rows outside the held-out fold, chosen by a hash of the id."""
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "label", "text")

    def bags(batches):
        hashes = WordHashes()
        for b in batches:
            yield pd.DataFrame({
                "doc_id": b.doc_id, "label": b.label,
                "ids": [ngram_ids(t, hashes).tobytes() for t in b.text],
            })

    got = rows.mapInPandas(bags, "doc_id long, label int, ids binary").toPandas()
    got = got.sort_values(["doc_id", "ids"]).drop_duplicates("doc_id")
    return fit_ftrl([np.frombuffer(b, np.int32) for b in got.ids], got.label.to_numpy(float))


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str], into: str = "score") -> DataFrame:
    """Add column ``into`` (0 to 1) as sparse dot products over whole texts; a null text counts as empty (the bias alone)."""
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # 2**BITS floats: fixed size

    def made():
        hashes, w = WordHashes(), shared.value

        def scores(texts):
            logits = []
            for t in texts:
                ids = ngram_ids(t, hashes)
                logits.append(bias + (float(w[ids].sum()) * SCALE / len(ids) if len(ids) else 0.0))
            return 1 / (1 + np.exp(-np.clip(np.array(logits, float), -30, 30)))

        return scores

    return with_values(docs, keep, into, DoubleType(), made)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score and predicted for every row; repeated rows are scored alike, empty tables give no rows.

    Only ``doc_id`` and ``text`` are read; other columns, whatever their names, play no part.
    """
    out = score(docs.select("doc_id", "text"), train(docs, labels, max_train), ["doc_id"])
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = MAX_TRAIN) -> DataFrame:
    """The documents scored at or above ``threshold``, with the columns they came with."""
    scored = score(docs, train(docs, labels, max_train), docs.columns, "granary score")
    return scored.where(F.col("granary score") >= threshold).drop("granary score")
