"""Toxicity: gradient-boosted trees over dense text features with isotonic calibration.

Two lexicons give the densities: a fixed one, and word beginnings learned from the labelled rows, whichever occur in
toxic documents far more often than in others.  The learned one is made three times: from each half of the rows, so that
no row gives features of itself to the trees and the curve, and from all of them for scoring.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from granary.llm.common import held_out, materialised, with_values

MAX_TRAIN = 8000  # labelled rows used to fit

# Insulting words in four languages
LEXICON = frozenset(
    "idiot idiots idiotic moron morons moronic stupid dumb loser losers scum trash clown clowns pathetic worthless "
    "disgusting imbecile fool freak creep jerk bastard bitch asshole fuck fucking shit crap damn whore slut retard pig "
    "vermin filth garbage ugly hate kill die dummkopf arschloch scheisse scheiße abschaum trottel wichser "
    "dumm blöd versager connard salaud merde imbécile crétin ordure débile abruti idiota estúpido imbécil basura "
    "mierda cabrón puta escoria payaso patético asqueroso inútil".split()
)
# Words addressing a person in four languages
SECOND = frozenset("you your youre yours ya u du dich dir dein deine ihr euch tu toi te ton vous votre tú usted ti vosotros".split())
_LEET = str.maketrans("01345$@!7", "oieassait")
_WORD = re.compile(r"[\w$@!*'’-]+")
_SPLIT = re.compile(r"(?:\b\w[.\-_* ]){3,}\w\b")
N_FEATURES = 18
BEGINNINGS = range(3, 9)  # letters of the word beginnings that are learned
LEARNED = 2000  # most beginnings of a learned lexicon
LEAST_ODDS = 2.0  # log odds of a learned beginning
LEAST_EVIDENCE = 25.0  # likelihood ratio statistic of a learned beginning
REMEMBERED = 200_000  # words whose weight a task remembers
TOXIC_WEIGHT = 3.0  # of a toxic row when trees are grown: there are far fewer of them


def plain_words(text: str | None) -> list[str]:
    """Lower-cased words with common stand-ins for letters undone."""
    low = (w.lower().strip("!*'’-") for w in _WORD.findall(text or ""))
    return [w if w.isalpha() else w.translate(_LEET) for w in low]


class Weights:
    """The largest log odds among a word's learned beginnings, 0.0 without one; remembers recent words."""

    def __init__(self, learned: dict[str, float]):
        self.learned, self._known = learned, {}

    def __call__(self, word: str) -> float:
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            found = max((self.learned.get(word[:k], 0.0) for k in BEGINNINGS if k <= len(word)), default=0.0)
            self._known[word] = found
        return found


def features(text: str | None, weight: Weights | None = None) -> list[float]:
    """Eighteen densities of a whole text; an empty or null text gives zeros."""
    text = text or ""
    words = _WORD.findall(text)
    n, chars = max(len(words), 1), max(len(text), 1)
    low = [w.lower().strip("!*'’-") for w in words]
    learned = [(k, w, odds) for k, w in enumerate(plain_words(text)) if (odds := weight(w))] if weight else []
    near_learned = sum(any(v in SECOND for v in low[max(0, k - 5) : k + 6]) for k, _, _ in learned)
    hits = [k for k, w in enumerate(low) if w in LEXICON]
    near = obfuscated = 0
    for k, w in enumerate(low):
        if w in SECOND and any(v in LEXICON for v in low[max(0, k - 5) : k + 6]):
            near += 1
        if not w.isalpha() and w and w not in LEXICON:
            plain = w.translate(_LEET)
            if plain in LEXICON or ("*" in w and any(c.isalpha() for c in w)):
                obfuscated += 1
    for run in _SPLIT.findall(text):
        if re.sub(r"\W|_", "", run).lower() in LEXICON:
            obfuscated += 1
    caps = sum(1 for w in words if len(w) > 1 and w.isupper())
    return [
        len(hits) / n, np.log1p(len(hits)), np.log1p(len({low[k] for k in hits})), sum(w in SECOND for w in low) / n,
        np.log1p(near), obfuscated / n, np.log1p(obfuscated), caps / n, text.count("!") / chars,
        text.count("?") / chars, sum(text.count(c) for c in "*#$%&@") / chars, np.log1p(len(words)),
        len(learned) / n, np.log1p(len(learned)), np.log1p(len({w for _, w, _ in learned})),
        sum(odds for _, _, odds in learned) / n, max((odds for _, _, odds in learned), default=0.0), np.log1p(near_learned),
    ]


def learned_beginnings(rows: DataFrame) -> list[dict[str, float]]:
    """Beginnings and their log odds learned from the rows of half 1, of half 0, and of all.

    ``rows`` has label, half and text.  A beginning counts once per document.  At most LEARNED of each lexicon, those
    with the most evidence, reach the driver.
    """

    def count(batches):
        for b in batches:
            found: dict[tuple, Counter] = {}
            for label, half, text in zip(b.label, b.half, b.text):
                seen = {w[:k] for w in set(plain_words(text)) if w.isalpha() for k in BEGINNINGS if k <= len(w)}
                found.setdefault((int(label), int(half)), Counter()).update(seen)
            for (label, half), c in found.items():
                yield pd.DataFrame({"label": label, "half": half, "beginning": list(c), "n": list(c.values())})

    counted = rows.mapInPandas(count, "label int, half int, beginning string, n long")
    sums = {f"n{y}{h}": F.sum(F.when((F.col("label") == y) & (F.col("half") == h), F.col("n")).otherwise(0)) for y in (0, 1) for h in (0, 1)}
    table = counted.groupBy("beginning").agg(*[c.alias(name) for name, c in sums.items()])
    table = materialised(table.where("n10 + n11 >= 3"), "toxicity-beginnings")
    sizes = {(r["label"], r["half"]): r["count"] for r in rows.groupBy("label", "half").count().collect()}
    out = []
    for halves in ((1,), (0,), (0, 1)):
        toxic, clean = (sum(sizes.get((y, h), 0) for h in halves) for y in (1.0, 0.0))
        t, c = (sum(F.col(f"n{y}{h}") for h in halves).cast("double") for y in (1, 0))
        share = toxic / max(toxic + clean, 1)
        if not 0 < share < 1:
            out.append({})
            continue
        odds = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
        # how much better the beginning's own share of toxic documents explains them than the share of all
        told = lambda n, p: F.when(n > 0, n * F.log(n / (t + c) / p)).otherwise(0.0)
        evidence = 2 * (told(t, share) + told(c, 1 - share))
        best = table.where(t + c > 0).select("beginning", odds.alias("odds"), evidence.alias("evidence"))
        best = best.where((F.col("odds") >= LEAST_ODDS) & (F.col("evidence") >= LEAST_EVIDENCE))
        best = best.orderBy(F.desc("evidence"), "beginning").limit(LEARNED)
        out.append({r["beginning"]: r["odds"] for r in best.collect()})
    return out


def with_features(docs: DataFrame, keep: list[str], lexicons: list[dict[str, float]], fold: str | None = None) -> DataFrame:
    """``keep`` and the features by the last lexicon, or by the one that column ``fold`` names."""

    def made():
        weights = [Weights(x) for x in lexicons]
        return lambda texts, folds=None: [features(t, weights[f]) for t, f in zip(texts, folds or [-1] * len(texts))]

    return with_values(docs, keep, "features", ArrayType(DoubleType()), made, [fold] if fold else None)


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN):
    """Trees fitted on three quarters of the open rows, an isotonic curve on the rest, the lexicon; None without both labels."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)

    def part(name: str, n: int):
        return F.crc32(F.concat(F.lit(name), F.col("doc_id").cast("string")).cast("binary")) % n

    rows = docs.select("doc_id", "text").join(known, "doc_id").dropDuplicates(["doc_id", "text"])
    rows = rows.select("doc_id", "label", part("h", 2).cast("int").alias("half"), "text")
    rows = materialised(rows, "toxicity-rows")
    lexicons = learned_beginnings(rows)
    rows = with_features(rows, ["doc_id", "label"], lexicons, "half")
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.max("features").alias("features"))
    rows = rows.select(
        "label", array_to_vector("features").alias("vector"), (part("c", 4) == 0).alias("curve"),
        F.when(F.col("label") == 1, TOXIC_WEIGHT).otherwise(1.0).alias("weight"),
    )
    rows = materialised(rows.coalesce(4), "toxicity-train")
    counts = {(r["curve"], r["label"]): r["count"] for r in rows.groupBy("curve", "label").count().collect()}
    if any((c, y) not in counts for c in (True, False) for y in (0.0, 1.0)):
        return None
    grower = GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", maxIter=20, maxDepth=4, maxBins=64, seed=7
    )
    trees = grower.fit(rows.where(~F.col("curve")))
    curve = trees.transform(rows.where("curve")).select("label", vector_to_array("probability")[1].alias("raw"))
    return trees, IsotonicRegression(featuresCol="raw", labelCol="label").fit(curve), lexicons[-1]


def score(
    docs: DataFrame, labels: DataFrame, keep: list[str], max_train: int = MAX_TRAIN, into: str = "score"
) -> DataFrame:
    """``keep`` and a calibrated score in column ``into``; without labelled rows of both kinds the score is 0."""
    model = fit(docs, labels, max_train)
    if model is None:
        return docs.select(*keep, F.lit(0.0).alias(into))
    trees, curve, lexicon = model
    # the columns keep out of the way under names of their own, whatever they are called
    plain = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("text"))
    names = [f"k{i}" for i in range(len(keep))]
    rows = with_features(plain, names, [lexicon]).withColumn("vector", array_to_vector("features"))
    rows = trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
    rows = curve.setPredictionCol("curve").transform(rows)
    final = F.least(F.greatest(F.col("curve"), F.lit(0.0)), F.lit(1.0))
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], final.alias(into))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score and predicted for every row, null, empty and repeated texts included."""
    out = score(docs.select("doc_id", "text"), labels, ["doc_id"], max_train)
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_train: int = MAX_TRAIN) -> DataFrame:
    """The documents scored below ``threshold``, with the columns they came with."""
    rows = score(docs, labels, docs.columns, max_train, "granary score")
    return rows.where(F.col("granary score") < threshold).drop("granary score")
