"""Language identification by known words first, then by ever shorter character n-grams of unknown words."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import held_out

LONGEST = 5  # letters of the longest n-gram
DOCS_PER_LANGUAGE = 3_000  # labelled documents a language is learned from, in the mean of the hash that picks them
WORDS = 400_000  # most words of the model, shared out evenly among the languages
WORDS_PER_LANGUAGE = 60_000
GRAMS = 400_000  # most n-grams of the model
REMEMBERED = 200_000  # unknown words whose n-gram scores a task remembers
SMOOTHING = 0.5
_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def has_letter(found: list[str]) -> bool:
    """Whether a letter is among the words: they may hold numerals that are neither digits nor letters."""
    return any(w.isalpha() for w in found) or any(c.isalpha() for w in found for c in w)


def grams(word: str, n: int) -> list[str]:
    """The character n-grams of a word with its two edges marked; the word as a whole where it is shorter."""
    edged = f"\2{word}\3" if n > 1 else word
    return [edged[k : k + n] for k in range(max(len(edged) - n + 1, 1))]


class Model:
    """Log frequencies per language: of words, and of the n-grams of each length of those words."""

    def __init__(self, languages: list[str], counts: list[tuple[str, str, int]], shares: list[float], longest: int = LONGEST):
        """``counts`` are (language, word, n); ``shares`` the languages' parts of the labelled documents."""
        self.languages, self.longest = languages, longest
        self.prior = np.log(np.maximum(np.array(shares, float), 1e-12))
        place = {name: k for k, name in enumerate(languages)}
        tables: list[dict[str, np.ndarray]] = [{} for _ in range(longest + 1)]
        for language, word, n in counts:
            k = place[language]
            for length in range(1, longest + 1):
                for g in grams(word, length):
                    tables[length].setdefault(g, np.zeros(len(languages)))[k] += n
            tables[0].setdefault(word, np.zeros(len(languages)))[k] += n
        self.known, self.logs = [], []
        room = GRAMS // longest
        for length, table in enumerate(tables):
            if length and len(table) > room:
                often = sorted(table, key=lambda g: (-table[g].sum(), g))[:room]
                table = {g: table[g] for g in often}
            seen = np.stack(list(table.values())) if table else np.zeros((0, len(languages)))
            seen += SMOOTHING
            self.known.append({g: i for i, g in enumerate(table)})
            self.logs.append(np.log(seen / seen.sum(axis=0)) if len(seen) else seen)

    def word(self, w: str) -> np.ndarray:
        """Scores of one word per language: its own frequency, else the mean of its longest known n-grams."""
        at = self.known[0].get(w)
        if at is not None:
            return self.logs[0][at]
        for n in range(self.longest, 0, -1):
            known = self.known[n]
            found = [known[g] for g in grams(w, n) if g in known]
            if found:
                return self.logs[n][found].mean(axis=0)
        return np.zeros(len(self.languages))


class Scorer:
    """Scores of whole texts, with the scores of recent unknown words at hand."""

    def __init__(self, model: Model, remembered: int = REMEMBERED):
        self.model, self.remembered = model, remembered
        self._clear()

    def _clear(self) -> None:
        logs = self.model.logs[0]
        self.place = dict(self.model.known[0])
        self.table = np.concatenate([logs, np.zeros((1024, len(self.model.languages)))])
        self.used = len(logs)

    def _add(self, w: str) -> None:
        if self.used == len(self.table):
            self.table = np.concatenate([self.table, np.zeros((len(self.table) // 2 + 1024, self.table.shape[1]))])
        self.table[self.used] = self.model.word(w)
        self.place[w] = self.used
        self.used += 1

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(language, share of it in the tempered posterior); ("und", 0.0) without a letter or a learned language."""
        found = words(text)
        if not self.model.languages or not has_letter(found):
            return "und", 0.0
        total = np.zeros(len(self.model.languages))
        for lo in range(0, len(found), self.remembered):
            part = found[lo : lo + self.remembered]
            if self.used - len(self.model.known[0]) > self.remembered:
                self._clear()
            place = self.place
            try:
                at = [place[w] for w in part]
            except KeyError:
                for w in dict.fromkeys(part):
                    if w not in place:
                        self._add(w)
                at = [place[w] for w in part]
            total += self.table[at].sum(axis=0)
        # the words of a text are not independent: their sum counts as the root of their number
        logits = total / np.sqrt(len(found)) + self.model.prior / len(found)
        p = np.exp(logits - logits.max())
        best = int(p.argmax())
        return self.model.languages[best], float(p[best] / p.sum())


def train(
    docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, words_per_language: int = WORDS_PER_LANGUAGE
) -> Model:
    """Learn from documents outside the held-out fold whose text and lang are there.

    A hash of id and text picks about ``docs_per_language`` documents of each language, all of them where there are
    fewer; tasks count their words.  The driver sees one number per language and at most WORDS words, the most
    frequent ones of each language.
    """
    open_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    open_ = open_.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in open_.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], [], [])
    limits = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, docs_per_language / sizes[name]))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003.0
    sample = open_.where(draw < limits[F.col("lang")]).select("lang", "text")

    def count(batches):
        for b in batches:
            found: dict[str, Counter] = {}
            for language, text in zip(b.lang, b.text):
                found.setdefault(language, Counter()).update(words(text))
            for language, c in found.items():
                yield pd.DataFrame({"lang": language, "word": list(c), "n": list(c.values())})

    counted = sample.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    most = min(words_per_language, max(1, WORDS // len(languages)))
    top = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    got = top.orderBy("lang", "place").select("lang", "word", "n").toPandas()
    everything = sum(sizes.values())
    return Model(
        languages, list(zip(got.lang, got.word, got.n.astype(int))), [sizes[name] / everything for name in languages]
    )


def identify(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, from whole texts alone.

    Null texts and texts without a letter are ``und`` with score 0, as all are if nothing could be learned.  Equal
    texts, repeated rows among them, get equal answers; languages that tie go to the first by name.  A null id counts
    as held out; other columns play no part.
    """
    model = train(docs, docs_per_language)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WORDS words and GRAMS n-grams at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def scored(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            got = [scorer(t) for t in b.text]
            yield pd.DataFrame({
                "doc_id": b.doc_id.astype("Int64"), "lang_pred": [g[0] for g in got], "score": [g[1] for g in got],
            })

    out = rows.mapInPandas(scored, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
