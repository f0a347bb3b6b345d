"""Mixture-controlled packing into windows of a fixed number of tokens.

Deficit round robin over one token queue per source, in closed form: how far each queue has come at an output
position follows from rounded shares, so what a queue gets short in one window it gets in a later one, and every
task works out its own pieces without talking to the others.  Sources too small for a piece in every window share one
queue, itself a mixture of them by the same rule over longer stretches, and so on down to the smallest.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import materialised

WINDOW = 2048
REST = "\0small sources"  # no stored source has this name
MIN_SHARE = 16  # sources with fewer tokens than this per window share one queue
REMEMBERED = 1_000_000  # bounds that a layout remembers
BATCH_CHARS = 1_000_000  # characters whose ids are handed on at a time; a longer text goes alone
LONG_RUN = 1000  # characters without (or only of) white space that the fast encoder is kept from
_TOKENS = "part long, doc_id long, source string, pos long, doc_tokens long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string"
)


def phases(totals: dict[str, int], target: dict[str, float] | None = None) -> list[dict]:
    """Stretches of the output with fixed shares; one ends when a queue runs out and the others take its part over.

    ``target`` defaults to the shares of all tokens, with which all queues run out together.  A queue without a
    target gets tokens only after all others.
    """
    left = {q: n for q, n in sorted(totals.items()) if n > 0}
    used, begin, out = dict.fromkeys(left, 0), 0, []
    while left:
        weight = {q: float(target.get(q, 0.0)) if target else float(left[q]) for q in left}
        live = {q: w for q, w in weight.items() if w > 0} or {q: float(left[q]) for q in left}
        if target:
            end = min(left[q] / w for q, w in live.items())
            amount = {q: min(left[q], int(round(w * end))) for q, w in live.items()}
            first = min(live, key=lambda q: left[q] / live[q])
            amount[first] = left[first]
            amount = {q: n for q, n in amount.items() if n > 0}
        else:
            amount = dict(left)
        queues = list(amount)
        edges = np.cumsum([amount[q] for q in queues]).tolist()
        out.append({"begin": begin, "queues": queues, "edges": edges, "used": [used[q] for q in queues]})
        begin += edges[-1]
        for q, n in amount.items():
            left[q] -= n
            used[q] += n
        left = {q: n for q, n in left.items() if n > 0}
    return out


class Layout:
    """Where each token of a queue goes."""

    def __init__(self, parts: list[dict], window: int = WINDOW):
        self.parts, self.window = parts, window
        widest = max((len(p["edges"]) for p in parts), default=0) + 1
        self._bounds = lru_cache(max(2, REMEMBERED // widest))(self._bounds_at)

    def _bounds_at(self, p: int, u: int) -> list[int]:
        """Tokens of the first k queues among the first ``u`` of a phase; never decreasing in ``u`` for any queue."""
        edges = self.parts[p]["edges"]
        out = [0] * (len(edges) + 1)
        out[-1] = u
        for k in range(len(edges) - 1, 0, -1):
            out[k] = out[k + 1] * edges[k - 1] // edges[k]
        return out

    def _cuts(self, p: int, j: int) -> int:
        """Start of the j-th window-sized segment of a phase, counted from the phase's begin."""
        begin, total = self.parts[p]["begin"], self.parts[p]["edges"][-1]
        return min(max((begin // self.window + j) * self.window - begin, 0), total)

    def pieces(self, queue: str, at: int, n: int):
        """(tokens before, length, output position) of queue tokens at .. at + n."""
        done = 0
        for p, part in enumerate(self.parts):
            if queue not in part["queues"]:
                continue
            k = part["queues"].index(queue)
            low = part["used"][k]
            amount = part["edges"][k] - (part["edges"][k - 1] if k else 0)
            while done < n and low <= at + done < low + amount:
                t = at + done - low
                j = (part["begin"] + t * part["edges"][-1] // amount) // self.window - part["begin"] // self.window

                def reached(j: int) -> int:
                    b = self._bounds(p, self._cuts(p, j))
                    return b[k + 1] - b[k]

                while j > 0 and reached(j) > t:
                    j -= 1
                while reached(j + 1) <= t:
                    j += 1
                u0, u1 = self._cuts(p, j), self._cuts(p, j + 1)
                b0, b1 = self._bounds(p, u0), self._bounds(p, u1)
                take = min(n - done, (b1[k + 1] - b1[k]) - t)
                where = part["begin"] + u0 + (b1[k] - b0[k]) + t - (b0[k + 1] - b0[k])
                yield done, take, where
                done += take
        if done != n:
            raise ValueError(f"queue {queue!r} holds fewer than {at + n} tokens")


def levels(totals: dict[str, int], target: dict[str, float] | None = None, window: int = WINDOW) -> list[tuple]:
    """(phases, window) of the output, then of the queue REST of each level before.

    Without a target, sources under MIN_SHARE tokens a window go to REST.  Its own windows are so long that each
    source of at least half its largest one's tokens gets MIN_SHARE of them, so tokens halve from level to level.
    """
    out, left = [], dict(sorted(totals.items()))
    while True:
        everything = sum(left.values())
        small = {} if target else {s: n for s, n in left.items() if n * window < MIN_SHARE * everything}
        own = {s: n for s, n in left.items() if s not in small}
        out.append((phases({**own, REST: sum(small.values())} if small else own, target), window))
        if not small:
            return out
        left, window = small, -(-2 * MIN_SHARE * sum(small.values()) // max(small.values()))


class Mixture:
    """Where each token of a source goes, through the levels."""

    def __init__(self, found: list[tuple]):
        self.layouts = [Layout(parts, window) for parts, window in found]
        self.level = {q: k for k, (parts, _) in enumerate(found) for part in parts for q in part["queues"] if q != REST}

    def pieces(self, source: str, at: int, n: int):
        """(tokens before, length, output position) of source tokens at .. at + n."""
        k = self.level[source]
        out = list(self.layouts[k].pieces(source, at, n))
        for layout in reversed(self.layouts[:k]):
            joined: list[tuple] = []
            for done, size, where in out:  # what lies together in REST goes on as one
                if joined and joined[-1][2] + joined[-1][1] == where:
                    done, size, where = joined[-1][0], joined[-1][1] + size, joined.pop()[2]
                joined.append((done, size, where))
            out = [(done + d, m, to) for done, size, where in joined for d, m, to in layout.pieces(REST, where, size)]
        return out


# Fixed value: how byte-level BPE cuts a text before merging.
_BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_ranks(described: dict) -> dict[bytes, int] | None:
    """Merge ranks of a tokenizer file that is plain byte-level BPE whose ids follow its merges, else None."""
    model, cutter = described["model"], described.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and described.get("normalizer") is None and cutter.get("type") == "ByteLevel"
        and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    )
    if not plain:
        return None
    # printable bytes stand for themselves in the file, the others for the characters from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))})
    vocabulary = model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if len(vocabulary) != 256 + len(merged) or any(vocabulary.get(m) != 256 + k for k, m in enumerate(merged)):
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}


_LONG = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")


def has_long_run(text: str, half: int = LONG_RUN // 2) -> bool:
    """Whether LONG_RUN characters without, or only of, white space follow each other.

    Such a run holds all of some half that begins at a multiple of its length; few texts have one to look at closer.
    """
    halves = (text[k : k + half] for k in range(0, len(text) - half + 1, half))
    return any(" " not in h or h.isspace() for h in halves) and _LONG.search(text) is not None


def encoder(tokenizer: str):
    """A function from a text to its ids by the tokenizer file, the same ids by the fastest way there is.

    Plain byte-level BPE is worked out by ``tiktoken`` from the file's own merges.  Texts that hold one of the file's
    added tokens, or very long runs with or without white space, and all other kinds of files go through
    ``tokenizers``, one text at a time and without threads of its own.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer)
    with open(tokenizer, encoding="utf-8") as f:
        described = json.load(f)
    ranks = _byte_ranks(described)

    def by_file(text: str) -> list[int]:
        return slow.encode(text, add_special_tokens=False).ids

    if ranks is None:
        return by_file
    import tiktoken

    fast = tiktoken.Encoding("granary", pat_str=_BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = [t["content"] for t in described.get("added_tokens", [])]

    def encode(text: str) -> list[int]:
        if any(a in text for a in added) or has_long_run(text):
            return by_file(text)
        return fast.encode_ordinary(text)

    return encode


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Token ids of whole texts with their place among the task's tokens of the same source."""

    def encoded(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        place: dict[str, int] = {}

        def frame(out: list[tuple]) -> pd.DataFrame:
            rows = pd.DataFrame(out, columns=["part", "doc_id", "source", "pos", "doc_tokens", "ids"])
            return rows.astype({"doc_id": "Int64"})

        for b in batches:
            out, held = [], 0
            for doc_id, source, text in zip(b.doc_id, b.source, b.text):
                if held and held + len(text) > BATCH_CHARS:
                    yield frame(out)
                    out, held = [], 0
                ids = array("I", encode(text))  # as little-endian 32-bit numbers below
                ids.append(end_id)
                if sys.byteorder == "big":
                    ids.byteswap()
                at = place.get(source, 0)
                place[source] = at + len(ids)
                out.append((part, doc_id, source, at, len(ids), ids.tobytes()))
                held += len(text)
            yield frame(out)

    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(source, F.lit("")).alias("source"),
    )
    return plain.mapInPandas(encoded, _TOKENS)


def pack(
    docs: DataFrame, tokenizer: str, target: dict[str, float] | None = None, window: int = WINDOW, end_id: int = 1
) -> DataFrame:
    """Pack every token of every document; one row per piece.

    A null text counts as empty (the end id alone), a null source as the source "".  Repeated rows are packed each
    on its own.  No documents, no rows.  Only the last window can be short.  The driver sees one total per source
    and bounded numbers per source and task, never documents.
    """
    rows = materialised(tokenised(docs, tokenizer, end_id), "packing-tokens")
    held = rows.groupBy("part", "source").agg(F.sum("doc_tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    held = materialised(held.withColumn("base", F.coalesce(before, F.lit(0).cast("long"))), "packing-totals")
    totals = {r["source"]: r["n"] for r in held.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    plan = levels(totals, target, window)

    def cut(batches):
        layout = Mixture(plan)
        for b in batches:
            out = []
            for doc_id, source, at, total, raw in zip(b["doc_id"], b["source"], b["at"], b["doc_tokens"], b["ids"]):
                for start, n, where in layout.pieces(source, int(at), int(total)):
                    crc = zlib.crc32(memoryview(raw)[4 * start : 4 * (start + n)])
                    out.append((doc_id, start, n, crc, total, where // window, where % window, source))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in _PIECES.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    placed = rows.join(held.select("part", "source", "base"), ["part", "source"])
    placed = placed.select("doc_id", "source", (F.col("pos") + F.col("base")).alias("at"), "doc_tokens", "ids")
    return placed.mapInPandas(cut, _PIECES)
