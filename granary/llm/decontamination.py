"""Benchmark decontamination by latent semantic retrieval and longest common subsequences."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import ROW, WordHashes, discard, materialised, numbered, picked

BITS = 13  # slots of the hashed vocabulary
RANK = 96
LEADING = 4  # leading singular vectors left out: they tell languages apart, not topics
SIZES = (24, 64)  # words of a passage; the passages of each size overlap by half
FIT_WORDS = 1 << 18  # words whose passages are multiplied at once in the fit
FIT_ROWS = 256  # passages whose commonest words are multiplied as one matrix
COMMON = 512  # slots in that matrix
GATHERED = 4096  # vectors gathered at once for the other words
PARTS = 64  # stretches of slots that partial sums are added up by
ITEM_BLOCK = 4096  # benchmark items searched for at once
CODED_BYTES = 1 << 23  # bytes of text cut into words at once
STRETCH = 128  # words of the stretches of a text that items are screened by
SCREENED = 1 << 20  # counts held at once while items are screened by stretches of a text
FEW = 3  # items that are not worth that screen
MANY_SIGNS = 64  # signs of a text beyond which it is cut by the pattern
_WORDS = re.compile(r"[^\W_]+")
# Latin-1 in lower case (one character each, Latin-1 again), and a space for each sign
_LATIN = bytes(ord(c) if c.isalnum() else ord(" ") for k in range(256) for c in [chr(k).lower()])


def words(text: str | None) -> list[str]:
    low = (text or "").lower()
    others = [c for c in set(low) if not c.isalnum()]
    if len(others) > MANY_SIGNS:
        return _WORDS.findall(low)
    for c in others:
        low = low.replace(c, " ")
    return low.split()  # the same words: a sign is all that is neither letter nor number, white space too


def vocabulary(benchmark: DataFrame) -> np.ndarray:
    """Sorted hashes of the distinct words of the benchmark, the stated query set."""

    def used(batches):
        hashes = WordHashes()
        for b in batches:
            found = [hashes(words(t)) for t in b.text]
            yield pd.DataFrame({"word": np.unique(np.concatenate([np.empty(0, np.uint64), *found])).view(np.int64)})

    rows = benchmark.select("text").mapInPandas(used, "word long").distinct().collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


def slot_table(listed: np.ndarray) -> np.ndarray:
    """The slot of each code: codes below the number of slots are slots, the others name the benchmark's words."""
    return np.concatenate([np.arange(1 << BITS), (listed >> np.uint64(64 - BITS)).astype(np.int64)])


def code_type(listed: np.ndarray) -> str:
    return "<u2" if len(listed) + (1 << BITS) <= 1 << 16 else "<u4"


def spaced(text: str | None) -> str | None:
    """The words of a text between single or more spaces; None without words."""
    try:
        low = (text or "").encode("latin-1").translate(_LATIN).decode("latin-1").strip(" ")
    except UnicodeEncodeError:
        low = " ".join(words(text))
    return low or None


def pieces(ends: np.ndarray, most: int):
    """(first, last + 1) of neighbouring rows that hold up to ``most`` in sum, or of one row; ``ends`` starts with 0."""
    lo = 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def coded(docs: DataFrame, listed: np.ndarray) -> DataFrame:
    """doc_id and the codes of all words of every text, in order: what the fit and the search are worked out from."""
    shared, kind = docs.sparkSession.sparkContext.broadcast(listed), np.dtype(code_type(listed))

    def encode(batches):
        import xxhash

        listed = shared.value
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
            for lo, hi in pieces(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), CODED_BYTES):
                part = b.slice(lo, hi - lo)
                cut = pc.ascii_split_whitespace(pa.array([spaced(t) for t in part.column("text").to_pylist()], pa.string()))
                n = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False)
                found = cut.flatten().dictionary_encode()
                # each distinct word of these texts is hashed once
                known = found.dictionary.cast(pa.binary()).to_pylist()
                h = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
                at = np.searchsorted(listed, h)
                own = np.searchsorted(listed, h, "right") > at
                code = np.where(own, (1 << BITS) + at, (h >> np.uint64(64 - BITS)).astype(np.int64)).astype(kind)
                ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)]) * kind.itemsize
                data = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(code[found.indices.to_numpy(zero_copy_only=False)])]
                codes = pa.Array.from_buffers(pa.binary(), hi - lo, data)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), codes], names=["doc_id", "codes"])

    return materialised(docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, codes binary"), "leak-codes")


def document_frequencies(texts: DataFrame, listed: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of the coded texts use each slot, over all texts; per task one row per slot."""
    slot_of, kind = slot_table(listed), code_type(listed)

    def count(batches):
        total, n = np.zeros(1 << BITS, np.int64), 0
        for b in batches:
            for raw in b.codes:
                used = np.zeros(1 << BITS, bool)
                used[slot_of[np.frombuffer(raw, kind)]] = True
                total += used
                n += 1
        yield pd.DataFrame({"slot": np.append(np.arange(1 << BITS), -1), "n": np.append(total, n)})

    rows = texts.select("codes").mapInPandas(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1 << BITS, np.int64)
    n = 0
    for r in rows:
        if r["slot"] < 0:
            n = r["n"]
        else:
            out[r["slot"]] = r["n"]
    return out, n


def fit_pieces(texts: pa.Array, kind: np.dtype, most: int = FIT_WORDS):
    """(codes, lengths) of about ``most`` words of neighbouring texts; a longer text comes in pieces of whole passages."""
    n = pc.binary_length(texts).to_numpy(zero_copy_only=False) // kind.itemsize
    for lo, hi in pieces(np.concatenate([[0], np.cumsum(n, dtype=np.int64)]), most):
        codes = np.concatenate([np.frombuffer(raw, kind) for raw in texts.slice(lo, hi - lo).to_pylist()])
        if len(codes) <= most:
            yield codes, n[lo:hi]
            continue
        for k in range(0, len(codes), most):
            yield codes[k : k + most], np.array([len(codes[k : k + most])])


def weighted_sums(table: np.ndarray, rows: np.ndarray, weights: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each run begin .. begin + n, n > 0: the sum of those rows of the table by their weights."""
    out = np.empty((len(n), table.shape[1]), np.float32)
    for size in np.unique(n).tolist():  # runs of one length are one stack of products
        same = np.flatnonzero(n == size)
        step = max(1, GATHERED // size)
        for lo in range(0, len(same), step):
            some = same[lo : lo + step]
            at = (begin[some][:, None] + np.arange(size)).ravel()
            gathered = table.take(rows[at], axis=0).reshape(len(some), size, -1)
            out[some] = (weights[at].reshape(len(some), 1, size) @ gathered)[:, 0]
    return out


def add_gram(total: np.ndarray, slots: np.ndarray, lengths: np.ndarray, idf: np.ndarray, q: np.ndarray, size: int = SIZES[-1]) -> None:
    """Add A'AQ of some texts' TF-IDF passages to ``total``; slots are numbered by falling frequency.

    The commonest slots fill a small matrix, the others are gathered word by word.
    """
    if not len(slots):
        return
    place = np.arange(len(slots)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    passage = np.cumsum(place % size == 0) - 1
    key = np.sort(passage << BITS | slots)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    times, key = np.diff(first, append=len(key)), key[first]
    slot, passage = key & ((1 << BITS) - 1), key >> BITS
    many = int(passage[-1]) + 1
    x = times.astype(np.float32) * idf[slot]
    x /= np.maximum(np.sqrt(np.add.reduceat(x * x, np.searchsorted(passage, np.arange(many)))), 1e-9)[passage]
    rare = slot >= COMMON
    s, p, w = slot[rare], passage[rare], x[rare]
    n = np.bincount(p, minlength=many)
    some = np.flatnonzero(n)
    v = np.zeros((many, q.shape[1]), np.float32)
    v[some] = weighted_sums(q, s, w, (np.cumsum(n) - n)[some], n[some])
    slot, passage, x = slot[~rare], passage[~rare], x[~rare]
    edges = np.searchsorted(passage, np.arange(0, many + FIT_ROWS, FIT_ROWS))
    for k, lo in enumerate(range(0, many, FIT_ROWS)):
        hi, here = min(lo + FIT_ROWS, many), slice(edges[k], edges[k + 1])
        dense = np.zeros((hi - lo, COMMON), np.float32)
        dense[passage[here] - lo, slot[here]] = x[here]
        v[lo:hi] += dense @ q[:COMMON]
        total[:COMMON] += dense.T @ v[lo:hi]
    order = np.argsort(s.astype(np.uint16), kind="stable")
    s = s[order]
    first = np.flatnonzero(np.diff(s, prepend=-1))
    total[s[first]] += weighted_sums(v, p[order], w[order], first, np.diff(first, append=len(s)))


def singular_vectors(texts: DataFrame, listed: np.ndarray, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors of TF-IDF passages by a randomised projection and two power steps.

    Each step is one Spark job over all passages of all texts: tasks add up their own part of A'AQ, the parts are
    added up by stretches of slots, and the driver gets the one sum, of a fixed size.
    """
    kind = np.dtype(code_type(listed))
    common = np.argsort(idf, kind="stable")  # the slots by falling frequency
    numbers = np.empty(1 << BITS, np.int64)
    numbers[common] = np.arange(1 << BITS)
    slot_of, weights = numbers[slot_table(listed)], idf[common]
    height = (1 << BITS) // PARTS
    q = np.linalg.qr(np.random.default_rng(11).standard_normal((1 << BITS, rank)))[0].astype(np.float32)
    for _ in range(3):
        shared = texts.sparkSession.sparkContext.broadcast(q)  # fixed size: slots x rank

        def step(batches):
            by_number, total = shared.value[common], np.zeros((1 << BITS, rank))
            for b in batches:
                for codes, lengths in fit_pieces(b.column("codes"), kind):
                    add_gram(total, slot_of[codes], lengths, weights, by_number)
            total = total[numbers].astype(np.float32)
            parts = [total[k * height : (k + 1) * height].tobytes() for k in range(PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], names=["part", "v"])

        def added(rows):
            total = sum(np.frombuffer(v, np.float32).astype(np.float64) for v in rows.v)
            return pd.DataFrame({"part": rows.part[:1], "v": [total.tobytes()]})

        y = np.zeros((1 << BITS, rank))
        sums = texts.select("codes").mapInArrow(step, "part int, v binary").groupBy("part").applyInPandas(added, "part int, v binary")
        for r in sums.collect():
            y[r["part"] * height : (r["part"] + 1) * height] = np.frombuffer(r["v"]).reshape(height, rank)
        q = np.linalg.qr(y + 1e-9 * np.random.default_rng(3).standard_normal(y.shape))[0].astype(np.float32)
        shared.unpersist()
    return q


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two word lists; a row of the table is one number's bits."""
    masks: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << k
    full = row = (1 << len(a)) - 1
    for x in b.tolist():
        if x in masks:
            both = row & masks[x]
            row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


def passages(n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the passages of one size in ``n`` words, and the words after their last."""
    lo = np.arange(0, max(n - size // 2, 1), size // 2)
    return lo, np.minimum(lo + size, n)


def agreement(
    item: np.ndarray, text: np.ndarray, lo: int, hi: int, min_common: float, min_answer: float
) -> tuple[float, float] | None:
    """Shares (common, answer) of an item found in a passage; None where it does not match."""
    # the passage widened by the item's length, so that no match is cut by its edges
    there = text[max(0, lo - len(item)) : hi + len(item)]
    shared = np.isin(item, there)
    tail = shared[-max(1, len(item) // 4) :]
    if shared.mean() < min_common or tail.mean() < min_answer:
        return None
    common = common_subsequence(item, there) / len(item)
    return (float(common), float(tail.mean())) if common >= min_common else None


class Item:
    """A benchmark item: its words as codes, and the places of its distinct words."""

    def __init__(self, item_id: int, codes: np.ndarray):
        self.item_id, self.codes = item_id, codes
        self.distinct, self.times = np.unique(codes, return_counts=True)


def by_word(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a text in order, and the place of each; places of one code ascend."""
    small = len(text) and text.max() < 1 << 16  # short numbers are sorted by their digits
    at = np.argsort(text.astype(np.uint16) if small else text, kind="stable")
    return text[at], at


def stretches(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers begin .. begin + n of all pairs, one pair after the other."""
    return np.arange(n.sum()) + np.repeat(begin - np.cumsum(n) + n, n)


def able_passages(
    item: Item, text: np.ndarray, min_common: float, ordered: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """Which passages of the largest size, widened by the item's length, hold enough of its words for a match.

    A word counts as often as both hold it, which is no less than in any common subsequence.  The widened passages
    hold each run of up to half that size and twice the item's words, those of the other sizes among them.
    ``ordered`` is ``by_word`` of the text.
    """
    codes, at = ordered or by_word(text)
    size = len(item.codes)
    begin = np.searchsorted(codes, item.distinct)
    n = np.searchsorted(codes, item.distinct, "right") - begin
    none = np.empty(0, np.int64)
    enough = np.flatnonzero(np.arange(size + 1) / size >= min_common)
    if not len(enough) or np.minimum(n, item.times).sum() < enough[0]:
        return none
    least = int(enough[0])
    lo, hi = passages(len(text), SIZES[-1])
    first, last = np.maximum(lo - size, 0), np.minimum(hi + size, len(text))
    # the text's commonest words make at most two thirds of a match: the others have to be there, and are few
    common = np.argsort(-n, kind="stable")
    sums = np.concatenate([[0], np.cumsum(item.times[common])])
    k = max(int(np.searchsorted(sums, least - least // 3 - 1, "right")) - 1, 0)
    rest = common[k:]
    there = np.sort(at[stretches(begin[rest], n[rest])])
    some = np.flatnonzero(np.searchsorted(there, last) - np.searchsorted(there, first) >= least - sums[k])
    if not len(some):
        return none
    # a place counts unless the item's number of this word lies between the start of the passage and it already
    there, of = at[stretches(begin, n)], np.repeat(np.arange(len(n)), n)
    nth = stretches(np.zeros(len(n), np.int64), n)
    back = np.arange(len(there)) - item.times[of]
    before = np.where(nth >= item.times[of], there[back], -1)
    order = np.argsort(there)
    there, before = there[order], before[order]
    begin, end = np.searchsorted(there, first[some]), np.searchsorted(there, last[some])
    passage = np.repeat(np.arange(len(some)), end - begin)
    fresh = before[stretches(begin, end - begin)] < first[some][passage]
    return some[np.bincount(passage[fresh], minlength=len(some)) >= least]


def screened(items: list[Item], text: np.ndarray, leasts: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Whether some widened passage may hold enough words of an item, for each item.

    Words are counted by stretches of the text: a widened passage lies in few stretches that follow each other, and
    these hold no fewer of the item's words.  ``column`` is zero for every code, before and after.
    """
    many = -(-len(text) // STRETCH)
    # a run of so many words touches no more stretches than these
    wide = np.array([-(-(SIZES[-1] + 2 * len(item.codes)) // STRETCH) + 1 for item in items])
    order = np.argsort(wide, kind="stable")
    sizes = np.array([len(item.distinct) for item in items])[order]
    out = wide >= many
    for lo, hi in pieces(np.concatenate([[0], np.cumsum(sizes)]), max(SCREENED // many, 1)):
        group = order[lo:hi]
        if sizes[lo:hi].sum() * many > SCREENED:  # one item in a very long text: left to the exact screen
            out[group] = True
            continue
        places, times = (np.concatenate([getattr(items[k], x) for k in group]) for x in ("distinct", "times"))
        column[places] = np.arange(1, len(places) + 1)  # a word of several items keeps one of its columns
        own, of = column[places], column[text]
        column[places] = 0
        at = np.flatnonzero(of)
        counts = np.bincount(at // STRETCH * (len(places) + 1) + of[at], minlength=many * (len(places) + 1))
        upto = np.zeros((many + 1, len(places)), np.int64)
        np.cumsum(counts.reshape(many, -1).take(own, axis=1), axis=0, out=upto[1:])
        begin = np.cumsum(sizes[lo:hi]) - sizes[lo:hi]
        for w in np.unique(wide[group]).tolist():
            if w >= many:
                continue
            same = np.flatnonzero(wide[group] == w)
            mine = slice(begin[same[0]], begin[same[-1]] + sizes[lo + same[-1]])
            held = np.minimum(upto[w:, mine] - upto[:-w, mine], times[mine])
            held = np.add.reduceat(held, begin[same] - mine.start, axis=1)
            out[group[same]] = (held >= leasts[group[same]]).any(axis=0)
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, min_cosine: float = 0.45, min_common: float = 0.6, min_answer: float = 0.5
) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer) of each document and benchmark item found in it.

    A passage matches when the longest common subsequence holds ``min_common`` of the item's words and ``min_answer``
    of the words of its last quarter, the answer, occur in it.  Passages whose latent cosine to the item is at least
    ``min_cosine`` are looked at first; an item not found in them is looked for in every passage, so the cosine decides
    which passage is reported, never whether an item is found.  Items too few of whose words the document, or any
    passage of it, holds could not match and are left out of its search.  Empty items and texts match nothing.
    """
    return searched(docs, benchmark, min_cosine, min_common, min_answer)[0]


def searched(
    docs: DataFrame, benchmark: DataFrame, min_cosine: float = 0.45, min_common: float = 0.6, min_answer: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """The ``matches``, and the scratch table of coded texts that they are worked out from."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = materialised(items.withColumn("block", F.floor(F.row_number().over(_by_item()) / ITEM_BLOCK)), "items")
    listed = vocabulary(items)
    texts = coded(docs, listed)
    df, n = document_frequencies(texts, listed)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.05)
    base = spark.sparkContext.broadcast(singular_vectors(texts, listed, idf)[:, LEADING:] * idf[:, None])  # fixed size
    slot_of, kind = slot_table(listed), code_type(listed)
    blocks = [r["block"] for r in items.select("block").distinct().orderBy("block").collect()]
    schema = "doc_id long, item_id long, cosine double, common double, answer double"
    found = spark.createDataFrame([], schema)
    for block in blocks:
        queries = [(r["item_id"], r["text"]) for r in items.where(F.col("block") == block).collect()]

        def search(batches, queries=queries):
            hashes, v = WordHashes(), base.value
            known = [Item(i, (1 << BITS) + np.searchsorted(listed, hashes(words(t)))) for i, t in queries]
            known = [item for item in known if len(item.codes)]

            def unit(x):
                return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)

            if not known:
                return
            places, times = (np.concatenate([getattr(item, x) for item in known]) for x in ("distinct", "times"))
            lengths = np.array([len(item.codes) for item in known])
            sizes = np.array([len(item.distinct) for item in known])
            starts = np.cumsum(sizes) - sizes
            # the fewest words of an item that make a match: more than it has where none do
            leasts = np.array([next((k for k in range(n + 1) if k / n >= min_common), n + 1) for n in lengths.tolist()])
            column = np.zeros(len(slot_of), np.int64)
            goal = unit(np.stack([v[slot_of[item.codes]].sum(axis=0) for item in known]))
            for b in batches:
                out = []
                for doc_id, raw in zip(b.doc_id, b.codes):
                    h = np.frombuffer(raw, kind).astype(np.int64)
                    # words the whole document lacks are in no passage of it: such items need no search
                    present = np.minimum(np.bincount(h, minlength=len(slot_of))[places], times)
                    able = np.flatnonzero(np.add.reduceat(present, starts) / lengths >= min_common)
                    if len(able) > FEW:
                        able = able[screened([known[k] for k in able], h, leasts[able], column)]
                    if len(able) == 0:
                        continue
                    ordered = by_word(h)
                    left = {k: p for k in able for p in [able_passages(known[k], h, min_common, ordered)] if len(p)}
                    if not left:
                        continue
                    able = np.array(list(left))
                    # only the stretch from the first to the last able passage, whose vectors are needed
                    whole = passages(len(h), SIZES[-1])
                    begin = min(whole[0][p[0]] for p in left.values())
                    end = max(whole[1][p[-1]] for p in left.values())
                    run = np.zeros((end - begin + 1, v.shape[1]), np.float32)
                    np.cumsum(v[slot_of[h[begin:end]]], axis=0, out=run[1:])
                    best: dict[int, tuple] = {}
                    for size in SIZES:
                        lo, hi = passages(len(h), size)
                        inside = (lo >= begin) & (hi <= end)
                        lo, hi = lo[inside], hi[inside]
                        cos = unit(run[hi - begin] - run[lo - begin]) @ goal[able].T
                        for p, k in np.argwhere(cos >= min_cosine):
                            item = known[able[k]]
                            got = agreement(item.codes, h, lo[p], hi[p], min_common, min_answer)
                            if got and (item.item_id not in best or got[0] > best[item.item_id][1]):
                                best[item.item_id] = (float(cos[p, k]), *got)
                    # what the vectors miss: every passage that holds enough of the item's words, whatever its cosine
                    lo, hi = whole
                    for k in able:
                        item = known[k]
                        if item.item_id in best:
                            continue
                        for p in left[k]:
                            got = agreement(item.codes, h, lo[p], hi[p], min_common, min_answer)
                            if got and (item.item_id not in best or got[0] > best[item.item_id][1]):
                                best[item.item_id] = (float(unit(run[hi[p] - begin] - run[lo[p] - begin]) @ goal[k]), *got)
                    out += [(doc_id, item, *values) for item, values in sorted(best.items())]
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame

        found = found.unionByName(texts.mapInPandas(search, schema))
    return found, texts


def _by_item():
    from pyspark.sql import Window

    return Window.orderBy("item_id", "text")  # the benchmark is the stated query set


def keep_unseen(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, with the columns they came with."""
    rows = numbered(docs, "leak-rows")
    # ids may be null or repeat, so rows are searched and dropped by their own
    named = rows.select(F.col(ROW).alias("doc_id"), "text")
    found, texts = searched(named, benchmark)
    found = materialised(found.select(F.col("doc_id").alias(ROW)).distinct(), "leaks")
    discard(texts)
    return picked(rows, found, "left_anti").select(*docs.columns)
