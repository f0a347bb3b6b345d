"""Fill-in-the-middle transformation by displacement scatter.

The bytes of many texts lie in one array.  A scan for line ends gives the cuts, a difference array holds by how much
every segment moves, its running sum gives each byte its shift, and one scatter builds all outputs.  The way back
finds the marks, works out the same shifts and gathers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
FORMS = ("plain", "psm", "spm")
SLICE_BYTES = 2_000_000  # texts worked on at a time; a longer text is a slice of its own
_MARK = {m: np.frombuffer(m.encode(), np.uint8) for m in MARKS}
_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES):
    """(first, end) of runs of texts with at most ``limit`` bytes, or one text."""
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield lo, hi
        lo = hi


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each value starts, with the end of the last."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[starts[0] : starts[-1]], starts - starts[0]


def strings(data: np.ndarray, starts: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """The opposite of ``buffers``; ``missing`` marks the values that are null."""
    valid, gone = None, 0
    if missing is not None and missing.any():
        valid, gone = pa.py_buffer(np.packbits(~missing, bitorder="little").tobytes()), int(missing.sum())
    parts = [valid, pa.py_buffer(starts.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(starts) - 1, parts, gone).cast(pa.string())


def displacement(begins: list[np.ndarray], shifts: list[np.ndarray], size: int) -> np.ndarray:
    """The shift of each of ``size`` bytes; ``begins`` are the starts of each text's first, second, ... segment.

    Empty segments start where the next one does, so their shifts cancel out in the sum.
    """
    at, to = np.stack(begins, axis=1).ravel(), np.stack(shifts, axis=1).ravel()
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, at, np.diff(to, prepend=0))
    return np.cumsum(steps[:-1])


def scatter(
    data: np.ndarray, starts: np.ndarray, form: np.ndarray, draws: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(output bytes, their starts, lines, prefix characters, middle characters) of all texts of a slice.

    ``form`` indexes FORMS; ``draws`` has two numbers for each text, which choose the lines to cut after.
    """
    begin, end = starts[:-1], starts[1:]
    ends = np.flatnonzero(data == 10)
    first = np.searchsorted(ends, begin)
    closed = np.searchsorted(ends, end) - first
    open_line = (end > begin) & (data[np.maximum(end - 1, 0)] != 10) if len(data) else np.zeros(len(begin), bool)
    lines = closed + open_line

    def cut(after: np.ndarray) -> np.ndarray:
        at = np.where(after > closed, end, begin)
        inside = (after > 0) & (after <= closed)
        at[inside] = ends[(first + after - 1)[inside]] + 1
        return at

    chosen = np.sort(draws % (lines + 1)[:, None], axis=1)
    p, q = cut(chosen[:, 0]), cut(chosen[:, 1])
    moved, spm = form > 0, form == 2
    out_size = (end - begin) + 9 * moved
    out_starts = np.concatenate([[0], np.cumsum(out_size)])
    o, prefix, middle, suffix = out_starts[:-1], p - begin, q - p, end - q
    # where the three segments go; a plain text moves as one
    prefix_at = np.where(moved, o + 3 + np.where(spm, suffix + 3, 0), o)
    suffix_at = np.where(moved, o + 3 + np.where(spm, 0, prefix + 3), o + prefix + middle)
    middle_at = np.where(moved, o + 9 + prefix + suffix, o + prefix)
    shift = displacement([begin, p, q], [prefix_at - begin, middle_at - p, suffix_at - q], len(data))
    out = np.empty(int(out_starts[-1]), np.uint8)
    out[np.arange(len(data)) + shift] = data
    for mark, at in zip(MARKS, (prefix_at, suffix_at, middle_at)):
        out[(at[moved] - 3)[:, None] + np.arange(3)] = _MARK[mark]
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return out, out_starts, lines, chars[p] - chars[begin], chars[q] - chars[p]


def gather(data: np.ndarray, starts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text bytes, their starts, whether not to be rebuilt) from the outputs and forms alone.

    An output that does not hold its form's three marks once each and in order cannot be rebuilt.
    """
    begin, end = starts[:-1], starts[1:]
    hit = np.flatnonzero((data[:-2] == 60) & (data[2:] == 62) & np.isin(data[1:-1], [80, 83, 77])) if len(data) > 2 else np.empty(0, np.int64)
    owner = np.searchsorted(starts, hit, side="right") - 1
    inside = hit + 3 <= end[owner] if len(hit) else np.empty(0, bool)
    hit, owner = hit[inside], owner[inside]
    found = np.bincount(owner, minlength=len(begin))
    moved = form > 0
    first = np.searchsorted(owner, np.arange(len(begin)))
    marks = np.zeros((len(begin), 3), np.int64)
    three = moved & (found == 3)
    marks[three] = hit[first[three][:, None] + np.arange(3)]
    wanted = np.where((form == 2)[:, None], np.frombuffer(b"SPM", np.uint8), np.frombuffer(b"PSM", np.uint8))
    good = three & (marks[:, 0] == begin)
    good[three] &= (data[marks[three] + 1] == wanted[three]).all(axis=1)
    bad = moved & ~good
    # the segments in their order of the output
    one, two, middle_at = marks[:, 0] + 3, marks[:, 1] + 3, marks[:, 2] + 3
    one_size, two_size = two - 3 - one, middle_at - 3 - two
    prefix_at, suffix_at = np.where(form == 2, two, one), np.where(form == 2, one, two)
    prefix, middle = np.where(form == 2, two_size, one_size), end - middle_at
    size = np.where(good, end - begin - 9, np.where(bad, 0, end - begin))
    text_starts = np.concatenate([[0], np.cumsum(size)])
    t = text_starts[:-1]
    p, q = np.where(good, t + prefix, t), np.where(good, t + prefix + middle, t)
    last = np.where(good, suffix_at - q, begin - t)
    shift = displacement(
        [t, p, q], [np.where(good, prefix_at - t, last), np.where(good, middle_at - p, last), last], int(text_starts[-1])
    )
    return data[np.arange(len(shift)) + shift], text_starts, bad


def transform(docs: DataFrame, seed: str = "7", rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars and output of every row.

    Four numbers drawn from sha256 of the seed and the id choose the two cuts, whether to transform (``rate`` in a
    hundred) and the form (``spm`` in a hundred put the suffix first).  A null text counts as empty, a null id draws
    like an empty one; texts that are empty or hold a mark stay plain.  Repeated rows give equal rows, an empty table
    none; other columns play no part.  A task holds a batch and a few arrays over a slice of it.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), digest.alias("digest"))
    draw = [F.conv(F.substring("digest", 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    plain = (F.col("text") == "") | (draw[2] % 100 >= rate)
    for mark in MARKS:
        plain |= F.contains("text", F.lit(mark))
    form = F.when(plain, 0).when(draw[3] % 100 < spm, 2).otherwise(1)
    rows = rows.select("doc_id", "text", form.alias("form"), draw[0].alias("one"), draw[1].alias("two"))

    def work(batches):
        for b in batches:
            data, starts = buffers(b["text"])
            form, draws = b["form"].to_numpy(), np.stack([b["one"].to_numpy(), b["two"].to_numpy()], axis=1)
            for lo, hi in slices(np.diff(starts)):
                part, at = data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo]
                out, out_starts, lines, prefix, middle = scatter(part, at, form[lo:hi], draws[lo:hi])
                none = form[lo:hi] == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        b["doc_id"].slice(lo, hi - lo), pa.array(lines, pa.int64()), pa.array(np.array(FORMS, object)[form[lo:hi]], pa.string()),
                        pa.array(prefix, pa.int64(), mask=none), pa.array(middle, pa.int64(), mask=none), strings(out, out_starts),
                    ],
                    names=[c.split()[0] for c in _SCHEMA.split(", ")],
                )

    return rows.mapInArrow(work, _SCHEMA)


def restore(rows: DataFrame, name: str = "restored") -> DataFrame:
    """The rows with the text rebuilt from ``output`` and ``form`` alone, in column ``name``.

    The text is null where the output does not fit its form; a null output or form is left out as unfit too.  A
    column of that name which is there already is replaced.
    """
    rows = rows.drop(name)
    names = rows.columns
    schema = StructType([*rows.schema.fields, StructField(name, StringType())])

    def work(batches):
        for b in batches:
            given, form_of = b["output"], {f: k for k, f in enumerate(FORMS)}
            form = np.array([form_of.get(f, -1) for f in b["form"].to_pylist()], np.int64)
            unfit = (form < 0) | ~given.is_valid().to_numpy(zero_copy_only=False)
            data, starts = buffers(given.fill_null(""))
            for lo, hi in slices(np.diff(starts)):
                part, at = data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo]
                text, text_starts, bad = gather(part, at, np.maximum(form[lo:hi], 0))
                kept = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, strings(text, text_starts, bad | unfit[lo:hi])], names=[*names, name]
                )

    return rows.mapInArrow(work, schema)
