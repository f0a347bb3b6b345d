import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.llm import infill, langid, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, form string, score string, restored string, hash string"


def docs(spark, rows):
    """Rows of (doc_id, text, lang, source); the other columns clash with names the operators use."""
    full = [(i, t, lang, s, None if t is None else len(t), "x", "y", "z", None) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = "".join(f"línea {k} ünd mehr\n" for k in range(150_000))
MIXED = [
    (0, "one\ntwo\nthree\n", "en", "b"), (1, "no line feed", "en", "b"), (2, "\n\n\n", "en", "a"), (3, "", "en", "a"),
    (4, None, "en", None), (5, "holds <M> itself\nx", "en", ""), (6, "é\r\n漢字\n😀", "fr", "é"), (6, "é\r\n漢字\n😀", "fr", "é"),
    (None, "null id\nx", None, None), (None, "null id\nx", None, None), (7, "ends with <\nP>\n<", None, "b"), (8, LONG, "fr", "b"),
    (2**62 + 1, "large id\n", "en", None),
]


# ---- fill-in-the-middle


def infilled(doc_id, text, seed="7", rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return len(units), "spm" if h4 % 100 < spm else "psm", len(p), len(m), out


@pytest.mark.parametrize("rate,spm,seed", [(100, 50, "7"), (40, 0, "x"), (100, 100, "")])
def test_infill_equals_brute_force_and_round_trips(spark, rate, spm, seed):
    table = docs(spark, MIXED)
    got = infill.restore(infill.transform(table, seed, rate, spm)).collect()
    want = sorted(((i, *infilled(i, t, seed, rate, spm), t or "") for i, t, _, _ in MIXED), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_infill_of_empty_table(spark):
    none = infill.restore(infill.transform(docs(spark, [])))
    assert none.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert none.count() == 0


def test_restore_keeps_columns_and_leaves_unfit_outputs_null(spark):
    rows = [("psm", "<P>a<S>c<M>b"), ("psm", "<S>c<P>a<M>b"), ("spm", "<P>a<S>c<M>b"), ("spm", "<S>c<P>a<M>b"), ("psm", "<P>a<S>c"),
            ("psm", " <P>a<S>c<M>b"), ("psm", "<P>a<S>c<M>b<M>"), ("plain", "<P>"), ("plain", ""), (None, "x"), ("psm", None), ("other", "x")]
    table = spark.createDataFrame([(*r, "old", 1) for r in rows], "form string, output string, restored string, n int").coalesce(1)
    got = infill.restore(table)
    assert got.columns == ["form", "output", "n", "restored"]
    assert [r["restored"] for r in got.collect()] == ["abc", None, None, "abc", None, None, None, "<P>", "", None, None, None]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab\n<PSM>é😀", max_size=30), st.integers(0, 2), st.integers(0, 99), st.integers(0, 99)), min_size=1, max_size=8))
def test_scatter_and_gather_are_inverse(rows):
    import pyarrow as pa

    rows = [(t, 0 if not t or any(m in t for m in infill.MARKS) else f, a, b) for t, f, a, b in rows]
    data, starts = infill.buffers(pa.array([r[0] for r in rows], pa.string()))
    form = np.array([r[1] for r in rows])
    out, at, *_ = infill.scatter(data, starts, form, np.array([r[2:] for r in rows]))
    text, begins, bad = infill.gather(out, at, form)
    assert not bad.any()
    assert infill.strings(text, begins).to_pylist() == [r[0] for r in rows]


def test_slices_cover_all_texts_once():
    sizes = np.array([0, 5, 3, 100, 0, 0, 2, 8, 10, 1])
    got = list(infill.slices(sizes, 10))
    assert [k for lo, hi in got for k in range(lo, hi)] == list(range(10))
    assert all(sizes[lo:hi].sum() <= 10 or hi == lo + 1 for lo, hi in got)
    assert list(infill.slices(np.array([], int))) == []


# ---- Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    out = []
    for v in row:
        t = None if v is None else str(v)
        out.append("-" if t is None else f"{len(t.encode())}:{t}")
    return H("".join(out))


def climbed(nodes, fanout):
    """The root, and for each node its siblings on the way there."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, w in enumerate(where):
            lo = w - w % fanout
            paths[k].append(("".join(nodes[lo:w]), "".join(nodes[w + 1 : lo + fanout])))
        where = [w // fanout for w in where]
        nodes = [H(*nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute_manifest(rows, fanout):
    """rows: (doc_id, source, leaf, candidate)."""
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])):
        trees.setdefault(r[1], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subs = [climbed([r[2] for r in trees[s]], fanout) for s in order]
    root, tops = climbed([s[0] for s in subs], fanout)
    out = []
    for source, (sub, paths), top in zip(order, subs, tops):
        for r, path in zip(trees[source], paths):
            whole, f = path + top, r[3]
            for left, right in whole:
                f = H(left, f, right)
            out.append((r[0], r[2], sub, root, H(*[x for lr in whole for x in lr]), f, f == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("fanout,height", [(3, 7), (3, 1), (2, 2)])
def test_manifest_equals_brute_force(spark, fanout, height):
    rows = MIXED + [(100 + k, f"text {k}\n", "en", "hot") for k in range(95)] + [(300 + k, f"t{k}", None, f"s{k % 7}") for k in range(40)]
    table = docs(spark, rows)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = merkle.manifest(merkle.document_leaves(table, tampered), fanout, height).select(*COLUMNS).collect()
    leaves = []
    for i, t, lang, s in rows:
        n = None if t is None else len(t)
        less = t.replace("\n", "") if t is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else t
        leaves.append((i, s, leaf_of((i, s, lang, n, t)), leaf_of((i, s, lang, n, less))))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(brute_manifest(leaves, fanout), key=repr)
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_of_one_row_and_of_none(spark):
    one = merkle.manifest(merkle.document_leaves(docs(spark, [(9, "x\n", None, None)]), F.lit(False))).collect()
    assert [(r["leaf"] == r["subroot"] == r["root"] == r["folded_root"], r["proof_sha256"], r["verified"], r["left"]) for r in one] == [(True, H(""), True, [])]
    assert merkle.manifest(merkle.document_leaves(docs(spark, []), F.lit(False))).count() == 0


def test_manifest_proofs_fold_to_the_root_and_show_changes(spark):
    table = docs(spark, [(k, f"t{k}", "en", f"s{k % 4}") for k in range(60)])
    rows = merkle.manifest(merkle.document_leaves(table, F.lit(False)), 3, 2).collect()
    assert all(merkle.fold(r["leaf"], r["left"], r["right"]) == r["root"] for r in rows)
    other = merkle.manifest(merkle.document_leaves(table.withColumn("text", F.when(F.col("doc_id") == 5, "t").otherwise(F.col("text"))), F.lit(False)), 3, 2)
    changed = {r["doc_id"] for r in other.collect()} if other.first()["root"] != rows[0]["root"] else set()
    assert len(changed) == 60
    assert merkle.document_leaves(table.drop("lang", "n_chars"), F.lit(None).cast("boolean")).where("leaf <> candidate").count() == 0


# ---- language identification

SPOKEN = {"en": "the house and river stone bread walk light", "de": "das haus und fluss stein brot gehen licht", "xx": "ôka ôlu mirô tavô sekô ralô"}


def spoken(n=60):
    out = []
    for lang, vocabulary in SPOKEN.items():
        listed = vocabulary.split()
        for k in range(n):
            out.append((len(out), " ".join(listed[(k * 7 + j * (1 + k % 3)) % len(listed)] for j in range(12)), lang, "s"))
    return out


def test_language_of_held_out_documents(spark):
    rows = spoken()
    table = docs(spark, rows)
    got = {r["doc_id"]: r for r in langid.identify(table).collect()}
    out = [(i, lang) for i, _, lang, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(out) > 20 and all(got[i]["held_out"] for i, _ in out)
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in out]) == 1.0
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_labels_of_held_out_rows_and_other_columns_play_no_part(spark):
    rows = spoken(30)
    held = [zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows]
    other = [(i, t, "zz" if h else lang, f"s{i}") for (i, t, lang, _), h in zip(rows, held)]
    a, b = ({tuple(r) for r in langid.identify(docs(spark, x)).collect()} for x in (rows, other))
    assert a == b


def test_unknown_words_back_off_to_shorter_grams():
    counts = [(lang, w, 3) for lang, vocabulary in SPOKEN.items() for w in vocabulary.split()]
    model = langid.Model(list(SPOKEN), counts, [1 / 3] * 3)
    assert np.array_equal(model.word("stone"), model.logs[0][model.known[0]["stone"]])
    # "hauses" holds the five letters of an edge and "haus"; "ô" is known as a single letter alone
    five = [model.known[5][g] for g in langid.grams("hauses", 5) if g in model.known[5]]
    assert five and np.array_equal(model.word("hauses"), model.logs[5][five].mean(axis=0))
    assert list(SPOKEN)[int(model.word("qqôqq").argmax())] == "xx"
    assert not model.word("漢").any()
    scorer = langid.Scorer(model, remembered=2)
    texts = ["hauses stones", "brote", "qqôqq zzôzz rrôrr", "hauses stones"]
    assert scorer(texts[0]) == [scorer(t) for t in texts][-1]
    # against sums worked out word by word
    text = "das hauses gehen über stone"
    total = sum(model.word(w) for w in text.split())
    logits = total / np.sqrt(5) + model.prior / 5
    p = np.exp(logits) / np.exp(logits).sum()
    assert scorer(text) == (list(SPOKEN)[int(p.argmax())], pytest.approx(float(p.max())))


def test_language_of_unusual_rows(spark):
    rows = spoken(30) + [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 % ² Ⅷ", "en", "s"), (1003, "漢字", None, "s"),
                         (1004, "x²", None, None), (None, "das haus", "de", "s"), (None, "das haus", "de", "s"), (1005, "the house " * 200_000, None, "s")]
    got = {}
    for r in langid.identify(docs(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["held_out"], r["lang_pred"], r["score"]))
    assert [got[k][0][1:] for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003][0][1] in SPOKEN and got[1004][0][1] in SPOKEN
    assert len(got[None]) == 2 and got[None][0] == got[None][1] and got[None][0][:2] == (True, "de")
    assert got[1005][0][1] == "en"


def test_language_without_anything_to_learn(spark):
    assert langid.identify(docs(spark, [])).count() == 0
    rows = langid.identify(docs(spark, [(1, "the house", None, "s")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]
