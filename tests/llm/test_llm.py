import base64
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import decontamination, html, jaccard, licenses, packing, quality, sketches, toxicity, urls, warc
from granary.llm.common import BITMAP, ROW, WordHashes, picked
from granary.session import shared_folder


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_shingles string")


WORDS = [f"w{k}" for k in range(400)]


@pytest.fixture(scope="module")
def mixed(spark):
    a = " ".join(WORDS[:100])
    near = " ".join(WORDS[:99])
    return docs(spark, [(3, a, "s", "x"), (1, a, "s", None), (7, near, None, None), (4, "", "t", None), (5, None, "t", None),
                        (6, "one two", "t", None), (8, "One TWO", "u", None), (9, " ".join(WORDS[200:400]), "u", None)])


def test_join_groups_equal_and_near_documents(mixed):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(mixed).collect()}
    assert got == {1: (97, 1), 3: (97, 1), 7: (96, 1), 4: (0, 4), 5: (0, 5), 6: (1, 6), 8: (1, 6), 9: (197, 9)}
    assert sorted(r["doc_id"] for r in jaccard.keep_one(mixed).collect()) == [1, 4, 5, 6, 9]


def test_linked_sets_of_all_sizes_keep_enough_tokens_in_common():
    rng = np.random.default_rng(1)
    for num, n in [(num, n) for num in (85, 80) for n in list(range(1, 40)) + [100, 1000]]:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for drop in range(0, n):
            b = np.sort(rng.permutation(a)[: n - drop])
            if 100 * len(b) < num * n:
                break
            common = len(np.intersect1d(*(x[: jaccard.kept_tokens(len(x), num, 100)] for x in (a, b))))
            for x in (a, b):
                assert common >= 1 + -(-num * len(x) // 100) // jaccard.SPARE, (n, drop)


def test_join_equals_brute_force_where_a_token_is_in_many_groups(spark):
    rng = np.random.default_rng(4)
    line, texts = [f"c{k}" for k in range(40)], []
    for family in range(12):
        base = [f"f{family}x{k}" for k in range(rng.integers(4, 60))]
        for _ in range(12):
            # copies with some words replaced, so that many links lead over other copies only
            w = [x if rng.random() > 0.02 else f"r{rng.integers(1 << 40)}" for x in base]
            texts.append(" ".join(line + w if rng.random() < 0.7 else w))
    hashes = WordHashes()
    for num, width in ((85, 4), (80, 5)):
        sets = [jaccard.shingle_set(t, hashes, width) for t in texts]
        first = list(range(len(texts)))

        def top(k):
            while first[k] != k:
                k = first[k]
            return k

        for i, x in enumerate(sets):
            for j in range(i):
                common = len(np.intersect1d(x, sets[j]))
                if 100 * common >= num * (len(x) + len(sets[j]) - common):
                    lo, hi = sorted((top(i), top(j)))
                    first[hi] = lo
        table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
        got = {r["doc_id"]: r["component_id"] for r in jaccard.join(table, num=num, width=width).collect()}
        assert got == {k: top(k) for k in range(len(texts))}
        assert 20 < len(set(got.values())) < len(texts) - 20


def test_join_compares_few_of_many_copies_that_do_not_link(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = []
    for family, size in enumerate((500, 40)):
        base = [f"f{family}x{k}" for k in range(90)]
        for k in range(size):
            w = [x if k == 0 or rng.random() > 0.03 else f"r{rng.integers(1 << 40)}" for x in base]
            texts += [" ".join(w)] + ([" ".join(w[:-1])] if k % 50 == 7 else [])
    sets = [jaccard.shingle_set(t, WordHashes()) for t in texts]
    first = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(x, sets[j], assume_unique=True))
            if 100 * common >= 85 * (len(x) + len(sets[j]) - common):
                lo, hi = sorted((first[i], first[j]))
                first = [lo if k == hi else k for k in first]
    rows = {}
    written = jaccard.materialised

    def counting(df, label):
        out = written(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "materialised", counting)
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.join(table).collect()} == dict(enumerate(first))
    assert 100 < len(set(first)) < len(texts) - 100
    assert max(rows["jaccard-opens"], rows["jaccard-rest"]) < 12 * len(texts)  # all pairs: 150,000


def test_packing_covers_every_token_once():
    totals = {"a": 10_000, "b": 3_001, "c": 17, "d": 5}
    for target in (None, {"a": 0.2, "b": 0.8, "c": 0.0}):
        layout = packing.Layout(packing.phases(totals, target), 64)
        seen = []
        for q, n in totals.items():
            at = 0
            while at < n:
                take = min(37, n - at)
                pieces = list(layout.pieces(q, at, take))
                assert sum(p[1] for p in pieces) == take
                seen += [x for _, size, where in pieces for x in range(where, where + size)]
                assert all(where // 64 == (where + size - 1) // 64 for _, size, where in pieces)
                at += take
        assert sorted(seen) == list(range(sum(totals.values())))


def test_packing_round_trip(mixed):
    public = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public)
    ids = {r["doc_id"]: np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4") for r in mixed.collect()}
    rows = packing.pack(mixed, public).collect()
    for r in rows:
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))


def test_warc_round_trip_and_salvage(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (2, "u", "x"), (3, None, None), (4, "v", "é")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert [got[k]["record_type"] for k in (1, 2, 3, 4)] == ["revisit", "response", "response", "response"]
    assert got[1]["refers_to"] == 2 and got[4]["payload_bytes"] == 2
    assert got[2]["payload_digest"] == base64.b32encode(hashlib.sha1(b"x").digest()).decode()

    def record(body):
        digest = base64.b32encode(hashlib.sha1(body).digest())
        return b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (digest, len(body), body)

    good, bad = record(b"one"), record(b"two").replace(b"two", b"twX")
    kinds = [x[0] for x in warc.salvage(good + bad + b"junk" + good)]
    assert kinds == ["record", "gap", "record"]


def test_url_rules(spark):
    rows = [(1, "http://WWW.Example.com/en/1?q"), (2, "https://a.example.com/en/x"), (3, "http://x.net/es/"), (4, None),
            (5, "nothing"), (6, "http://spam-farm.example.org/"), (7, "http://b.com")]
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {1: ("www.example.com", "www.example.com/en/", "allow"), 2: ("a.example.com", "example.com/en/", "block"),
                   3: ("x.net", "net/es/", "block"), 4: ("", None, "allow"), 5: ("", None, "allow"),
                   6: ("spam-farm.example.org", None, "block"), 7: ("b.com", None, "allow")}


def test_html_keeps_the_article():
    w, t = html.trained()
    page = "<body><nav><ul><li><a href='#'>Home</a></li></ul></nav><article><h1>Head &amp; line</h1><p>First words here.</p><p>Second\n one.</p></article><footer>Copy</footer><script>x</script>"
    assert html.main_text(page, w, t) == "Head & line First words here. Second one."
    assert html.main_text(None, w, t) == html.main_text("", w, t) == ""


def test_license_scan(spark, mixed):
    text = " ".join(WORDS[:150]) + ". Released under the MIT License."
    found = licenses.scan(mixed.select("doc_id", "text").union(spark.createDataFrame([(20, text)], "doc_id long, text string")))
    assert [(r["doc_id"], r["license"], r["containment"]) for r in found.collect()] == [(20, "MIT", 1.0)]


def test_fingerprints(mixed):
    rows = {r["doc_id"]: r for r in sketches.fingerprints(mixed, 3).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in mixed.collect()}
    order = sorted(texts)
    for k, i in enumerate(order):
        edited = sketches.edited_text(texts[i], texts[order[(k + 1) % len(order)]])
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert rows[1]["fingerprint"] == rows[3]["fingerprint"] and rows[1]["near_next"] == 1.0


def test_classifiers_take_empty_tables_and_texts(spark, mixed):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(mixed, none).count() == 8
    assert {r["score"] for r in toxicity.classify(mixed, none).collect()} == {0.0}
    assert quality.ngram_ids(None, WordHashes()).size == 0 and sum(toxicity.features(None)) == 0
    assert quality.classify(mixed.where(F.lit(False)), none).count() == 0


def test_decontamination(spark, mixed):
    bench = spark.createDataFrame([(1, " ".join(WORDS[220:250])), (2, "absent words only here"), (3, None)], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontamination.matches(mixed, bench, min_cosine=0.0).collect()] == [(9, 1)]
    assert decontamination.common_subsequence(np.array([1, 2, 3, 4]), np.array([2, 9, 4, 1])) == 2


def test_decontamination_finds_every_planted_copy_at_the_production_limit(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"v{k}" for k in range(3000)])
    items = [[str(w) for w in rng.choice(words, n)] for n in (8, 12, 16, 20, 30, 59) for _ in range(4)]
    rows, planted = [], set()
    for k in range(240):
        item = list(items[k % len(items)])
        for at in rng.permutation(len(item))[: int(len(item) * (0, 0.15, 0.3)[k % 3])]:
            item[at] = f"other{k}"
        text = [str(w) for w in rng.choice(words, int(rng.integers(100, 600)))]
        at = int(rng.integers(0, len(text)))
        rows.append((k, " ".join(text[:at] + item + text[at:])))
        # brute force: every run of twice the item's words
        true = items[k % len(items)]
        whole, ids = text[:at] + item + text[at:], {w: n for n, w in enumerate(words)}
        x, h = np.array([ids[w] for w in true]), np.array([ids.get(w, -1) for w in whole])
        for lo in range(max(0, at - len(x)), at + len(x)):
            there = h[lo : lo + 2 * len(x)]
            tail = np.isin(x, there)[-max(1, len(x) // 4) :].mean()
            if tail >= 0.5 and decontamination.common_subsequence(x, there) >= 0.6 * len(x):
                planted.add((k, k % len(items)))
                break
    assert len(planted) > 200 and planted >= {(k, k % len(items)) for k in range(0, 240, 3)}
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.matches(table, bench).collect()} == planted


def test_decontamination_fits_its_vectors_on_every_text(spark):
    order = [r["doc_id"] for r in spark.range(5400).withColumnRenamed("id", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    topics = [[f"{name}{k}" for k in range(6)] for name in ("first", "second", "late")]
    # the third topic is in texts only that are the last by the hash of their id
    table = spark.createDataFrame([(i, " ".join(topics[2 if n >= 5000 else n % 2])) for n, i in enumerate(order)], "doc_id long, text string")
    listed = np.empty(0, np.uint64)
    texts = decontamination.coded(table, listed)
    df, n = decontamination.document_frequencies(texts, listed)
    assert n == 5400 and sorted(set(df[df > 0])) == [400, 2500]
    q = decontamination.singular_vectors(texts, listed, np.ones(1 << decontamination.BITS, np.float32), rank=3)
    for topic in topics:
        at = [int(h >> np.uint64(64 - decontamination.BITS)) for h in WordHashes()(topic)]
        x = np.zeros(len(q))
        x[at] = 1 / np.sqrt(len(at))  # each topic is a singular vector
        assert np.linalg.norm(x @ q) > 0.99


def test_decontamination_codes_are_hashes_of_the_words(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "CODED_BYTES", 60)  # of several pieces
    texts = [None, "", " .!? ", "one", " Two  two\ttwo\n", "Straße ÀÉ µ² x_y ¼", "naïve – “quoted” ΑΣ İ 漢字", *[" ".join(WORDS[k : k + 9]) for k in range(40)]]
    listed = np.sort(WordHashes()(["two", "straße", "漢字", WORDS[3]]))
    table = spark.createDataFrame([(k if k else None, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    for own in (listed, np.empty(0, np.uint64)):
        got = {r["doc_id"]: np.frombuffer(r["codes"], "<u2").tolist() for r in decontamination.coded(table, own).collect()}
        for k, t in enumerate(texts):
            h = WordHashes()(decontamination.words(t)).tolist()
            known = {x: (1 << decontamination.BITS) + n for n, x in enumerate(own.tolist())}
            assert got[k or None] == [known.get(x, x >> (64 - decontamination.BITS)) for x in h]


def test_decontamination_fit_step_is_the_product_of_all_passages(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(6)
    slots = 1 << decontamination.BITS
    texts = [(slots * rng.random(n) ** 4).astype("<u2") for n in (0, 1, 63, 64, 65, 700, 0, 3000, 129)]
    idf, q = rng.random(slots).astype(np.float32) + 0.1, rng.standard_normal((slots, 5)).astype(np.float32)
    want = np.zeros((slots, 5))
    for t in texts:
        for lo in range(0, len(t), 64):
            x = np.bincount(t[lo : lo + 64], minlength=slots) * idf.astype(float)
            x /= np.linalg.norm(x)
            want += np.outer(x, x @ q)
    for most, rows in ((1 << 18, 256), (640, 7), (64, 1)):
        monkeypatch.setattr(decontamination, "FIT_ROWS", rows)
        monkeypatch.setattr(decontamination, "GATHERED", rows)
        got = np.zeros((slots, 5))
        for codes, lengths in decontamination.fit_pieces(pa.array([t.tobytes() for t in texts], pa.binary()), np.dtype("<u2"), most):
            assert lengths.sum() == len(codes) <= most
            decontamination.add_gram(got, codes.astype(np.int64), lengths, idf, q)
        assert np.allclose(got, want, atol=1e-4)


def test_decontamination_counts_by_stretches_leave_no_able_item_out(monkeypatch):
    rng = np.random.default_rng(3)
    excluded = 0
    for n in range(80):
        monkeypatch.setattr(decontamination, "STRETCH", (8, 64, 128)[n % 3])
        monkeypatch.setattr(decontamination, "SCREENED", (200, 1 << 20)[n % 2])  # few items at once, long ones left to the exact screen
        text = rng.integers(0, 600, int(rng.integers(1, 1500)))
        items = [decontamination.Item(k, rng.integers(0, 620, int(rng.integers(1, 90)))) for k in range(12)]
        items.append(decontamination.Item(12, np.append(text[len(text) // 2 :][:30], 619)))
        leasts = np.array([next(k for k in range(len(i.codes) + 1) if k / len(i.codes) >= 0.35) for i in items])
        column = np.zeros(620, np.int64)
        got = decontamination.screened(items, text, leasts, column)
        able = np.array([len(decontamination.able_passages(i, text, 0.35)) > 0 for i in items])
        assert got[able].all() and able[-1] and not column.any()
        excluded += (~got).sum()
    assert excluded > 100


def test_scores_are_worked_out_from_few_rows_at_a_time_and_leave_columns_as_they_are(spark):
    from pyspark.sql.types import LongType

    from granary.llm import common

    rows = [(k, None if k % 7 == 0 else "x" * (k % 5), None if k % 3 else (1 << 53) + k, [k], k % 2) for k in range(1500)]
    table = spark.createDataFrame(rows, "id long, text string, big long, list array<long>, `odd name` int").coalesce(1)

    def made():
        return lambda texts, folds: [len(texts) * 10 + f for f in folds]

    got = common.with_values(table, ["id", "big", "list", "odd name"], "held", LongType(), made, ["odd name"]).collect()
    assert [tuple(r)[:4] for r in got] == [(k, b, x, f) for k, _, b, x, f in rows]
    assert {r["held"] // 10 for r in got} <= set(range(1, common.AT_ONCE + 1)) and all(r["held"] % 10 == r["odd name"] for r in got)


def test_decontamination_screens_passages_and_subsequences_like_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        text, codes = rng.integers(0, 40, int(rng.integers(1, 400))), rng.integers(0, 50, int(rng.integers(1, 40)))
        item = decontamination.Item(1, codes)
        want = []
        for p, (lo, hi) in enumerate(zip(*decontamination.passages(len(text), 64))):
            there = text[max(0, lo - len(codes)) : hi + len(codes)].tolist()
            if sum(min(n, there.count(x)) for x, n in zip(item.distinct, item.times)) / len(codes) >= 0.6:
                want.append(p)
        assert decontamination.able_passages(item, text, 0.6).tolist() == want
        table = [[0] * (len(text) + 1) for _ in range(len(codes) + 1)]
        for i, x in enumerate(codes):
            for j, y in enumerate(text):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(codes, text) == table[-1][-1]


def test_words_and_long_runs_are_those_of_their_patterns():
    rng = np.random.default_rng(4)
    signs = [chr(c) for c in [*range(1, 0x250), *range(0x5D0, 0x6D0), *range(0x2000, 0x2100), *range(0x3000, 0x3100), 0x130, 0xFF10, 0x1F600]]
    texts = ["".join(rng.choice(signs[: int(rng.integers(40, len(signs)))], int(rng.integers(0, 300)))) for _ in range(300)]
    for t in [None, *texts]:
        assert decontamination.words(t) == decontamination._WORDS.findall((t or "").lower())
    for n in (999, 1000):
        for before in (0, 1, 499, 501, 730):
            for run in ("a" * n, "\n" * n, " " * n):
                assert packing.has_long_run("x " * before + run[:0] + ("b" if run.isspace() else " ") + run + ("b" if run.isspace() else " ") + "c d " * 40) == (n == 1000)


def test_keep_one_takes_five_words_and_eight_tenths(spark):
    a = WORDS[:60]
    rows = [(1, " ".join(a)), (2, " ".join(a[:46])), (3, " ".join(a[:48]))]  # 42 and 44 of the 56 five-word shingles
    rows += [(4, " ".join(WORDS[100:160])), (5, " ".join(WORDS[100:150])), (6, " ".join(WORDS[200:260])), (7, " ".join(WORDS[200:248]))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    linked = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert linked == {(2, 3), (4, 5)}  # 42 / 44, 46 / 56; 44 / 56 is under the limit
    assert sorted(r["doc_id"] for r in jaccard.keep_one(table).collect()) == [1, 2, 4, 6, 7]


def test_license_scan_finds_altered_copies_at_every_offset(spark):
    mit = licenses.TEMPLATES[1][1].split()
    whole = [f"term{k}" for k in range(300)]
    rows, altered = [], {}
    for offset in range(70):
        copies = [mit] + [mit[:k] + ["other"] * n + mit[k + n :] for k in (2, 24, 45) for n in (1, 2)]
        for n, copy in enumerate(copies):
            altered[10 * offset + n] = (1, [" ".join(mit), " ".join(copy)])
            rows.append((10 * offset + n, " ".join(WORDS[:offset] + copy + WORDS[200:260])))
        altered[10 * offset + 9] = (2, [" ".join(whole)] * 2)
        rows.append((10 * offset + 9, " ".join(WORDS[:offset] + whole + WORDS[200:260])))
    want = set()
    for key, (template, texts) in altered.items():
        a, b = ({tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in ("".join(c if c.isalnum() else " " for c in t).lower().split() for t in texts))
        want.add((key, template, round(len(a & b) / len(a), 9)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    given = [licenses.TEMPLATES[0], licenses.TEMPLATES[1], ("Own", " ".join(whole))]
    got = {(r["doc_id"], r["template"], round(r["containment"], 9)) for r in licenses.scan(table, given).collect()}
    assert got == want


def test_rows_with_null_and_repeated_ids_are_kept_and_dropped_one_by_one(spark):
    a, b, c, d = (" ".join(WORDS[k : k + 60]) for k in (0, 80, 160, 240))
    near = " ".join(WORDS[240:298])
    rows = [(None, a, "s", "1"), (None, b, "s", "2"), (None, "", "s", "3"), (None, None, "s", "4"),  # unlike each other
            (5, c, "s", "5"), (5, a, "s", "6"), (5, " ".join(WORDS[320:380]), "s", "7"),
            (None, d, "s", "8"), (None, near, "s", "9")]  # linked, by null ids alone
    table = docs(spark, rows)
    kept = {r["n_shingles"] for r in jaccard.keep_one(table).collect()}
    assert len(kept & {"8", "9"}) == 1 and kept - {"8", "9"} == {"2", "3", "4", "5", "6", "7"}
    got = [(r["doc_id"], r["component_id"]) for r in jaccard.join(table).collect()]
    assert sorted(got, key=str) == sorted([(5, 5)] * 3 + [(None, 5)] + [(None, None)] * 5, key=str)
    bench = spark.createDataFrame([(1, " ".join(WORDS[90:120]))], "item_id long, text string")
    clean = decontamination.keep_unseen(table, bench)
    assert {r["n_shingles"] for r in clean.collect()} == set("13456789") and clean.columns == table.columns


def test_small_sources_are_mixed_by_their_shares():
    rng = np.random.default_rng(2)
    for totals in (
        {f"s{k:03d}": 3000 + k for k in range(400)}, {"hot": 2_000_000, **{f"t{k:03d}": int(n) for k, n in enumerate(rng.integers(20, 4000, 300))}}
    ):
        found = packing.levels(totals, window=2048)
        layout, owner = packing.Mixture(found), np.full(sum(totals.values()), -1)
        for k, (source, n) in enumerate(totals.items()):
            at = 0
            while at < n:
                take = min(int(rng.integers(1, 500)), n - at)
                pieces = layout.pieces(source, at, take)
                assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces])[:-1].tolist() and sum(p[1] for p in pieces) == take
                for _, size, where in pieces:
                    assert (owner[where : where + size] == -1).all() and where // 2048 == (where + size - 1) // 2048
                    owner[where : where + size] = k
                at += take
        assert (owner >= 0).all()
        # at the end of every window each source is within a few of its own pieces of its share
        for upto in range(2048, len(owner), 2048):
            held = np.bincount(owner[:upto], minlength=len(totals))
            assert np.abs(held - np.array(list(totals.values())) * upto / len(owner)).max() <= 4 * packing.MIN_SHARE


def test_warc_damage_costs_the_records_it_hits(spark, tmp_path):
    rng = np.random.default_rng(8)
    pages = [(k, f"http://a/{k}", " ".join(rng.choice(WORDS, 60))) for k in range(300)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(1)
    warc.write_archives(warc.records(table).repartition(1), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*")
    raw = bytearray(file.read_bytes())
    assert {r["page_id"]: r["payload"] for r in warc.read_archives(spark, str(tmp_path / "w")).collect()} == {k: t for k, _, t in pages}
    for share in (0.3, 0.6, 0.9):
        raw[int(len(raw) * share)] ^= 0x55
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.warc.gz").write_bytes(raw)
    rows = [r for r in warc.read_archives(spark, str(tmp_path / "d")).collect() if r["kind"] == "record"]
    assert len(rows) >= 297 and all(r["payload"] == pages[r["page_id"]][2] for r in rows)


def test_warc_reads_standard_responses_and_what_stands_before_damage():
    def record(block, *more):
        lines = [b"WARC/1.0", b"WARC-Type: response", *more, b"Content-Length: %d" % len(block)]
        return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nbody"
    sha1 = b"WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(b"body").digest())
    kind = b"Content-Type: application/http; msgtype=response"
    data = record(b"plain") + record(http, kind, sha1) + record(http.replace(b"body", b"bodY"), kind, sha1)
    found = list(warc.salvage(data))
    assert [x[0] for x in found] == ["record", "record", "gap"] and [x[2] for x in found[:2]] == [b"plain", b"body"]
    # one member for many records, damaged half way
    whole = b"".join(record(hashlib.sha256(b"%d" % k).hexdigest().encode()) for k in range(2000))
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = bytearray(packed.compress(whole) + packed.flush())
    raw[len(raw) // 2 : len(raw) // 2 + 40] = b"\xff" * 40
    got, gaps = warc.inflate(bytes(raw))
    same = next((k for k, (x, y) in enumerate(zip(got, whole)) if x != y), len(got))
    assert same > 0.4 * len(whole) and gaps == [(0, len(raw))]
    # a record is never completed with bytes from behind a seam
    assert [x[0] for x in warc.salvage(data[:-9] + b"\r\n\r\n", [20])][0] == "gap"


def test_warc_members_end_in_a_zero_byte():
    import gzip

    for body in (b"", b"x", bytes(1 << 24)):
        assert warc.member(body).endswith(b"\0") and gzip.decompress(warc.member(body)) == body


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(12)
    items = [[str(w) for w in rng.choice(WORDS, n)] for n in (16, 30, 50)]
    texts = [[str(w) for w in rng.choice(WORDS, int(rng.integers(60, 200)))] for _ in range(24)]
    for k in range(10):  # near copies of several distances
        copy = list(texts[k])
        for at in rng.permutation(len(copy))[: k // 2]:
            copy[at] = "edited"
        texts.append(copy)
    for k, item in enumerate(items):  # altered benchmark passages and license texts
        changed = [w if n % 5 else "changed" for n, w in enumerate(item)]
        texts.append(texts[20][:40] + changed + texts[21 + k][:40])
        mit = licenses.TEMPLATES[1][1].split()
        texts.append(texts[20 + k][30:50] + mit[: 20 + k] + ["changed"] + mit[21 + k :] + texts[k][:30])
    ids = [None if k % 6 == 0 else k // 2 * 2 for k in range(len(texts))]  # null and repeated ids
    table = docs(spark, [(i, " ".join(t), "s" if k % 2 else None, str(k)) for k, (i, t) in enumerate(zip(ids, texts))])
    spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)

    def runs(width):
        return [{tuple(t[k : k + width]) for k in range(len(t) - width + 1)} for t in texts]

    def components(sets, limit):
        label = list(range(len(sets)))
        for a in range(len(sets)):
            for b in range(a):
                if len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b]):
                    x, y = label[a], label[b]
                    label = [min(x, y) if v in (x, y) else v for v in label]
        return label

    label = components(runs(5), 0.8)
    lowest = {}
    for k in range(len(texts)):
        key = (ids[k] is None, ids[k] or 0)
        lowest[label[k]] = min(lowest.get(label[k], key), key)
    kept = [int(r["n_shingles"]) for r in stages["jaccard"](spark, table, str(tmp_path)).collect()]
    assert sorted(label[k] for k in kept) == sorted(set(label)) and len(set(label)) < len(texts)
    assert all((ids[k] is None, ids[k] or 0) == lowest[label[k]] for k in kept)

    joined = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(table).collect()}
    sets = runs(4)
    label = components(sets, 0.85)
    named = {x: min((i for i, y in zip(ids, label) if x == y and i is not None), default=None) for x in label}
    assert joined == {(ids[k], len(sets[k]), named[label[k]]) for k in range(len(texts))}

    seen = set()
    for k, text in enumerate(texts):
        for item in items:
            for lo in range(len(text)):
                there = text[lo : lo + 2 * len(item)]
                row = [0] * (len(there) + 1)
                for x in item:
                    last = row[:]
                    for n, y in enumerate(there):
                        row[n + 1] = last[n] + 1 if x == y else max(row[n], last[n + 1])
                tail = item[-(len(item) // 4) :]
                if row[-1] >= 0.6 * len(item) and sum(w in there for w in tail) >= 0.5 * len(tail):
                    seen.add(k)
    clean = stages["decontamination"](spark, table, str(tmp_path))
    assert {int(r["n_shingles"]) for r in clean.collect()} == set(range(len(texts))) - seen and len(seen) == 3
    found = {(r["doc_id"], r["template"]) for r in licenses.scan(table).collect()}
    assert found == {(ids[k], 1) for k in (35, 37, 39)}
    if pytest.importorskip("public_tokenizers"):
        rows = stages["packing"](spark, clean, str(tmp_path)).collect()
        places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
        upto = 0
        for window, offset, length in places:
            assert window * packing.WINDOW + offset == upto
            upto += length
        assert upto == sum(r["length"] for r in rows)


def test_fast_ids_are_those_of_the_tokenizer_file(tmp_path):
    import json
    import random

    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    slow, encode = Tokenizer.from_file(path), packing.encoder(path)
    pick = random.Random(4)
    pieces = ["don't", " we'll", "\n\n", "  ", "\t", "é", "漢字", "😀", "123", "...", "$$$", " a", "Zürich", "\u00a0", "x" * 30, "\r\n", "'S", "<|endoftext|>", "\x00", "ﬁ", "²"]
    texts = ["", " ", "<|endoftext|>", "x" * 5000, " " * 5000, "a " * 3000, *["".join(pick.choices(pieces, k=pick.randrange(1, 40))) for _ in range(2000)]]
    assert [encode(t) for t in texts] == [slow.encode(t, add_special_tokens=False).ids for t in texts]
    # a file whose ids do not follow its merges, or that is another kind, is not taken for byte-level BPE
    described = json.load(open(path, encoding="utf-8"))
    assert packing._byte_ranks(described) is not None
    described["model"]["merges"] = described["model"]["merges"][::-1]
    assert packing._byte_ranks(described) is None
    other = json.load(open(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"), encoding="utf-8"))
    assert packing._byte_ranks(other) is None
    word = packing.encoder(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))
    assert word("Hello there") == Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")).encode("Hello there", add_special_tokens=False).ids


def test_toxic_beginnings_are_learned_across_halves(spark):
    import random

    pick = random.Random(2)
    words_ = [a + b for a in ("ta", "lo", "mi", "ru", "se", "ne") for b in ("ka", "po", "ri", "du", "ve")]
    rows, marks = [], []
    for k in range(1200):
        bad = k % 6 == 0
        text = pick.choices(words_, k=30)
        if bad:
            text[pick.randrange(30)] = "zorg" + pick.choice(words_)
        rows.append((k, " ".join(text), "s", "x"))
        marks.append((k, int(bad)))
    table = docs(spark, rows).withColumn("score", F.lit("clash")).withColumn("raw", F.lit(1)).withColumn("features", F.lit(2))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.classify(table, labels).collect()}
    out = [k for k, _ in marks if got[k]["held_out"]]
    assert sum(got[k]["predicted"] == dict(marks)[k] for k in out) / len(out) > 0.97
    kept = toxicity.keep_clean(table, labels)
    assert kept.columns == table.columns and 950 <= kept.count() <= 1050
    # a lexicon learned from one half knows nothing of the other half's own words
    part = spark.createDataFrame([(1.0, k % 2, f"only{'ab'[k % 2] * 3}x") for k in range(40)] + [(0.0, k % 2, "plain") for k in range(400)], "label double, half int, text string")
    of_one, of_zero, of_all = toxicity.learned_beginnings(part)
    assert "onlyb" in of_one and "onlya" not in of_one and "onlya" in of_zero and {"onlya", "onlyb"} <= set(of_all)


def test_quality_stage_with_a_clashing_column(spark):
    table = docs(spark, [(k, "good words here", "s", "x") for k in range(6)]).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(k, 1) for k in range(6)], "doc_id long, quality int")
    assert quality.keep_good(table, labels).columns == table.columns


@pytest.mark.parametrize("odd", ["<![foo[x]]>", "<![ x>", "<![", "<![foo", "<!x", "<!-- a", "<?x", "<", "</", "<a <b", "&#xFFFFFFFF;", "<![CDATA[x]]>", "<!DOCTYPE [<!x]>"])
def test_malformed_markup_does_not_fail(odd):
    for page in (odd, f"<p>before</p>{odd}<p>after</p>", f"<p>before</p>{odd}"):
        texts = [b[0] for b in html.leaves(page)]
        assert page == odd or "before" in texts[0]
    assert [b[0] for b in html.leaves("<p>one</p><![foo[x]]><p>two</p>")] == ["one", "two"]


def test_pipeline_stages_hand_over_small_batches(spark):
    import corpus_pipeline

    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    try:
        for given in (10000, 0, 300):
            spark.conf.set(name, given)
            corpus_pipeline.bounded(lambda spark, docs, folder: seen.append(int(spark.conf.get(name))))(spark, None, "")
    finally:
        spark.conf.set(name, before)
    assert seen == [corpus_pipeline.BATCH_ROWS] * 2 + [300]
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["good_quality", "not_toxic", "one_of_each", "unseen", "packed"]


def test_rows_are_picked_and_left_out_by_their_bits(spark):
    n = 2 * BITMAP + 100
    rows = spark.range(n).select((F.col("id") + (F.col("id") % 3) * (1 << 33)).alias(ROW), F.col("id").alias("block"))
    edges = {0, 7, 8, BITMAP - 1, BITMAP, 2 * BITMAP - 1, 2 * BITMAP, n - 1}
    some = rows.where(F.col("block").isin(*edges) | (F.xxhash64("block") % 5 == 0)).select(ROW)
    want = {r[ROW] for r in some.collect()}
    inside = [r[ROW] for r in picked(rows, some).collect()]
    outside = [r[ROW] for r in picked(rows, some, "left_anti").collect()]
    assert len(want) > n // 10 and set(inside) == want and not want & set(outside)
    assert len(inside) == len(want) and len(outside) == n - len(want) == len(set(outside))
    assert picked(rows, some.limit(0)).count() == 0 and picked(rows, some.limit(0), "left_anti").count() == n


def test_stages_leave_texts_where_they_are_read_and_little_behind(spark, mixed):
    bench = spark.createDataFrame([(1, " ".join(WORDS[210:240]))], "item_id long, text string")
    fs = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark)).getFileSystem(spark._jsc.hadoopConfiguration())
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark) + "/granary")
    stored = lambda: {p.getPath().getName() for p in fs.listStatus(folder)} if fs.exists(folder) else set()
    before, least = stored(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if there were many ids
    try:
        for stage, ids in ((jaccard.keep_one(mixed), [1, 4, 5, 6, 9]), (decontamination.keep_unseen(mixed, bench), [1, 3, 4, 5, 6, 7, 8])):
            plan = stage._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
            assert sorted(r["doc_id"] for r in stage.collect()) == ids
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    left = {name.rsplit("-", 1)[0] for name in stored() - before}
    assert "jaccard-rows" in left and "leak-rows" in left
    assert not left & {"jaccard-sets", "jaccard-bodies", "jaccard-tokens", "leak-codes"}
