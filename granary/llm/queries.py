"""One registered query per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import (
    decontamination, html, infill, jaccard, langid, licenses, merkle, packing, quality, sketches, toxicity, urls, warc,
)
from granary.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)).drop("queue")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(table(spark, sf_dir, "pages"))
    return rows.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infill.restore(infill.transform(table(spark, sf_dir, "documents")))
    shas = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *shas)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(merkle.document_leaves(table(spark, sf_dir, "documents"), tampered), proofs=False)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def all_queries() -> dict:
    named = {
        f.__name__: f for f in (
            op1_license_scan, op2_url_filter, op3_html_extract, op4_toxicity, op5_packing, op6_warc, op7_quality,
            op8_fingerprint, op9_jaccard_join, op10_decontaminate, op11_infill, op12_merkle_manifest, op13_language_id,
        )
    }
    return {**named, "pipeline": corpus_pipeline.run}


def all_oracles() -> dict[str, str]:
    return {
        "op2_url_filter": URL_SQL, "op6_warc": WARC_SQL, "op11_infill": INFILL_SQL, "op12_merkle_manifest": merkle_sql(),
    }


URL_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, s, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f AS (SELECT p.page_id, arg_max(h || s, length(h || s)) AS rule, arg_max(verdict, length(h || s)) AS verdict
      FROM (SELECT DISTINCT * FROM p) p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY p.page_id)
SELECT p.page_id, host, path, f.rule,
       coalesce(f.verdict, CASE WHEN host = 'spam-farm.example.org' OR ends_with(host, '.spam-farm.example.org') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f USING (page_id)
"""

WARC_SQL = r"""
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS kept FROM d)
SELECT page_id, payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(sha, g * 5 + 1, 5))::BIGINT >> s) & 31) + 1)::BIGINT, 1), '' ORDER BY g, s DESC)
        FROM range(8) a(g), (VALUES (0), (5), (10), (15)) b(s)) AS payload_digest,
       CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < kept THEN kept END AS refers_to
FROM k
"""

INFILL_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS prefix, coalesce(array_to_string(lines[a + 1:b], ''), '') AS middle,
             coalesce(array_to_string(lines[b + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def merkle_sql(levels: int = 16) -> str:
    """The manifest in SQL, for sources, and a number of sources, of at most 3 ** levels."""
    def leaf(text: str) -> str:
        parts = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({p}::VARCHAR)::VARCHAR || ':' || {p}::VARCHAR, '-')" for p in parts) + ")"

    run = "PARTITION BY tree, pos // 3 ORDER BY pos"
    out = [f"""
WITH d AS (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("replace(text, chr(10), '')")} AS less,
                  list_reduce(flatten([[4294967295], flatten([[ord(x), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(doc_id::VARCHAR, '')])]),
                    LAMBDA c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END) AS crc FROM documents),
l AS (SELECT doc_id, coalesce('=' || source, '') AS tree, leaf, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN less ELSE leaf END AS candidate FROM d),
a0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h, doc_id, leaf, candidate FROM l)"""]

    def climb(x: str) -> None:
        for k in range(levels):
            out.append(f"""
{x}s{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS size, coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
       coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {x}{k}),
{x}{k + 1} AS (SELECT tree, pos // 3 AS pos, CASE WHEN max(size) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE max(h) END AS h FROM {x}s{k} GROUP BY tree, pos // 3)""")

    climb("a")
    out.append(f"""
b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, tree AS name, h AS subroot FROM a{levels})""")
    climb("b")
    out.append("""
f0 AS (SELECT doc_id, tree AS name, tree, pos, leaf, candidate AS f, '' AS proof FROM a0)""")
    step = 0

    def ascend(x: str) -> None:
        nonlocal step
        for k in range(levels):
            out.append(f"""
f{step + 1} AS (SELECT doc_id, name, f.tree, pos // 3 AS pos, leaf, CASE WHEN size > 1 THEN sha256(l || f || r) ELSE f END AS f, proof || l || r AS proof
       FROM f{step} f JOIN (SELECT tree, pos, size, l, r FROM {x}s{k}) s USING (tree, pos))""")
            step += 1

    ascend("a")
    out.append(f"""
f{step + 1} AS (SELECT doc_id, f.name, '' AS tree, b0.pos, leaf, f, proof FROM f{step} f JOIN b0 ON f.name = b0.name)""")
    step += 1
    ascend("b")
    out.append(f"""
o AS (SELECT f.doc_id, leaf, b0.subroot, root.h AS root, sha256(proof) AS proof_sha256, f AS folded_root
      FROM f{step} f JOIN b0 ON f.name = b0.name JOIN b{levels} root ON f.tree = root.tree)""")
    return ",".join(out) + """
SELECT *, folded_root = root AS verified FROM o"""
