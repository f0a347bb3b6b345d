import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from granary.plans import ingest, intake, reports
from granary.sinks import files, tables
from granary.sources import delimited, documents, warehouse

STAMP = datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


# -- delimited sources -------------------------------------------------------


def test_headers_may_differ_between_files(spark, tmp_path):
    a = put(tmp_path / "a.csv", "#note\nid,name\n1,x # not a comment\n2,\"y, z\"\n")
    b = put(tmp_path / "b.csv", "age,ID\nold,3\n41,4\n")
    df = delimited.read_delimited(spark, [a, b], types={"Id": "bigint", "age": "int"})
    assert rows(df.select("id", "name", "age")) == [
        (1, "x # not a comment", None), (2, "y, z", None), (3, None, None), (4, None, 41),
    ]


def test_separator_rule():
    assert delimited.separator_for("data_clinical_sample.txt") == "\t"
    assert delimited.separator_for("x.csv") == ","
    assert delimited.separator_for(table="cbioportal_clinical_sample") == "\t"


def test_release_file_selection(spark):
    listing = spark.createDataFrame(
        [("data_clinical_sample.txt",), ("meta_study.txt",), ("data_CNA.txt",), ("notes.txt",)], "name string"
    )
    chosen = delimited.select_release_files(
        listing, {**delimited.PORTAL_FILES, "meta_study.txt": "META"}, delimited.PORTAL_EXCLUDED
    )
    assert rows(chosen) == [("data_clinical_sample.txt", "CLINICAL_SAMPLE")]


def test_recent_files_and_listing(spark, tmp_path):
    put(tmp_path / "in" / "a_manifest.csv", "x\n")
    put(tmp_path / "in" / "deep" / "b.csv", "x\n")
    listing = delimited.list_files(spark, str(tmp_path / "in"))
    assert [r["name"] for r in listing.orderBy("name").collect()] == ["a_manifest.csv", "b.csv"]
    fixed = listing.withColumn("modified", F.lit("2024-01-02T03:00:00.000Z"))
    assert delimited.recent_files(fixed, "_manifest.csv", datetime(2024, 1, 3, 2)).count() == 1
    assert delimited.recent_files(fixed, "_manifest.csv", datetime(2024, 1, 3, 3)).count() == 0


def test_mapping_keeps_the_first_value(spark, tmp_path):
    path = put(tmp_path / "m.csv", "file,specimen\nf1,s1\nf1,s2\nf2,s3\n")
    assert rows(delimited.read_mapping(spark, path, "file", "specimen")) == [("f1", "s1"), ("f2", "s3")]


def test_catalog_kinds(spark, tmp_path):
    path = put(tmp_path / "c.csv", "ID,grant\n1,g\n")
    spark.createDataFrame([(1,)], "ID int").createOrReplaceTempView("portal_view")
    assert delimited.read_catalog(spark, "portal_view", "table").count() == 1
    assert delimited.read_catalog(spark, path, "file").columns == ["ID", "grant"]
    with pytest.raises(TypeError):
        delimited.read_catalog(spark, path, "folder")


def test_ignore_list(spark, tmp_path):
    full = put(tmp_path / "i.json", json.dumps({"ids": ["a", "b"], "note": "x"}, indent=1))
    empty = put(tmp_path / "e.json", "{}")
    assert rows(documents.read_ignore_list(spark, full, "ids")) == [("a",), ("b",)]
    assert rows(documents.read_ignore_list(spark, empty, "ids")) == []


def test_samplesheet_conversion(spark, tmp_path):
    source = put(tmp_path / "s.tsv", "p1\tXX\t0\ts1\ta.bam\ta.bai\n")
    target = str(tmp_path / "sheet")
    intake.convert_samplesheet(spark, source, target)
    df = spark.read.option("header", True).csv(target)
    assert df.columns == ["patient", "sex", "status", "sample", "bam", "bai"]
    assert rows(df) == [("p1", "XX", "0", "s1", "a.bam", "a.bai")]


def test_jdbc_options():
    plain = warehouse.jdbc_options("jdbc:x", "select 1")
    assert plain["query"] == "select 1" and "dbtable" not in plain
    split = warehouse.jdbc_options("jdbc:x", "select id from t", "id", (0, 100), 4)
    assert split["dbtable"] == "(select id from t) report" and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        warehouse.jdbc_options("jdbc:x", "select 1", "id")


# -- pages -------------------------------------------------------------------


def pages_of(spark, sizes, page_size, total=None, first=1):
    data = [(first + n, list(range(size)), total) for n, size in enumerate(sizes)]
    df = spark.createDataFrame(data, "page int, data array<int>, total int")
    return documents.flatten_pages(
        df, "data", "page", page_size, total="total" if total is not None else None, first_page=first
    )


@pytest.mark.parametrize("sizes, total, kept", [
    ([10, 10, 3, 10], None, 23),   # reading ends with the first short page
    ([10, 0, 10], None, 10),       # an empty page ends it as well
    ([10, 10], None, 20),
    ([10, 10, 10], 20, 20),        # the announced total ends it
    ([0], 0, 0),
])
def test_end_of_pages(spark, sizes, total, kept):
    assert pages_of(spark, sizes, 10, total).count() == kept


def test_usage_records_of_several_pages(spark, tmp_path):
    """Seven records on pages of three; every third one has no statistics, the odd ones are resources."""
    made = [
        {"id": 40 + n, "metadata": {"title": f"Item {n}{' Resource' * (n % 2)}", "publication_date": f"2023-0{n + 1}-09"},
         **({"stats": {"views": 10 * n, "unique_views": n, "downloads": 3 * n, "unique_downloads": 1}} if n % 3 else {})}
        for n in range(7)
    ]
    for page in range(3):
        put(tmp_path / "pages" / f"{page}.json", json.dumps({"page": page + 1, "hits": {"total": 7, "hits": made[3 * page : 3 * page + 3]}}))
    records = reports.usage_records(documents.read_pages(spark, str(tmp_path / "pages")), "https://x/", page_size=3)
    reports.require_usage_records(records)
    got = {r["index"]: (r["title"], r["views"], r["link"], r["category"]) for r in records.collect()}
    assert got == {
        n: (m["metadata"]["title"], 10 * n if n % 3 else 0, f"https://x/{40 + n}", "component" if n % 2 else "report")
        for n, m in enumerate(made)
    }
    totals = {r["category"]: r["views"] for r in reports.report_rows(records.drop("checked")).filter("is_total = 1").collect()}
    assert totals == {"report": 20 + 40, "component": 10 + 50}


def test_report_files_end_with_totals(spark, tmp_path):
    kinds = ["north", "south", "west"]
    data = [(n, f"R{n}", f"2023-{n + 1:02d}", 7 * n, 5 * n, n, n % 2, f"u/{n}", kinds[n % 3]) for n in range(9)]
    df = spark.createDataFrame(
        data, "index bigint, title string, date string, views bigint, unique_views bigint, downloads bigint, "
        "unique_downloads bigint, link string, category string"
    ).repartition(4)
    path = tmp_path / "out"
    reports.write_reports(df, str(path))
    for k, kind in enumerate(kinds):
        parts = sorted((path / f"category={kind}").glob("part-*"))
        written = [line.replace('""', "").split(",") for part in parts for line in part.read_text().splitlines()]
        own = [d for d in data if d[0] % 3 == k]
        assert written[0] == list(reports.REPORT_HEADINGS.values())
        assert written[1:-1] == [[str(v) for v in d[1:8]] for d in own]
        assert written[-1] == ["TOTALS", "", *[str(sum(d[c] for d in own)) for c in range(3, 7)], ""]


def test_split_reports_have_one_heading_and_keep_equal_rows(spark, tmp_path):
    one = (7, "same", "2024", 1, 1, 1, 1, "l", "report")
    many = [(k, f"t{k:03d}", "2024", k, 1, 1, 1, "l", "report") for k in range(200)]
    df = spark.createDataFrame([one, one, *many], "index bigint, title string, date string, views bigint, unique_views bigint, "
                               "downloads bigint, unique_downloads bigint, link string, category string").repartition(4)
    total = reports.report_rows(df).filter("is_total = 1").collect()
    assert [(r["title"], r["views"], r["unique_views"]) for r in total] == [("TOTALS", sum(range(200)) + 2, 202)]
    plan = reports.report_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Union" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        reports.write_reports(df, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "out" / "category=report").glob("part-*"))
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert len(parts) > 1 and len(lines) == 204 and [line.startswith("Title,") for line in lines].count(True) == 1
    assert lines[0].startswith("Title,") and lines[-1].startswith("TOTALS,")
    assert [line.split(",")[0] for line in lines if line.startswith("t")] == [f"t{k:03d}" for k in range(200)]


# -- documents ---------------------------------------------------------------


def test_documents_are_found_by_the_manifest(spark, tmp_path):
    sizes = {"large one": 900, "b c": 1, "a": 7, "é": 2}
    made = [(key, s, f"{n:04d}", f"{key} {s} {n} ü") for key, size in sizes.items() for s in range(2) for n in range(size)]
    df = spark.createDataFrame(made, "object_key string, section int, place string, line string").repartition(5)
    path = str(tmp_path / "docs")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # files are read in blocks
    try:
        files.write_documents(df, path)
        back = files.read_documents(spark, path).collect()
        manifest = files.document_manifest(spark, path).collect()
        assert len({r["part"] for r in manifest if r["object_key"] == "large one"}) > 1
        for key in sizes:
            lines = [r["line"] for r in sorted((r for r in back if r["object_key"] == key), key=lambda r: r["place"])]
            assert lines == [m[3] for m in sorted(made) if m[0] == key]
            assert sum(r["n_lines"] for r in manifest if r["object_key"] == key) == len(lines)
        assert sum(r["n_bytes"] for r in manifest) == sum(len(m[3].encode()) for m in made)
        assert files.damaged_documents(spark, path).count() == 0
        # two lines exchanged within a document are noticed
        part = next(p for p in sorted((tmp_path / "docs" / "parts").glob("part-*")) if "large one 0 10 " in p.read_text())
        text = part.read_text()
        part.write_text(text.replace("large one 0 10 ü\nlarge one 0 11 ü\n", "large one 0 11 ü\nlarge one 0 10 ü\n"))
        for crc in (tmp_path / "docs" / "parts").glob(".*.crc"):
            crc.unlink()
        assert [r["object_key"] for r in files.damaged_documents(spark, path).collect()] == ["large one"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    files.write_documents(df.limit(0), str(tmp_path / "none"))
    assert files.read_documents(spark, str(tmp_path / "none")).count() == 0


# -- NDJSON, bundles, manifests, matrices ------------------------------------


def test_ndjson_is_compact_and_counted(spark, tmp_path):
    path = tmp_path / "nd"
    df = spark.createDataFrame([(1, "é ü", None), (2, "b", "x")], "id int, t string, n string")
    assert files.write_ndjson_gz(df, str(path)) == 2
    text = "".join(gzip.open(p, "rt", encoding="utf-8").read() for p in sorted(path.glob("*.json.gz")))
    assert sorted(text.splitlines()) == ['{"id":1,"t":"é ü"}', '{"id":2,"t":"b","n":"x"}']
    assert files.write_ndjson_gz(df.limit(0), str(path)) == 0


def test_bundle_and_manifest(spark, tmp_path):
    bundle = files.bundle_reports({"a": spark.range(2).toDF("n"), "b": spark.createDataFrame([("x",)], "s string")})
    assert rows(bundle) == [("a", '{"n":0}'), ("a", '{"n":1}'), ("b", '{"s":"x"}')]
    path = files.write_manifest(spark.range(3).toDF("i"), str(tmp_path), "run-7")
    assert path.endswith("/run-7/submissions")
    assert spark.read.option("header", True).csv(path).columns == ["submission_id"]


def test_matrix_file(spark, tmp_path):
    df = spark.createDataFrame([("b", 1.0), ("a", None)], "Hugo string, s1 double")
    files.write_matrix(df, str(tmp_path / "m"), "Hugo")
    parts = sorted((tmp_path / "m").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "Hugo\ts1\na\t\nb\t1.0\n"


# -- tables ------------------------------------------------------------------


def test_partition_rules(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = ["COHORT", "RELEASE"]
    first = spark.createDataFrame([(1, "A", "r1"), (2, "A", "r2")], "x int, COHORT string, RELEASE string")
    again = spark.createDataFrame([(9, "A", "r1"), (8, "B", "r1")], "x int, COHORT string, RELEASE string")
    tables.store_release(first, path, keys, overwrite_partition=False)
    tables.store_release(again, path, keys, overwrite_partition=False)
    assert rows(spark.read.parquet(path)) == [(1, "A", "r1"), (2, "A", "r2"), (8, "B", "r1")]
    tables.store_release(again, path, keys, overwrite_partition=True)
    tables.store_release(again, path, keys, overwrite_partition=True)
    stored = spark.read.parquet(path)
    assert rows(stored) == [(2, "A", "r2"), (8, "B", "r1"), (9, "A", "r1")]
    # the partition test compares text in upper case
    assert tables.partition_exists(stored, COHORT="a", RELEASE="R1")
    assert not tables.partition_exists(stored, COHORT="c")


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "hot"
    df = spark.range(0, 80000, numPartitions=8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 20 > 0, "hot").otherwise("cold").alias("RELEASE"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "512k")
    try:
        tables.replace_partition(df, str(path), ["RELEASE"])
    finally:
        spark.conf.set(size, before)
    assert len(list((path / "RELEASE=hot").glob("part-*"))) > 1
    assert len(list((path / "RELEASE=cold").glob("part-*"))) == 1
    assert spark.read.parquet(str(path)).count() == 80000


def test_save_table_rules(spark):
    df = spark.createDataFrame([(1,)], "x int")
    tables.ensure_schema(spark, "lab")
    tables.ensure_schema(spark, "lab")
    assert tables.save_table(df, "lab.rules") is True
    assert tables.save_table(df.limit(0), "lab.rules") is False
    assert spark.table("lab.rules").count() == 1
    assert tables.save_table(df.union(df), "lab.rules", overwrite=True) is True
    assert spark.table("lab.rules").count() == 2
    with pytest.raises(ValueError, match="unknown options"):
        tables.save_table(df, "lab.rules", quote=True)
    tables.append(df, "lab.rules")
    assert spark.table("lab.rules").count() == 3
    tables.overwrite_table(df, "lab.rules")
    assert spark.table("lab.rules").count() == 1


def test_snapshot_of_a_day_is_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    for day, n in ((1, 3), (2, 4), (2, 5)):
        tables.append_snapshot(spark.range(n), path, date(2024, 1, day))
    counts = spark.read.parquet(path).groupBy("export_date").count()
    assert rows(counts) == [(date(2024, 1, 1), 3), (date(2024, 1, 2), 5)]


def test_merge_takes_nulls_and_keeps_the_rest(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, s string")
    assert rows(tables.merge_upsert(target, source, "k")) == [(1, "a", 1.0), (2, None, 2.0), (3, "c", None)]
    with pytest.raises(ValueError):
        tables.merge_upsert(target, source.withColumn("new", F.lit(1)), "k")


def test_upsert_actions_and_dry_run(spark, tmp_path):
    target = spark.createDataFrame([("a", "1"), ("b", "2"), ("z", "9")], "k string, url string")
    source = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4")], "k string, url string")
    actions = tables.upsert_actions(target, source, ["k"], "url")
    assert rows(actions) == [("a", "1", "unchanged"), ("b", "3", "update"), ("c", "4", "insert")]
    path = tmp_path / "links"
    changes = tables.apply_upsert(target, actions, ["k"], str(path))
    assert rows(changes.select("k")) == [("b",), ("c",)] and not path.exists()
    tables.apply_upsert(target, actions, ["k"], str(path), apply=True)
    stored = spark.read.parquet(str(path))
    assert rows(stored) == [("a", "1"), ("b", "3"), ("c", "4"), ("z", "9")]
    gone = tmp_path / "kept"
    tables.delete_rows(stored, stored.filter("k = 'z'"), ["k"], str(gone), apply=True)
    assert spark.read.parquet(str(gone)).count() == 3


def test_merge_touches_the_partitions_of_the_source_only(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = spark.createDataFrame([(k, f"v{k}", k / 2, "abc"[k % 3]) for k in range(30)], "k bigint, v string, w double, p string")
    tables.replace_partition(stored, path, ["p"])
    files_of = lambda p: {f.name for f in (tmp_path / "t" / f"p={p}").glob("*.parquet")}
    before = {p: files_of(p) for p in "abc"}
    source = spark.createDataFrame([(1, "b", None), (31, "b", "new"), (7, "d", "moved key")], "k bigint, p string, v string")
    tables.merge_partitions(source, path, ["k", "p"], ["p"])
    want = {(k, f"v{k}", k / 2, "abc"[k % 3]) for k in range(30) if k != 1} | {(1, None, 0.5, "b"), (31, "new", None, "b"), (7, "moved key", None, "d")}
    assert {tuple(r) for r in spark.read.parquet(path).select("k", "v", "w", "p").collect()} == want
    assert files_of("a") == before["a"] and files_of("c") == before["c"] and not files_of("b") & before["b"]
    tables.merge_partitions(source, path, ["k", "p"], ["p"])
    assert {tuple(r) for r in spark.read.parquet(path).select("k", "v", "w", "p").collect()} == want
    # a repeated key fails and leaves the table alone
    now = {p: files_of(p) for p in "abcd"}
    with pytest.raises(PySparkException, match="several source rows"):
        tables.merge_partitions(source.unionAll(source.limit(1)), path, ["k", "p"], ["p"])
    assert {p: files_of(p) for p in "abcd"} == now
    with pytest.raises(ValueError):
        tables.merge_partitions(source, path, "k", ["p"])
    plan = tables.touched_partitions(spark.read.parquet(path), source, ["p"])._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_merge_notices_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(PySparkException, match="several source rows"):
        tables.merge_upsert(target, twice, "k").collect()
    # incomplete keys match nothing, however many there are
    loose = spark.createDataFrame([(None, "x"), (None, "y"), (1, "z")], "k int, v string")
    assert rows(tables.merge_upsert(target, loose, "k")) == [(1, "z"), (None, "x"), (None, "y")]
    assert rows(tables.merge_upsert(target, loose.limit(0), "k")) == [(1, "a")]


# -- ingestion ---------------------------------------------------------------


def test_main_release_ingest_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "main")
    folders = {
        "19.3-consortium": put(tmp_path / "a" / "data_clinical_sample.txt", "#c\nSAMPLE_ID\tPATIENT_ID\nS1\tP1\nS2\tP2\n"),
        "20.0-public": put(tmp_path / "b" / "data_clinical_sample.txt", "SAMPLE_ID\tPATIENT_ID\tAGE\nS3\tP3\t4\n"),
        "21.0-public": put(tmp_path / "c" / "data_clinical_sample.txt", "SAMPLE_ID\tPATIENT_ID\n"),
    }
    for _ in range(2):
        ingest.ingest_main(spark, folders, path, types={"AGE": "int"}, ingested_at=STAMP)
    df = spark.read.parquet(path)
    assert rows(df.select("SAMPLE_ID", "AGE", "RELEASE", "RELEASE_TYPE", "MAJOR_VERSION", "MINOR_VERSION")) == [
        ("S1", None, "19_3_CONSORTIUM", "CONSORTIUM", 19, 3), ("S2", None, "19_3_CONSORTIUM", "CONSORTIUM", 19, 3),
        ("S3", 4, "20_0_PUBLIC", "PUBLIC", 20, 0),
    ]
    put(tmp_path / "a" / "data_clinical_sample.txt", "SAMPLE_ID\tPATIENT_ID\nS9\tP9\n")
    ingest.ingest_main(spark, folders, path, overwrite_partition=True, types={"AGE": "int"}, ingested_at=STAMP)
    assert [r[0] for r in rows(spark.read.parquet(path).select("SAMPLE_ID"))] == ["S3", "S9"]


def test_walk_does_not_open_files_of_stored_releases(spark, tmp_path):
    file, root, path = "data_clinical_sample.txt", tmp_path / "in", str(tmp_path / "out")
    old = root / "Releases" / "Release 17" / "17.1-public" / file
    put(old / "part-0.csv", "ID\nS1\n")
    for step in range(2):
        found = ingest.ingest_walk(spark, str(root), path, ["ID"], ingested_at=STAMP, files={file: "T"})
        assert found["T"]["rows"] == 1
        (old / "part-1.csv.gz").write_bytes(b"no archive")  # reading this fails
        put(root / "Releases" / "Release 17" / "17.2-public" / file / "part-0.csv", "ID\nS2\n")
    assert rows(spark.read.parquet(f"{path}/T").select("ID", "RELEASE")) == [("S1", "17_1_PUBLIC"), ("S2", "17_2_PUBLIC")]


def test_bad_release_name_fails_the_load(spark, tmp_path):
    file = put(tmp_path / "x.txt", "A\n1\n")
    with pytest.raises(PySparkException, match="Unexpected version format"):
        ingest.ingest_main(spark, {"v1-public": file}, str(tmp_path / "t"))


def test_cohort_ingest_replaces_the_cohort_column(spark, tmp_path):
    path = str(tmp_path / "cohorts")
    specs = [
        delimited.ReleaseSpec("crc", [put(tmp_path / "1" / "p.csv", "cohort,id\nwrong,1\n")], "PANEL", "public_02_2"),
        delimited.ReleaseSpec("crc", [put(tmp_path / "2" / "p q.csv", "id,note\n2,n\n")], "PANEL", "consortium_01_1"),
        delimited.ReleaseSpec("brca", [put(tmp_path / "3" / "p.csv", "id\n3\n")], "PANEL", "public_preview_01_0"),
    ]
    ingest.ingest_cohorts(spark, specs, path, ingested_at=STAMP)
    df = spark.read.parquet(path)
    assert rows(df.select("id", "COHORT", "RELEASE", "SOURCE_FILE")) == [
        ("1", "CRC", "2_2_PUBLIC", "p.csv"), ("2", "CRC", "1_1_CONSORTIUM", "p q.csv"),
    ]
    # loading with overwrite really replaces the upper-case partition
    ingest.ingest_cohorts(spark, specs, path, overwrite_partition=True, ingested_at=STAMP)
    assert spark.read.parquet(path).count() == 2


def test_project_ingest_stacks_all_files(spark, tmp_path):
    spec = delimited.ReleaseSpec(
        "ntrk", [put(tmp_path / "a.csv", "id,x\n1,a\n"), put(tmp_path / "b.csv", "id,y\n2,b\n")], "panel"
    )
    assert ingest.ingest_projects(spark, [spec], ingested_at=STAMP) == {"ntrk.panel": True}
    assert rows(spark.table("ntrk.panel").select("id", "x", "y", "RELEASE")) == [
        ("1", "a", None, "ntrk"), ("2", None, "b", "ntrk")
    ]
    assert ingest.ingest_projects(spark, [spec], ingested_at=STAMP) == {"ntrk.panel": False}


def test_known_columns_are_read_once_and_faults_counted(spark, tmp_path):
    a = put(tmp_path / "a.csv", '# c\nID,name,age\n1,x,4\n2,"y, ""z""",old\n3,short\n4,a,5,extra\n')
    b = put(tmp_path / "b.csv", 'id,name,age\n5,"un,6\n6,,\n')
    columns, types = ["id", "name", "age"], {"ID": "bigint", "age": "int"}
    seen = Observation()
    df = delimited.counted_faults(delimited.read_known(spark, [a, b], columns, types=types), seen)
    assert df.columns == columns
    assert rows(df) == [(1, "x", 4), (2, 'y, "z"', None), (3, "short", None), (4, "a", 5), (5, "un,6", None), (6, None, None)]
    assert seen.get == {"rows": 6, "malformed": 3, "unbalanced": 1, "failed_casts": 1}
    # counting does not depend on which columns are used
    seen = Observation()
    assert delimited.counted_faults(delimited.read_known(spark, [a, b], columns, types=types), seen).select("id").count() == 6
    assert seen.get["malformed"] == 3
    with pytest.raises(PySparkException, match="faulty row"):
        delimited.counted_faults(delimited.read_known(spark, a, columns, types=types), Observation(), strict=True).collect()
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        delimited.read_known(spark, a, ["id", "other", "age"]).collect()


def test_quoted_line_breaks(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id,note\n1,"a\nb"\n2,c\n')
    whole = delimited.read_known(spark, path, ["id", "note"], multi_line=True)
    assert rows(whole.select("id", "note", "_malformed")) == [("1", "a\nb", False), ("2", "c", False)]
    # without the option the break is not silent: its second half is malformed and unbalanced
    split = delimited.read_known(spark, path, ["id", "note"])
    assert [tuple(r) for r in split.filter("_malformed").select("id", "_unbalanced").collect()] == [('b"', True)]


def test_walk_applies_the_path_rule_and_opens_no_other_file(spark, tmp_path):
    file = "data_clinical_sample.txt"
    good = "SAMPLE_ID\tAGE\n"
    put(tmp_path / "in" / "Releases" / "Release 17" / "17.1-public" / file, f"#x\n{good}S1\t4\nS2\told\n")
    put(tmp_path / "in" / "Releases" / "Release 18" / "18.02-consortium" / file, f"{good}S3\t5\n")
    put(tmp_path / "in" / "Releases" / "Release 18" / "18.3-public" / file, good)
    put(tmp_path / "in" / "Releases" / "Release 18" / "18.3-public" / "meta.txt", "nothing\n")
    # would fail the job if it were opened
    put(tmp_path / "in" / "Releases" / "Release 05" / "5.1-public" / file, "OTHER\nx\n")
    put(tmp_path / "in" / "Releases" / file, "OTHER\nx\n")
    put(tmp_path / "in" / "Releases" / "Release 18" / "a" / "18.4-public" / file, "OTHER\nx\n")
    out = str(tmp_path / "out")

    def load(**options):
        return ingest.ingest_walk(spark, str(tmp_path / "in"), out, ["SAMPLE_ID", "AGE"], types={"AGE": "int"}, ingested_at=STAMP, **options)

    assert load() == {"CLINICAL_SAMPLE": {"rows": 3, "malformed": 0, "unbalanced": 0, "failed_casts": 1}}
    assert load()["CLINICAL_SAMPLE"]["rows"] == 0
    df = spark.read.parquet(f"{out}/CLINICAL_SAMPLE")
    assert rows(df.select("SAMPLE_ID", "AGE", "RELEASE", "MAJOR_VERSION", "MINOR_VERSION")) == [
        ("S1", 4, "17_1_PUBLIC", 17, 1), ("S2", None, "17_1_PUBLIC", 17, 1), ("S3", 5, "18_2_CONSORTIUM", 18, 2),
    ]
    with pytest.raises(PySparkException, match="faulty row"):
        load(overwrite_partition=True, strict=True)
    put(tmp_path / "in" / "Releases" / "Release 19" / "v19-public" / file, f"{good}S9\t1\n")
    with pytest.raises(PySparkException, match="Unexpected version format"):
        load()


def test_release_set_with_known_columns(spark, tmp_path):
    specs = [
        delimited.ReleaseSpec("crc", [str(tmp_path / "one")], "P", "public_02_2", columns=["cohort", "id"], types={"id": "int"}, folders=True),
        delimited.ReleaseSpec("brca", [str(tmp_path / "two" / "p q.csv")], "P", "consortium_1_1", columns=["id", "note"], types={"id": "int"}),
        delimited.ReleaseSpec("nsclc", [str(tmp_path / "three.csv")], "P", "public_1_1", types={"id": "int"}),
    ]
    put(tmp_path / "one" / "a.csv", "cohort,id\nwrong,1\n")
    put(tmp_path / "one" / "b.csv", "cohort,id\nwrong,x\n")
    put(tmp_path / "two" / "p q.csv", "id,note\n3,n\n4\n")
    put(tmp_path / "three.csv", "age,id\n7,5\n")
    path = str(tmp_path / "out")
    found = ingest.ingest_cohorts(spark, specs, path, ingested_at=STAMP)
    assert found == {"rows": 5, "malformed": 1, "unbalanced": 0, "failed_casts": 1}
    assert rows(spark.read.parquet(path).select("id", "note", "age", "COHORT", "RELEASE", "SOURCE_FILE")) == [
        (1, None, None, "CRC", "2_2_PUBLIC", "a.csv"), (3, "n", None, "BRCA", "1_1_CONSORTIUM", "p q.csv"),
        (4, None, None, "BRCA", "1_1_CONSORTIUM", "p q.csv"), (5, None, "7", "NSCLC", "1_1_PUBLIC", "three.csv"),
        (None, None, None, "CRC", "2_2_PUBLIC", "b.csv"),
    ]


def test_catalog_refresh(spark, tmp_path):
    path = put(tmp_path / "portal.csv", "id,grant\n1,g1\n")
    ingest.refresh_catalog(spark, {"portal_nf": (path, "file")})
    ingest.refresh_catalog(spark, {"portal_nf": (path, "file")})
    assert spark.table("portal_nf").columns == ["ID", "GRANTS"]
    assert spark.table("portal_nf").count() == 1


def test_skipped_sources(spark):
    specs = [delimited.ReleaseSpec("a", ["f1", "f2"], "t")]
    loaded = spark.createDataFrame([("f1",)], "_file string")
    assert rows(ingest.skipped_sources(specs, loaded)) == [("f2",)]
