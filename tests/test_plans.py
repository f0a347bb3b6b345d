import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from granary.operators import quality
from granary.plans import catalog, documents, intake, leaderboards, matrix, platform, runs, tracking
from granary.sinks import files as file_sinks

URL = "https://x/"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def usage(spark):
    nodes = spark.createDataFrame(
        [
            (1, 1, "Home", "project", True, None, None), (2, 2, "Two", "project", True, None, None),
            (3, 3, "Three", "project", True, None, None), (4, 4, "Private", "project", False, None, None),
            (20, 2, "f", "file", True, 100, datetime(2024, 1, 5)), (21, 2, "g", "file", True, 101, datetime(2024, 7, 1)),
            (90, None, "view", "entityview", False, None, None),
        ],
        "id bigint, project_id bigint, name string, node_type string, is_public boolean, file_handle_id bigint, created_on timestamp",
    ).withColumn("scope_ids", F.when(F.col("id") == 90, F.array(F.lit(2).cast("bigint"), F.lit(4).cast("bigint"))))
    day = date(2024, 6, 29)
    events = spark.createDataFrame(
        [
            (1, 10, 100, day, "prod"), (2, 10, 100, day, "prod"), (2, 11, 101, day, "prod"), (2, 10, 100, day, "prod"),
            (3, 12, 100, day, "prod"), (4, 13, 100, day, "prod"), (3, 12, 999, day, "prod"),
            (3, 14, 100, date(2024, 6, 1), "dev"), (2, 15, 100, date(2024, 5, 31), "prod"),
        ],
        "project_id bigint, user_id bigint, file_handle_id bigint, record_date date, stack string",
    )
    files = spark.createDataFrame([(100, 2**30), (101, None)], "id bigint, content_size bigint")
    return nodes, events, files


def test_daily_leaderboard(usage):
    nodes, events, files = usage
    out = leaderboards.leaderboard(nodes, events, files, leaderboards.Day("2024-06-30"), 1)
    assert [tuple(r) for r in out.collect()] == [("syn2", "Two", 3, 2 * 2**30, 2), ("syn3", "Three", 1, 2**30, 1)]


def test_trailing_and_all_time(usage):
    nodes, events, files = usage
    month = leaderboards.leaderboard(nodes, events, files, leaderboards.Trailing("2024-06-30"), 1)
    assert {r["project"]: r["downloads_per_project"] for r in month.collect()} == {"syn2": 3, "syn3": 2}
    ever = leaderboards.leaderboard(nodes, events, files, leaderboards.AllTime(), 1)
    assert {r["project"]: r["downloads_per_project"] for r in ever.collect()} == {"syn2": 4, "syn3": 2}


def test_group_message_and_snapshot(usage):
    nodes, events, files = usage
    window = leaderboards.Day("2024-06-30")
    groups = [(90, "Group A")]
    grouped = leaderboards.group_leaderboard(nodes, events, files, groups, window)
    assert rows(grouped) == [("syn90", "Group A", 2, 2, 4, 3 * 2**30, 3)]
    public = leaderboards.leaderboard(nodes, events, files, window, 1)
    combined = leaderboards.combined_leaderboard(public, grouped)
    assert [r["project"] for r in combined.collect()] == ["syn90", "syn2", "syn3"]
    text = leaderboards.top_message(combined, 24, "2024-06-30", URL).first()["message"]
    assert text.splitlines()[2] == (
        "1. <https://x/syn90|Group A> - 4 downloads, 3 unique users, 3.000 GiB egressed (2/2 projects with downloads)"
    )
    assert text.splitlines()[4].startswith("2. <https://x/syn2|Two> - 3 downloads, 2 unique users, 2.000 GiB")
    snapshot = leaderboards.public_snapshot(combined, groups, 24, "2024-06-30")
    assert [(r["project"], r["record_date"]) for r in snapshot.orderBy("project").collect()] == [
        ("syn2", date(2024, 6, 29)), ("syn3", date(2024, 6, 29))
    ]


def test_trending_leaves_out_projects_without_files(usage):
    nodes, events, files = usage
    out = platform.trending_month(nodes, events, files, "2024-06-10", exclude_id=1)
    assert [tuple(r) for r in out.collect()] == [(2, 2, "2024-06-29", 1.0)]


def test_hosted_files_are_distinct(usage, spark):
    nodes, _, files = usage
    links = spark.createDataFrame([(100, "TableEntity"), (101, "FileEntity")], "filehandleid bigint, associatetype string")
    assert rows(platform.hosted_files(nodes.filter("id != 21"), files, links)) == [(100, 2**30)]


def test_hot_project_counts_are_exact(spark):
    """One project holds nine tenths of the events."""
    nodes = spark.range(5).select(
        F.col("id"), F.col("id").alias("project_id"), F.concat(F.lit("P"), "id").alias("name"),
        F.lit("project").alias("node_type"), F.lit(True).alias("is_public"),
    )
    events = spark.range(20000).select(
        F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id") % 5).cast("bigint").alias("project_id"),
        (F.col("id") % 977).alias("user_id"), (F.col("id") % 101).alias("file_handle_id"),
        F.lit(date(2024, 6, 29)).alias("record_date"),
    )
    files = spark.range(101).select("id", F.lit(3).cast("bigint").alias("content_size"))
    out = leaderboards.leaderboard(nodes, events, files, leaderboards.Day("2024-06-30"))
    hot = out.filter("project = 'syn0'").first()
    mine = [i for i in range(20000) if i % 10 < 9 or i % 5 == 0]
    assert hot["downloads_per_project"] == len(mine)
    assert hot["number_of_unique_users_downloaded"] == len({i % 977 for i in mine})
    assert hot["data_download_size"] == 3 * len(mine)


# -- tracking ----------------------------------------------------------------


@pytest.fixture(scope="module")
def layout():
    return tracking.Layout(cohorts=["CRC", "CRC2"], named_cohorts=["CRC2"], projects=["AKT1"])


def test_tracking_table(spark, layout):
    main = spark.createDataFrame(
        [("S1", "P1", "2_0_PUBLIC", 2, 0), ("S2", "P2", "1_9_PUBLIC", 1, 9), (None, "P3", "2_0_PUBLIC", 2, 0)],
        "SAMPLE_ID string, PATIENT_ID string, RELEASE string, MAJOR_VERSION int, MINOR_VERSION int",
    )
    cohorts = spark.createDataFrame(
        [("S1", "P1", "CRC", "1_2_PUBLIC", 1, 2), ("S5", "P5", "CRC", "1_1_PUBLIC", 1, 1), ("S2", "P2", "CRC2", "1_1_PUBLIC", 1, 1)],
        "CPT string, RECORD_ID string, COHORT string, RELEASE string, MAJOR_VERSION int, MINOR_VERSION int",
    )
    akt = spark.createDataFrame([("S2", "P2"), ("S2", "P2"), ("S9", None)], "SAMPLE_ID string, PID string")
    pairs = tracking.all_pairs(
        main, cohorts, {"AKT1": tracking.Project(akt, patient_key="PID")}, layout, "CPT", "RECORD_ID"
    )
    table = tracking.tracking_table(pairs, layout)
    assert table.columns == [
        "SAMPLE_ID", "PATIENT_ID", "IN_LATEST_MAIN", "IN_AKT1_PROJECT", "IN_COHORT_CRC_RELEASE",
        "IN_COHORT_CRC2_RELEASE", "MAIN_RELEASE", "COHORT_CRC2_RELEASE",
    ]
    assert rows(table) == [
        ("S1", "P1", True, False, True, False, "2_0_PUBLIC", None),
        ("S2", "P2", False, True, False, True, None, "1_1_PUBLIC"),
    ]
    assert tracking.tracking_checks(table, layout).count() == 0
    flags = {(r["SAMPLE_ID"], r["RELEASE_PROJECT_TYPE"]): r["IN_LATEST_RELEASE"] for r in tracking.membership_pairs(pairs, layout).collect()}
    assert flags == {("S1", "MAIN"): "Yes", ("S1", "COHORT_CRC"): "Yes", ("S2", "COHORT_CRC2"): "No", ("S2", "SP_AKT1"): "No"}


def test_publishing_needs_a_sound_table(spark, layout, tmp_path):
    bad = spark.createDataFrame([("S", "P"), ("S", "P")], "SAMPLE_ID string, PATIENT_ID string")
    with pytest.raises(quality.QualityError, match="duplicate SAMPLE_ID,PATIENT_ID"):
        tracking.publish(bad, layout, str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


# -- entities and runs -------------------------------------------------------


def test_recent_entities_and_lines(spark):
    nodes = spark.createDataFrame(
        [
            (1, "A", 1, "project", "{}", datetime(2024, 6, 29), 5, True),
            (2, "B", 1, "file", '{"annotations":{"contentType":{"value":["dataset"]}}}', datetime(2024, 6, 28), 6, True),
            (3, "C", 1, "file", "{}", datetime(2024, 6, 28), 6, True),
            (4, "D", 1, "dataset", "{}", datetime(2024, 6, 1), 6, False),
        ],
        "id bigint, name string, project_id bigint, node_type string, annotations string, created_on timestamp, created_by bigint, is_public boolean",
    ).withColumn("annotations", F.parse_json("annotations"))
    users = spark.createDataFrame([(5, "ada", "Ada", "L")], "id bigint, user_name string, first_name string, last_name string")
    out = platform.recent_entities(nodes, users, "2024-06-30")
    assert [(r["id"], r["content_type"], r["user_name_full_name"]) for r in out.collect()] == [(2, "dataset", None), (1, None, "Ada L")]
    lines = {(r["section"], r["rank"]): r["line"] for r in platform.recent_lines(out, URL, "https://p/").collect()}
    assert lines[("Private datasets", 0)] == "Nothing to be found."
    assert lines[("Public datasets", 2)] == (
        "2. <https://x/syn1|*A*> (Type: project, Created on: 2024-06-29, Created by: <https://p/5/profile|Ada L>, Public: True)"
    )
    assert platform.public_recent(out).columns == ["id", "node_type", "created_on", "created_by"]


def test_run_reports(spark):
    asof = datetime(2024, 3, 31)
    data = [
        (1, 7, "wf", "SUCCEEDED", "u1", datetime(2024, 3, 30), asof), (2, 7, "wf", "FAILED", "u2", datetime(2024, 3, 29), asof),
        (3, 8, "other", "SUCCEEDED", "u1", datetime(2024, 2, 1), asof), (4, 7, "wf", "RUNNING", "u3", datetime(2024, 3, 28), None),
        (5, 7, "wf", "SUCCEEDED", "u9", datetime(2022, 3, 28), asof),
    ]
    table = spark.createDataFrame(
        data, "id int, workspace_id int, project_name string, status string, user_name string, date_created timestamp, complete timestamp"
    )
    spaces = spark.createDataFrame([(7, "lab"), (8, "lab")], "id int, full_name string")
    users = spark.createDataFrame([("u1",), ("u2",)], "user_name string")
    out = runs.run_reports(table, spaces, users, asof)
    assert rows(out["total_workflows_per_workspace_past_week"]) == [("lab", 3)]
    assert rows(out["workflow_distribution_past_week"]) == [("lab", "wf", 3, 100.0)]
    assert rows(out["avg_workflows_run_per_month"]) == [(2.0,)]
    assert rows(out["run_status_breakdown_past_year"]) == [("FAILED", 1, 33.33), ("SUCCEEDED", 2, 66.67)]
    assert rows(out["workflow_breakdown_past_month"]) == [("wf", 2, 100.0)]
    assert rows(out["total_users"]) == [(2,)]
    assert rows(out["active_users_past_month"]) == [(3,)]


def test_reports_from_one_pass_are_those_of_single_queries(spark):
    pick = random.Random(3)
    asof = datetime(2024, 3, 31, 12)
    data = []
    for k in range(500):
        when = asof - timedelta(hours=pick.choice([0, 1, 24 * 7, 24 * 7 + 1, *range(0, 24 * 400, 5)]))
        done = pick.choice([None, asof])
        data.append((k, pick.randrange(5), pick.choice(["wf", "other", None]), pick.choice("SFR"), pick.choice(["u1", "u2", None]), when, done))
    table = spark.createDataFrame(
        data, "id int, workspace_id int, project_name string, status string, user_name string, date_created timestamp, complete timestamp"
    )
    spaces = spark.createDataFrame([(0, "lab"), (1, "lab"), (2, "x"), (3, "y")], "id int, full_name string")
    users = spark.createDataFrame([("u1",), ("u2",)], "user_name string")
    apart = runs.run_reports(table, spaces, users, asof)
    cube = runs.run_cube(table, asof)
    for name, report in runs.reports_from_cube(cube, spaces, users).items():
        assert rows(report) == rows(apart[name]), name
        assert report.columns == apart[name].columns
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("Expand") == 1 and "SortAggregate" not in plan
    none = runs.reports_from_cube(runs.run_cube(table.limit(0), asof), spaces, users)
    assert rows(none["active_users_past_month"]) == [(0,)] and rows(none["run_status_breakdown_past_year"]) == []


def test_failure_attribution(spark):
    tasks = spark.createDataFrame(
        [(1, "t", "FAILED", "No input"), (2, "t", "COMPLETED", "No input"), (3, "t", "FAILED", "??")],
        "task_id int, tag string, status string, execution_log string",
    )
    assert rows(runs.failure_reasons(tasks, ["No input"])) == [(1, "t", "No input"), (3, "t", "Failure Reason Undetermined")]


# -- catalogue ---------------------------------------------------------------


def catalogue_fixture(spark):
    datasets = spark.createDataFrame(
        [("syn1", 2, "syn9", "Set one", None, "2024-01-01", {"license": ["CC"], "title": ["T", "U"], "keywords": ["a", "b"]}),
         ("syn2", 1, "syn9", "Empty", "d", "2024-01-01", {})],
        "dataset_id string, dataset_version int, dataset_collection string, name string, description string, modified_on string, annotations map<string,array<string>>",
    )
    items = spark.createDataFrame(
        [("syn1", 2, "syn9", "syn30", 1), ("syn1", 2, "syn9", "syn4", 2), ("syn1", 2, "syn9", "syn5", 1), ("syn2", 1, "syn9", "syn99", 1)],
        "dataset_id string, dataset_version int, dataset_collection string, file_id string, file_version int",
    )
    entities = spark.createDataFrame(
        [("syn30", 1, "a \"quoted\".csv", "desc", None, {"beta": "1", "Alpha": "2"}), ("syn4", 2, "b", None, "b.json.gz", {"gamma": "x"}),
         ("syn5", 1, "c", "", "c.odd", {"beta": "y"})],
        "file_id string, file_version int, name string, description string, file_name string, annotations map<string,string>",
    )
    nodes = spark.createDataFrame(
        [(30, True, [(1, "m1", 300), (2, "m2", 301)]), (4, True, [(2, "m4", 400)]), (5, False, [(1, "m5", 500)])],
        "id bigint, is_public boolean, version_history array<struct<versionNumber:int,contentMd5:string,fileHandleId:bigint>>",
    )
    files = spark.createDataFrame([(300, "text/x"), (400, "NOT_SET")], "id bigint, content_type string")
    return datasets, items, entities, nodes, files


def test_documents_are_valid_json(spark, tmp_path):
    lines = documents.dataset_documents(*catalogue_fixture(spark), URL)
    path = tmp_path / "docs"
    file_sinks.write_documents(lines, str(path))
    stored = file_sinks.read_documents(spark, str(path)).orderBy("object_key", "place").collect()
    assert len({r["object_key"] for r in stored}) == 1  # a data set without files has no document
    doc = json.loads("".join(r["line"] for r in stored))
    assert doc["@id"] == "syn1.2" and doc["description"] == "Dataset for Set one"
    assert doc["title"] == "T" and doc["keywords"] == ["a", "b"] and "studyId" not in doc
    assert doc["@context"]["data"] == {"@id": "cr:data", "@type": "@json"}
    assert [d["@id"] for d in doc["distribution"]] == ["metadata", "syn30.1", "syn4.2", "syn5.1"]
    found = {d["@id"]: (d["md5"], d["encodingFormat"], d["description"]) for d in doc["distribution"]}
    assert found["syn30.1"] == ("m1", "text/x", "desc")
    assert found["syn4.2"] == ("m4", "application/json", "Data file associated with b")
    assert found["syn5.1"] == ("unknown_md5", "application/octet-stream", "Data file associated with c")
    assert [f["name"] for f in doc["recordSet"]["field"]] == ["Alpha", "beta", "gamma"]
    assert doc["recordSet"]["field"][0]["source"] == {"fileObject": {"@id": "metadata"}, "extract": {"column": "Alpha"}}


def test_minimal_documents(spark):
    rows_in = spark.createDataFrame(
        [("syn1", "N", None, None, "MIT"), (None, "gone", "d", "c", "l")],
        "id string, name string, description string, contributors string, license string",
    )
    out = documents.minimal_documents(rows_in, URL, "Owner").collect()
    assert len(out) == 1 and out[0]["object_key"] == "N_syn1.minimal_croissant.jsonld"
    assert json.loads(out[0]["document"]) == {
        "@context": "https://schema.org/", "@type": "Dataset", "name": "N", "description": "", "url": URL + "syn1",
        "identifier": "syn1", "creator": {"@type": "Organization", "name": "Owner"}, "license": "MIT",
    }


def test_document_links_are_quoted(spark):
    datasets = catalogue_fixture(spark)[0]
    urls = [r["object_url"] for r in documents.document_links(datasets, "https://o/").collect()]
    assert "https://o/Set+one_syn1.2_datasetCollection_syn9_croissant.jsonld" in urls


def test_stale_objects(spark):
    keys = [
        "A_syn1.1_datasetCollection_syn9_c.jsonld", "A_syn1.2_datasetCollection_syn9_c.jsonld",
        "B_syn1.2_datasetCollection_syn9_c.jsonld", "A_syn1.1_datasetCollection_syn8_c.jsonld", "readme.md",
    ]
    listing = spark.createDataFrame([(k,) for k in keys], "key string")
    now = spark.createDataFrame(
        [("syn1", 2, "syn9", "A")], "dataset_id string, dataset_version int, dataset_collection string, dataset_name string"
    )
    assert [r[0] for r in rows(catalog.stale_objects(listing, now, ["syn9"]))] == [keys[0], keys[2]]
    minimal = spark.createDataFrame(
        [("A_b_syn1.minimal_croissant.jsonld",), ("A_syn2.minimal_croissant.jsonld",), ("x.minimal_croissant.jsonld",), ("o.json",)],
        "key string",
    )
    current = spark.createDataFrame([("A_b", "syn1")], "dataset_name string, dataset_id string")
    assert rows(catalog.stale_minimal_objects(minimal, current)) == [("A_syn2.minimal_croissant.jsonld",)]


def test_intake(spark):
    items = spark.createDataFrame(
        [(0, "k0", "t", "d" * 1500), (1, "k1", "t", "d"), (2, "k2", "t", "d"), (3, "k3", "u", "d"), (4, "k4", "v", "d"), (5, None, "w", "d")],
        "i int, k string, t string, d string",
    )
    existing = spark.createDataFrame([("k2",)], "sameAs string")
    ignored = spark.createDataFrame([("k3",), ("k1",)], "id string")
    mapping = {"sameAs": F.col("k"), "title": F.col("t"), "description": F.col("d")}
    status, errors = catalog.catalogue_intake(
        items, existing, ignored, mapping, {"has key": F.col("sameAs").isNotNull()}, "i"
    )
    assert {r["sameAs"]: r["status"] for r in status.collect()} == {
        "k0": "duplicate", "k1": "duplicate", "k2": "existing", "k3": "ignored", "k4": "new"
    }
    assert rows(errors.select("item_index", "error")) == [(5, "has key")]
    assert {r["sameAs"] for r in catalog.accepted(status).collect()} == {"k2", "k4"}
    assert catalog.duplicates(status).count() == 2
    extra = [f for f in ("creator", "keywords", "subject", "collection", "publisher", "species", "url")]
    wide = catalog.duplicates(status).withColumns({f: F.lit(None).cast("string") for f in extra})
    lines = [r["line"] for r in catalog.review_lines(wide).orderBy("rank").collect()]
    assert lines[0].startswith("1. Identifier: k0, title: t, creator: None")


def test_gene_matrix(spark):
    expression = spark.createDataFrame(
        [("f1", "a|b|c|d|e|G1", 1.0), ("f1", "a|b|c|d|e|G1|x", 4.0), ("f2", "a|b|c|d|e|G2", 2.0), ("f2", "short", 9.0), ("f3", "a|b|c|d|e|G9", 9.0)],
        "file_id string, target_id string, tpm double",
    )
    mapping = spark.createDataFrame([("f1", "s1"), ("f2", "s2")], "file_id string, specimen string")
    out = matrix.gene_matrix(expression, mapping)
    assert out.columns == ["Hugo", "s1", "s2"]
    assert rows(out) == [("G1", 4.0, None), ("G2", None, 2.0)]


def test_submission_intake(spark):
    queue = spark.createDataFrame([("a", "RECEIVED"), ("b", "RECEIVED"), ("c", "OTHER"), ("d", "RECEIVED")], "submission_id string, status string")
    history = spark.createDataFrame(
        [("r1", "success", datetime(2024, 1, 1)), ("r2", "running", datetime(2024, 1, 2)), ("r3", "failed", datetime(2024, 1, 3))],
        "run_id string, state string, start_date timestamp",
    )
    taken = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", "d")], "run_id string, submission_id string")
    assert {r["submission_id"] for r in intake.submission_intake(queue, history, taken).collect()} == {"d"}
    assert {r["submission_id"] for r in intake.submission_intake(queue, history, taken, n=1).collect()} == {"a", "d"}
    assert {r["submission_id"] for r in intake.submission_intake(queue, history, taken, n=0).collect()} == {"a", "b", "d"}
    with pytest.raises(TypeError):
        intake.in_progress(spark.createDataFrame([(1.5,)], "submission_id double"))
