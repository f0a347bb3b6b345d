import random
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from granary.operators import aggregates, filters, joins, quality, ranking
from granary.session import cut_lineage, literal_table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def days(spark, *values):
    return spark.createDataFrame([(date.fromisoformat(v),) for v in values], "d date")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- filters -----------------------------------------------------------------


def test_month_ranges(spark):
    df = days(spark, "2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01")
    assert [r[0].day for r in filters.in_month(df, "d", "2024-02-10").collect()] == [1, 29]
    assert filters.up_to_month(df, "d", "2024-02-10").count() == 3


def test_trailing_window_is_half_open(spark):
    df = days(spark, "2024-05-31", "2024-06-01", "2024-06-30", "2024-07-01")
    assert [r[0] for r in filters.trailing_days(df, "d", 30, "2024-06-30").collect()] == [
        date(2024, 6, 1), date(2024, 6, 30),
    ]


@pytest.mark.parametrize("hours, found", [(24, 1), (48, 1), (30, 0)])
def test_lookback_day(spark, hours, found):
    df = days(spark, "2024-06-28", "2024-06-29")
    assert filters.on_lookback_day(df, "d", hours, "2024-06-30").count() == found


def test_day_filters_take_times_inside_the_day(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, timestamp'2024-05-31 23:00:00'), (2, timestamp'2024-06-01 00:00:00'),
        (3, timestamp'2024-06-30 13:00:00'), (4, timestamp'2024-07-01 00:00:00') AS t(id, ts)""")
    assert sorted(r[0] for r in filters.trailing_days(df, "ts", 30, "2024-06-30").collect()) == [2, 3]
    assert [r[0] for r in filters.on_lookback_day(df, "ts", 24, "2024-07-01").collect()] == [3]
    assert filters.on_lookback_day(df, "ts", 11, "2024-07-01").count() == 0


@pytest.mark.parametrize("asof, first", [
    ("2024-06-10", date(2024, 6, 3)),
    (datetime(2024, 6, 10, 12), date(2024, 6, 4)),
])
def test_created_since_compares_dates(spark, asof, first):
    df = days(spark, "2024-06-02", "2024-06-03", "2024-06-04", "2024-06-05")
    assert min(r[0] for r in filters.created_since(df, "d", 7, asof).collect()) == first


def test_time_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(10).select(F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("ts")).write.parquet(path)
    df = spark.read.parquet(path)
    for filtered in (
        filters.in_month(df, "ts", "1970-01-05"), filters.trailing_days(df, "ts", 3, "1970-01-05"),
        filters.on_lookback_day(df, "ts", 24, "1970-01-05"), filters.created_since(df, "ts", 3, "1970-01-05"),
    ):
        text = plan(filtered)
        assert "PushedFilters" in text
        assert any(op in text for op in ("GreaterThan", "EqualTo"))


def test_columns_are_standardised(spark):
    df = spark.createDataFrame([(1, 2, 3)], "grant int, group int, Name int")
    assert filters.standardize_columns(df).columns == ["GRANTS", "GROUPS", "NAME"]
    with pytest.raises(ValueError):
        filters.standardize_columns(spark.createDataFrame([(1, 2)], "`a` int, `b` int").toDF("grant", "grants"))


def test_release_metadata(spark):
    df = spark.createDataFrame([(1,)], "x int")
    out = filters.add_release_metadata(df, "2_1_PUBLIC", "PUBLIC", 2, 1, cohort="crc", source_file="f.csv")
    row = out.first().asDict()
    assert list(row)[:1] == ["x"] and df.columns == ["x"]
    assert (row["COHORT"], row["MAJOR_VERSION"], row["SOURCE_FILE"]) == ("CRC", 2, "f.csv")
    assert row["INGESTED_AT"] is not None
    assert filters.add_release_metadata(df, "crc").columns == ["x", "RELEASE", "INGESTED_AT"]


def test_drop_if_present_ignores_case(spark):
    df = spark.createDataFrame([(1, 2)], "Cohort int, x int")
    assert filters.drop_if_present(df, "cohort", "absent").columns == ["x"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert sorted(str(r[0]) for r in filters.nan_to_null(df).collect()) == ["1.0", "None"]


def test_public_projects(spark):
    df = spark.createDataFrame(
        [(1, "project", True), (2, "project", False), (3, "file", True), (4, "project", True)],
        "project_id int, node_type string, is_public boolean",
    )
    assert [r[0] for r in filters.public_projects(df, 4).collect()] == [1]


def test_pair_membership(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "id int, v int")
    pairs = spark.createDataFrame([(1, 2), (1, 2), (2, 9)], "id int, v int")
    assert rows(filters.in_pairs(df, pairs, ["id", "v"])) == [(1, 2)]


# -- joins and sets ----------------------------------------------------------


def test_membership_flag(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    keys = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(joins.membership_flag(df, keys, ["k"])) == [(1, "a", "Yes"), (2, "b", "No")]


def test_one_row_table_has_no_product(spark):
    frames = [spark.range(5).agg(F.sum("id").alias(n)) for n in ("a", "b", "c")]
    df = joins.one_row_table(*frames)
    assert rows(df) == [(10, 10, 10)]
    assert "Nested" not in plan(df) and "Cartesian" not in plan(df)
    with pytest.raises(ValueError):
        joins.one_row_table(frames[0], frames[0])


def test_anti_joins(spark):
    links = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "d string, v int")
    now = spark.createDataFrame([("a", 2)], "d string, v int")
    assert rows(joins.stale_rows(links, now, ["d", "v"])) == [("a", 1), ("b", 1)]
    assert rows(joins.new_ids(links, now.select("d"), "d")) == [("b", 1)]
    assert rows(filters.exclude_ids(links, now.select("d"), "d")) == [("b", 1)]


def test_lookup_default(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    mapping = spark.createDataFrame([(1, "x")], "k int, v string")
    assert rows(joins.lookup(df, mapping, ["k"], "none")) == [(1, "x"), (2, "none")]


def test_stack_fills_and_dedups(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1,), (1,)], "x int")
    assert ranking.stack(a, b).count() == 3
    assert ranking.stack_distinct(a, b).count() == 2


# -- aggregates --------------------------------------------------------------


def test_collapsed_and_plain_statistics_agree(spark):
    """One project holds most events; the numbers must not depend on collapsing."""
    events = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(F.lit(99)).alias("project_id"),
        (F.col("id") % 11).alias("file_handle_id"),
        (F.col("id") % 13).alias("user_id"),
        F.when(F.col("id") % 17 != 0, F.lit(date(2024, 1, 1))).alias("record_date"),
    )
    files = spark.range(10).select("id", (F.col("id") * 1000 + 1).alias("content_size"))
    sizes = files.withColumnRenamed("id", "file_handle_id")
    plain = aggregates.download_stats(events.join(sizes, "file_handle_id"), ["project_id"])
    collapsed = aggregates.download_stats(
        aggregates.collapse_downloads(events).join(sizes, "file_handle_id"), ["project_id"]
    )
    assert rows(plain) == rows(collapsed)
    hot = {r["project_id"]: r for r in plain.collect()}[99]
    expected = [i for i in range(4000) if i % 3 and i % 11 < 10]
    assert hot["downloads_per_project"] == sum(1 for i in expected if i % 17)
    assert hot["number_of_unique_users_downloaded"] == len({i % 13 for i in expected})
    assert hot["data_download_size"] == sum((i % 11) * 1000 + 1 for i in expected)


def test_group_statistics_count_shared_projects_in_every_group(spark):
    df = spark.createDataFrame(
        [("A", 1, 10, 100, 5), ("A", 2, 10, 101, 5), ("B", 1, 10, 100, 5)],
        "g string, project_id int, user_id int, file_handle_id int, content_size bigint",
    ).withColumn("record_date", F.lit(date(2024, 1, 1)))
    out = {r["g"]: r for r in aggregates.group_download_stats(df, ["g"]).collect()}
    assert (out["A"]["projects_with_downloads"], out["A"]["number_of_unique_users_downloaded"]) == (2, 1)
    assert (out["B"]["projects_with_downloads"], out["B"]["data_download_size"]) == (1, 5)


def test_approximate_switch(spark):
    df = spark.range(1000).select(
        F.lit(1).alias("project_id"), F.col("id").alias("user_id"), F.lit(1).alias("file_handle_id"),
        F.lit(date(2024, 1, 1)).alias("record_date"), F.lit(1).alias("content_size"),
    )
    n = aggregates.download_stats(df, ["project_id"], approx=True).first()["number_of_unique_users_downloaded"]
    assert abs(n - 1000) < 150


def test_shares(spark):
    df = spark.createDataFrame([("w", "a", 1), ("w", "b", 3), ("v", "a", 0)], "g string, i string, n bigint")
    within = {(r["g"], r["i"]): r["percentage"] for r in aggregates.share_within(df, "n", ["g"]).collect()}
    assert within[("w", "b")] == 75.0 and within[("v", "a")] is None
    overall = aggregates.share_within(df, "n", digits=2).collect()
    assert sorted(r["percentage"] for r in overall) == [0.0, 25.0, 75.0]


def test_membership_wide(spark):
    df = spark.createDataFrame(
        [(1, "MAIN", "r1"), (1, "SP_X", "X"), (2, "SP_X", "X"), (1, "MAIN", "r0")], "k int, kind string, name string"
    )
    out = aggregates.membership_wide(
        df, ["k"], "kind", "name", {"IN_MAIN": "MAIN", "IN_Y": "SP_Y"}, {"MAIN_RELEASE": "MAIN"}
    )
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[0]) == [
        (1, True, False, "r1"), (2, False, False, None)
    ]


def test_matrix_takes_largest_and_fills(spark):
    df = spark.createDataFrame(
        [("g1", "s1", 1.0), ("g1", "s1", 3.0), ("g2", "s2", float("nan")), ("g2", "s1", 2.0), (None, "s1", 9.0)],
        "gene string, sample string, tpm double",
    )
    out = aggregates.sample_matrix(df, "gene", "sample", "tpm")
    assert out.columns == ["gene", "s1", "s2"]
    assert rows(out) == [("g1", 3.0, None), ("g2", 2.0, None)]
    with pytest.raises(ValueError):
        aggregates.sample_matrix(df, "gene", "sample", "tpm", max_columns=1)


def test_join_annotations_is_by_key_not_position(spark):
    stored = spark.createDataFrame([("syn1", "b"), ("syn2", "a")], "id string, sameAs string")
    items = spark.createDataFrame([("a", ["x", "y"]), ("b", ["z"])], "sameAs string, words array<string>")
    assert rows(aggregates.join_annotations(stored, items, "sameAs", ["sameAs", "words"])) == [
        ("syn1", "b", "z"), ("syn2", "a", "x, y")
    ]


# -- ranking -----------------------------------------------------------------


def test_latest_versions(spark):
    df = spark.createDataFrame(
        [("a", 1, 9), ("a", 2, 0), ("b", 1, 1), ("b", None, 7), (None, 9, 9), ("a", 2, 0)],
        "c string, major int, minor int",
    )
    assert rows(ranking.latest_by(df, ["c"], ["major", "minor"])) == [("a", 2, 0), ("b", 1, 1)]
    assert rows(ranking.latest_global(df, ["major", "minor"])) == [(9, 9)]
    assert ranking.latest_global(df.limit(0), ["major", "minor"]).count() == 0


@pytest.mark.parametrize("long_keys", [False, True])
def test_all_members_of_duplicate_groups(spark, long_keys):
    df = spark.createDataFrame(
        [(1, "x"), (2, "x"), (3, "y"), (4, None), (5, None), (6, "")], "id int, t string"
    )
    assert [r[0] for r in rows(ranking.duplicate_rows(df, ["t"], long_keys).select("id"))] == [1, 2, 4, 5]


def test_arg_max_skips_nulls(spark):
    df = spark.createDataFrame([("g", 1.0, "a"), ("g", 5.0, "b"), ("g", None, "c")], "k string, v double, w string")
    assert rows(ranking.arg_max(df, ["k"], "v")) == [("g", 5.0, "b")]


def test_arg_max_settles_ties_and_sorts_no_input(spark):
    pick = random.Random(6)
    data = [(pick.choice([None, "a", "b", "c"]), pick.choice([None, 1.0, 2.0, float("nan")]) if k > 30 else 2.0, pick.choice([None, 1, 2]), pick.choice([None, "x", "y"])) for k in range(300)]
    df = spark.createDataFrame(data, "k string, v double, n int, w string").repartition(5)
    least = lambda x: (x is not None, x or 0) if not isinstance(x, str) else (True, x)
    want = {}
    for k, v, n, w in data:
        if v is not None:
            rank = (v != v, 0 if v != v else v, least(n), (w is not None, w or ""))
            if k not in want or rank > want[k][0]:
                want[k] = (rank, (k, repr(v), n, w))
    got = [(r["k"], repr(r["v"]), r["n"], r["w"]) for r in ranking.arg_max(df, ["k"], "v").collect()]
    assert sorted(got, key=repr) == sorted((row for _, row in want.values()), key=repr)
    text = plan(ranking.arg_max(df, ["k"], "v"))
    assert "SortAggregate" not in text and "WindowGroupLimit" in text
    assert ranking.arg_max(df.select("k", "v").filter("k = 'a'"), ["k"], "v").count() == 1


def test_numbering_is_complete_under_ties_and_skew(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("v"))
    out = ranking.numbered(df.repartition(7), [F.asc("v"), F.asc("id")]).collect()
    expected = sorted(range(3000), key=lambda i: (0 if i % 3 == 0 else i % 50, i))
    assert {r["rank"]: r["id"] for r in out} == {n + 1: i for n, i in enumerate(expected)}


def test_rank_desc_puts_missing_last(spark):
    df = spark.createDataFrame([(None, "a"), (1, "c"), (1, "b"), (2, "d")], "v int, k string")
    assert [r["k"] for r in ranking.rank_desc(df, "v", ["k"]).collect()] == ["d", "b", "c", "a"]


# -- quality -----------------------------------------------------------------


def test_sound_table_has_no_failures(spark):
    df = spark.createDataFrame([(1, "a", None)], "k int, IN_X_RELEASE string, X_RELEASE string")
    checks = quality.validate_table(df, ["k", "IN_X_RELEASE", "X_RELEASE"], ["k"])
    assert checks.collect() == []
    quality.require_sound(checks)


def test_all_failures_are_collected(spark):
    df = spark.createDataFrame(
        [(1, None, float("nan")), (1, "b", 1.0), (2, "c", 2.0)], "k int, IN_X_RELEASE string, v double"
    )
    checks = quality.validate_table(df, ["k", "IN_X_RELEASE", "v", "gone"], ["k", "no_such_key"])
    assert rows(checks) == [
        ("duplicate", "k", 2), ("missing_column", "gone", 1), ("null", "IN_X_RELEASE", 1), ("null", "v", 1),
    ]
    with pytest.raises(quality.QualityError, match="(?s)duplicate k.*missing_column gone.*null"):
        quality.require_sound(checks)


def test_empty_table_is_only_empty(spark):
    df = spark.createDataFrame([], "k int")
    assert rows(quality.validate_table(df, ["k"], ["k"]).select("check", "n")) == [("empty", 1)]


GOOD = '{"title":"T","date":"2024","views":1,"unique_views":1,"downloads":0,"unique_downloads":0,"link":"x","category":"report"}'


@pytest.mark.parametrize("change, errors", [
    (("", ""), []),
    (('"views":1', '"views":-1'), ["record 0 field 'views' is not a non-negative integer"]),
    (('"views":1', '"views":true'), ["record 0 field 'views' is not a non-negative integer"]),
    (('"views":1', '"views":"1"'), ["record 0 field 'views' is not a non-negative integer"]),
    (('"views":1', '"views":1.5'), ["record 0 field 'views' is not a non-negative integer"]),
    (('"views":1', '"views":null'), ["record 0 field 'views' is not a non-negative integer"]),
    (('"title":"T"', '"title":""'), ["record 0 has empty 'title'"]),
    (('"date":"2024"', '"date":null'), ["record 0 has empty 'date'"]),
    ((',"link":"x"', ""), ["record 0 has empty 'link'", "record 0 missing fields: link"]),
    ((',"category":"report"', ""), ["record 0 missing fields: category"]),
])
def test_record_faults(spark, change, errors):
    df = spark.createDataFrame([(0, GOOD.replace(*change))], "i int, j string")
    df = df.select("i", F.parse_json("j").alias("r"))
    assert [e for _, e in rows(quality.validate_records(df, "r", "i"))] == errors


def test_records_must_exist_and_be_valid(spark):
    df = spark.createDataFrame([(0, GOOD)], "i int, j string").select("i", F.parse_json("j").alias("r"))
    quality.require_valid_records(df, "r", "i")
    with pytest.raises(quality.QualityError, match="zero records"):
        quality.require_valid_records(df.limit(0), "r", "i")
    bad = df.select("i", F.parse_json(F.lit('{"title":"T"}')).alias("r"))
    with pytest.raises(quality.QualityError, match="7 errors"):
        quality.require_valid_records(bad, "r", "i")


def test_rules_split_rows(spark):
    df = spark.createDataFrame([(0, 5), (1, -1), (2, None)], "i int, v int")
    valid, errors = quality.split_by_rules(df, {"positive": F.col("v") > 0, "small": F.col("v") < 9}, "i")
    assert rows(valid) == [(0, 5)]
    assert rows(errors.select("item_index", "error")) == [(1, "positive"), (2, "positive; small")]


def test_required_fields_fail_the_job(spark):
    df = spark.createDataFrame([("a", "t"), ("", "u")], "sameAs string, title string")
    assert rows(quality.missing_fields(df, ["sameAs", "title"])) == [("", "u", "sameAs")]
    with pytest.raises(PySparkException, match="Missing or empty 'sameAs'"):
        quality.require_fields(df, ["sameAs", "title"]).collect()


@pytest.mark.parametrize("n, found", [(0, "none"), (1, "one"), (2, "many"), (9, "many")])
def test_cardinality(spark, n, found):
    assert quality.cardinality(spark.range(n)) == found
    if found == "many":
        with pytest.raises(quality.QualityError):
            quality.require_one_or_none(spark.range(n))
    else:
        assert quality.require_one_or_none(spark.range(n)) == (n == 1)


@pytest.mark.parametrize("size, state", [(0, "findable"), (1001, "findable"), (10, "gone")])
def test_fetch_params(size, state):
    with pytest.raises(ValueError):
        quality.check_fetch_params(size, state)


def test_unmatched_names_the_side(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(quality.unmatched(a, b, "k")) == [(1, "stored"), (3, "update")]


# -- session -----------------------------------------------------------------


def test_literal_table_is_part_of_the_plan(spark):
    df = literal_table(spark, [(1, "a"), (2, None)], "k bigint, v string")
    assert "LocalTableScan" in plan(df) and sorted(r[0] for r in df.collect()) == [1, 2]
    assert literal_table(spark, [], "k bigint").count() == 0


def test_cut_lineage_is_reliable(spark):
    df = cut_lineage(spark.range(5).withColumn("r", F.rand()))
    assert rows(df) == rows(df)
    assert spark.sparkContext.getCheckpointDir()
