from datetime import datetime

import pytest
from pyspark.sql import functions as F

from granary.session import scratch_path
from granary.streaming import jobs

SCHEMA = "submission_id string, status string, ts timestamp, user_id bigint"


def land(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_usage_is_exact_across_batches_and_restarts(spark, tmp_path):
    source, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    day = datetime(2024, 1, 1, 5)
    land(spark, source, [("a", "x", day, 1), ("b", "x", day, 1), ("c", "x", day, 2)])

    def run():
        stream = jobs.stream_folder(spark, source, SCHEMA, files_per_batch=1)
        jobs.run_available(jobs.usage(stream, "1 day"), jobs.batch_log(log), mark, "update")
        current = jobs.latest_of_log(spark.read.parquet(log), ["window", "user_id"])
        report = jobs.usage_report(current)
        return rows(report.select(F.date_format("window.start", "yyyy-MM-dd"), "events", "unique_users"))

    assert run() == [("2024-01-01", 3, 2)]
    # users seen before are not counted again after a restart
    land(spark, source, [("d", "x", datetime(2024, 1, 1, 9), 2), ("e", "x", datetime(2024, 1, 2), 3)])
    assert run() == [("2024-01-01", 4, 2), ("2024-01-02", 1, 1)]


def test_sliding_report_from_daily_counts(spark):
    daily = spark.createDataFrame(
        [("2024-01-01", 1, 2), ("2024-01-02", 1, 1), ("2024-01-02", 2, 5)], "d string, user_id bigint, n bigint"
    ).select(F.struct(F.to_timestamp("d").alias("start")).alias("window"), "user_id", "n")
    out = jobs.sliding_report(daily, 2)
    assert rows(out.select(F.date_format("day", "dd"), "events", "unique_users")) == [("01", 2, 1), ("02", 8, 2), ("03", 6, 2)]


def test_approximate_usage(spark, tmp_path):
    source, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    land(spark, source, [("a", "x", datetime(2024, 1, 1), 1), ("b", "x", datetime(2024, 1, 1), 2)])
    stream = jobs.approx_usage(jobs.stream_folder(spark, source, SCHEMA), "1 day", "12 hours")
    jobs.run_available(stream, jobs.batch_log(log), mark, "update")
    assert {(r["events"], r["unique_users"]) for r in spark.read.parquet(log).collect()} == {(2, 2)}


def test_submissions_are_taken_once(spark, tmp_path):
    source, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    t = datetime(2024, 1, 1)
    land(spark, source, [("a", "RECEIVED", t, 1), ("a", "RECEIVED", t, 1), ("b", "OTHER", t, 1)])

    def run():
        stream = jobs.new_submissions(jobs.stream_folder(spark, source, SCHEMA), "1 day")
        jobs.run_available(stream, jobs.batch_log(log), mark)
        return rows(spark.read.parquet(log).select("submission_id"))

    assert run() == [("a",)]
    land(spark, source, [("a", "RECEIVED", t, 1), ("c", "RECEIVED", t, 1)])
    assert run() == [("a",), ("c",)]


def test_messages(spark, tmp_path):
    source, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    spark.createDataFrame([("m1", '{"objectId":"syn7"}')], "MessageId string, Body string").write.json(source)
    stream = jobs.stream_folder(spark, source, "MessageId string, Body string", format="json")
    jobs.run_available(jobs.message_lines(stream, "https://x/"), jobs.batch_log(log), mark)
    assert rows(spark.read.parquet(log).select("id", "body")) == [
        ("m1", "Entity syn7 has been created and can be viewed at https://x/syn7")
    ]


def test_status_history(spark):
    history = spark.createDataFrame(
        [("a", "RECEIVED", datetime(2024, 1, 1), 1), ("a", "DONE", datetime(2024, 1, 2), 1)], SCHEMA
    )
    moved = jobs.status_transitions(history)
    assert rows(moved.select("submission_id", "status")) == [("a", "EVALUATION_IN_PROGRESS")]
    assert rows(jobs.current_status(history)) == [("a", "DONE")]
    with pytest.raises(TypeError):
        jobs.status_transitions(history.withColumn("submission_id", F.lit(1.5)))


def test_batch_log_replaces_a_repeated_batch(spark):
    path = scratch_path(spark, "log")
    write = jobs.batch_log(path)
    write(spark.range(3), 0)
    write(spark.range(2), 1)
    write(spark.range(3), 0)
    assert spark.read.parquet(path).count() == 5


def test_sliding_report_equals_counting_every_range(spark):
    import random
    from datetime import date, timedelta

    pick = random.Random(5)
    found = {(pick.randrange(60), pick.choice([None, *range(8)]), "ab"[pick.randrange(2)]): pick.randrange(1, 5) for _ in range(150)}
    first = date(2024, 1, 1)
    daily = spark.createDataFrame(
        [((first + timedelta(days=d)).isoformat(), u, k, n) for (d, u, k), n in found.items()], "d string, user_id long, k string, n long"
    ).select(F.struct(F.to_timestamp("d").alias("start")).alias("window"), "user_id", "k", "n")
    for days in (1, 2, 7, 30):
        want = {}
        for (d, u, k), n in found.items():
            for day in range(d, d + days):
                events, users = want.get((day, k), (0, set()))
                want[day, k] = (events + n, users | ({u} - {None}))
        got = jobs.sliding_report(daily, days, keys=["k"]).collect()
        assert {((r["day"] - first).days, r["k"]): (r["events"], r["unique_users"]) for r in got} == {c: (n, len(u)) for c, (n, u) in want.items()}
    empty = jobs.sliding_report(daily.filter("n < 0"), 7)
    assert empty.columns == ["day", "events", "unique_users"] and empty.count() == 0


def test_late_events_are_kept_apart(spark, tmp_path):
    source, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    day = lambda d, h=0: datetime(2024, 1, d, h)
    batches = [
        [("a", "x", day(5), 1), ("b", "x", day(9, 3), 1), ("c", "x", None, 2)],
        [("d", "x", day(8, 2), 1), ("e", "x", day(8, 3), 7), ("f", "x", day(20), 3)],  # limit: 8th, 3 o'clock
        [("g", "x", day(18), 4), ("h", "x", day(19), 1), ("i", "x", None, 1), ("j", "x", day(1), 1)],
    ]
    write = jobs.usage_with_late(log, "1 day", "1 day")

    def run():
        jobs.run_available(jobs.stream_folder(spark, source, SCHEMA, files_per_batch=1), write, mark)
        report = jobs.usage_report(spark.read.parquet(f"{log}/counts"))
        return (rows(report.select(F.date_format("window.start", "dd"), "events", "unique_users")),
                rows(spark.read.parquet(f"{log}/late").select("submission_id")))

    land(spark, source, batches[0])
    assert run() == ([("05", 1, 1), ("09", 1, 1)], [("c",)])
    for b in batches[1:]:
        land(spark, source, b)
    want = ([("05", 1, 1), ("08", 1, 1), ("09", 1, 1), ("19", 1, 1), ("20", 1, 1)], [("c",), ("d",), ("g",), ("i",), ("j",)])
    assert run() == want
    marks = spark.read.parquet(f"{log}/marks")
    assert rows(marks.select("batch_id", "counted", "late")) == [(0, 2, 1), (1, 2, 1), (2, 1, 3)]
    # a batch that comes again sees the marks before it only, and changes nothing
    write(spark.createDataFrame(batches[1], SCHEMA), 1)
    assert run() == want


def test_runs_take_on_what_the_last_six_have_not(spark, tmp_path):
    log = str(tmp_path / "log")
    write = jobs.take_on(log)
    t = datetime(2024, 1, 1)
    batches = [[("a", "RECEIVED", t, 1), ("a", "RECEIVED", t, 1), (None, "RECEIVED", t, 1)], [("a", "RECEIVED", t, 1), ("b", "OTHER", t, 1)]]
    batches += [[("a", "RECEIVED", t, 1), (f"n{k}", "RECEIVED", t, 1)] for k in range(2, 9)]
    for k, b in enumerate(batches):
        write(spark.createDataFrame(b, SCHEMA), k)

    def taken():
        return rows(spark.read.parquet(log).select("submission_id", F.col("batch_id").cast("int")))

    want = sorted([("a", 0), ("a", 7), *[(f"n{k}", k) for k in range(2, 9)]])
    assert taken() == want
    for k in (0, 3, 7, 8):
        write(spark.createDataFrame(batches[k], SCHEMA), k)
    assert taken() == want
