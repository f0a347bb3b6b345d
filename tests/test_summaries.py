import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from granary.plans import summaries
from granary.session import scratch_path

EVENTS = "project_id long, file_handle_id long, user_id long, record_date timestamp"
FIRST, LAST = date(2024, 1, 1), date(2024, 4, 30)


def made(seed, n, first=FIRST, last=LAST):
    pick = random.Random(seed)
    days = (last - first).days + 1
    out = []
    for _ in range(n):
        day = first + timedelta(days=pick.randrange(days))
        out.append((pick.randrange(4), pick.randrange(12), pick.choice([-70, -1, 0, 5, 63, 64, 900, 2**40, None, *range(100, 160)]),
                    datetime(day.year, day.month, day.day, pick.randrange(24))))
    return out


def frames(spark, events):
    return spark.createDataFrame(events, EVENTS), spark.createDataFrame([(k, 10 + k) for k in range(10)], "id long, content_size long")


def brute(events, first, last):
    out = {}
    for project, file, user, ts in events:
        if file < 10 and first <= ts.date() <= last:
            users, n, size = out.get(project, (set(), 0, 0))
            out[project] = (users | ({user} - {None}), n + 1, size + 10 + file)
    return {p: (n, size, len(users)) for p, (users, n, size) in out.items()}


def stored(spark, store, first, last):
    rows = summaries.totals(store.rows(spark, first, last), ["project_id"]).collect()
    return {r["project_id"]: tuple(r)[1:] for r in rows}


def test_any_window_is_a_merge(spark):
    events = made(1, 1500)
    frame, files = frames(spark, events)
    store = summaries.UsageStore(scratch_path(spark, "store"), daily_from=date(2024, 2, 1))
    store.put(frame, files, FIRST, LAST)
    for first, last in [(FIRST, LAST), (date(2024, 2, 3), date(2024, 2, 3)), (date(2024, 2, 20), date(2024, 4, 9)), (FIRST, date(2024, 3, 1)),
                        (date(2024, 2, 1), date(2024, 3, 31)), (date(2024, 2, 5), date(2024, 2, 8))]:
        assert stored(spark, store, first, last) == brute(events, first, last)
    with pytest.raises(ValueError):
        store.rows(spark, date(2024, 1, 2), LAST)


def test_a_day_put_again_replaces_itself(spark):
    events = made(2, 600)
    frame, files = frames(spark, events)
    store = summaries.UsageStore(scratch_path(spark, "store"))
    store.put(frame, files, FIRST, LAST)
    low, high = date(2024, 2, 10), date(2024, 3, 5)
    kept = [e for e in events if not low <= e[3].date() <= high]
    late = [e for e in made(3, 90, low, high) if e[3].date() != date(2024, 2, 12)]
    again, _ = frames(spark, kept + late)
    for _ in range(2):
        store.put(again, files, low, high)
        for first, last in [(FIRST, LAST), (date(2024, 2, 11), date(2024, 2, 13)), (date(2024, 2, 1), date(2024, 2, 29))]:
            assert stored(spark, store, first, last) == brute(kept + late, first, last)
    # a day that has lost all its events is empty, not as it was
    assert stored(spark, store, date(2024, 2, 12), date(2024, 2, 12)) == {}


def test_days_kept_by_month_are_stored_by_whole_months(spark):
    frame, files = frames(spark, made(4, 20))
    store = summaries.UsageStore(scratch_path(spark, "store"), daily_from=date(2024, 3, 1))
    for first, last in [(date(2024, 1, 2), LAST), (FIRST, date(2024, 1, 30))]:
        with pytest.raises(ValueError):
            store.put(frame, files, first, last)
    with pytest.raises(ValueError):
        summaries.UsageStore("x", daily_from=date(2024, 3, 2))
    assert stored(spark, store, FIRST, LAST) == {}


def test_merging_is_hash_aggregation_and_repeatable(spark):
    frame, files = frames(spark, made(5, 300))
    rows = summaries.summarize(summaries.sized_events(frame, files), F.col("record_date").cast("date"), "day")
    once = summaries.merged(rows, ["project_id"])
    twice = summaries.merged(summaries.merged(rows, ["project_id", "day"]), ["project_id"])
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))
    plan = summaries.totals(rows, ["project_id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_estimates_from_united_sketches(spark):
    users = spark.range(40_000).select(
        (F.col("id") % 2).alias("project_id"), F.lit(1).cast("long").alias("file_handle_id"), F.col("id").alias("user_id"),
        F.timestamp_seconds(F.lit(1_704_100_000) + F.col("id") % 30 * 86400).alias("record_date"),
    )
    _, files = frames(spark, [])
    rows = summaries.summarize(summaries.sized_events(users, files), F.col("record_date").cast("date"), "day")
    near = summaries.estimated_users(summaries.sketches(rows, ["project_id", "day"]), ["project_id"]).collect()
    errors = [abs(r["estimated_users"] - 20_000) / 20_000 for r in near]
    assert len(errors) == 2 and max(errors) < 0.04
    few = summaries.estimated_users(summaries.sketches(rows.filter("word < 2"), ["project_id"]), ["project_id"]).collect()
    assert [r["estimated_users"] for r in few] == [64, 64]


def test_cover_takes_whole_months_and_the_days_at_the_ends():
    d = date
    assert summaries.cover(d(2024, 1, 31), d(2024, 4, 1)) == ([d(2024, 2, 1), d(2024, 3, 1)], [(d(2024, 1, 31), d(2024, 1, 31)), (d(2024, 4, 1), d(2024, 4, 1))])
    assert summaries.cover(d(2024, 2, 1), d(2024, 2, 29)) == ([d(2024, 2, 1)], [])
    assert summaries.cover(d(2024, 2, 2), d(2024, 2, 28)) == ([], [(d(2024, 2, 2), d(2024, 2, 28))])
    assert summaries.cover(d(2024, 2, 2), d(2024, 2, 1)) == ([], [])
