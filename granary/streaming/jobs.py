"""Streams: usage counts, new submissions, queue messages, status changes.

Sinks are folders or ``foreachBatch`` writers keyed by the batch id, so a batch
that is run again after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from granary.functions import messages
from granary.operators import filters, ranking
from granary.plans.intake import IN_PROGRESS, RECEIVED
from granary.session import is_directory, literal_table
from granary.sinks.tables import stored_or_empty

_MARKS = "high long, counted long, late long, batch_id long"


def stream_folder(
    spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Stream a folder; for a single file, stream its folder restricted to that file."""
    reader = spark.readStream.format(format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_directory(spark, path):
        return reader.load(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).load(folder)


def new_submissions(stream: DataFrame, delay: str, key: str = "submission_id", ts: str = "ts") -> DataFrame:
    """Received submissions, each id once within the delay."""
    received = filters.by_value(stream, "status", RECEIVED)
    return received.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def usage(
    stream: DataFrame, length: str, slide: str | None = None, watermark: str = "1 day",
    ts: str = "ts", user: str = "user_id", keys: Sequence[str] = (),
) -> DataFrame:
    """Events per (window, user), tumbling or sliding.

    The state is keyed by user as well, so that one busy window is spread over
    all tasks; ``usage_report`` folds it into exact unique users.
    """
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (
        stream.withWatermark(ts, watermark)
        .groupBy(span.alias("window"), *keys, user)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def usage_report(counts: DataFrame, keys: Sequence[str] = (), user: str = "user_id") -> DataFrame:
    """Events and exact unique users per window from per-user counts."""
    return counts.groupBy("window", *keys).agg(
        F.sum("n").alias("events"), F.countDistinct(user).alias("unique_users")
    )


def sliding_report(daily: DataFrame, days: int, user: str = "user_id", keys: Sequence[str] = ()) -> DataFrame:
    """Events and exact unique users of the ``days`` days up to each day, from daily per-user counts.

    A sweep: a user's days each cover the ``days`` days from them on.  Where a covered stretch begins the number of
    users rises by one, after its end it falls by one; events rise by a day's count and fall when it leaves the
    range.  So a user-day gives two changes, which combine per day before they are shuffled, and a running sum
    over days does the rest.  Days without any event in their range have no row; a missing user counts no one.
    """
    first = F.to_date("window.start")
    seen = daily.select(*keys, first.alias("first"), F.col(user).alias("_user"), "n")
    own = Window.partitionBy(*keys, "_user").orderBy("first")
    after, before = F.lead("first").over(own), F.lag("first").over(own)
    here = F.col("_user").isNotNull()
    stretches = seen.select(
        *keys, "first", "n",
        (here & (before.isNull() | (F.date_add(before, days) < F.col("first")))).cast("long").alias("rises"),
        (here & (after.isNull() | (F.date_add("first", days) < after))).cast("long").alias("falls"),
    )
    changes = stretches.select(
        *keys,
        F.inline(F.array(
            F.struct(F.col("first").alias("day"), F.col("n").alias("events"), F.col("rises").alias("users")),
            F.struct(F.date_add("first", days).alias("day"), (-F.col("n")).alias("events"), (-F.col("falls")).alias("users")),
        )),
    )
    daily_changes = changes.groupBy(*keys, "day").agg(F.sum("events").alias("events"), F.sum("users").alias("users"))
    # one row per calendar day (and key) from here on
    order = Window.partitionBy(*keys).orderBy("day")
    running = daily_changes.select(
        *keys, "day", F.lead("day").over(order).alias("until"),
        F.sum("events").over(order).alias("events"), F.sum("users").over(order).alias("unique_users"),
    )
    held = running.filter("events > 0").withColumn("day", F.explode(F.sequence("day", F.date_sub("until", 1))))
    return held.select("day", *keys, "events", "unique_users")


def approx_usage(
    stream: DataFrame, length: str, slide: str | None = None, watermark: str = "1 day",
    ts: str = "ts", user: str = "user_id", keys: Sequence[str] = (),
) -> DataFrame:
    """Events and approximate unique users per window with one small state row per window."""
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (
        stream.withWatermark(ts, watermark)
        .groupBy(span.alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("events"), F.approx_count_distinct(user).alias("unique_users"))
    )


def batch_log(path: str, column: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that stores each batch in its own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn(column, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(path)
        )

    return write


def take_on(path: str, runs: int = 6, key: str = "submission_id") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that takes on received submissions, each batch being a run.

    An id that one of the last ``runs`` batches has taken on is left out; after that it may come again.  The table of
    taken ids, one partition per batch, is all the memory there is: a batch that is repeated compares with the
    batches before it only, so it writes what it wrote.  Ids in the batch are made distinct, missing ones are dropped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ids = filters.by_value(batch, "status", RECEIVED).select(key).dropna().distinct()
        taken = stored_or_empty(batch.sparkSession, path, f"{key} {dict(batch.dtypes)[key]}, batch_id long")
        recent = taken.filter(F.col("batch_id").between(batch_id - runs, batch_id - 1))
        batch_log(path)(ids.join(recent, key, "left_anti"), batch_id)

    return write


def usage_with_late(
    path: str, length: str, delay: str, ts: str = "ts", user: str = "user_id", keys: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that counts events per (window, user) and keeps the late ones apart.

    An event is late if it lies more than ``delay`` before the latest event of the batches before; events without a
    time are put with them.  Below ``path``, ``counts`` holds each batch's counts, which add up, ``late`` the whole late
    events and ``marks`` one row per batch: the latest time and how many events were counted and late.  The mark is
    written last.  A repeated batch looks at the marks before it and replaces its own output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = stored_or_empty(spark, f"{path}/marks", _MARKS)
        high = marks.filter(F.col("batch_id") < batch_id).agg(F.max("high")).scalar()
        limit = F.timestamp_micros(high) - F.expr(f"INTERVAL {delay}")
        tagged = batch.withColumn("_late", F.col(ts).isNull() | F.coalesce(F.col(ts) < limit, F.lit(False)))
        seen = Observation()
        counted = tagged.observe(
            seen, F.max(F.unix_micros(ts)).alias("high"), F.count_if(~F.col("_late")).alias("counted"),
            F.count_if("_late").alias("late"),
        ).filter(~F.col("_late"))
        counts = counted.groupBy(F.window(ts, length).alias("window"), *keys, user).agg(F.count(F.lit(1)).alias("n"))
        batch_log(f"{path}/counts")(counts, batch_id)
        found = seen.get
        if found["late"]:
            batch_log(f"{path}/late")(tagged.filter("_late").drop("_late"), batch_id)
        mark = [(found["high"], found["counted"], found["late"])]
        batch_log(f"{path}/marks")(literal_table(spark, mark, "high long, counted long, late long"), batch_id)

    return write


def latest_of_log(log: DataFrame, keys: Sequence[str], column: str = "batch_id") -> DataFrame:
    """Current state of an update log: the row of the latest batch per key."""
    return ranking.arg_max(log, keys, column).drop(column)


def run_available(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process what is there and stop; the checkpoint remembers how far it got."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def message_lines(stream: DataFrame, entity_url: str, body: str = "Body") -> DataFrame:
    """Queue messages as (id, body text); the checkpoint takes the place of deleting them."""
    parsed = stream.withColumn("message", F.from_json(body, "objectId string"))
    return parsed.select(
        F.col("MessageId").alias("id"),
        messages.created_message(F.col("message.objectId"), entity_url).alias("body"),
    )


def status_transitions(
    stream: DataFrame, from_status: str = RECEIVED, to_status: str = IN_PROGRESS,
    key: str = "submission_id",
) -> DataFrame:
    """Status rows for everything that leaves ``from_status``."""
    kind = dict(stream.dtypes)[key]
    if kind not in ("string", "int", "bigint"):
        raise TypeError(f"{key} must be text or a whole number, not {kind}")
    return filters.by_value(stream, "status", from_status).withColumn("status", F.lit(to_status))


def current_status(history: DataFrame, key: str = "submission_id", ts: str = "ts") -> DataFrame:
    """Latest status per id from the status history; entries without a time play no part."""
    return ranking.arg_max(history.select(key, ts, "status"), [key], ts).select(key, "status")
