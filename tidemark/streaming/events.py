"""Bounded event streams: ingest, count, route, deduplicate.

Every query runs with ``availableNow``: it works off what is there and stops.
Progress is kept in a checkpoint in the shared folder, so a query that lost
executors, or was started again, continues without doubling rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import staging_path

BATCH = "_batch"

# Files of a batch unless stated; a long backlog is worked off in batches of this size.
FILES_PER_BATCH = 1000

# Seconds between two looks at a running query's progress, far fewer than its last reports cover.
LOOK_EVERY = 0.5


@dataclass(frozen=True)
class Landing:
    """Where a stream writes and remembers its progress."""

    data: str
    checkpoint: str

    @staticmethod
    def fresh(spark: SparkSession, label: str) -> Landing:
        base = staging_path(spark, label)
        return Landing(f"{base}/data", f"{base}/checkpoint")


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    pattern: str,
    file_format: str = "json",
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """A stream over the files of a folder, oldest first, in batches of so many files."""
    reader = spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", pattern)
    return reader.option("maxFilesPerTrigger", files_per_batch).load(folder)


def topic_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType) -> DataFrame:
    """A stream over a topic from its beginning, values decoded by ``schema``."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    decoded = F.from_json(F.col("value").cast("string"), schema).alias("event")
    return raw.select(F.col("key").cast("string").alias("key"), decoded).select("key", "event.*")


def to_topic(records: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Publish (key, value) records and stop at the end of the input."""
    return _finish(
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def as_records(events: DataFrame, *, key: str = "event_type", stamp: bool = True) -> DataFrame:
    """Events as (key, JSON value) records, stamped with the time they were produced."""
    body = [F.col(c) for c in events.columns]
    if stamp:
        body.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("produced_at"))
    return events.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*body)).alias("value"))


def critical_records(events: DataFrame, condition: Column) -> DataFrame:
    """The events meeting ``condition`` as records keyed by event id, for a topic of their own (:func:`to_topic`)."""
    return as_records(events.filter(condition), key="event_id", stamp=False)


def _finish(writer) -> StreamingQuery:
    """Run to the end of the input, keeping the progress of every batch.

    The query itself remembers its last 100 reports only.
    """
    query = writer.trigger(availableNow=True).start()
    seen: dict[int, dict] = {}
    over = False
    while not over:
        over = query.awaitTermination(LOOK_EVERY)
        for p in query.recentProgress:
            known = seen.get(p["batchId"])
            if known is None or p["numInputRows"] >= known["numInputRows"]:
                seen[p["batchId"]] = p
    query.batches = list(seen.values())
    return query


def land(stream: DataFrame, landing: Landing) -> StreamingQuery:
    """Append to Parquet; the file sink commits every batch exactly once."""
    return _finish(
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", landing.data)
        .option("checkpointLocation", landing.checkpoint)
    )


def landed(spark: SparkSession, stream: DataFrame, landing: Landing) -> DataFrame:
    """What :func:`land` has written so far."""
    return spark.read.schema(stream.schema).parquet(landing.data)


def _batch_folder(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def land_updates(stream: DataFrame, landing: Landing) -> StreamingQuery:
    """Keep the changed rows of every batch, in a folder per batch.

    A replayed batch replaces its own folder.
    """
    path = landing.data
    return _finish(
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", landing.checkpoint)
        .foreachBatch(lambda df, batch: _batch_folder(df, path, batch))
    )


def latest(spark: SparkSession, stream: DataFrame, landing: Landing, keys: list[str]) -> DataFrame:
    """The newest row per key of what :func:`land_updates` wrote."""
    schema = T.StructType([*stream.schema.fields, T.StructField(BATCH, T.IntegerType())])
    updates = spark.read.schema(schema).parquet(landing.data)
    rest = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col(BATCH)).alias("_newest")
    return updates.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def counts_by_type(events: DataFrame, key: str = "event_type") -> DataFrame:
    """Running count per event type; one small partial count per task and batch is shuffled."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))


def is_critical(severity: Column) -> Column:
    return (F.col("event_type") == "escalation_raised") & (severity == "Critical")


def route(
    events: DataFrame, condition: Column, everything: Landing, matching: str
) -> StreamingQuery:
    """Write all events to one sink and those meeting ``condition`` to a second.

    Each batch is read once; the second write takes its rows from what the first has written.
    """

    def both(df: DataFrame, batch: int) -> None:
        _batch_folder(df, everything.data, batch)
        written = df.sparkSession.read.schema(df.schema).parquet(f"{everything.data}/{BATCH}={batch}")
        _batch_folder(written.filter(condition), matching, batch)

    return _foreach(events, both, everything.checkpoint)


def _foreach(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return _finish(
        stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    )


def routed(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """One of the two sinks of :func:`route`."""
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])
    return spark.read.schema(with_batch).parquet(path).drop(BATCH)


def summary(counts: DataFrame, forwarded: DataFrame) -> DataFrame:
    """Events consumed, event types seen and events forwarded, as one row."""
    consumed = counts.agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_consumed"),
        F.count(F.lit(1)).alias("event_types"),
    )
    return consumed.withColumn("critical_forwarded", forwarded.agg(F.count(F.lit(1))).scalar())


def report(counts: DataFrame, forwarded: DataFrame, query: StreamingQuery) -> dict:
    """The summary with counts per type and the rate, for a log or a JSON file."""
    totals = summary(counts, forwarded).first().asDict()
    per_type = {r["event_type"]: r["event_count"] for r in counts.orderBy("event_type").collect()}
    return {**totals, "event_counts": per_type, **rate(query)}


def rate(query: StreamingQuery) -> dict[str, float]:
    """Rows, seconds and rows per second over all batches of a finished query, and the rows that came too late.

    Late rows are those that the watermark dropped before a stateful step; idle time is left out.
    """
    batches = query.batches
    rows = sum(p["numInputRows"] for p in batches)
    seconds = sum(p["durationMs"].get("triggerExecution", 0) for p in batches) / 1000
    late = sum(s.get("numRowsDroppedByWatermark", 0) for p in batches for s in p["stateOperators"])
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds else 0.0, "late_rows": late}


def dedupe(events: DataFrame, *, keys: list[str], time: str, late_by: str, salts: int = 0) -> DataFrame:
    """First arrival per key; a key is forgotten once the watermark has passed it.

    Where single keys may arrive in very many copies, ``salts`` thins the copies in
    that many separate states first, so they do not all meet in one task.
    """
    timed = events.withWatermark(time, late_by)
    if salts:
        salted = timed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        timed = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark(keys)


def daily_volume(events: DataFrame, *, time: str, late_by: str) -> DataFrame:
    """Events per day and type; a day is closed once the watermark has passed it."""
    return (
        events.withWatermark(time, late_by)
        .groupBy(F.window(time, "1 day"), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.to_date("window.start").alias("event_date"), "event_type", "event_count")
    )
