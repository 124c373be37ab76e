"""Streams that keep what comes late.

A watermark forgets the past, and drops rows that belong to it. Here the landed
tables are the memory instead: every batch writes one folder, named by its number,
and reads only the folders of earlier batches. A batch that is run again after a
failure replaces its own folder and sees what it saw the first time, so nothing is
doubled or lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.matching import keep_first
from tidemark.streaming.events import BATCH, Landing, _batch_folder, _finish

LATE, DAY = "_late", "_day"


def _earlier(spark: SparkSession, path: str, schema: T.StructType, batch: int) -> DataFrame:
    """What batches before this one have written."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])).parquet(path).filter(F.col(BATCH) < batch)


def _opened(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty first folder, so that the first batch finds a table."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{BATCH}=-1")


def _bounds_schema() -> T.StructType:
    return T.StructType([T.StructField("latest", T.TimestampType())])


def _mark_late(spark: SparkSession, rows: DataFrame, bounds: str, batch: int, time: str, late_by: str) -> DataFrame:
    """Whether a row lies behind the newest time of the earlier batches by more than ``late_by``; one bound a batch is kept."""
    known = _earlier(spark, bounds, _bounds_schema(), batch).agg(F.max("latest")).first()[0]
    _batch_folder(rows.agg(F.max(time).cast("timestamp").alias("latest")).coalesce(1), bounds, batch)
    limit = F.lit(known).cast("timestamp") - F.expr(f"INTERVAL {late_by}")
    return rows.withColumn(LATE, F.coalesce(F.col(time) < limit, F.lit(False)))


def land_unique(events: DataFrame, landing: Landing, *, keys: list[str], time: str, late_by: str) -> StreamingQuery:
    """Keep the first arrival of every key, also of keys that come late; late ones are marked.

    Copies of a key share its time, at least its day: a batch is matched against the
    landed keys of the days it holds (Parquet statistics skip the other files). Within a
    batch the first by time stays. Rows without a time are matched among themselves.
    """
    spark = events.sparkSession
    schema = T.StructType([*events.schema.fields, T.StructField(DAY, T.DateType()), T.StructField(LATE, T.BooleanType())])
    data, bounds = f"{landing.data}/rows", f"{landing.data}/bounds"
    _opened(spark, data, schema)
    _opened(spark, bounds, _bounds_schema())
    order = [time, *[c for c in events.columns if c != time and not isinstance(events.schema[c].dataType, T.MapType)]]

    def run(df: DataFrame, batch: int) -> None:
        own = df.sparkSession
        rows = keep_first(_mark_late(own, df, bounds, batch, time, late_by), keys, order).withColumn(DAY, F.to_date(time))
        first, last = rows.agg(F.min(DAY), F.max(DAY)).first()
        known = _earlier(own, data, schema, batch).filter(F.col(DAY).between(first, last) | F.col(DAY).isNull()).select(*keys, DAY)
        same = F.lit(True)
        for name in [*keys, DAY]:
            same = same & F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}"))
        fresh = rows.alias("new").join(known.alias("old"), same, "left_anti")
        _batch_folder(fresh.select(*[f.name for f in schema.fields]).sortWithinPartitions(DAY), data, batch)

    return _finish(events.writeStream.option("checkpointLocation", landing.checkpoint).foreachBatch(run))


def unique_rows(spark: SparkSession, events: DataFrame, landing: Landing, late: bool | None = None) -> DataFrame:
    """What :func:`land_unique` has written: all, or only what came in time, or late."""
    schema = T.StructType([*events.schema.fields, T.StructField(DAY, T.DateType()), T.StructField(LATE, T.BooleanType())])
    rows = _earlier(spark, f"{landing.data}/rows", schema, 1 << 30)
    kept = rows if late is None else rows.filter(F.col(LATE) == late)
    return kept.select(*events.columns)


_DAILY = T.StructType([
    T.StructField("event_date", T.DateType()), T.StructField("event_type", T.StringType()),
    T.StructField("event_count", T.LongType()), T.StructField("late_count", T.LongType()),
])


def land_daily(events: DataFrame, landing: Landing, *, time: str, late_by: str) -> StreamingQuery:
    """Events per day and type, restated when late rows arrive.

    A batch writes a new version of the days and types it adds to: the newest earlier
    version plus its own rows, those that came late counted apart as well.
    """
    spark = events.sparkSession
    data, bounds = f"{landing.data}/daily", f"{landing.data}/bounds"
    _opened(spark, data, _DAILY)
    _opened(spark, bounds, _bounds_schema())

    def run(df: DataFrame, batch: int) -> None:
        own = df.sparkSession
        added = _mark_late(own, df, bounds, batch, time, late_by).groupBy(F.to_date(time).alias("event_date"), "event_type").agg(
            F.count(F.lit(1)).alias("event_count"), F.count(F.when(F.col(LATE), F.lit(1))).alias("late_count"))
        before = _newest(_earlier(own, data, _DAILY, batch))
        both = added.alias("a").join(
            before.alias("b"),
            F.col("a.event_date").eqNullSafe(F.col("b.event_date")) & F.col("a.event_type").eqNullSafe(F.col("b.event_type")), "left")
        _batch_folder(both.select(
            "a.event_date", "a.event_type",
            *[(F.col(f"a.{c}") + F.coalesce(f"b.{c}", F.lit(0))).alias(c) for c in ("event_count", "late_count")]), data, batch)

    return _finish(events.writeStream.option("checkpointLocation", landing.checkpoint).foreachBatch(run))


def _newest(versions: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("event_count", "late_count"), BATCH).alias("v")
    return versions.groupBy("event_date", "event_type").agg(newest).select("event_date", "event_type", "v.*")


def daily_counts(spark: SparkSession, landing: Landing) -> DataFrame:
    """The newest version of every day and type that :func:`land_daily` has written."""
    return _newest(_earlier(spark, f"{landing.data}/daily", _DAILY, 1 << 30))
