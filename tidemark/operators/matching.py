"""Keep-first, first-in-first-out matching and interval overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import Running, in_order


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key by ``order``.

    Asking for row number 1 lets Spark keep one row per key in every map task before
    the shuffle, so a key with many copies does not travel, and columns nobody reads
    are pruned. ``order`` should end in columns that separate equal times. Null keys
    form one group each.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter(F.col("_nth") == 1).drop("_nth")


def fifo_match(
    events: DataFrame,
    *,
    group: str,
    time: str,
    event_id: str,
    opens: Column,
    closes: Column,
    open_fields: dict[str, Column],
    close_fields: dict[str, Column],
    slices: int | None = None,
) -> DataFrame:
    """Let every closing event end the oldest open one of its group.

    One row per opening event; the ``close_fields`` are null while it is open. A
    close with nothing open is dropped. Opens sort before closes of equal time; an open
    without a time stays unmatched, a close without one is dropped.

    With +1 per open and -1 per close, let ``s`` be the running sum and ``floor``
    its lowest value so far (at most 0). A close lowers the floor exactly when
    nothing was open, so the number of useful closes so far is closes + floor, and
    the k-th useful close belongs to the k-th open. Both sides of the final match
    have unique (group, k) keys, so it cannot skew.
    """
    usable = F.col(group).isNotNull() & (opens | (closes & F.col(time).isNotNull()))
    marked = events.filter(usable).select(
        F.col(group).alias("_group"),
        F.col(time).isNull().alias("_undated"),
        F.col(time).alias("_time"),
        F.when(opens, 0).otherwise(1).alias("_side"),
        F.col(event_id).alias("_event"),
        F.when(opens, F.struct(*[v.alias(n) for n, v in open_fields.items()])).alias("_open"),
        F.when(~opens, F.struct(*[v.alias(n) for n, v in close_fields.items()])).alias("_close"),
    )
    order = ["_undated", "_time", "_side", "_event"]
    lowest = (
        in_order(marked, ["_group"], order, slices=slices)
        .running({"_opened": Running("sum", 1 - F.col("_side")), "_closed": Running("sum", F.col("_side"))})
        .with_columns({"_balance": F.col("_opened") - F.col("_closed")})
        .running({"_low": Running("min", F.col("_balance"), prior=True)})
        .rows
    )
    floor = F.least(F.lit(0), F.col("_low"))
    useful = (F.col("_side") == 1) & (F.col("_balance") >= floor)
    numbered = lowest.withColumn(
        "_k", F.when(F.col("_side") == 0, F.col("_opened")).when(useful, F.col("_closed") + floor)
    ).filter(F.col("_k").isNotNull())
    # Pairs hold at most two rows, so combining before the shuffle would only cost a sort.
    pairs = numbered.repartition("_group", "_k").groupBy("_group", "_k").agg(
        F.first("_open", ignorenulls=True).alias("_open"),
        F.first("_close", ignorenulls=True).alias("_close"),
    )
    return pairs.filter(F.col("_open").isNotNull()).select(
        F.col("_group").alias(group), "_open.*", "_close.*"
    )


def overlapping_intervals(
    df: DataFrame, *, key: str, version: str, start: str, end: str, slices: int | None = None
) -> DataFrame:
    """Intervals that begin before an earlier-starting one of the same key has ended.

    Each is reported once, with the earlier interval reaching furthest as witness;
    listing all pairs would grow with the square of a key's intervals.
    """
    usable = df.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
    narrow = usable.select(
        F.col(key).alias("_key"), F.col(start).alias("_start"), F.col(version).alias("_version"),
        F.col(end).alias("_end"),
    )
    order = ["_start", "_version"]
    reach = in_order(narrow, ["_key"], order, slices=slices).running(
        {"_reach": Running("max", F.struct("_end", "_version"), prior=True)}
    )
    return reach.rows.filter(F.col("_reach._end") >= F.col("_start")).select(
        F.col("_key").alias(key),
        F.col("_reach._version").alias("version_a"),
        F.col("_version").alias("version_b"),
        F.col("_reach._end").alias("a_to"),
        F.col("_start").alias("b_from"),
        F.col("_end").alias("b_to"),
    )
