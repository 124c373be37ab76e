"""Exact group quantiles and what is built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import is_filled
from tidemark.operators.lookup import lookup_join
from tidemark.operators.ordered import Running, in_order
from tidemark.session import stage


def group_quantiles(
    df: DataFrame,
    group: list[str],
    value: str,
    quantiles: dict[str, float],
    *,
    approx: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, nulls and NaN ignored.

    ``F.percentile`` keeps a group's distinct values in one task. Here values are
    first counted (map-side combined), then ranked by a running count, and
    only the one or two rows each quantile falls on are kept. ``approx=True``
    uses the bounded-memory sketch instead.
    """
    known = df.filter(is_filled(df, value))
    for g in group:
        known = known.filter(F.col(g).isNotNull())
    if approx:
        return known.groupBy(*group).agg(
            *[F.percentile_approx(value, q).cast("double").alias(n) for n, q in quantiles.items()]
        )
    counted = known.groupBy(*group, F.col(value).cast("double").alias("_value")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    placed = (
        in_order(counted, group, ["_value"], slices=slices)
        .totals({"_total": F.col("_n")})
        .running({"_upto": Running("sum", F.col("_n"))})
        .rows
    )

    def position(q: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(q))

    def covers(rank: Column) -> Column:
        return (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))

    needed = F.lit(False)
    picks = []
    for i, q in enumerate(quantiles.values()):
        low, high = covers(F.floor(position(q))), covers(F.ceil(position(q)))
        needed = needed | low | high
        picks.append(F.max(F.when(low, F.col("_value"))).alias(f"_low{i}"))
        picks.append(F.max(F.when(high, F.col("_value"))).alias(f"_high{i}"))
    edges = placed.filter(needed).groupBy(*group).agg(*picks, F.max("_total").alias("_total"))
    results = []
    for i, (name, q) in enumerate(quantiles.items()):
        share = position(q) - F.floor(position(q))
        results.append((F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * share).alias(name))
    return edges.select(*group, *results)


def impute_group_median(
    df: DataFrame, group: str, value: str, *, low: float, high: float, slices: int | None = None
) -> DataFrame:
    """Replace null and out-of-range values by the median of the group's valid ones."""
    valid = F.col(value).between(F.lit(low), F.lit(high))
    checked = df.withColumn(value, F.when(valid, F.col(value).cast("double")))
    medians = stage(group_quantiles(checked, [group], value, {"_median": 0.5}, slices=slices), "medians")
    return (
        lookup_join(checked, medians, {group: group}, ["_median"])
        .withColumn(value, F.coalesce(F.col(value), F.col("_median")))
        .drop("_median")
        .select(*df.columns)
    )


def flag_outside_band(
    df: DataFrame,
    group: str,
    value: str,
    flag: str,
    *,
    fix: str = "p95",
    slices: int | None = None,
) -> DataFrame:
    """Flag values above 1.5 x p95 or below 0.5 x p05 of their group and pull them in.

    ``fix='p95'`` sets every flagged value to p95, ``'clamp'`` sets low ones to
    p05, ``'none'`` only flags.
    """
    bands = stage(group_quantiles(df, [group], value, {"_p05": 0.05, "_p95": 0.95}, slices=slices), "bands")
    banded = lookup_join(df, bands, {group: group}, ["_p05", "_p95"])
    above = (F.col(value) > F.col("_p95") * 1.5) & is_filled(df, value)
    below = F.col(value) < F.col("_p05") * 0.5
    outside = F.coalesce(above | below, F.lit(False))
    fixes = {
        "p95": F.when(outside, F.col("_p95")).otherwise(F.col(value)),
        "clamp": F.when(above, F.col("_p95")).when(below, F.col("_p05")).otherwise(F.col(value)),
        "none": F.col(value),
    }
    if fix not in fixes:
        raise ValueError(f"fix must be one of {sorted(fixes)}")
    return banded.select(
        *[fixes[fix].alias(value) if c == value else F.col(c) for c in df.columns],
        outside.alias(flag),
    )
