"""Distinct counts that add up: states per group that are kept by day and merged over days.

Exact states are bitmaps over dense codes of the values: a row per group and
32,768 codes, at most 4 KB each, so a hot group is many rows and is combined
before the shuffle like a sum. Codes come from a table that only grows; a value
keeps its code. Approximate states are sketches, one per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.operators.ordered import number_rows
from tidemark.session import stage

CODE, BUCKET, STATE = "code", "bucket", "state"


def extend_codes(df: DataFrame, column: str, codes: DataFrame | None = None) -> DataFrame:
    """(column, code): ``codes`` with the values of ``df`` that it lacks; null has no code.

    Codes are dense from 1. New values are numbered in their order behind the largest code.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    if codes is None:
        return number_rows(values, [column], CODE).select(column, CODE)
    held = codes.agg(F.max(CODE)).first()[0] or 0
    fresh = number_rows(values.join(codes, column, "left_anti"), [column], CODE)
    return stage(codes.select(column, CODE).unionByName(fresh.select(column, (F.col(CODE) + held).alias(CODE))), "codes")


def distinct_states(df: DataFrame, keys: list[str], column: str, codes: DataFrame) -> DataFrame:
    """(keys, bucket, state) of the values of ``column`` per group; every value must have a code.

    A value without one raises rather than leave the count. Groups whose values are all null have no state.
    """
    named = lookup_join(df.filter(F.col(column).isNotNull()), codes, {column: column}, [CODE], how="left")
    code = F.when(F.col(CODE).isNull(), F.raise_error(F.lit(f"a value of {column} has no code")).cast("bigint")).otherwise(F.col(CODE))
    placed = named.select(*keys, code.alias(CODE))
    return placed.groupBy(*keys, F.bitmap_bucket_number(CODE).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(CODE)).alias(STATE)
    )


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of finer groups, or of several days, as states of ``keys``."""
    return states.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(STATE).alias(STATE))


def distinct_counts(states: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Exact counts per group of merged or single states."""
    merged = merge_states(states, keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count(STATE)).alias(name))


def sketch_states(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, state): a sketch per group, of the same size whatever the number of values."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column).alias(STATE))


def sketch_counts(states: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Approximate counts per group of sketches merged over finer groups."""
    return states.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(STATE)).alias(name))
