"""Sums of doubles against exact arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from tidemark.functions.sums import exact_sum, merged_state, merged_value, state_value, sum_state


def exact(values):
    """Every double as its shortest decimal, added up and rounded once."""
    total = sum((Fraction(repr(v)) for v in values), Fraction(0))
    return float(total) if total else 0.0


def summed(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact_sum("x")).first()[0]


@pytest.mark.parametrize("values", [
    [1.0, 2e20, 5e20],
    [1e-9] * 1000,
    [0.1] * 1000,
    [1e20, 1.0, -1e20],
    [-7e20, 1.0],
    [3e36, -3e36, 1e-20, 0.25],
    [-0.3, 0.1, 0.1, 0.1],
    [1e-13, -2e-13, 1.2345678901234567e-14],
    [99999999999.123456, -99999999999.12],
    [1e10, 0.123456789, -1e10],
    [-1e-20],
    [-5.0, 0.0099, -1e19],
    [0.0, -0.0],
])
def test_known_sums(spark, values):
    assert summed(spark, values) == exact(values)


def test_random_sums_in_any_order(spark):
    rng = random.Random(11)
    for low, high in ((-3, 9), (-13, 19), (-12, 36), (15, 36)):
        values = [rng.choice([-1, 1]) * rng.uniform(1, 10) * 10.0 ** rng.randint(low, high) for _ in range(400)]
        expected = exact(values)
        for parts in (1, 5):
            rng.shuffle(values)
            assert summed(spark, values, parts) == expected


def test_extremes_are_never_left_out(spark):
    inf = math.inf
    assert summed(spark, [1e300, 1e300, 5.0]) == 2e300
    assert summed(spark, [1e-30, 1e-30]) == 2e-30
    assert summed(spark, [inf, 1.0]) == inf
    assert summed(spark, [-inf, 1e20]) == -inf
    assert math.isnan(summed(spark, [inf, -inf]))
    assert summed(spark, [math.nan, 2.0, None]) == 2.0
    assert summed(spark, [None, math.nan]) is None


def test_other_types(spark):
    df = spark.sql("""
        SELECT * FROM VALUES (CAST(12345678901234567890.123456789012345678 AS DECIMAL(38, 18)), 2, '1.5', CAST(1.1 AS FLOAT)),
                             (CAST(0.000000000000000001 AS DECIMAL(38, 18)), 3, 'x', CAST(2.2 AS FLOAT)) AS t(d, i, s, f)""")
    got = df.agg(*[exact_sum(c).alias(c) for c in "disf"]).first()
    assert got["d"] == float("12345678901234567890.123456789012345679")
    assert (got["i"], got["s"]) == (5.0, 1.5)
    assert got["f"] == pytest.approx(3.3, abs=1e-6)


def test_states_add_up_over_groups_and_windows(spark):
    rng = random.Random(12)
    rows = [(k % 7, rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 30)) for k in range(500)]
    per = spark.createDataFrame(rows, "g int, x double").groupBy("g").agg(sum_state("x").alias("s"))
    again = per.groupBy((F.col("g") % 2).alias("h")).agg(merged_state("s").alias("s"))
    assert again.agg(merged_value("s")).first()[0] == exact([x for _, x in rows])
    assert [r["v"] for r in per.filter("g = 3").select(state_value("s").alias("v")).collect()] == [exact([x for g, x in rows if g == 3])]
    assert per.agg(merged_value("s")).first()[0] == exact([x for _, x in rows])
    upto = "ORDER BY g ROWS UNBOUNDED PRECEDING"
    for r in per.select("g", merged_value("s", upto).alias("v")).collect():
        assert r["v"] == exact([x for g, x in rows if g <= r["g"]])
