import pytest
from pyspark.sql import functions as F

from tidemark.operators.distinct import (
    distinct_counts,
    distinct_states,
    extend_codes,
    merge_states,
    sketch_counts,
    sketch_states,
)


@pytest.fixture(scope="module")
def visits(spark):
    """A third of the rows in one group, values beyond one bucket, nulls in both columns."""
    return spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 > 0, F.concat(F.lit("g"), F.col("id") % 7)).alias("grp"),
        (F.col("id") % 4).alias("day"),
        F.when(F.col("id") % 13 > 0, F.concat(F.lit("u"), (F.col("id") * 7919) % 70_001)).alias("who"),
    )


def test_states_of_days_merge_to_the_direct_count(spark, visits, rows):
    codes, kept = None, []
    for day in range(4):
        today = visits.filter(F.col("day") == day)
        codes = extend_codes(today, "who", codes)
        kept.append(distinct_states(today, ["day", "grp"], "who", codes))
    found = codes.agg(F.count("code"), F.countDistinct("code"), F.min("code"), F.max("code")).first()
    assert tuple(found) == (visits.select("who").distinct().count() - 1,) * 2 + (1, visits.select("who").distinct().count() - 1)
    states = kept[0].unionByName(kept[1]).unionByName(kept[2]).unionByName(kept[3])
    assert states.select("bucket").distinct().count() == 3
    direct = visits.groupBy("grp").agg(F.count_distinct("who").alias("n"))
    assert rows(distinct_counts(states, ["grp"], "n"), "grp", "n") == rows(direct, "grp", "n")
    by_day = visits.groupBy("day", "grp").agg(F.count_distinct("who").alias("n"))
    assert rows(distinct_counts(states, ["day", "grp"], "n"), "day", "grp", "n") == rows(by_day, "day", "grp", "n")
    again = merge_states(states.unionByName(states), ["grp"])
    assert rows(distinct_counts(again, ["grp"], "n"), "grp", "n") == rows(direct, "grp", "n")
    rough = {r.grp: r.n for r in sketch_counts(sketch_states(visits, ["day", "grp"], "who"), ["grp"], "n").collect()}
    assert all(abs(rough[r.grp] - r.n) <= 0.1 * r.n for r in direct.collect())


def test_a_value_without_a_code_raises_and_empty_tables_give_nothing(spark, visits):
    codes = extend_codes(visits.filter("day = 0"), "who")
    with pytest.raises(Exception, match="has no code"):
        distinct_states(visits, ["grp"], "who", codes.limit(5)).collect()
    empty = visits.limit(0)
    assert distinct_counts(distinct_states(empty, ["grp"], "who", extend_codes(empty, "who")), ["grp"], "n").count() == 0
