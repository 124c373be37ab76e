import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookup
from tidemark.operators.lookup import (
    DuplicateKeyError,
    HotKeys,
    lookup_join,
    measure,
    missing_references,
    point_in_time_join,
)
from tidemark.session import stage


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(2)
    data = [(i, 7 if rng.random() < 0.4 else rng.choice([None, *range(1000)])) for i in range(3000)]
    return spark.createDataFrame(data, "id int, k int").cache()


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(i, f"name {i}") for i in range(0, 1000, 2)] + [(7, "hot")], "key int, name string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_side_gives_the_same_rows_as_broadcast(fact, dim, rows, how):
    small = lookup_join(fact, dim, {"k": "key"}, ["name"], how=how)
    large = lookup_join(fact, dim, {"k": "key"}, ["name"], how=how, max_bytes=0)
    assert rows(small) == rows(large)
    if how == "left":
        assert large.count() == fact.count()


def test_only_a_measured_small_side_is_broadcast(fact, dim, spark):
    plan = lookup_join(fact, dim, {"k": "key"}, ["name"])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    big = lookup_join(fact, dim, {"k": "key"}, ["name"], max_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "hot-side" in big or "_hot" in big


def test_a_hot_or_missing_key_does_not_fill_one_task(spark):
    from pyspark.sql import functions as F

    fact = spark.range(8000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 500).alias("k")
    )
    dim = spark.range(500).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup_join(fact, dim, {"k": "key"}, ["name"], max_bytes=0)
        parts = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("name").alias("m"))
        sizes = parts.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r.n for r in sizes) == 8000 and len(sizes) == 4 and max(r.n for r in sizes) < 2800
    assert got.filter("k = 7 AND name = 'n7'").count() == fact.filter("k = 7").count()


def test_a_hot_key_missing_from_the_lookup(spark):
    fact = spark.createDataFrame([(9,)] * 50 + [(1,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "key int, name string")
    assert lookup_join(fact, dim, {"k": "key"}, ["name"], max_bytes=0).filter("name IS NULL").count() == 50
    assert lookup_join(fact, dim, {"k": "key"}, ["name"], how="inner", max_bytes=0).count() == 1


def test_two_key_columns(spark, rows):
    fact = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "a", 12), (None, "a", 13)], "x int, y string, v int")
    dim = spark.createDataFrame([(1, "a", "one-a"), (2, "a", "two-a")], "x int, y string, label string")
    for limit in (0, 10**6):
        got = lookup_join(fact, dim, {"x": "x", "y": "y"}, {"found": "label"}, max_bytes=limit)
        assert rows(got, "v", "found") == [(10, "one-a"), (11, None), (12, "two-a"), (13, None)]


def test_duplicate_key_is_refused(fact, spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "key int, name string")
    with pytest.raises(DuplicateKeyError):
        lookup_join(fact, twice, {"k": "key"}, ["name"])


def test_null_keys_of_the_lookup_side_do_not_count_as_duplicates(fact, spark):
    side = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "key int, name string")
    assert lookup_join(fact, side, {"k": "key"}, ["name"]).count() == fact.count()


def test_measure(spark):
    size = measure(spark.createDataFrame([(1, "abc"), (2, None), (2, "x")], "k int, s string"), ["k"])
    assert (size.rows, size.copies) == (3, 2)
    assert size.bytes >= 4


def test_missing_references_counts_rows_per_value(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (2,), (9,), (9,), (9,), (None,)], "fk int")
    ref = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert rows(missing_references(fact, "fk", ref, "id")) == [(9, 3)]


def _versions(rng, start):
    """Consecutive versions, sometimes with a gap."""
    out, day = [], start
    for n in range(rng.randrange(1, 5)):
        end = day + timedelta(days=rng.randrange(0, 20))
        out.append((day, end, n))
        day = end + timedelta(days=rng.choice([1, 1, 1, 5]))
    return out


def test_point_in_time_forms_agree_with_brute_force(spark, rows):
    rng = random.Random(3)
    start = date(2024, 1, 1)
    held = {k: _versions(rng, start + timedelta(days=rng.randrange(10))) for k in range(15)}
    versions = spark.createDataFrame(
        [(k, a, b, n) for k, vs in held.items() for a, b, n in vs], "who int, a date, b date, n int"
    )
    facts = [
        (i, rng.choice([None, 3, 3, 3, *range(17)]), rng.choice([None, start + timedelta(days=rng.randrange(-5, 80))]))
        for i in range(600)
    ]
    facts = [(i, k, d if rng.random() < 0.05 else d or start) for i, k, d in facts]
    fact = spark.createDataFrame(facts, "id int, who_id int, on date")
    want = sorted(
        ((i, next((n for a, b, n in held.get(k, []) if d and a <= d <= b), None)) for i, k, d in facts), key=repr
    )
    for limit in (10**9, 0):
        got = point_in_time_join(
            fact, versions, key="who_id", date="on", order=["id"], version_key="who", valid_from="a", valid_to="b",
            columns={"version": "n"}, max_bytes=limit, slices=6,
        )
        assert got.columns == ["id", "who_id", "on", "version"]
        assert rows(got, "id", "version") == want


def test_point_in_time_edges(spark, rows):
    versions = spark.createDataFrame(
        [("e", date(2024, 1, 1), date(2024, 1, 31), "old"), ("e", date(2024, 2, 1), date(9999, 12, 31), "new")],
        "who string, a date, b date, label string",
    )
    fact = spark.createDataFrame(
        [(1, "e", date(2023, 12, 31)), (2, "e", date(2024, 1, 31)), (3, "e", date(2024, 2, 1))], "id int, w string, on date"
    )
    for limit in (10**9, 0):
        got = point_in_time_join(
            fact, versions, key="w", date="on", order=["id"], version_key="who", valid_from="a", valid_to="b",
            columns={"label": "label"}, max_bytes=limit,
        )
        assert rows(got, "id", "label") == [(1, None), (2, "old"), (3, "new")]


def test_lookups_by_one_key_share_a_shuffle(spark):
    """Also where keys are missing, as long as few are."""
    fact = spark.range(4000).selectExpr("id", "if(id = 7, null, id) AS k")
    dim = spark.range(0, 4000, 2).selectExpr("id AS key", "concat('n', id) AS name", "id % 3 AS kind")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how, rows in (("left", 4000), ("inner", 2000)):
            once = lookup_join(fact, dim, {"k": "key"}, ["name"], how=how, max_bytes=0)
            both = lookup_join(once, dim, {"k": "key"}, ["kind"], how=how, max_bytes=0)
            assert both._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
            assert both.count() == rows and both.filter("name = concat('n', k) AND kind = k % 3").count() == 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_missing_keys_do_not_fill_one_task(spark):
    fact = spark.range(8000).selectExpr("id", "if(id % 2 = 0, null, id) AS k")
    dim = spark.range(8000).selectExpr("id AS key", "id AS name")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for hot in (None, HotKeys(fact, ["id", "k"])):
            got = lookup_join(fact, dim, {"k": "key"}, ["name"], max_bytes=0, hot=hot)
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 8000 and max(sizes) < 3000 and got.filter("name = k").count() == 4000
        assert hot.rows() == HotKeys(fact, ["id"]).rows() == 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_point_in_time_moves_only_the_columns_asked_for(spark, rows):
    versions = spark.createDataFrame([(k, date(2024, 1, 1), date(2024, 6, 30), k * 10) for k in range(4)], "who int, a date, b date, n int")
    fact = stage(spark.createDataFrame([(i, i % 5, date(2024, 1 + i % 12, 1), "x" * 50) for i in range(60)], "id int, w int, day date, note string"), "fact")
    got = point_in_time_join(
        fact, versions, key="w", date="day", order=["id", "note"], version_key="who", valid_from="a", valid_to="b",
        columns={"n": "n"}, max_bytes=0, counted=fact.select("w"),
    )
    assert got.schema["day"].dataType == fact.schema["day"].dataType and got.columns == ["id", "w", "day", "note", "n"]
    narrow = got.select("id", "n")
    assert "note" not in narrow._jdf.queryExecution().executedPlan().toString()
    assert rows(narrow) == rows(fact.selectExpr("id", "if(month(day) <= 6 AND w < 4, w * 10, null) AS n"))


def test_the_search_for_hot_keys_does_not_count_every_key(spark, rows, monkeypatch):
    base = spark.range(20_000).selectExpr("id", "if(id % 3 = 0, 7, if(id % 5 = 0, null, id)) AS k", "concat('x', id) AS s")
    written = []
    monkeypatch.setattr(lookup, "stage", lambda df, label: (written.append(stage(df, label)), written[-1])[1])
    hot = HotKeys(base, ["k", "s"])
    assert rows(hot.of("k", "v")) == [(7,), (None,)] and rows(hot.of("s", "v")) == [] and hot.rows() == 20_000
    assert [df.count() for df in written] == [1, 2]
    monkeypatch.setattr(lookup, "HOT_ROWS", 5)  # below the share: counted
    assert rows(HotKeys(base, ["k", "s"]).of("k", "v")) == [(7,), (None,)]
    assert rows(HotKeys(base.limit(0), ["k", "s"]).of("k", "v")) == []


def test_a_hot_key_spread_over_many_others_is_found(spark, rows):
    base = spark.range(400_000).selectExpr("if(id % 400 = 0, -1, id) AS k").repartition(8)
    assert rows(HotKeys(base, ["k"]).of("k", "v")) == [(-1,)]
