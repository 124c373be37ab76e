"""Sliced running values and numbering against plain windows and brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ordered
from tidemark.operators.ordered import MOST_SLICES, Running, _placed, in_order, number_rows, slice_count
from tidemark.session import shared_folder, stage


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, values with nulls."""
    rng = random.Random(1)
    data = []
    for i in range(900):
        group = "hot" if rng.random() < 0.4 else f"g{rng.randrange(40)}"
        data.append((group, rng.randrange(60), i, rng.choice([None, rng.randrange(-9, 10)])))
    return stage(spark.createDataFrame(data, "g string, t int, id int, v int"), "skewed")


@pytest.mark.parametrize("slices", [None, 1, 7, 40])
def test_running_equals_window_over_whole_group(skewed, rows, slices):
    order = ["t", "id"]
    ordered = in_order(skewed, ["g"], order, slices=slices)
    assert ordered.split == (slices is not None)
    if slices:
        assert ordered.rows.select("_slice").distinct().count() == slices
    values = {
        "total": Running("sum", F.col("v")),
        "before": Running("sum", F.col("v"), prior=True),
        "low": Running("min", F.col("v"), prior=True),
        "high": Running("max", F.col("v")),
        "last": Running("last", F.col("v")),
        "previous": Running("last", F.col("v"), prior=True),
    }
    got = ordered.running(values).plain()
    whole = Window.partitionBy("g").orderBy(*order)
    here, prior = whole.rowsBetween(Window.unboundedPreceding, 0), whole.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    want = skewed.select(
        "g", "t", "id", "v",
        F.coalesce(F.sum("v").over(here), zero).alias("total"),
        F.coalesce(F.sum("v").over(prior), zero).alias("before"),
        F.min("v").over(prior).alias("low"),
        F.max("v").over(here).alias("high"),
        F.last("v", True).over(here).alias("last"),
        F.last("v", True).over(prior).alias("previous"),
    )
    assert rows(got, *want.columns) == rows(want)


def test_hot_group_is_spread_over_slices(skewed):
    sliced = in_order(skewed, ["g"], ["t", "id"], slices=10).rows
    assert sliced.filter("g = 'hot'").select("_slice").distinct().count() >= 3


def test_carry_has_at_most_one_row_per_slice(skewed):
    sliced = in_order(skewed, ["g"], ["t", "id"], slices=10).rows
    first_slice = sliced.groupBy("g").agg(F.min("_slice").alias("first"))
    continued = sliced.join(first_slice, "g").filter("_slice > first").select("g", "_slice").distinct()
    assert continued.groupBy("_slice").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("slices", [None, 6])
def test_group_totals(skewed, rows, slices):
    ordered = in_order(skewed, ["g"], ["t", "id"], slices=slices).totals({"n": F.lit(1)})
    assert ordered.rows.count() == skewed.count()
    assert rows(ordered.rows.select("g", "n").distinct()) == rows(skewed.groupBy("g").count())


def test_only_groups_beyond_one_task_are_split(skewed):
    assert not in_order(skewed, ["g"], ["t", "id"], whole_rows=900).split
    assert in_order(skewed, ["g"], ["t", "id"], whole_rows=100).split


@pytest.mark.parametrize("slices", [None, 1, 9])
def test_number_rows_is_a_global_row_number(skewed, rows, slices):
    got = number_rows(skewed, ["g", "t", "id"], "n", slices)
    want = skewed.withColumn("n", F.row_number().over(Window.orderBy("g", "t", "id")))
    assert rows(got, "n", "g", "id") == rows(want, "n", "g", "id")


def written(spark):
    """How many tables this application has staged so far."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return len(files.listStatus(path))


def test_small_input_is_not_written(skewed, spark):
    before = written(spark)
    in_order(skewed, ["g"], ["t", "id"]).running({"n": Running("sum", F.lit(1))}).rows.count()
    number_rows(skewed, ["g", "t", "id"], "n").count()
    assert written(spark) == before
    in_order(skewed, ["g"], ["t", "id"], whole_rows=100)
    number_rows(skewed, ["g", "t", "id"], "n", whole_rows=100)
    assert written(spark) == before + 3


def test_slices_grow_with_the_rows(spark):
    def slices(rows):
        df = stage(spark.range(rows).select((F.col("id") % 3 == 0).alias("g"), "id"), "grown")
        sliced = in_order(df, ["g"], ["id"], whole_rows=1000).rows
        sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
        assert sum(sizes) == rows and max(sizes) < 2000
        return len(sizes)

    few, many = slices(6000), slices(60_000)
    assert 5 <= few <= 7 and 9 * few <= many <= 11 * few
    assert slice_count(0) == 1 and slice_count(10**15) == MOST_SLICES


@pytest.mark.parametrize("whole_rows", [100, 10_000])
def test_numbers_by_measure_equal_a_global_row_number(skewed, rows, whole_rows):
    got = number_rows(skewed, ["g", "t", "id"], "n", whole_rows=whole_rows)
    want = skewed.withColumn("n", F.row_number().over(Window.orderBy("g", "t", "id")).cast("long"))
    assert got.schema["n"].dataType == want.schema["n"].dataType
    assert rows(got, "n", "g", "id") == rows(want, "n", "g", "id")


def test_number_rows_with_equal_rows_is_dense(spark):
    same = spark.createDataFrame([(1,)] * 50, "a int").unionByName(spark.createDataFrame([(2,)] * 3, "a int"))
    got = [r.n for r in number_rows(same, ["a"], "n", 5).orderBy("n").collect()]
    assert got == list(range(1, 54))


def test_a_group_of_copies_is_cut_too(spark):
    copies = spark.range(4000).repartition(8).select(F.lit("same").alias("a"), F.lit(1).alias("b"))
    placed = _placed(copies, ["a", "b"], 4)
    sizes = [r["count"] for r in placed.groupBy(F.shiftright("_pos", 33)).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 2500
    sliced = in_order(stage(copies, "copies"), ["a"], ["b"], slices=4)
    got = sliced.running({"n": Running("sum", F.lit(1))}).rows
    assert [r.n for r in got.orderBy("n").collect()] == list(range(1, 4001))


def test_unknown_kind_is_refused(skewed):
    ordered = in_order(skewed, ["g"], ["t", "id"])
    with pytest.raises(ValueError):
        ordered.running({"x": Running("median", F.col("v"))})


def test_known_rows_are_not_counted(skewed, spark, rows):
    """Neither the rows of a table nor the groups of one are counted from a plan that costs more than another."""
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    costly = skewed.mapInArrow(seen, skewed.schema)
    number_rows(costly, ["g", "t", "id"], "n", rows=900)
    in_order(costly, ["g"], ["t", "id"], counted=skewed)
    assert evaluated.value == 0
    got = number_rows(costly, ["g", "t", "id"], "n", whole_rows=100, rows=900)
    assert rows(got, "n", "g", "id") == rows(number_rows(skewed, ["g", "t", "id"], "n"), "n", "g", "id")


def test_numbering_inside_groups_writes_no_rows(skewed, rows, monkeypatch):
    df = skewed.withColumn("g", F.when(F.col("id") % 11 > 0, F.col("g")))  # null sorts first
    order = ["g", "t", "id"]
    expected = rows(df.withColumn("n", F.row_number().over(Window.orderBy(*order))), "n", "g", "id", "v")
    staged = []
    monkeypatch.setattr(ordered, "stage", lambda df, label: (staged.append(label), stage(df, label))[1])
    found = number_rows(df, order, "n", whole_rows=100, grouped=df.select("g"))
    assert rows(found, "n", "g", "id", "v") == expected and found.columns == ["n", *df.columns]
    assert staged == ["group-sizes", "group-slices"]
    monkeypatch.setattr(ordered, "WHOLE_GROUP_ROWS", 50)  # a group that outgrows a task is cut
    assert rows(number_rows(df, order, "n", whole_rows=100, grouped=df.select("g")), "n", "g", "id", "v") == expected
    assert staged[2:] == ["group-sizes", "numbered"]
    assert number_rows(df.limit(0), order, "n", grouped=df.limit(0).select("g")).count() == 0
