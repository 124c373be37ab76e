"""One meaning at every size, and no value lost without a word."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions.sums import exact_sum
from tidemark.operators.lookup import DuplicateKeyError, HotKeys, OverlapError, lookup_join, point_in_time_join
from tidemark.operators.quantile import group_quantiles
from tidemark.operators.scd2 import version_gaps
from tidemark.plans import business
from tidemark.plans.dashboard import top_vendors_and_rest
from tidemark.quality.checks import one_look, outliers
from tidemark.quality.config import Checks
from tidemark.quality.gate import key_completeness
from tidemark.quality.report import check_dataset
from tidemark.session import shared_folder, staging_path
from tidemark.sinks.files import write_csv
from tidemark.sources.files import null_profile, read_typed_csv
from tidemark.streaming import events as st


def day(n):
    return dt.date(2024, 1, n)


def joined(spark, versions, max_bytes):
    fact = spark.createDataFrame([(1, "a", day(5)), (2, "a", day(15)), (3, "b", day(5))], "id int, k string, d date")
    side = spark.createDataFrame(versions, "k string, f date, t date, v int")
    return point_in_time_join(
        fact, side, key="k", date="d", order=["id"], version_key="k", valid_from="f", valid_to="t",
        columns={"v": "v"}, max_bytes=max_bytes)


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_versions_that_overlap_or_share_a_start_raise_on_both_paths(spark, max_bytes):
    with pytest.raises(OverlapError):
        joined(spark, [("a", day(1), day(20), 1), ("a", day(10), day(30), 2)], max_bytes)
    with pytest.raises(DuplicateKeyError):
        joined(spark, [("b", day(1), day(3), 1), ("b", day(1), day(9), 2)], max_bytes)


def test_both_paths_agree_on_sound_versions(spark, rows):
    versions = [("a", day(1), day(9), 1), ("a", day(10), day(30), 2), ("b", day(6), day(9), 3), (None, day(1), day(2), 4)]
    assert rows(joined(spark, versions, 0)) == rows(joined(spark, versions, 1 << 20)) == [
        (1, "a", day(5), 1), (2, "a", day(15), 2), (3, "b", day(5), None)]


def test_sums_add_what_is_there(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert small.agg(exact_sum("x")).first()[0] == 4.0
    odd = spark.createDataFrame([(1.5,), (math.nan,), (None,), (2.25,)], "x double")
    assert odd.agg(exact_sum("x")).first()[0] == 3.75


def test_csv_keeps_text(spark, rows, tmp_path):
    texts = ["  lead and trail  ", 'say "hi", you', "two\nlines", "a,b", 'ends with "', "back\\slash", "'", "é|ß"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    write_csv(frame, str(tmp_path / "t"))
    back = read_typed_csv(spark, str(tmp_path / "t"), frame.schema, multi_line=True)
    assert rows(back) == rows(frame)


def test_csv_rows_of_the_wrong_shape_are_reported(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,t\n1,a\n2\n3,b,c\n")
    schema = "id int, t string"
    shape = spark.createDataFrame([], schema).schema
    with pytest.raises(Exception, match="MALFORMED"):
        read_typed_csv(spark, str(tmp_path / "x.csv"), shape).collect()
    kept = read_typed_csv(spark, str(tmp_path / "x.csv"), shape, keep_corrupt=True).collect()
    assert [r["_corrupt_record"] for r in kept] == [None, "2", "3,b,c"]


def test_nan_is_missing(spark):
    values = [(1, "g", float(v)) for v in range(100)] + [(2, "g", math.nan)]
    frame = spark.createDataFrame(values, "k int, g string, x double")
    checks = Checks(key=("k",), ranges={"x": (0, 99)}, outliers=("x",))
    found = {(r["check"], r["column"]): r for r in one_look(frame, checks, day(1)).collect()}
    assert found["validity_numeric", "x"]["metric"] == 0
    assert found["completeness", "x"]["metric"] == round(100 / 101, 4)
    assert outliers(frame, checks)[0].first()["metric"] == 0
    assert {r["column_name"]: r["null_rows"] for r in null_profile(frame).collect()} == {"k": 0, "g": 0, "x": 1}
    assert group_quantiles(frame, ["g"], "x", {"p": 0.95}).first()["p"] == pytest.approx(94.05)
    gate = key_completeness({"t": frame}, {"t": "x"}).first()
    assert gate["completeness"] == round(100 / 101, 4)


def test_spend_without_a_vendor_counts_once(spark):
    vendors = spark.createDataFrame([(1, "v1"), (2, "v2"), (3, None)], "vendor_id int, vendor_name string")
    lines = spark.createDataFrame([(1, 300.0), (2, 20.0), (3, 100.0), (3, 100.0)], "vendor_id int, amount_aed double")
    found = top_vendors_and_rest(lines, vendors, top=2).collect()
    assert sum(r["total_spend"] for r in found) == 520.0


def test_rate_counts_all_batches_and_late_rows(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    source = tmp_path / "in"
    stamps = ["2024-01-01T10:00:00", "2024-01-01T20:00:00", "2024-01-01T20:30:00", "2024-01-01T11:00:00"] + ["2024-01-01T21:00:00"] * 5
    for n, stamp in enumerate(stamps):
        spark.createDataFrame([(n, stamp)], "event_id int, s string").select(
            "event_id", F.to_timestamp("s").alias("timestamp")).coalesce(1).write.mode("append").json(str(source))
    schema = "event_id int, timestamp timestamp"
    stream = st.file_stream(
        spark, str(source), spark.createDataFrame([], schema).schema, pattern="*.json", files_per_batch=1)
    unique = st.dedupe(stream, keys=["event_id"], time="timestamp", late_by="1 hour")
    query = st.land(unique, st.Landing.fresh(spark, "late"))
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    found = st.rate(query)
    assert found["rows"] == len(stamps)
    assert found["late_rows"] >= 1


def test_a_broken_dimension_has_gaps(spark, rows):
    versions = [(1, 10, day(1), day(4)), (1, 11, day(5), day(9)), (1, 12, day(12), day(20)), (None, 13, day(1), day(2))]
    frame = spark.createDataFrame(versions, "employee_id int, employee_key int, valid_from date, valid_to date")
    expected = [(1, 11, day(9), day(12))]
    assert rows(version_gaps(frame)) == rows(version_gaps(frame, slices=3)) == expected


def test_hot_keys_of_several_lookups_come_from_one_pass(spark, rows, tmp_path):
    reads = spark.sparkContext.accumulator(0)
    fact = spark.createDataFrame([(n, 1 if n % 3 else n, n % 5) for n in range(300)], "id int, a int, b int")
    counted = fact.rdd.map(lambda r: (reads.add(1), tuple(r))[1]).toDF(fact.schema)
    side = spark.createDataFrame([(n, f"v{n}") for n in range(300)], "k int, v string")
    hot = HotKeys(counted, ["a", "b"])
    one = lookup_join(counted, side, {"a": "k"}, {"va": "v"}, max_bytes=0, hot=hot)
    two = lookup_join(one, side, {"b": "k"}, {"vb": "v"}, max_bytes=0, hot=hot)
    found = rows(two)
    assert found == sorted(((n, a, b, f"v{a}", f"v{b}") for n, a, b in map(tuple, fact.collect())), key=repr)
    assert reads.value <= 2 * 300


def test_a_local_folder_is_refused_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Context()
        conf = {"spark.checkpoint.dir": "file:///tmp/x"}

    with pytest.raises(RuntimeError):
        shared_folder(Session())
    assert staging_path(spark, "x").startswith(shared_folder(spark))


def test_checks_by_dataset_name(spark):
    frame = spark.createDataFrame([(1,), (1,)], "id int")
    found = check_dataset(frame, "d", as_of=day(1), datasets={"d": Checks(key=("id",))})
    assert {r["check"]: r["status"] for r in found.collect()}["uniqueness"] == "FAIL"
    with pytest.raises(KeyError):
        check_dataset(frame, "unknown", as_of=day(1))


def test_critical_records_are_keyed_by_event(spark):
    events = spark.createDataFrame([(7, "escalation_raised", "Critical"), (8, "login", None)], "event_id long, event_type string, severity string")
    found = st.critical_records(events, st.is_critical(F.col("severity"))).collect()
    assert [(r["key"], '"event_id":7' in r["value"]) for r in found] == [("7", True)]


def test_the_total_of_concentration_reuses_the_groups(spark):
    """Line items are read once: the total's plan reuses the shuffle of the groups."""
    rows = spark.range(1000).selectExpr("id % 40 AS vendor_id", "id * 1.5 AS amount_aed")
    vendors = spark.range(40).selectExpr("id AS vendor_id", "concat('v', id % 9) AS vendor_name")
    found = business.vendor_concentration(rows, vendors, above=1.0)
    assert found.count() == 9
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]
