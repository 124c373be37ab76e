from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.quality import checks as dq
from tidemark.quality.config import DATASETS, Checks, checks_for
from tidemark.quality.constraints import Constraints, constrained_columns, violations
from tidemark.quality.gate import QualityGateError, gate, key_completeness
from tidemark.quality.report import log_failures, quality_report, run_report, stage_rows

AS_OF = date(2024, 6, 30)


def results(df, checks, **options):
    found = dq.run_checks(df, "d", checks, as_of=AS_OF, **options)
    return {(r.check, r.column): (r.status, r.metric) for r in found.collect()}


def test_one_look(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "2024-01-01", "2024-02-01"), (2, -1.0, "2024-07-01", "2024-07-01"), (3, 200.0, "junk", "2024-01-01"),
         (4, None, "2024-03-01", "2024-02-01")],
        "id int, v double, a string, b string",
    )
    checks = Checks(
        key=("id",), completeness=0.8, ranges={"v": (0, 100), "absent": (0, 1)}, dates=("a", "b"),
        rules=(
            {"type": "before", "columns": ("a", "b")},
            {"type": "before", "columns": ("a", "b"), "strict": True},
            {"type": "non_negative", "column": "v"},
            {"type": "non_negative", "column": "absent"},
        ),
        fresh_column="b", fresh_days=30,
    )
    got = results(df, checks)
    assert got[("completeness", "v")] == ("FAIL", 0.75)
    assert got[("completeness", "id")] == ("PASS", 1.0)
    assert got[("uniqueness", "id")] == ("PASS", 0.0)
    assert got[("validity_numeric", "v")] == ("FAIL", 2.0)
    assert got[("validity_date", "a")] == ("FAIL", 2.0)  # one unparseable, one future
    assert got[("validity_date", "b")] == ("FAIL", 1.0)
    assert got[("consistency", "a <= b")] == ("FAIL", 1.0)
    assert got[("consistency", "a < b")] == ("FAIL", 2.0)
    assert got[("consistency", "v >= 0")] == ("FAIL", 1.0)
    assert got[("freshness", "b")] == ("PASS", -1.0)
    assert not any("absent" in (column or "") for _, column in got)


def test_nine_checks_even_without_rules(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    found = dq.run_checks(df, "d", Checks(key=("id",)), as_of=AS_OF)
    assert {r.check: r.status for r in dq.check_statuses(found).collect()} == dict.fromkeys(dq.ALL_CHECKS, "PASS")
    totals = dq.suite_totals(found).first()
    assert (totals.checks_run, totals.checks_passed, totals.checks_failed) == (9, 9, 0)


def test_uniqueness_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None)], "a int, b string")
    assert dq.uniqueness(df, Checks(key=("a", "b"))).first().metric == 1.0


def test_references(spark):
    df = spark.createDataFrame([("e1", "e2"), ("e2", "gone"), ("e3", None)], "id string, boss string")
    checks = Checks(key=("id",), references={"boss": ("people", "id"), "id": ("nowhere", "id")})
    got = results(df, checks, references={"people": df})
    assert got[("referential_integrity", "boss -> people.id")] == ("FAIL", 1.0)
    assert got[("referential_integrity", "id -> nowhere.id")] == ("SKIPPED", None)
    found = dq.run_checks(df, "d", Checks(key=("id",), completeness=0.5, references={"id": ("nowhere", "id")}), as_of=AS_OF)
    assert dq.suite_totals(found).first().checks_failed == 0


def test_distribution(spark):
    df = spark.createDataFrame([("x", i % 4, None) for i in range(6)] + [("y", i % 4, None) for i in range(10)], "a string, b int, c string")
    got = results(df, Checks(key=("a", "b"), distribution=("a", "b", "c")))
    assert got[("distribution", "a")] == ("FAIL", 0.625)
    assert got[("distribution", "b")][0] == "FAIL" or got[("distribution", "b")][1] <= 0.3125
    assert ("distribution", "c") not in got  # an empty column is ignored
    loose = results(df, Checks(key=("a", "b"), distribution=("a",), top_share=0.7))
    assert loose[("distribution", "a")][0] == "PASS"


def test_outliers(spark):
    df = spark.createDataFrame([(float(i % 3), 1.0) for i in range(50)] + [(100.0, 1.0)], "v double, same double")
    got = results(df, Checks(key=("v",), outliers=("v", "same")))
    assert got[("outliers", "v")] == ("FAIL", 1.0)
    assert got[("outliers", "same")] == ("PASS", 0.0)


def test_band_rule(spark):
    df = spark.createDataFrame([("L", 100.0 + i) for i in range(50)] + [("L", 900.0)], "level string, pay double")
    checks = Checks(key=("pay",), rules=({"type": "band", "column": "pay", "group": "level"},))
    assert results(df, checks, slices=3)[("consistency", "pay in level band")] == ("FAIL", 1.0)


def test_freshness(spark):
    df = spark.createDataFrame([(date(2024, 5, 1),)], "d date")
    assert results(df, Checks(key=("d",), fresh_column="d", fresh_days=30))[("freshness", "d")] == ("FAIL", 60.0)
    assert results(df, Checks(key=("d",), fresh_column="d", fresh_days=60))[("freshness", "d")] == ("PASS", 60.0)


def test_configuration():
    assert checks_for("projects") is DATASETS["projects"]
    with pytest.raises(KeyError):
        checks_for("unknown")


def keyed(spark, filled, total):
    return spark.range(total).select(F.when(F.col("id") < filled, F.col("id")).alias("k"))


def test_gate(spark):
    good, bad = keyed(spark, 80, 100), keyed(spark, 79, 100)
    frames = {"good": good}
    assert gate(frames, {"good": "k"}) is frames
    ran = []
    with pytest.raises(QualityGateError, match="bad.k 79.0% < 80%"):
        ran.append(gate({"good": good, "bad": bad}, {"good": "k", "bad": "k"}))
    assert not ran
    with pytest.raises(QualityGateError, match="good.k"):
        gate(frames, {"good": "k"}, threshold=1.01)
    absent = key_completeness(frames, {"good": "no_such_column"}).first()
    assert (absent.completeness, absent.passed) == (0.0, False)
    empty = key_completeness({"none": keyed(spark, 0, 0)}, {"none": "k"}).first()
    assert (empty.completeness, empty.passed) == (0.0, False)


def test_constraints(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "a"), (2, None)], "id int, name string")
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, parent_id int")
    rules = {
        "parent": Constraints(("id",), (("name",),), ("name",)),
        "child": Constraints(("id",), (), (), {"parent_id": ("parent", "id")}),
    }
    got = {(r.table_name, r.constraint, r.columns): r.violations for r in violations({"parent": parent, "child": child}, rules).collect()}
    assert got == {
        ("parent", "primary_key", "id"): 1, ("parent", "unique", "name"): 1, ("parent", "not_null", "name"): 1,
        ("child", "primary_key", "id"): 0, ("child", "foreign_key", "parent_id"): 1,
    }


def test_failures_are_logged(spark, caplog):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    found = dq.run_checks(df, "d", Checks(key=("id",)), as_of=AS_OF)
    with caplog.at_level("WARNING"):
        assert log_failures(found) == 1
    assert "d uniqueness id (1 keys in 2 rows)" in caplog.text


def test_reports(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "id int, v string")
    found = dq.run_checks(df, "d", Checks(key=("id",)), as_of=AS_OF)
    text = quality_report(found, "d")
    assert "Checks run: 9, passed: 7, failed: 2" in text
    assert "| uniqueness | **FAIL** | id: 1 keys in 2 rows |" in text
    assert "| freshness | PASS | not configured |" in text
    counted = stage_rows({("d", "raw"): df, ("d", "clean"): df.dropna()})
    report = run_report(counted, ["nulls dropped"], 1.5, 30)
    assert "d clean: 1" in report and "d raw: 2" in report and "Elapsed 1.50 s of 30 s: PASS" in report


def test_columns_that_constraints_look_at():
    assert constrained_columns("dim_project") == ["project_key", "project_id", "project_name"]
    assert constrained_columns("fact_transactions") == ["transaction_key", "project_key", "employee_key", "vendor_key", "date_key"]
    assert constrained_columns("b", {"a": Constraints(("k",), foreign_keys={"f": ("b", "x")}), "b": Constraints(("k",))}) == ["k", "x"]
