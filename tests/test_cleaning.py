from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import title_case
from tidemark.operators.lookup import DuplicateKeyError
from tidemark.operators.quantile import flag_outside_band, group_quantiles
from tidemark.plans.cleaning import (
    PLACEHOLDER_EMAIL,
    clean_employees,
    employee_quality_summary,
    enrich_transactions,
    status_conflicts,
    transform_projects,
    value_counts,
)
from tidemark.sources import schemas

AS_OF = date(2024, 1, 1)


def project(pid, budget, cost, priority="Low", status="Completed", start=None, end=None):
    return (pid, "name", "IT", status, start, end, budget, cost, "M1", priority, "North")


def test_transform_projects(spark):
    raw = spark.createDataFrame(
        [
            project("null budget", None, 100.0),
            project("zero", 0.0, 0.0),
            project("95", 100.0, 95.0),
            project("90", 100.0, 90.0),
            project("high", 100.0, 10.0, priority="High"),
            project("critical", 100.0, 10.0, priority="Critical"),
            project("messy", 100.0, None, priority=None, status="  in progress ", start=date(2024, 1, 1), end=date(2024, 1, 31)),
            project("unmapped", 1.0, 0.5, status="Cancelled"),
        ],
        schemas.PROJECTS,
    )
    got = {r.project_id: r for r in transform_projects(raw).collect()}
    row = got["null budget"]
    assert (row.budget_variance, row.is_over_budget, row.budget_utilisation_pct, row.risk_level) == (100.0, True, None, "High")
    row = got["zero"]
    assert (row.is_over_budget, row.budget_utilisation_pct, row.risk_level) == (False, None, "Low")
    assert {k: got[k].risk_level for k in ("95", "90", "high", "critical")} == {
        "95": "Medium", "90": "Low", "high": "Medium", "critical": "High"
    }
    row = got["messy"]
    assert (row.status, row.status_category, row.duration_days, row.actual_cost, row.risk_level) == (
        "In Progress", "Active", 30, 0.0, "Low"
    )
    assert (got["unmapped"].status_category, got["zero"].duration_days) == (None, None)
    assert len(transform_projects(raw).columns) == 17
    counts = {r.value: r.rows for r in value_counts(transform_projects(raw), "status_category").collect()}
    assert counts == {"Closed": 6, "Active": 1, None: 1}


@pytest.mark.parametrize("text", ["  in progress ", "on-hold", "ALL CAPS", "a1b c", "éa ünder", "x--y z", "", "don't"])
def test_title_case_follows_python(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(title_case(F.col("s"))).first()[0] == text.strip().title()


def employee(eid, email="a@b", hire="2015-06-01", salary="100", years="5", level="L", manager=None, status="Active"):
    return (eid, f"Name {eid}", email, "IT", "Dev", level, hire, salary, manager, "North", status, years)


def cleaned(spark, data, **options):
    raw = spark.createDataFrame(data, schemas.EMPLOYEES)
    clean = clean_employees(raw, AS_OF, **options).cache()
    return raw, clean, {r.employee_id: r for r in clean.collect()}


def test_emails_and_dates(spark):
    hires = {
        "neg": "-999", "year": "2020", "long": "99999-01-01", "early": "1989-12-31", "future": "2024-01-02",
        "nosuch": "2020-02-30", "ok": "2015-06-01", "null": None,
    }
    data = [employee(k, hire=v) for k, v in hires.items()]
    data += [employee("e1", email=None), employee("e2", email=""), employee("e3", email="   ")]
    raw, clean, got = cleaned(spark, data)
    assert {k: got[k].hire_date for k in hires} == {k: date(2015, 6, 1) if k == "ok" else None for k in hires}
    assert [got[k].email for k in ("e1", "e2", "e3", "ok")] == [PLACEHOLDER_EMAIL] * 3 + ["a@b"]
    summary = employee_quality_summary(raw, clean, AS_OF).first()
    assert summary.missing_email_fixed == 3
    assert summary.invalid_hire_date_format_fixed == 2
    assert summary.implausible_hire_date_fixed == 3
    assert len(clean.columns) == 13


def test_experience_takes_the_level_median(spark):
    years = {"a": "-1", "b": "51", "c": "0", "d": "50", "e": None, "f": "4", "g": "6", "h": "text"}
    raw, clean, got = cleaned(spark, [employee(k, years=v) for k, v in years.items()])
    assert {k: got[k].years_experience for k in years} == {
        "a": 5.0, "b": 5.0, "c": 0.0, "d": 50.0, "e": 5.0, "f": 4.0, "g": 6.0, "h": 5.0
    }
    assert employee_quality_summary(raw, clean, AS_OF).first().years_experience_out_of_range_fixed == 2


def test_salary_band(spark):
    salaries = [str(100 + i) for i in range(60)]
    data = [employee(f"s{i}", salary=s) for i, s in enumerate(salaries)] + [employee("top", salary="900"), employee("low", salary="3")]
    values = pd.Series([float(d[7]) for d in data])
    p05, p95 = values.quantile(0.05), values.quantile(0.95)
    raw, clean, got = cleaned(spark, data)
    assert {k for k, r in got.items() if r.salary_flagged_outlier} == {"top", "low"}
    assert got["top"].salary == got["low"].salary == pytest.approx(p95)
    assert got["s7"].salary == 107.0
    assert employee_quality_summary(raw, clean, AS_OF).first().salary_level_mismatch_fixed == 2
    clamped = cleaned(spark, data, fix="clamp")[2]
    assert clamped["low"].salary == pytest.approx(p05)
    with pytest.raises(ValueError):
        cleaned(spark, data, fix="other")


def test_status_conflicts(spark):
    data = [
        employee("boss", status="Inactive"), employee("a", manager="boss"), employee("b", manager="boss", status="Inactive"),
        employee("c", manager="a"), employee("d", manager="nobody"),
    ]
    raw, clean, got = cleaned(spark, data)
    assert [tuple(r) for r in status_conflicts(raw).collect()] == [("boss", 1)]
    assert employee_quality_summary(raw, clean, AS_OF).first().status_conflicts_found == 1
    assert got["a"].manager_id == "boss"


def transaction(tid, pid="P", amount=10.0, approver="E"):
    return (tid, pid, "V", "Vendor", "Cloud", amount, "AED", date(2024, 3, 5), approver, "Paid", "I", None)


TX = ("transaction_id string, project_id string, vendor_id string, vendor_name string, category string, amount double, "
      "currency string, transaction_date date, approved_by string, payment_status string, invoice_ref string, notes string")


def test_enrich_transactions(spark):
    tx = spark.createDataFrame(
        [transaction("1"), transaction("2", amount=None), transaction("3", approver=None), transaction("4", pid="unknown")], TX
    )
    projects = spark.createDataFrame([("P", "Proj", "IT")], "project_id string, project_name string, department string")
    people = spark.createDataFrame([("E", "Eli")], "employee_id string, full_name string")
    enriched = enrich_transactions(tx, projects, people)
    assert len(enriched.columns) == 18
    got = {r.transaction_id: r for r in enriched.collect()}
    assert len(got) == 4
    assert (got["1"].project_name, got["1"].approver_full_name, got["1"].transaction_year_month) == ("Proj", "Eli", "2024-03")
    assert (got["2"].amount, got["2"].amount_aed) == (None, 0.0)
    assert (got["3"].is_approved, got["3"].approver_full_name) == (False, None)
    assert got["4"].project_name is None
    with pytest.raises(DuplicateKeyError):
        enrich_transactions(tx, projects.unionByName(projects), people)


@pytest.mark.parametrize("slices", [None, 5])
def test_group_quantiles_equal_pandas(spark, slices):
    rng = np.random.default_rng(8)
    groups = rng.choice(["hot", "hot", "a", "b", "one"], 800)
    values = np.where(rng.random(800) < 0.05, np.nan, np.round(rng.normal(0, 30, 800), 1))
    pdf = pd.DataFrame({"g": groups, "v": values})
    pdf.loc[len(pdf)] = ["single", 3.5]
    df = spark.createDataFrame([(g, None if np.isnan(v) else float(v)) for g, v in pdf.itertuples(index=False)], "g string, v double")
    wanted = {"p05": 0.05, "mid": 0.5, "p95": 0.95, "lo": 0.0, "hi": 1.0}
    got = {r.g: r for r in group_quantiles(df, ["g"], "v", wanted, slices=slices).collect()}
    want = pdf.groupby("g")["v"].quantile(list(wanted.values())).unstack()
    assert set(got) == set(want.index)
    for g, row in want.iterrows():
        assert [got[g][n] for n in wanted] == pytest.approx(list(row), rel=1e-12)


def test_approximate_quantiles_are_close(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    got = group_quantiles(df, ["g"], "v", {"mid": 0.5}, approx=True).collect()
    assert all(abs(r.mid - 500) < 10 for r in got)


def test_band_leaves_nulls_and_unknown_groups(spark, rows):
    df = spark.createDataFrame([("g", 1.0), ("g", None), (None, 5.0)], "g string, v double")
    got = flag_outside_band(df, "g", "v", "out")
    assert rows(got) == sorted([("g", 1.0, False), ("g", None, False), (None, 5.0, False)], key=repr)
