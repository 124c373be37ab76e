from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import business
from tidemark.plans.dashboard import export_extracts
from tidemark.plans.warehouse import load_star, run_load
from tidemark.quality.constraints import violations
from tidemark.quality.gate import QualityGateError
from tidemark.sources import schemas

AS_OF = date(2024, 6, 30)
TX = ("transaction_id string, project_id string, vendor_id string, vendor_name string, category string, amount double, "
      "currency string, transaction_date date, approved_by string, payment_status string, invoice_ref string, notes string")


@pytest.fixture(scope="module")
def extracts(spark):
    projects = spark.createDataFrame(
        [
            (f"P{i}", f"Project {i}", "IT" if i % 2 else "HR", "in progress" if i < 5 else "Completed", date(2024, 1, 1),
             date(2024, 3, i + 1), 1000.0, 100.0 * i, "E1" if i < 5 else "E2", "Low", "North")
            for i in range(8)
        ],
        schemas.PROJECTS,
    )
    employees = spark.createDataFrame(
        [
            ("E1", "Ann", "ann@x", "IT", "Lead", "L2", "2019-01-01", "30000", None, "North", "Active", "9"),
            ("E2", "Bob", " ", "IT", "Dev", "L1", "-999", "20000", "E1", "North", "Active", "-1"),
            ("E3", "Cy", "cy@x", "IT", "Dev", "L1", "2020-01-01", "21000", "E1", "North", "Active", "4"),
        ],
        schemas.EMPLOYEES,
    )
    transactions = spark.createDataFrame(
        [
            (f"T{i:03}", f"P{i % 9}", f"V{i % 3}", f"Vendor {i % 3}", "Cloud" if i % 2 else "Travel",
             None if i == 7 else 1000.0 * i, "AED", date(2024, 1 + i % 6, 3), ["E1", "E2", None][i % 3],
             ["Pending", "Disputed", "Paid"][i % 3], f"I{i}", None)
            for i in range(40)
        ],
        TX,
    )
    return projects, employees, transactions


def history(spark):
    return spark.createDataFrame(
        [
            ("E1", date(2019, 1, 1), None, 25000.0, None, "Dev", None, "L1", "hire", "hired"),
            ("E1", date(2024, 3, 1), 25000.0, 29000.0, "Dev", "Lead", "L1", "L2", "raise", "promotion"),
        ],
        schemas.SALARY_HISTORY,
    )


@pytest.fixture(scope="module")
def loaded(spark, extracts, tmp_path_factory):
    out = f"file://{tmp_path_factory.mktemp('load')}"
    return out, run_load(*extracts, out, as_of=AS_OF, as_csv=True)


def test_load(spark, loaded):
    out, result = loaded
    assert {n: df.count() for n, df in result.clean.items()} == {"projects": 8, "employees": 3, "transactions": 40}
    assert "transactions clean: 40" in result.report
    assert "transactions without amount, counted as 0 in sums: 1" in result.report
    assert "employees.missing_email_fixed: 1" in result.report
    assert "left without category: 0" in result.report
    assert "| referential_integrity | **FAIL** |" in result.quality_reports["transactions"]
    assert spark.read.json(f"{out}/employee_quality_summary").first().years_experience_out_of_range_fixed == 1
    assert spark.read.option("header", True).csv(f"{out}/projects_clean_csv").count() == 8


def test_gate_stops_the_load(spark, extracts, tmp_path):
    projects, employees, transactions = extracts
    headless = transactions.withColumn("transaction_id", F.lit(None).cast("string"))
    with pytest.raises(QualityGateError, match="transactions.transaction_id"):
        run_load(projects, employees, headless, str(tmp_path / "out"), as_of=AS_OF)
    assert not (tmp_path / "out").exists()


def test_star(spark, loaded, tmp_path, rows):
    result = loaded[1]
    for _ in range(2):
        tables = load_star(result.clean, history(spark), str(tmp_path / "star"))
        assert {n: df.count() for n, df in tables.items()} == {
            "dim_date": 11323, "dim_project": 8, "dim_employee": 4, "dim_vendor": 3,
            "bridge_employee_project": 8, "fact_transactions": 40,
        }
    assert violations(tables).filter("violations > 0").count() == 0
    fact = {r.transaction_id: r for r in tables["fact_transactions"].collect()}
    people = {r.employee_key: r for r in tables["dim_employee"].collect()}
    assert sorted(r.transaction_key for r in fact.values()) == list(range(1, 41))
    assert fact["T007"].amount == 0.0
    assert fact["T008"].project_key is None and fact["T008"].employee_key is None  # unknown project, no approver
    early, late = people[fact["T000"].employee_key], people[fact["T003"].employee_key]
    assert (early.salary, early.is_current) == (25000.0, False) and (late.salary, late.is_current) == (30000.0, True)
    assert people[fact["T001"].employee_key].valid_from == date(1900, 1, 1)  # unusable hire date
    bridge = tables["bridge_employee_project"].join(tables["dim_employee"], "employee_key")
    assert bridge.filter("NOT is_current").count() == 0


def test_business_questions(spark, loaded, tmp_path):
    clean = loaded[1].clean
    projects, transactions = clean["projects"], clean["transactions"]
    vendors = transactions.select("vendor_id", "vendor_name").distinct()
    people = clean["employees"].withColumn("is_current", F.lit(True))
    assert [r.department for r in business.department_budget(projects, 0.35).collect()] == ["IT"]
    busy = business.manager_workload(projects, people, more_than=3).collect()
    assert [(r.employee_id, r.active_project_count) for r in busy] == [("E1", 5)]
    shares = business.vendor_concentration(transactions, vendors).collect()
    assert {r.risk_flag for r in shares} == {"HIGH"}
    assert sum(r.percentage_of_total_spend for r in shares) == pytest.approx(100, abs=0.02)
    assert business.vendor_concentration(transactions, vendors, above=99).count() == 0
    open_sums = business.open_issues(transactions, projects, above=0).collect()
    assert [r.open_transaction_value for r in open_sums] == sorted((r.open_transaction_value for r in open_sums), reverse=True)
    trend = business.monthly_spend(transactions).filter("category = 'Cloud'").collect()
    assert trend[-1].running_total == sum(r.monthly_spend for r in trend)
    assert trend[0].month_over_month_pct_change is None
    last = business.trailing_year(transactions, months=2)
    assert last.agg(F.min("transaction_date")).first()[0] == date(2024, 5, 3)
    flagged = business.issue_rate(projects, transactions.filter("payment_status = 'Disputed'")).collect()
    assert len(flagged) == 8 and len({r.issue_pct for r in flagged}) == 1

    frame = business.above_average_pending(transactions, projects, people)
    for name, df in (("projects", projects), ("transactions", transactions), ("employees", people)):
        df.createOrReplaceTempView(name)
    text = spark.sql(business.above_average_pending_sql())
    assert frame.count() > 0 and sorted(frame.collect()) == sorted(text.select(*frame.columns).collect())
    names = export_extracts(projects, transactions, vendors, str(tmp_path / "dash"))
    assert len(names) == 6
    cards = spark.read.option("header", True).csv(str(tmp_path / "dash" / "kpi_cards")).first()
    assert float(cards.total_budget) == 8000.0 and cards.total_transactions == "40"
    top = spark.read.option("header", True).csv(str(tmp_path / "dash" / "vendor_concentration_top5_other"))
    assert top.count() == 3  # three vendors, nothing left over
