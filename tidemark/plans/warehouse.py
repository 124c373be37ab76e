"""The gated load: check, clean, enrich, build the star, report."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import scd2, star
from tidemark.operators.scd2 import HistorySpec
from tidemark.plans.cleaning import (
    clean_employees,
    employee_quality_summary,
    enrich_transactions,
    transform_projects,
    value_counts,
)
from tidemark.quality import checks as dq
from tidemark.quality.config import DATASETS
from tidemark.quality.gate import gate
from tidemark.quality.report import log_failures, quality_report, run_report, stage_rows
from tidemark.session import stage
from tidemark.sinks.files import write_csv, write_metrics, write_table, write_text
from tidemark.sources.files import calendar, read_table

# Days of the calendar and the time a run may take, in seconds.
FIRST_DAY, LAST_DAY = date(2000, 1, 1), date(2030, 12, 31)
TIME_BUDGET = 30.0

TRANSACTION_COLUMNS = ["currency", "category", "payment_status", "invoice_ref", "notes"]


@dataclass(frozen=True)
class RunResult:
    clean: dict[str, DataFrame]
    checks: DataFrame
    quality_reports: dict[str, str]
    report: str


def run_load(
    projects: DataFrame,
    employees: DataFrame,
    transactions: DataFrame,
    out: str,
    *,
    as_of: date,
    as_csv: bool = False,
) -> RunResult:
    """Check all three extracts, stop at the gate, then write the cleaned tables.

    Each extract is landed once; checks, cleaning and counts read the landed table.
    The time is taken around the writes.
    """
    started = time.perf_counter()
    spark = projects.sparkSession
    raw = {
        name: stage(df, name)
        for name, df in (("projects", projects), ("employees", employees), ("transactions", transactions))
    }
    found = stage(
        reduce(
            DataFrame.unionByName,
            [dq.run_checks(df, name, DATASETS[name], references=raw, as_of=as_of) for name, df in raw.items()],
        ),
        "checks",
    )
    log_failures(found)
    reports = {name: quality_report(found, name) for name in raw}
    gate(raw)

    clean_projects = transform_projects(raw["projects"])
    clean_people = stage(clean_employees(raw["employees"], as_of), "employees-clean")
    enriched = enrich_transactions(raw["transactions"], clean_projects, clean_people)
    written = {}
    counts: dict[tuple[str, str], int] = {}
    for name, df in (("projects", clean_projects), ("employees", clean_people), ("transactions", enriched)):
        path = f"{out}/{name}_clean"
        counts[name, "clean"] = write_table(df, path)
        written[name] = read_table(spark, path, df.schema)
        if as_csv:
            write_csv(written[name], f"{path}_csv")
    summary = stage(employee_quality_summary(raw["employees"], clean_people, as_of), "quality-summary")
    write_metrics(summary, f"{out}/employee_quality_summary")
    rows = stage_rows({(n, "raw"): df for n, df in raw.items()}).unionByName(_counted(spark, counts))
    decisions = [f"employees.{name}: {count}" for name, count in summary.first().asDict().items()]
    missing = raw["transactions"].agg(
        F.count(F.when(F.col("amount").isNull(), 1)).alias("amount"),
        F.count(F.when(F.col("approved_by").isNull(), 1)).alias("approver"),
    ).first()
    unmapped = F.count(F.when(F.col("status_category").isNull(), 1)).alias("n")
    decisions += [
        f"projects with a status outside the known ones, left without category: {written['projects'].agg(unmapped).first()['n']}",
        f"transactions without amount, counted as 0 in sums: {missing['amount']}",
        f"transactions without approver, not approved: {missing['approver']}",
    ]
    risk = value_counts(written["projects"], "risk_level").collect()
    decisions += [f"projects at risk level {r['value']}: {r['rows']}" for r in sorted(risk, key=lambda r: str(r["value"]))]
    elapsed = time.perf_counter() - started
    report = run_report(rows, decisions, elapsed, TIME_BUDGET)
    write_text(spark, f"{out}/run_report", report)
    for name, text in reports.items():
        write_text(spark, f"{out}/quality_{name}", text)
    return RunResult(written, found, reports, report)


def _counted(spark: SparkSession, counts: dict[tuple[str, str], int]) -> DataFrame:
    """Row counts that the writes returned, shaped as :func:`stage_rows` gives them."""
    return spark.createDataFrame([(d, s, n) for (d, s), n in counts.items()], "dataset string, stage string, rows bigint")


def load_star(
    clean: dict[str, DataFrame],
    history: DataFrame,
    out: str,
    *,
    spec: HistorySpec = HistorySpec(),
    days: tuple[date, date] = (FIRST_DAY, LAST_DAY),
    order: tuple[str, ...] = ("transaction_id",),
    columns: tuple[str, ...] = tuple(TRANSACTION_COLUMNS),
) -> dict[str, DataFrame]:
    """Write the star schema below ``out`` and return the written tables.

    Dimensions are written before the tables that refer to them, and every later step reads
    the written ones. Running it again replaces everything with the same content.
    """
    spark = history.sparkSession

    def write(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{out}/{name}")
        return read_table(spark, f"{out}/{name}", df.schema)

    changes = stage(scd2.collapse_same_day(history, spec).drop("terminal_states"), "changes")
    tables = {
        "dim_date": write("dim_date", star.dim_date(calendar(spark, *days))),
        "dim_project": write("dim_project", star.dim_project(clean["projects"])),
        "dim_employee": write(
            "dim_employee", scd2.build_versions(changes, clean["employees"].drop("salary_flagged_outlier"), spec=spec)
        ),
        "dim_vendor": write("dim_vendor", star.dim_vendor(clean["transactions"])),
    }
    tables["bridge_employee_project"] = write(
        "bridge_employee_project", star.bridge_employee_project(tables["dim_project"], tables["dim_employee"])
    )
    fact = star.fact_transactions(
        clean["transactions"], tables["dim_project"], tables["dim_vendor"], tables["dim_employee"],
        order=list(order), columns=list(columns),
    )
    tables["fact_transactions"] = write("fact_transactions", fact)
    return tables
