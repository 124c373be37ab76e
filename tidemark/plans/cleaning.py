"""Cleaning and enrichment of projects, employees and transactions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    BARE_NUMBER,
    LONG_YEAR,
    blank_to,
    count_where,
    days_between,
    guarded_pct,
    is_blank,
    map_values,
    parse_date,
    parse_number,
    title_case,
    year_month,
)
from tidemark.operators.lookup import BROADCAST_BYTES, HotKeys, lookup_join
from tidemark.operators.quantile import flag_outside_band, impute_group_median

# Project status to category.
STATUS_CATEGORIES = {
    "In Progress": "Active",
    "Completed": "Closed",
    "Not Started": "Pending",
    "On Hold": "Pending",
}

# Plausible years of experience and first plausible hire date.
EXPERIENCE_RANGE = (0, 50)
FIRST_HIRE = date(1990, 1, 1)

PLACEHOLDER_EMAIL = "unknown@example.com"


def transform_projects(projects: DataFrame) -> DataFrame:
    """Fill money, normalise the status and derive the six reporting columns.

    Missing budget and cost count as 0 before anything is derived from them.
    """
    budget, cost = F.col("budget"), F.col("actual_cost")
    filled = projects.withColumns(
        {
            "budget": F.coalesce(budget, F.lit(0.0)),
            "actual_cost": F.coalesce(cost, F.lit(0.0)),
            "status": title_case(F.col("status")),
        }
    )
    derived = filled.withColumns(
        {
            "budget_variance": cost - budget,
            "is_over_budget": cost > budget,
            "duration_days": days_between(F.col("start_date"), F.col("end_date")),
            "budget_utilisation_pct": guarded_pct(cost, budget),
            "status_category": map_values(F.col("status"), STATUS_CATEGORIES),
        }
    )
    return derived.withColumn("risk_level", _risk_level())


def _risk_level() -> Column:
    priority = F.col("priority")
    high = (priority == "Critical") | F.col("is_over_budget")
    medium = (priority == "High") | (F.col("budget_utilisation_pct") > 90)
    return F.when(high, "High").when(medium, "Medium").otherwise("Low")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a label column."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def _bare_number() -> Column:
    return F.coalesce(F.col("hire_date").rlike(BARE_NUMBER), F.lit(False))


def _implausible(as_of: date) -> Column:
    text = F.col("hire_date")
    parsed = parse_date(text)
    outside = ~parsed.between(F.lit(FIRST_HIRE), F.lit(as_of))
    return ~_bare_number() & F.coalesce(outside | text.rlike(LONG_YEAR), F.lit(False))


def _out_of_range() -> Column:
    years = parse_number(F.col("years_experience"))
    return ~years.between(*[F.lit(float(x)) for x in EXPERIENCE_RANGE])


def clean_employees(employees: DataFrame, as_of: date, *, fix: str = "p95", slices: int | None = None) -> DataFrame:
    """Repair the text extract of employees; adds ``salary_flagged_outlier``.

    Emails get a placeholder, hire dates that are not dates or implausible become
    null, experience outside the range takes the level's median, and salaries far
    outside their level's band are pulled in (see ``flag_outside_band``).
    """
    typed = employees.withColumns(
        {
            "email": blank_to(F.col("email"), PLACEHOLDER_EMAIL),
            "hire_date": F.when(~(_bare_number() | _implausible(as_of)), parse_date(F.col("hire_date"))),
            "years_experience": parse_number(F.col("years_experience")),
            "salary": parse_number(F.col("salary")),
        }
    )
    low, high = EXPERIENCE_RANGE
    aged = impute_group_median(typed, "level", "years_experience", low=low, high=high, slices=slices)
    return flag_outside_band(aged, "level", "salary", "salary_flagged_outlier", fix=fix, slices=slices)


def status_conflicts(employees: DataFrame) -> DataFrame:
    """Managers that are inactive but still have active reports, with the number of reports.

    Reports are counted per manager before the join, so a manager of very many
    people does not become one big task.
    """
    reports = (
        employees.filter((F.col("status") == "Active") & F.col("manager_id").isNotNull())
        .groupBy("manager_id")
        .agg(F.count(F.lit(1)).alias("active_reports"))
    )
    inactive = employees.filter(F.col("status") == "Inactive").select(F.col("employee_id").alias("manager_id"))
    return reports.join(inactive, "manager_id", "left_semi")


def employee_quality_summary(employees: DataFrame, cleaned: DataFrame, as_of: date) -> DataFrame:
    """One row: how many values each rule found."""
    found = employees.agg(
        count_where(is_blank(F.col("email"))).alias("missing_email_fixed"),
        count_where(_bare_number()).alias("invalid_hire_date_format_fixed"),
        count_where(_implausible(as_of)).alias("implausible_hire_date_fixed"),
        count_where(_out_of_range()).alias("years_experience_out_of_range_fixed"),
    )
    banded = cleaned.agg(count_where(F.col("salary_flagged_outlier")))
    conflicts = status_conflicts(employees).agg(F.coalesce(F.sum("active_reports"), F.lit(0)))
    return found.withColumns(
        {"salary_level_mismatch_fixed": banded.scalar(), "status_conflicts_found": conflicts.scalar()}
    )


def enrich_transactions(
    transactions: DataFrame, projects: DataFrame, employees: DataFrame, *, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add project and approver names, the approval flag, a 0-filled amount and the month.

    Both lookups are checked for unique keys, so no transaction is ever doubled.
    """
    hot = HotKeys(transactions, ["project_id", "approved_by"])
    named = lookup_join(
        transactions, projects, {"project_id": "project_id"}, ["project_name", "department"], max_bytes=max_bytes, hot=hot)
    approved = lookup_join(
        named, employees, {"approved_by": "employee_id"}, {"approver_full_name": "full_name"}, max_bytes=max_bytes, hot=hot)
    return approved.withColumns(
        {
            "is_approved": F.col("approved_by").isNotNull(),
            "amount_aed": F.coalesce(F.col("amount").cast("double"), F.lit(0.0)),
            "transaction_year_month": year_month(F.col("transaction_date")),
        }
    )
