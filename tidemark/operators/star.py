"""Builders of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import date_key
from tidemark.operators.lookup import BROADCAST_BYTES, HotKeys, lookup_join, point_in_time_join
from tidemark.operators.ordered import number_rows
from tidemark.session import stage


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame with ``full_date`` (ISO weeks, Monday = 1)."""
    d = F.col("full_date")
    weekday = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )


# Column order of the project dimension.
PROJECT_COLUMNS = [
    "project_id", "project_name", "department", "status", "status_category", "start_date", "end_date",
    "budget", "actual_cost", "budget_variance", "is_over_budget", "duration_days",
    "budget_utilisation_pct", "risk_level", "project_manager_id", "priority", "region",
]


def dim_project(projects: DataFrame, slices: int | None = None) -> DataFrame:
    """Cleaned projects with a surrogate key in natural order."""
    listed = projects.select(*PROJECT_COLUMNS)
    return number_rows(listed, ["project_id"], "project_key", slices, grouped=listed.select("project_id"))


def dim_vendor(transactions: DataFrame, slices: int | None = None) -> DataFrame:
    """Distinct vendors of the transactions."""
    vendors = transactions.select("vendor_id", "vendor_name").distinct()
    return number_rows(vendors, ["vendor_id", "vendor_name"], "vendor_key", slices)


def bridge_employee_project(projects: DataFrame, employees: DataFrame, slices: int | None = None) -> DataFrame:
    """Who manages a project today: project keys against the open employee version."""
    current = employees.filter("is_current")
    managed = lookup_join(
        projects.select("project_key", "project_manager_id"), current,
        {"project_manager_id": "employee_id"}, ["employee_key"], how="inner",
    )
    linked = managed.select("employee_key", "project_key", F.lit("Manager").alias("project_role"))
    return number_rows(linked, ["project_key"], "bridge_key", slices)


def fact_transactions(
    transactions: DataFrame,
    projects: DataFrame,
    vendors: DataFrame,
    employees: DataFrame,
    *,
    order: list[str],
    columns: list[str],
    slices: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Transactions with dimension keys; the approver as of the transaction date.

    ``order`` is the natural order of the surrogate key, ``columns`` are kept as
    they are. Transactions without a match keep a null key. Dimensions above
    ``max_bytes`` are shuffled; the hot keys of both lookups are counted in one pass.
    Of projects and vendors only the pairs of keys are written, so that measuring and
    joining them does not build the dimensions twice. The surrogate key is a matter of the
    transactions alone, so they are numbered first, inside their project where ``order`` begins
    with it: then the lookup by project needs no further shuffle, and columns of the order that
    nobody asks for are not carried on. ``counted`` is a frame with the transactions' project and
    vendor that costs less to read.
    """
    kept = [c for c in columns if c not in order]
    counted = transactions if counted is None else counted
    projects = stage(projects.select("project_id", "project_key"), "project-keys")
    vendors = stage(vendors.select("vendor_id", "vendor_key"), "vendor-keys")
    carried = [*order, "project_id", "vendor_id", "approved_by", "transaction_date", "amount_aed", *kept]
    transactions = transactions.select(*dict.fromkeys(carried))
    hot = HotKeys(counted, ["project_id", "vendor_id"])
    numbered = number_rows(
        transactions, order, "transaction_key", slices,
        grouped=counted.select("project_id") if order[0] == "project_id" else None)
    with_project = lookup_join(
        numbered, projects, {"project_id": "project_id"}, ["project_key"], max_bytes=max_bytes, hot=hot)
    with_vendor = lookup_join(
        with_project, vendors, {"vendor_id": "vendor_id"}, ["vendor_key"], max_bytes=max_bytes, hot=hot)
    resolved = point_in_time_join(
        with_vendor, employees, key="approved_by", date="transaction_date", order=order,
        version_key="employee_id", valid_from="valid_from", valid_to="valid_to",
        columns={"employee_key": "employee_key"}, max_bytes=max_bytes, slices=slices, counted=transactions,
    )
    return resolved.select(
        "transaction_key", *order, "project_key", "employee_key", "vendor_key",
        date_key(F.col("transaction_date")).alias("date_key"),
        F.col("amount_aed").alias("amount"), *kept,
    )
