"""Extracts behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_where, row_count, share_pct
from tidemark.functions.sums import exact_sum
from tidemark.plans.business import department_budget, monthly_spend, vendor_spend
from tidemark.sinks.files import write_csv


def kpi_cards(projects: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row of headline numbers."""
    return projects.agg(
        exact_sum("budget").alias("total_budget"),
        exact_sum("actual_cost").alias("total_actual_spend"),
        share_pct(count_where(F.col("is_over_budget")), row_count()).alias("pct_over_budget_projects"),
    ).withColumn("total_transactions", transactions.agg(row_count()).scalar())


_SLICERS = ["project_id", "project_name", "department", "region", "status", "status_category", "priority"]
_FIGURES = ["budget", "actual_cost", "budget_variance", "is_over_budget", "risk_level"]


def top_variance(projects: DataFrame, top: int = 10) -> DataFrame:
    """Projects with the largest overspend."""
    return projects.select(*_SLICERS, *_FIGURES).orderBy(F.desc("budget_variance"), "project_id").limit(top)


def top_vendors_and_rest(transactions: DataFrame, vendors: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` vendors by spend and one row for all others.

    Ranking uses the limit operator, so no task sees all vendors.
    """
    spend = vendor_spend(transactions, vendors).select("vendor_name", "total_spend")
    leaders = spend.orderBy(F.desc("total_spend"), "vendor_name").limit(top)
    # at most ``top`` rows; spend without a vendor name is one group, so names compare null-safe
    named = F.broadcast(leaders.select(F.col("vendor_name").alias("_leader")))
    rest = spend.join(named, F.col("vendor_name").eqNullSafe(F.col("_leader")), "left_anti")
    other = rest.agg(F.lit("Other").alias("vendor_name"), exact_sum("total_spend").alias("total_spend"))
    return leaders.unionByName(other.filter(F.col("total_spend").isNotNull())).orderBy(F.desc("total_spend"))


def all_projects(projects: DataFrame) -> DataFrame:
    """Every project with its start year, for the slicers."""
    return projects.select(*_SLICERS, F.year("start_date").alias("project_year"), *_FIGURES)


def export_extracts(projects: DataFrame, transactions: DataFrame, vendors: DataFrame, out: str) -> list[str]:
    """Write every extract as header CSV below ``out``; only the full project list may be several files."""
    extracts = {
        "kpi_cards": kpi_cards(projects, transactions),
        "department_budget_vs_actual": department_budget(projects, threshold=None),
        "monthly_spend_by_category": monthly_spend(transactions),
        "top10_budget_variance": top_variance(projects),
        "vendor_concentration_top5_other": top_vendors_and_rest(transactions, vendors),
        "all_projects": all_projects(projects),
    }
    for name, extract in extracts.items():
        write_csv(extract, f"{out}/{name}", single_file=name != "all_projects")
    return sorted(extracts)
