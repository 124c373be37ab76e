"""Business questions over projects, transactions and the employee dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import count_where, row_count, share_pct, year_month
from tidemark.functions.sums import exact_sum, merged_value, state_value, sum_state
from tidemark.operators.lookup import lookup_join


def _budget_by_department(projects: DataFrame) -> DataFrame:
    totals = projects.groupBy("department").agg(
        exact_sum("budget").alias("total_budget"),
        exact_sum("actual_cost").alias("total_actual_cost"),
    )
    spent, budget = F.col("total_actual_cost"), F.col("total_budget")
    return totals.select(
        "department", "total_budget", "total_actual_cost",
        share_pct(spent, budget).alias("spend_percentage"),
        (spent > budget).alias("over_budget"),
    )


def department_budget(projects: DataFrame, threshold: float | None = 0.90) -> DataFrame:
    """Departments that spent more than ``threshold`` of their budget; ``None`` keeps all."""
    totals = _budget_by_department(projects)
    if threshold is not None:
        used = F.col("total_actual_cost") / F.nullif(F.col("total_budget"), F.lit(0.0))
        totals = totals.filter(used > threshold)
    return totals.orderBy(F.desc("spend_percentage"), "department")


def manager_workload(projects: DataFrame, employees: DataFrame, more_than: int = 3) -> DataFrame:
    """Managers of more than ``more_than`` active projects, with their current name.

    Projects are aggregated per manager first; only the managers found are joined.
    """
    busy = (
        projects.filter(F.col("status_category") == "Active")
        .groupBy(F.col("project_manager_id").alias("employee_id"))
        .agg(
            row_count().alias("active_project_count"),
            exact_sum("budget").alias("combined_budget_responsibility"),
            exact_sum("actual_cost").alias("combined_actual_spend"),
        )
        .filter(F.col("active_project_count") > more_than)
    )
    current = employees.filter("is_current").select("employee_id", "full_name", "email")
    return busy.join(current, "employee_id").orderBy(F.desc("active_project_count"), "employee_id")


def vendor_spend(transactions: DataFrame, vendors: DataFrame) -> DataFrame:
    """Spend and rows per vendor name; transactions are summed per id before the lookup."""
    per_id = transactions.groupBy("vendor_id").agg(
        sum_state("amount_aed").alias("_spend"), row_count().alias("_rows")
    )
    named = lookup_join(per_id, vendors, {"vendor_id": "vendor_id"}, ["vendor_name"], how="inner")
    return named.groupBy("vendor_name").agg(
        merged_value("_spend").alias("total_spend"),
        F.sum("_rows").alias("transaction_count"),
    )


def vendor_concentration(
    transactions: DataFrame, vendors: DataFrame, *, above: float = 5.0, high: float = 10.0
) -> DataFrame:
    """Vendors holding more than ``above`` percent of the spend."""
    spend = vendor_spend(transactions, vendors)
    # The total asks for all columns of the groups, so that it reuses their shuffle instead of reading the rows again.
    both = spend.agg(F.struct(exact_sum("total_spend").alias("spend"), F.sum("transaction_count").alias("n")).alias("t"))
    total = both.scalar()["spend"]
    share = F.lit(100.0) * F.col("total_spend") / total
    flag = F.when(share > high, "HIGH").when(share > above, "MEDIUM").otherwise("NORMAL")
    return (
        spend.filter(share > above)
        .select(
            "vendor_name", "total_spend", "transaction_count",
            F.round(share, 2).alias("percentage_of_total_spend"), flag.alias("risk_flag"),
        )
        .orderBy(F.desc("percentage_of_total_spend"), "vendor_name")
    )


def open_issues(transactions: DataFrame, projects: DataFrame, above: float = 50_000) -> DataFrame:
    """Projects whose pending and disputed transactions add up to more than ``above``.

    The sum is taken per project before the join, which then has unique keys on both sides.
    """
    unsettled = (
        transactions.filter(F.col("payment_status").isin("Pending", "Disputed"))
        .groupBy("project_id")
        .agg(
            row_count().alias("open_transaction_count"),
            exact_sum("amount_aed").alias("open_transaction_value"),
        )
        .filter(F.col("open_transaction_value") > above)
    )
    about = projects.select("project_id", "project_name", "department", F.col("status").alias("project_status"))
    return unsettled.join(about, "project_id").orderBy(F.desc("open_transaction_value"), "project_id")


def monthly_spend(transactions: DataFrame) -> DataFrame:
    """Spend per month and category with running total and change from the month before.

    Months are grouped as dates and written as text afterwards. The windows run over
    the monthly sums, a bounded number of rows per category.
    """
    monthly = (
        transactions.groupBy(F.trunc("transaction_date", "month").alias("_month"), "category")
        .agg(sum_state("amount_aed").alias("_spend"))
        .withColumns({"year_month": year_month(F.col("_month")), "_value": state_value("_spend")})
    )
    by_category = Window.partitionBy("category").orderBy("year_month")
    upto = "PARTITION BY category ORDER BY year_month ROWS UNBOUNDED PRECEDING"
    spend = F.col("_value")
    before = F.lag(spend).over(by_category)
    return monthly.select(
        "year_month", "category", spend.alias("monthly_spend"),
        merged_value("_spend", upto).alias("running_total"),
        F.round(F.lit(100.0) * (spend - before) / F.nullif(before, F.lit(0.0)), 2).alias("month_over_month_pct_change"),
    ).orderBy("category", "year_month")


def trailing_year(transactions: DataFrame, months: int = 12) -> DataFrame:
    """Transactions of the last ``months`` months of the data."""
    since = transactions.agg(F.add_months(F.max("transaction_date"), -months)).scalar()
    return transactions.filter(F.col("transaction_date") > since)


def above_average_pending(transactions: DataFrame, projects: DataFrame, employees: DataFrame) -> DataFrame:
    """Pending transactions above the pending average, on projects neither completed nor on hold."""
    pending = transactions.filter(F.col("payment_status") == "Pending").select(
        "project_id", "amount", "category", "payment_status", "transaction_date"
    )
    average = pending.agg(exact_sum("amount") / F.count("amount")).scalar()
    large = pending.filter(F.col("amount") > average)
    open_projects = projects.filter(~F.col("status").isin("Completed", "On Hold"))
    with_project = lookup_join(
        large, open_projects, {"project_id": "project_id"},
        {c: c for c in ("project_name", "status", "budget", "actual_cost", "project_manager_id")},
        how="inner",
    )
    with_manager = lookup_join(
        with_project, employees, {"project_manager_id": "employee_id"},
        ["full_name", "department", "role"], how="inner",
    )
    return with_manager.select(
        "full_name", "department", "role", "project_name", "status", "budget", "actual_cost",
        "amount", "category", "payment_status", "transaction_date",
    ).orderBy("department", F.desc("amount"))


def above_average_pending_sql() -> str:
    """The same question as SQL text over views ``employees``, ``projects`` and ``transactions``."""
    return """
        WITH pending AS (SELECT project_id, amount, category, payment_status, transaction_date
                         FROM transactions WHERE payment_status = 'Pending'),
             average AS (SELECT cast(sum(cast(rint(amount * 100) AS decimal(18, 0))) AS double) / 100 / count(amount) AS amount
                         FROM pending)
        SELECT full_name, employees.department, role, project_name, projects.status, budget, actual_cost,
               pending.amount, category, payment_status, transaction_date
        FROM pending, projects, employees
        WHERE pending.amount > (SELECT amount FROM average)
          AND pending.project_id = projects.project_id
          AND projects.status <> 'Completed' AND projects.status <> 'On Hold'
          AND projects.project_manager_id = employees.employee_id
    """


def issue_rate(projects: DataFrame, issues: DataFrame) -> DataFrame:
    """Every project with whether it appears in ``issues``, and the overall percentage."""
    raised = issues.select("project_id").filter(F.col("project_id").isNotNull()).distinct()
    flagged = projects.select("project_id", "project_name", "status").join(
        raised.withColumn("_issue", F.lit(True)), "project_id", "left"
    ).select("project_id", "project_name", "status", F.coalesce("_issue", F.lit(False)).alias("had_issue"))
    overall = flagged.agg(share_pct(count_where(F.col("had_issue")), row_count())).scalar()
    return flagged.withColumn("issue_pct", overall)


def share_of_total(df: DataFrame, group: str, value: Column) -> DataFrame:
    """Group sum, and its percentage of the grand total (no group holds the whole table)."""
    sums = df.select(group, value.alias("_value")).groupBy(group).agg(sum_state("_value").alias("_state"))
    whole = sums.agg(merged_value("_state")).scalar()
    return sums.select(group, state_value("_state").alias("total")).withColumn("share_pct", share_pct(F.col("total"), whole))
