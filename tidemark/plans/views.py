"""The entities of the library seen in the TPC-H-like test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import map_values
from tidemark.operators.lookup import lookup_join
from tidemark.operators.ordered import Running, in_order
from tidemark.operators.scd2 import HistorySpec
from tidemark.plans.cleaning import transform_projects

HISTORY = HistorySpec(
    tiebreak=("order_id",),
    versioned={"role": "new_role", "salary": "new_salary"},
)

# Order of the transactions' surrogate key: all columns that tell line items apart.
LINE_ORDER = [
    "project_id", "line_number", "part_id", "vendor_id", "transaction_date", "amount_aed", "quantity",
    "discount", "tax", "return_flag", "line_status",
]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their nation and region name; both tables are tiny, which Spark sees from the files."""
    nation = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def raw_projects(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as projects; cost and end date come from their line items.

    Line items are summed per order before the join. Both sides of it are then
    unique in the order key and hash-partitioned by it. The net price is counted
    in whole 1/10000 units and rounded to cents once per order.
    """
    paid_pct = F.lit(100) - F.rint(F.col("l_discount") * 100).cast("long")
    net = (F.rint(F.col("l_extendedprice") * 100).cast("long") * paid_pct).cast("decimal(18,0)")
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        (F.round(F.sum(net), -2).cast("double") / 10_000).alias("actual_cost"),
        F.max("l_shipdate").cast("date").alias("end_date"),
    )
    orders = table(spark, folder, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    placed = lookup_join(orders, people(spark, folder), {"o_custkey": "c_custkey"}, ["c_mktsegment", "r_name"])
    return placed.select(
        F.col("o_orderkey").alias("project_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("project_name"),
        F.col("c_mktsegment").alias("department"),
        map_values(
            F.col("o_orderstatus"), {"F": "Completed", "O": " in progress", "P": "ON HOLD "}
        ).alias("status"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        "end_date",
        F.col("o_totalprice").alias("budget"),
        "actual_cost",
        F.col("o_custkey").alias("project_manager_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Critical")
        .when(F.col("o_orderpriority") == "2-HIGH", "High")
        .otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("r_name").alias("region"),
    )


def projects(spark: SparkSession, folder: str) -> DataFrame:
    return transform_projects(raw_projects(spark, folder))


def first_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("hire_date")
    )


def raw_employees(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as an employee extract in text form.

    Customers in debt (negative balance) play the dirty rows: they have no email, a
    number where the date should be, and are inactive. The manager is the customer
    numbered like the nation.
    """
    balance = F.col("c_acctbal")
    debt = balance < 0
    since = people(spark, folder).join(
        first_orders(spark, folder), F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    return since.select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_name").alias("full_name"),
        F.when(debt, " ").otherwise(
            F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com"))
        ).alias("email"),
        F.col("c_mktsegment").alias("department"),
        F.col("n_name").alias("role"),
        F.col("c_mktsegment").alias("level"),
        F.when(debt, F.floor(balance).cast("string")).otherwise(F.col("hire_date").cast("string")).alias("hire_date"),
        balance.cast("string").alias("salary"),
        F.col("c_nationkey").cast("long").alias("manager_id"),
        F.col("r_name").alias("region"),
        F.when(debt, "Inactive").otherwise("Active").alias("status"),
        F.floor(balance / F.lit(180.0)).cast("string").alias("years_experience"),
    )


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The current state of every customer."""
    since = people(spark, folder).join(
        first_orders(spark, folder), F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    return since.select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("department"),
        F.col("n_name").alias("role"),
        F.col("c_acctbal").alias("salary"),
        "hire_date",
        F.col("r_name").alias("region"),
    )


def history(spark: SparkSession, folder: str, status: str | None = "F") -> DataFrame:
    """A customer's orders as salary changes; the old value is the order before."""
    orders = table(spark, folder, "orders").filter(F.col("o_custkey").isNotNull())
    if status:
        orders = orders.filter(F.col("o_orderstatus") == status)
    changes = orders.select(
        F.col("o_custkey").alias("employee_id"),
        F.col("o_orderdate").cast("date").alias("effective_date"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("new_salary"),
        F.col("o_orderpriority").alias("new_role"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("change_reason"),
    )
    before = {"previous_salary": Running("last", F.col("new_salary"), prior=True)}
    return in_order(changes, ["employee_id"], ["effective_date", "order_id"]).running(before).plain()


def vendors(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers, named by their nation."""
    named = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return named.select(F.col("s_suppkey").alias("vendor_id"), F.col("n_name").alias("vendor_name"))


def transactions(spark: SparkSession, folder: str, *, category: bool = False) -> DataFrame:
    """Line items as transactions. ``category`` adds the part's type."""
    lines = table(spark, folder, "lineitem")
    if category:
        lines = lookup_join(lines, table(spark, folder, "part"), {"l_partkey": "p_partkey"}, {"category": "p_type"})
    extra = ["category"] if category else []
    return lines.select(
        F.col("l_orderkey").alias("project_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_extendedprice").alias("amount_aed"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        map_values(F.col("l_returnflag"), {"N": "Pending", "R": "Disputed", "A": "Paid"}).alias("payment_status"),
        *extra,
    )


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as the raw extract: no amount where neither discount nor tax is set, and
    approved by the supplier only once finished."""
    priced = (F.col("discount") > 0) | (F.col("tax") > 0)
    return transactions(spark, folder).drop("amount_aed").withColumns(
        {
            "amount": F.when(priced, F.col("amount")),
            "approved_by": F.when(F.col("line_status") == "F", F.col("vendor_id")),
        }
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return as_events(table(spark, folder, "events"))


def as_events(raw: DataFrame) -> DataFrame:
    """Test events in the library's event shape; sessions have no project."""
    k = F.from_json("props", "map<string,string>").getItem("k")
    kind = map_values(
        F.col("event_type"),
        {
            "error": "escalation_raised", "purchase": "escalation_resolved", "view": "login",
            "signup": "logout", "click": "task_completed",
        },
    )
    number = k.cast("int")
    severity = (
        F.when(number >= 75, "Critical").when(number >= 50, "High").when(number >= 25, "Medium").otherwise("Low")
    )
    payload = F.create_map(
        F.lit("severity"), severity, F.lit("resolved_by"), F.concat(F.lit("user-"), F.col("user_id"))
    )
    return raw.select(
        "event_id",
        kind.alias("event_type"),
        F.when(~kind.isin("login", "logout"), k).alias("project_id"),
        "user_id",
        F.col("ts").alias("timestamp"),
        payload.alias("payload"),
    )
