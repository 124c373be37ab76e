"""Every operator as a query over the test tables: name -> (spark, folder) -> frame."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import count_where, row_count
from tidemark.functions.sums import exact_sum
from tidemark.operators import matching, scd2, star
from tidemark.operators.distinct import distinct_counts, distinct_states, extend_codes
from tidemark.operators.lookup import BROADCAST_BYTES, lookup_join, point_in_time_join
from tidemark.operators.quantile import flag_outside_band, group_quantiles
from tidemark.plans import business, cleaning, dashboard, governance, views
from tidemark.plans import events as ev
from tidemark.quality import checks as dq
from tidemark.quality.config import DATASETS, Checks
from tidemark.quality.constraints import Constraints, constrained_columns, violations
from tidemark.quality.gate import key_completeness
from tidemark.quality.report import stage_rows
from tidemark.session import stage, staging_path
from tidemark.sinks.files import write_csv, write_table
from tidemark.sources.files import calendar_between, null_profile, read_json_records, read_jsonl, read_table, read_typed_csv
from tidemark.streaming import events as st
from tidemark.streaming import late

AS_OF = date(2001, 6, 30)
HIRED_BY = date(2000, 6, 30)
SALT = "tidemark"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return views.table(spark, folder, name)


# --- sources and sinks -------------------------------------------------------


def csv_round_trip(spark, folder):
    part = _table(spark, folder, "part")
    path = staging_path(spark, "part-csv")
    write_csv(part, path)
    return read_typed_csv(spark, path, part.schema)


def csv_text_round_trip(spark, folder):
    """Whole texts with quotes, commas, blanks and line breaks through CSV and back."""
    docs = _table(spark, folder, "documents")
    path = staging_path(spark, "documents-csv")
    write_csv(docs, path)
    return read_typed_csv(spark, path, docs.schema, multi_line=True)


def _with_nan(df, column, key):
    """The column as NaN in every 97th key."""
    return df.withColumn(column, F.when(F.col(key) % 97 == 0, F.lit(float("nan"))).otherwise(F.col(column).cast("double")))


def null_profile_nan(spark, folder):
    lines = _table(spark, folder, "lineitem").select("l_orderkey", "l_discount", "l_tax")
    return null_profile(_with_nan(lines, "l_discount", "l_orderkey"))


def null_profile_customer(spark, folder):
    return null_profile(_table(spark, folder, "customer"))


def json_round_trip(spark, folder):
    supplier = _table(spark, folder, "supplier")
    path = staging_path(spark, "supplier-json")
    arrays = F.concat(F.lit("["), F.to_json(F.struct(*supplier.columns)), F.lit("]"))
    supplier.select(arrays.alias("value")).write.text(path)
    return read_json_records(spark, path, supplier.schema, date_columns=(), multi_line=False)


def json_array_round_trip(spark, folder):
    """Documents as arrays over many lines, one array a file and up to 100,000 documents each, read by all their splits."""
    docs = _table(spark, folder, "documents")
    path = staging_path(spark, "document-arrays")
    record = F.to_json(F.struct(*docs.columns), {"pretty": "true"})
    numbered = docs.select(F.expr("doc_id div 100000").alias("file"), "doc_id", record.alias("value"))
    first = F.row_number().over(Window.partitionBy("file").orderBy("doc_id", "value")) == 1
    records = numbered.withColumn("at", F.when(first, 0).otherwise(1)).select(
        "file", "doc_id", F.concat(F.when(F.col("at") == 0, "[").otherwise(","), "value").alias("value"), "at")
    ends = numbered.select("file").distinct().select(
        "file", F.lit(None).cast("long").alias("doc_id"), F.lit("]").alias("value"), F.lit(2).alias("at"))
    whole = records.unionByName(ends).repartition("file").sortWithinPartitions("file", "at", "doc_id")
    whole.select("file", "value").write.partitionBy("file").text(path)
    return read_json_records(spark, path, docs.schema, date_columns=())


def jsonl_round_trip(spark, folder):
    """Events as JSON lines, read back by a name pattern."""
    path = staging_path(spark, "events-jsonl")
    source = views.events(spark, folder)
    source.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
            T.StructField("project_id", T.StringType()), T.StructField("user_id", T.LongType()),
            T.StructField("timestamp", T.TimestampNTZType()),
            T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
        ]
    )
    back = read_jsonl(spark, path, schema, pattern="*.json")
    return back.select(
        "event_id", "event_type", "project_id", "user_id",
        F.col("timestamp").alias("event_time"),
        F.col("payload")["severity"].alias("severity"), F.col("payload")["resolved_by"].alias("resolved_by"),
    )


def partitioned_events(spark, folder):
    path = staging_path(spark, "events-by-date")
    dated = _table(spark, folder, "events").withColumn("event_date", F.to_date("ts"))
    write_table(dated, path, partition_by=["event_date"])
    return read_table(spark, path).groupBy("event_date", "event_type").agg(
        row_count().alias("event_count"), exact_sum("value").alias("total_value")
    )


def repeated_write(spark, folder):
    """Writing the daily volume twice leaves it as it was."""
    path = staging_path(spark, "volume")
    volume = stage(ev.daily_event_volume(ev.event_time_parts(views.events(spark, folder))), "volume")
    for _ in range(2):
        write_table(volume, path, partition_by=["event_date"], replace_partitions=True)
    return read_table(spark, path, volume.schema).select("event_date", "event_type", "event_count", "cumulative_count")


def load_row_counts(spark, folder):
    raw = views.raw_projects(spark, folder)
    lines = views.raw_transactions(spark, folder)
    people = views.raw_employees(spark, folder)
    events = views.events(spark, folder)
    return stage_rows(
        {
            ("projects", "raw"): _table(spark, folder, "orders"),
            ("projects", "clean"): cleaning.transform_projects(raw),
            ("employees", "raw"): _table(spark, folder, "customer"),
            ("employees", "clean"): cleaning.clean_employees(people, HIRED_BY),
            ("transactions", "raw"): _table(spark, folder, "lineitem"),
            ("transactions", "clean"): cleaning.enrich_transactions(lines, raw, _approvers(spark, folder)),
            ("events", "raw"): _table(spark, folder, "events"),
            ("events", "clean"): ev.validate_events(events),
        }
    )


# --- cleaning and enrichment -------------------------------------------------


def transform_orders(spark, folder):
    return views.projects(spark, folder)


def clean_customers(spark, folder):
    return cleaning.clean_employees(views.raw_employees(spark, folder), HIRED_BY)


def employee_quality_summary(spark, folder):
    raw = views.raw_employees(spark, folder)
    return cleaning.employee_quality_summary(raw, cleaning.clean_employees(raw, HIRED_BY), HIRED_BY)


def status_conflicts(spark, folder):
    return cleaning.status_conflicts(views.raw_employees(spark, folder))


def _approvers(spark, folder):
    return _table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("employee_id"), F.col("s_name").alias("full_name")
    )


def enrich_lineitems(spark, folder, max_bytes=BROADCAST_BYTES):
    lines = views.raw_transactions(spark, folder)
    return cleaning.enrich_transactions(
        lines, views.raw_projects(spark, folder), _approvers(spark, folder), max_bytes=max_bytes)


def enrich_lineitems_shuffled(spark, folder):
    """The same with both lookup sides too large to broadcast."""
    return enrich_lineitems(spark, folder, max_bytes=0)


def winsorise_band(spark, folder):
    events = _table(spark, folder, "events").select("event_id", "event_type", "value")
    return flag_outside_band(events, "event_type", "value", "flagged")


def value_quantiles(spark, folder, slices=None):
    bands = {"p05": 0.05, "median": 0.5, "p95": 0.95}
    lines = _table(spark, folder, "lineitem")
    exact = group_quantiles(lines, ["l_returnflag"], "l_extendedprice", bands, slices=slices)
    return exact.select("l_returnflag", *[F.round(c, 4).alias(c) for c in bands])


def value_quantiles_nan(spark, folder):
    """NaN is no value: quantiles are those of the other rows."""
    bands = {"p05": 0.05, "median": 0.5, "p95": 0.95}
    lines = _with_nan(_table(spark, folder, "lineitem"), "l_extendedprice", "l_orderkey")
    exact = group_quantiles(lines, ["l_returnflag"], "l_extendedprice", bands)
    return exact.select("l_returnflag", *[F.round(c, 4).alias(c) for c in bands])


def value_quantiles_sliced(spark, folder):
    """The same with the groups split over slices."""
    return value_quantiles(spark, folder, slices=6)


def risk_value_counts(spark, folder):
    return cleaning.value_counts(views.projects(spark, folder), "risk_level")


def dedupe_first(spark, folder):
    lines = _table(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in lines.columns if c not in [*keys, "l_shipdate"]]
    return matching.keep_first(lines, keys, ["l_shipdate", *rest])


# --- aggregates --------------------------------------------------------------


def agg_conditional(spark, folder):
    flag = F.col("l_returnflag")
    return _table(spark, folder, "lineitem").groupBy("l_linestatus").agg(
        row_count().alias("line_count"),
        count_where(flag == "R").alias("disputed"),
        count_where(flag == "N").alias("pending"),
        exact_sum("l_extendedprice").alias("total_price"),
        F.min("l_shipdate").cast("date").alias("first_ship"),
        F.max("l_shipdate").cast("date").alias("last_ship"),
    )


def agg_distinct(spark, folder):
    return _table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )


def distinct_merged_days(spark, folder):
    """Users and projects that met: states kept per day, merged over days into counts per project."""
    events = ev.validate_events(views.events(spark, folder)).filter(F.col("project_id").isNotNull())
    codes = extend_codes(events, "user_id")
    kept = stage(distinct_states(events, ["event_date", "project_id"], "user_id", codes), "daily-users")
    return distinct_counts(kept, ["project_id"], "unique_users")


def agg_share(spark, folder):
    return business.share_of_total(_table(spark, folder, "lineitem"), "l_returnflag", F.col("l_extendedprice"))


# --- dimension with history --------------------------------------------------


def history_dedup(spark, folder):
    return scd2.collapse_same_day(views.history(spark, folder, status=None), views.HISTORY).select(
        "employee_id", "effective_date", "order_id", "previous_salary", "new_salary", "terminal_states"
    )


def _dimension(spark, folder):
    """The numbered versions and what they were built from."""
    changes = scd2.collapse_same_day(views.history(spark, folder), views.HISTORY).drop("terminal_states")
    current = views.snapshot(spark, folder)
    return scd2.build_versions(changes, current, spec=views.HISTORY), changes, current


def dim_customer_scd2(spark, folder):
    return _dimension(spark, folder)[0]


def scd2_multi_current(spark, folder):
    return scd2.several_current(_dimension(spark, folder)[0])


def scd2_version_count(spark, folder):
    return scd2.version_counts(_dimension(spark, folder)[0])


def scd2_overlaps(spark, folder):
    return scd2.version_overlaps(_dimension(spark, folder)[0])


def scd2_row_equation(spark, folder):
    return scd2.row_equation(*_dimension(spark, folder))


def scd2_gaps(spark, folder):
    return scd2.version_gaps(_dimension(spark, folder)[0])


def _broken_dimension(spark, folder):
    """A dimension with a second current version, begun ten days later, for every third key."""
    dimension = _dimension(spark, folder)[0]
    second = dimension.filter(F.col("is_current") & (F.col("employee_id") % 3 == 0)).withColumns(
        {"employee_key": F.col("employee_key") + 1_000_000_000, "valid_from": F.date_add("valid_from", 10)})
    return dimension.unionByName(second)


def scd2_multi_current_broken(spark, folder):
    return scd2.several_current(_broken_dimension(spark, folder))


def scd2_overlaps_broken(spark, folder):
    return scd2.version_overlaps(_broken_dimension(spark, folder))


def scd2_gaps_broken(spark, folder):
    return scd2.version_gaps(_broken_dimension(spark, folder))


def order_overlaps(spark, folder):
    """Orders of a customer that start before an earlier one has shipped."""
    spans = views.raw_projects(spark, folder).select("project_manager_id", "project_id", "start_date", "end_date")
    return matching.overlapping_intervals(
        spans.filter(F.col("end_date") >= F.col("start_date")),
        key="project_manager_id", version="project_id", start="start_date", end="end_date",
    )


def largest_increase(spark, folder):
    return scd2.adjacent_increases(_dimension(spark, folder)[0])


def manager_workload(spark, folder):
    return business.manager_workload(views.projects(spark, folder), _dimension(spark, folder)[0])


def _approved_lines(spark, folder):
    """Line items with the order's customer as approver."""
    return lookup_join(
        views.transactions(spark, folder), _table(spark, folder, "orders"),
        {"project_id": "o_orderkey"}, {"approved_by": "o_custkey"},
    )


def point_in_time_value_merged(spark, folder):
    """The same with the versions too large to broadcast."""
    return point_in_time_value(spark, folder, max_bytes=0)


def point_in_time_value(spark, folder, max_bytes=BROADCAST_BYTES):
    """Lines and amount by whether the approver had a version at the time, and its state."""
    matched = point_in_time_join(
        _approved_lines(spark, folder), _dimension(spark, folder)[0],
        key="approved_by", date="transaction_date", order=views.LINE_ORDER,
        version_key="employee_id", valid_from="valid_from", valid_to="valid_to",
        columns={"version_salary": "salary", "version_current": "is_current"}, max_bytes=max_bytes,
    )
    return matched.groupBy("version_current").agg(
        row_count().alias("line_count"),
        exact_sum("amount_aed").alias("total_amount"),
        exact_sum("version_salary").alias("total_salary"),
    )


# --- star schema -------------------------------------------------------------


def dim_date(spark, folder):
    """Calendar over the whole years covered by orders and shipments."""
    ordered = _table(spark, folder, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    shipped = _table(spark, folder, "lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    span = ordered.unionByName(shipped).agg(F.year(F.min("a")).alias("y0"), F.year(F.max("b")).alias("y1"))
    bounds = span.select(F.make_date("y0", F.lit(1), F.lit(1)).alias("first"),
                         F.make_date("y1", F.lit(12), F.lit(31)).alias("last"))
    return star.dim_date(calendar_between(bounds))


def dim_order(spark, folder):
    return star.dim_project(views.projects(spark, folder))


def _line_vendors(spark, folder):
    named = _table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name")
    )
    used = _table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("vendor_id")).distinct()
    return used.join(named, "vendor_id")


def dim_vendor(spark, folder):
    return star.dim_vendor(_line_vendors(spark, folder))


def bridge_customer_order(spark, folder):
    return star.bridge_employee_project(dim_order(spark, folder), _dimension(spark, folder)[0])


def fact_lineitem_shuffled(spark, folder):
    """The same with all dimensions too large to broadcast, numbered over slices."""
    return fact_lineitem(spark, folder, max_bytes=0, slices=5)


def fact_lineitem(spark, folder, max_bytes=BROADCAST_BYTES, slices=None):
    return star.fact_transactions(
        _approved_lines(spark, folder), dim_order(spark, folder), dim_vendor(spark, folder),
        _dimension(spark, folder)[0],
        order=[c for c in views.LINE_ORDER if c != "amount_aed"] + ["amount_aed"],
        columns=["payment_status"], max_bytes=max_bytes, slices=slices, counted=views.transactions(spark, folder),
    ).drop("amount_aed")


# --- business questions and dashboard ----------------------------------------


def department_budget(spark, folder):
    return business.department_budget(views.projects(spark, folder), threshold=0.80)


def department_budget_all(spark, folder):
    return business.department_budget(views.projects(spark, folder), threshold=None)


def vendor_concentration(spark, folder):
    return business.vendor_concentration(views.transactions(spark, folder), views.vendors(spark, folder))


def open_issues(spark, folder):
    return business.open_issues(views.transactions(spark, folder), views.projects(spark, folder))


def monthly_spend(spark, folder):
    return business.monthly_spend(views.transactions(spark, folder, category=True))


def monthly_spend_trailing(spark, folder):
    return business.monthly_spend(business.trailing_year(views.transactions(spark, folder, category=True)))


def _managers(spark, folder):
    return views.snapshot(spark, folder).select("employee_id", "full_name", "department", "role")


def pending_above_average(spark, folder):
    return business.above_average_pending(
        views.transactions(spark, folder, category=True), views.projects(spark, folder), _managers(spark, folder)
    )


def pending_above_average_sql(spark, folder):
    _managers(spark, folder).createOrReplaceTempView("employees")
    views.projects(spark, folder).createOrReplaceTempView("projects")
    views.transactions(spark, folder, category=True).createOrReplaceTempView("transactions")
    return spark.sql(business.above_average_pending_sql())


def issue_rate(spark, folder):
    disputed = views.transactions(spark, folder).filter(F.col("payment_status") == "Disputed")
    return business.issue_rate(views.projects(spark, folder), disputed)


def kpi_cards(spark, folder):
    return dashboard.kpi_cards(views.projects(spark, folder), views.transactions(spark, folder))


def top10_variance(spark, folder):
    return dashboard.top_variance(views.projects(spark, folder))


def top5_plus_other(spark, folder):
    return dashboard.top_vendors_and_rest(views.transactions(spark, folder), views.vendors(spark, folder))


def all_orders_slicer(spark, folder):
    return dashboard.all_projects(views.projects(spark, folder))


# --- event marts -------------------------------------------------------------


def validate_events(spark, folder):
    return ev.validate_events(views.events(spark, folder)).select(
        "event_id", "event_type", "project_id", "user_id", F.col("timestamp").alias("event_time"),
        "event_date", "event_hour", "event_month",
    )


def validate_events_dirty(spark, folder):
    """Events of which every 97th comes again an hour later and every 89th has no user."""
    events = views.events(spark, folder)
    events = events.withColumn("user_id", F.when(F.col("event_id") % 89 != 0, F.col("user_id")))
    again = events.filter(F.col("event_id") % 97 == 0).withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 hour"))
    return ev.validate_events(events.unionByName(again)).select(
        "event_id", "event_type", "project_id", "user_id", F.col("timestamp").alias("event_time"),
        "event_date", "event_hour", "event_month",
    )


def _mart(name):
    def query(spark, folder):
        clean = ev.validate_events(views.events(spark, folder))
        return ev.show_order(name, ev.MARTS[name](clean))

    return query


def escalation_log_sliced(spark, folder):
    """The escalation log with its groups split over slices."""
    return ev.escalation_log(ev.validate_events(views.events(spark, folder)), slices=6)


def escalation_log_by_user(spark, folder):
    return ev.escalation_log(ev.validate_events(views.events(spark, folder)), group="user_id")


# --- data quality ------------------------------------------------------------

LINE_CHECKS = Checks(key=("l_orderkey", "l_linenumber"))
CUSTOMER_CHECKS = Checks(
    key=("c_custkey",), ranges={"c_acctbal": (0, 9_000)}, outliers=("c_acctbal",),
    rules=({"type": "non_negative", "column": "c_acctbal"},),
)
DOCUMENT_CHECKS = Checks(key=("doc_id",), distribution=("lang", "source"), outliers=("n_chars",))
ORDER_CHECKS = Checks(
    key=("project_id",), dates=("start_date", "end_date"), outliers=("budget",),
    rules=(
        {"type": "before", "columns": ("start_date", "end_date")},
        {"type": "before", "columns": ("start_date", "end_date"), "strict": True},
        {"type": "non_negative", "column": "actual_cost"},
    ),
    fresh_column="start_date", fresh_days=30,
)


def _only(results: DataFrame, check: str) -> DataFrame:
    return results.filter(F.col("check") == check).select("column", "status", "metric")


def dq_completeness(spark, folder):
    results = dq.one_look(views.raw_projects(spark, folder), ORDER_CHECKS, AS_OF)
    return _only(results, "completeness")


def dq_uniqueness(spark, folder):
    tables = {"lineitem": LINE_CHECKS, "customer": CUSTOMER_CHECKS, "documents": DOCUMENT_CHECKS}
    found = [
        dq.uniqueness(_table(spark, folder, name), rule).select(
            F.lit(name).alias("dataset"), "status", "metric", "details"
        )
        for name, rule in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


def dq_numeric_range(spark, folder):
    return _only(dq.one_look(_table(spark, folder, "customer"), CUSTOMER_CHECKS, AS_OF), "validity_numeric")


def dq_date(spark, folder):
    raw = dq.one_look(views.raw_employees(spark, folder), DATASETS["employees"], HIRED_BY)
    orders = dq.one_look(views.raw_projects(spark, folder), ORDER_CHECKS, AS_OF)
    return _only(raw, "validity_date").unionByName(_only(orders, "validity_date"))


def dq_consistency(spark, folder):
    orders = views.raw_projects(spark, folder)
    band = Checks(key=("event_id",), rules=({"type": "band", "column": "value", "group": "event_type"},))
    banded = dq.bands(_table(spark, folder, "events"), band)[0]
    return _only(dq.one_look(orders, ORDER_CHECKS, AS_OF), "consistency").unionByName(_only(banded, "consistency"))


def dq_foreign_keys(spark, folder):
    rule = Checks(
        key=("l_orderkey",),
        references={
            "l_orderkey": ("orders", "o_orderkey"),
            "l_partkey": ("supplier", "s_suppkey"),
            "l_suppkey": ("absent", "s_suppkey"),
        },
    )
    references = {
        "orders": _table(spark, folder, "orders"),
        # most part keys are no supplier keys
        "supplier": _table(spark, folder, "supplier"),
    }
    found = dq.referential_integrity(_table(spark, folder, "lineitem"), rule, references)
    return _only(reduce(DataFrame.unionByName, found), "referential_integrity")


def dq_distribution(spark, folder):
    return _only(dq.distribution(_table(spark, folder, "documents"), DOCUMENT_CHECKS)[0], "distribution")


def dq_freshness(spark, folder):
    return _only(dq.one_look(views.raw_projects(spark, folder), ORDER_CHECKS, AS_OF), "freshness")


def dq_outliers(spark, folder):
    found = [
        dq.outliers(_table(spark, folder, "documents"), DOCUMENT_CHECKS)[0],
        dq.outliers(_table(spark, folder, "customer"), CUSTOMER_CHECKS)[0],
    ]
    return _only(reduce(DataFrame.unionByName, found), "outliers")


def _suite(spark, folder):
    """The three operational datasets with their configured checks."""
    projects = stage(views.raw_projects(spark, folder), "projects")
    employees = stage(views.raw_employees(spark, folder), "employees")
    lines = views.raw_transactions(spark, folder).withColumn(
        "transaction_id", F.concat_ws("-", "project_id", "line_number")
    )
    frames = {"projects": projects, "employees": employees, "transactions": lines}
    results = [
        dq.run_checks(df, name, DATASETS[name], references=frames, as_of=AS_OF) for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, results)


def dq_results(spark, folder):
    return _suite(spark, folder).select("dataset", "check", "column", "status", "metric")


def dq_suite(spark, folder):
    return dq.suite_totals(_suite(spark, folder))


def dq_gate(spark, folder):
    lines = views.raw_transactions(spark, folder)
    frames = {
        "projects": views.raw_projects(spark, folder),
        "employees": views.raw_employees(spark, folder),
        "transactions": lines,
    }
    keys = {"projects": "project_id", "employees": "employee_id", "transactions": "approved_by"}
    return key_completeness(frames, keys)


TABLE_CONSTRAINTS = {
    "region": Constraints(("r_regionkey",), (("r_name",),), ("r_regionkey", "r_name")),
    "nation": Constraints(("n_nationkey",), (("n_name",),), ("n_nationkey",), {"n_regionkey": ("region", "r_regionkey")}),
    "customer": Constraints(("c_custkey",), (("c_name",),), ("c_custkey",), {"c_nationkey": ("nation", "n_nationkey")}),
    "orders": Constraints(("o_orderkey",), (), ("o_orderkey", "o_orderdate"), {"o_custkey": ("customer", "c_custkey")}),
    "lineitem": Constraints(
        ("l_orderkey", "l_linenumber"), (), ("l_orderkey", "l_linenumber"), {"l_orderkey": ("orders", "o_orderkey")}
    ),
}


def dq_table_constraints(spark, folder):
    return violations({name: _table(spark, folder, name) for name in TABLE_CONSTRAINTS}, TABLE_CONSTRAINTS)


def dq_star_constraints(spark, folder):
    """All constraints of the star schema built from the tables."""

    def written(name, table, *more):
        # built once; what no constraint or later table looks at is not written
        return stage(table.select(*dict.fromkeys([*constrained_columns(name), *more])), name)

    projects = written("dim_project", dim_order(spark, folder), "project_manager_id")
    vendors, people = dim_vendor(spark, folder), written("dim_employee", _dimension(spark, folder)[0])
    fact = star.fact_transactions(
        _approved_lines(spark, folder), projects, vendors, people, order=views.LINE_ORDER, columns=[],
        counted=views.transactions(spark, folder),
    )
    return violations({
        "dim_date": written("dim_date", dim_date(spark, folder)), "dim_project": projects,
        "dim_employee": people, "dim_vendor": written("dim_vendor", vendors),
        "bridge_employee_project": written(
            "bridge_employee_project", star.bridge_employee_project(projects, people)),
        "fact_transactions": written("fact_transactions", fact),
    })


# --- streaming ---------------------------------------------------------------


def _stream(spark, folder):
    """The events file as a bounded stream; watermarks need zoned timestamps."""
    schema = _table(spark, folder, "events").schema
    raw = st.file_stream(spark, folder, schema, pattern="events.parquet", file_format="parquet")
    return views.as_events(raw).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _severity():
    return F.col("payload").getItem("severity")


def stream_ingest(spark, folder):
    records = st.as_records(_stream(spark, folder), stamp=False)
    landing = st.Landing.fresh(spark, "ingest")
    st.land(records, landing)
    schema = "event_id bigint, project_id string, user_id bigint, payload map<string,string>"
    return st.landed(spark, records, landing).select(
        F.col("key").alias("event_type"), F.from_json("value", schema).alias("e")
    ).select("event_type", "e.event_id", "e.project_id", "e.user_id", F.col("e.payload")["severity"].alias("severity"))


def _counted(spark, folder):
    counts = st.counts_by_type(_stream(spark, folder))
    landing = st.Landing.fresh(spark, "counts")
    st.land_updates(counts, landing)
    return st.latest(spark, counts, landing, ["event_type"])


def stream_counts(spark, folder):
    return _counted(spark, folder)


def _critical(spark, folder):
    source = _stream(spark, folder)
    everything = st.Landing.fresh(spark, "routed")
    matching_path = staging_path(spark, "critical")
    st.route(source, st.is_critical(_severity()), everything, matching_path)
    return st.routed(spark, source.schema, matching_path)


def stream_critical(spark, folder):
    return _critical(spark, folder).select("event_id", "event_type", "project_id", "user_id", _severity().alias("severity"))


def stream_summary(spark, folder):
    return st.summary(_counted(spark, folder), _critical(spark, folder))


def stream_dedupe(spark, folder):
    source = _stream(spark, folder).select("event_id", "event_type", "user_id", "timestamp")
    unique = st.dedupe(source, keys=["event_id"], time="timestamp", late_by="1 hour", salts=8)
    landing = st.Landing.fresh(spark, "unique")
    st.land(unique, landing)
    return st.landed(spark, unique, landing).select("event_id", "event_type", "user_id")


def stream_daily(spark, folder):
    daily = st.daily_volume(_stream(spark, folder), time="timestamp", late_by="1 hour")
    landing = st.Landing.fresh(spark, "daily")
    st.land_updates(daily, landing)
    return st.latest(spark, daily, landing, ["event_date", "event_type"])


def _scattered(spark, folder):
    """The events with a copy of every tenth, in files that each hold times from all over the table."""
    raw = _table(spark, folder, "events")
    copies = raw.filter(F.col("event_id") % 10 == 0).withColumn("_copy", F.lit(1))
    rows = raw.withColumn("_copy", F.lit(0)).unionByName(copies)
    path = staging_path(spark, "scattered-events")
    rows.repartition(6, F.xxhash64("event_id", "_copy")).drop("_copy").write.parquet(path)
    files = st.file_stream(spark, path, raw.schema, pattern="*.parquet", file_format="parquet", files_per_batch=2)
    return views.as_events(files).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def stream_unique_late(spark, folder):
    events = _scattered(spark, folder).select("event_id", "event_type", "user_id", "timestamp")
    landing = st.Landing.fresh(spark, "unique-late")
    late.land_unique(events, landing, keys=["event_id"], time="timestamp", late_by="1 hour")
    parts = [late.unique_rows(spark, events, landing, late=x) for x in (False, True)]
    return parts[0].unionByName(parts[1]).select("event_id", "event_type", "user_id")


def stream_daily_restated(spark, folder):
    landing = st.Landing.fresh(spark, "daily-late")
    late.land_daily(_scattered(spark, folder), landing, time="timestamp", late_by="1 hour")
    return late.daily_counts(spark, landing).select("event_date", "event_type", "event_count")


# --- governance --------------------------------------------------------------

CUSTOMER_CLASSES = {
    "c_custkey": governance.INTERNAL, "c_name": governance.PII, "c_nationkey": governance.INTERNAL,
    "c_acctbal": governance.CONFIDENTIAL, "c_mktsegment": governance.INTERNAL,
}
ORDER_CLASSES = {
    "o_orderkey": governance.INTERNAL, "o_custkey": governance.PII, "o_orderstatus": governance.INTERNAL,
    "o_totalprice": governance.CONFIDENTIAL, "o_orderdate": governance.INTERNAL,
}


def column_classes(spark, folder):
    return governance.classify_columns(
        _table(spark, folder, "customer"), "customer", CUSTOMER_CLASSES
    ).unionByName(governance.classify_columns(_table(spark, folder, "orders"), "orders", ORDER_CLASSES))


def persona_view(spark, folder):
    return governance.persona_view(
        _table(spark, folder, "customer"), "employees", "BI Analyst", hidden=["c_acctbal"]
    )


def persona_view_aggregated(spark, folder):
    return governance.persona_view(
        _table(spark, folder, "customer"), "employees", "Executive", group=["c_mktsegment"],
        measures={"headcount": row_count(), "total_balance": exact_sum("c_acctbal")},
    )


def retention_split(spark, folder):
    orders = _table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return governance.retention_split(orders, "o_orderdate", AS_OF, governance.RETENTION["transactions"])


def pseudonymise(spark, folder):
    people = _table(spark, folder, "customer")
    return governance.pseudonymise(
        people, ids=["c_custkey"], names=["c_name"], salt=SALT, expired=F.col("c_acctbal") < 0
    )


def free_text_audit(spark, folder):
    return governance.free_text_audit(_table(spark, folder, "documents"), "text", "source")


QUERIES = {
    fn.__name__: fn
    for fn in [
        csv_round_trip, csv_text_round_trip, null_profile_nan, json_round_trip, json_array_round_trip, jsonl_round_trip, partitioned_events, repeated_write, load_row_counts,
        transform_orders, clean_customers, employee_quality_summary, status_conflicts, enrich_lineitems,
        enrich_lineitems_shuffled, winsorise_band, value_quantiles, value_quantiles_sliced, value_quantiles_nan, risk_value_counts, dedupe_first,
        agg_conditional, agg_distinct, distinct_merged_days, agg_share,
        history_dedup, dim_customer_scd2, scd2_multi_current, scd2_version_count, scd2_overlaps,
        scd2_row_equation, scd2_gaps, scd2_multi_current_broken, scd2_overlaps_broken, scd2_gaps_broken, order_overlaps, largest_increase, manager_workload, point_in_time_value, point_in_time_value_merged,
        dim_date, dim_order, dim_vendor, bridge_customer_order, fact_lineitem, fact_lineitem_shuffled,
        department_budget, department_budget_all, vendor_concentration, open_issues, monthly_spend,
        monthly_spend_trailing, pending_above_average, pending_above_average_sql, issue_rate,
        kpi_cards, top10_variance, top5_plus_other, all_orders_slicer,
        validate_events, validate_events_dirty, escalation_log_sliced, escalation_log_by_user,
        dq_completeness, dq_uniqueness, dq_numeric_range, dq_date, dq_consistency, dq_foreign_keys,
        dq_distribution, dq_freshness, dq_outliers, dq_results, dq_suite, dq_gate,
        dq_table_constraints, dq_star_constraints,
        stream_ingest, stream_counts, stream_critical, stream_summary, stream_dedupe, stream_daily,
        stream_unique_late, stream_daily_restated,
        column_classes, persona_view, persona_view_aggregated, retention_split, pseudonymise, free_text_audit,
    ]
}
QUERIES["null_profile"] = null_profile_customer
for _name in ev.MARTS:
    QUERIES[_name] = _mart(_name)
