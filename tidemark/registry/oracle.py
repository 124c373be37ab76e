"""The same answers as SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

from tidemark.plans.governance import PERSONAL_DATA
from tidemark.registry.queries import AS_OF, HIRED_BY, SALT

def quantiles(source: str, group: str, value: str, wanted: dict[str, float]) -> str:
    """Linear interpolation written out, low + (high - low) * fraction."""
    picks = ", ".join(
        f"""MAX(CASE WHEN i = floor((n - 1) * {q}::DOUBLE) THEN v END)
        + (MAX(CASE WHEN i = ceil((n - 1) * {q}::DOUBLE) THEN v END) - MAX(CASE WHEN i = floor((n - 1) * {q}::DOUBLE) THEN v END))
        * ((MAX(n) - 1) * {q}::DOUBLE - floor((MAX(n) - 1) * {q}::DOUBLE)) AS {name}"""
        for name, q in wanted.items()
    )
    return f"""SELECT g, {picks} FROM (
      SELECT {group} AS g, {value} AS v, COUNT(*) OVER (PARTITION BY {group}) AS n,
        ROW_NUMBER() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS i
      FROM {source} WHERE {value} IS NOT NULL) GROUP BY g"""


BAND = {"p05": 0.05, "p95": 0.95}

PEOPLE = """
people AS (
  SELECT c.*, n_name, r_name FROM customer c
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
first_orders AS (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS hire_date FROM orders GROUP BY o_custkey)"""

RAW_PROJECTS = f"""{PEOPLE},
line_totals AS (
  SELECT l_orderkey,
    CAST(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(18,2)) AS DOUBLE) AS actual_cost,
    CAST(MAX(l_shipdate) AS DATE) AS end_date
  FROM lineitem GROUP BY l_orderkey),
raw_projects AS (
  SELECT o_orderkey AS project_id, 'Order ' || o_orderkey AS project_name, c_mktsegment AS department,
    CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN ' in progress' WHEN 'P' THEN 'ON HOLD ' END AS status,
    CAST(o_orderdate AS DATE) AS start_date, end_date, o_totalprice AS budget, actual_cost,
    o_custkey AS project_manager_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' ELSE o_orderpriority END AS priority,
    r_name AS region
  FROM orders LEFT JOIN line_totals ON o_orderkey = l_orderkey LEFT JOIN people ON o_custkey = c_custkey)"""

PROJECTS = f"""{RAW_PROJECTS},
filled AS (
  SELECT * REPLACE (
    COALESCE(budget, 0) AS budget, COALESCE(actual_cost, 0) AS actual_cost,
    CASE trim(lower(status)) WHEN 'completed' THEN 'Completed' WHEN 'in progress' THEN 'In Progress'
      WHEN 'on hold' THEN 'On Hold' END AS status)
  FROM raw_projects),
projects AS (
  SELECT *, CASE WHEN priority = 'Critical' OR is_over_budget THEN 'High'
                 WHEN priority = 'High' OR budget_utilisation_pct > 90 THEN 'Medium' ELSE 'Low' END AS risk_level
  FROM (SELECT *, actual_cost - budget AS budget_variance, actual_cost > budget AS is_over_budget,
          CAST(end_date - start_date AS INTEGER) AS duration_days,
          CASE WHEN budget > 0 THEN actual_cost / budget * 100 END AS budget_utilisation_pct,
          CASE status WHEN 'In Progress' THEN 'Active' WHEN 'Completed' THEN 'Closed'
            WHEN 'Not Started' THEN 'Pending' WHEN 'On Hold' THEN 'Pending' END AS status_category
        FROM filled))"""

RAW_EMPLOYEES = f"""{PEOPLE},
raw_employees AS (
  SELECT c_custkey AS employee_id, c_name AS full_name,
    CASE WHEN c_acctbal < 0 THEN ' ' ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
    c_mktsegment AS department, n_name AS role, c_mktsegment AS level,
    CASE WHEN c_acctbal < 0 THEN CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) ELSE CAST(hire_date AS VARCHAR) END AS hire_date,
    c_acctbal AS salary, CAST(c_nationkey AS BIGINT) AS manager_id, r_name AS region,
    CASE WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status,
    floor(c_acctbal / 180.0) AS years_experience
  FROM people LEFT JOIN first_orders ON c_custkey = o_custkey)"""

CLEAN_EMPLOYEES = f"""{RAW_EMPLOYEES},
typed AS (
  SELECT * REPLACE (
    CASE WHEN trim(email) = '' THEN 'unknown@example.com' ELSE email END AS email,
    CASE WHEN TRY_CAST(hire_date AS DATE) BETWEEN DATE '1990-01-01' AND DATE '{HIRED_BY}'
      AND NOT regexp_matches(hire_date, '^-?[0-9]{{1,4}}$') THEN TRY_CAST(hire_date AS DATE) END AS hire_date,
    CASE WHEN years_experience BETWEEN 0 AND 50 THEN years_experience END AS years_experience)
  FROM raw_employees),
level_median AS ({quantiles("typed", "level", "years_experience", {"med": 0.5})}),
level_band AS ({quantiles("typed", "level", "salary", BAND)}),
clean_employees AS (
  SELECT employee_id, full_name, email, department, role, level, hire_date,
    CASE WHEN salary > p95 * 1.5 OR salary < p05 * 0.5 THEN p95 ELSE salary END AS salary,
    manager_id, region, status, COALESCE(years_experience, med) AS years_experience,
    (salary > p95 * 1.5 OR salary < p05 * 0.5) AS salary_flagged_outlier
  FROM typed LEFT JOIN level_median m ON level = m.g LEFT JOIN level_band b ON level = b.g)"""

TRANSACTIONS = """
transactions AS (
  SELECT l_orderkey AS project_id, l_linenumber AS line_number, l_partkey AS part_id, l_suppkey AS vendor_id,
    CAST(l_shipdate AS DATE) AS transaction_date, l_extendedprice AS amount, l_extendedprice AS amount_aed,
    l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_returnflag AS return_flag,
    l_linestatus AS line_status, p_type AS category,
    CASE l_returnflag WHEN 'N' THEN 'Pending' WHEN 'R' THEN 'Disputed' WHEN 'A' THEN 'Paid' END AS payment_status
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

RAW_TRANSACTIONS = f"""{TRANSACTIONS},
raw_transactions AS (
  SELECT * EXCLUDE (amount, amount_aed, category),
    CASE WHEN discount > 0 OR tax > 0 THEN amount END AS amount,
    CASE WHEN line_status = 'F' THEN vendor_id END AS approved_by
  FROM transactions)"""

VENDORS = """
vendors AS (SELECT s_suppkey AS vendor_id, n_name AS vendor_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
vendor_spend AS (
  SELECT vendor_name, CAST(SUM(CAST(amount_aed AS DECIMAL(18,2))) AS DOUBLE) AS total_spend, COUNT(*) AS transaction_count
  FROM transactions JOIN vendors USING (vendor_id) GROUP BY vendor_name)"""


def _history(where: str) -> str:
    return f"""
history AS (
  SELECT o_custkey AS employee_id, CAST(o_orderdate AS DATE) AS effective_date, o_orderkey AS order_id,
    o_totalprice AS new_salary, o_orderpriority AS new_role, 'Order ' || o_orderkey AS change_reason,
    LAG(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_salary
  FROM orders {where}),
marked AS (
  SELECT h.*, EXISTS (SELECT 1 FROM history x WHERE x.employee_id = h.employee_id
      AND x.effective_date = h.effective_date AND x.previous_salary = h.new_salary AND x.order_id <> h.order_id) AS superseded
  FROM history h),
collapsed AS (
  SELECT *, SUM(CASE WHEN superseded THEN 0 ELSE 1 END) OVER (PARTITION BY employee_id, effective_date) AS terminal_states
  FROM marked
  QUALIFY ROW_NUMBER() OVER (PARTITION BY employee_id, effective_date ORDER BY superseded, order_id DESC) = 1)"""


DIMENSION = f"""{PEOPLE}, {_history("WHERE o_orderstatus = 'F'")},
snapshot AS (
  SELECT c_custkey AS employee_id, c_name AS full_name, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
    c_mktsegment AS department, n_name AS role, c_acctbal AS salary, hire_date, r_name AS region
  FROM people LEFT JOIN first_orders ON c_custkey = o_custkey),
starts AS (
  SELECT employee_id, effective_date AS valid_from, new_role, new_salary, change_reason FROM collapsed
  UNION ALL
  SELECT employee_id, COALESCE(hire_date, DATE '1900-01-01'), NULL, NULL, NULL FROM snapshot ANTI JOIN history USING (employee_id)),
spans AS (SELECT *, LEAD(valid_from) OVER (PARTITION BY employee_id ORDER BY valid_from) AS next_from FROM starts),
dimension AS (
  SELECT ROW_NUMBER() OVER (ORDER BY employee_id, valid_from) AS employee_key, employee_id, full_name, email, department,
    CASE WHEN next_from IS NULL THEN role ELSE new_role END AS role,
    CASE WHEN next_from IS NULL THEN salary ELSE new_salary END AS salary, hire_date, region, valid_from,
    COALESCE(CAST(next_from - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to, next_from IS NULL AS is_current,
    CASE WHEN next_from IS NOT NULL THEN change_reason END AS change_reason
  FROM spans JOIN snapshot USING (employee_id))"""

BROKEN = f"""{DIMENSION}, broken AS (
  SELECT * FROM dimension UNION ALL
  SELECT * REPLACE (employee_key + 1000000000 AS employee_key, CAST(valid_from + INTERVAL 10 DAY AS DATE) AS valid_from)
  FROM dimension WHERE is_current AND employee_id % 3 = 0)"""

APPROVED = """
approved AS (
  SELECT t.*, o_custkey AS approved_by FROM transactions t LEFT JOIN orders ON project_id = o_orderkey)"""

PROJECT_COLUMNS = """project_id, project_name, department, status, status_category, start_date, end_date, budget,
  actual_cost, budget_variance, is_over_budget, duration_days, budget_utilisation_pct, risk_level,
  project_manager_id, priority, region"""

DIM_PROJECT = f"dim_project AS (SELECT ROW_NUMBER() OVER (ORDER BY project_id) AS project_key, {PROJECT_COLUMNS} FROM projects)"
DIM_VENDOR = """dim_vendor AS (
  SELECT ROW_NUMBER() OVER (ORDER BY vendor_id) AS vendor_key, vendor_id, vendor_name
  FROM (SELECT DISTINCT l_suppkey AS vendor_id, s_name AS vendor_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey))"""
DIM_DATE = """
span AS (SELECT MIN(d) AS a, MAX(d) AS b FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)),
days AS (SELECT CAST(UNNEST(generate_series(make_date(CAST(year(a) AS INTEGER), 1, 1)::TIMESTAMP,
  make_date(CAST(year(b) AS INTEGER), 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
    CAST(week(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, isodow(d) IN (6, 7) AS is_weekend
  FROM days)"""
BRIDGE = """bridge AS (
  SELECT ROW_NUMBER() OVER (ORDER BY project_key) AS bridge_key, employee_key, project_key, 'Manager' AS project_role
  FROM dim_project JOIN dimension ON employee_id = project_manager_id AND is_current)"""
FACT = f"""fact AS (
  SELECT ROW_NUMBER() OVER (ORDER BY t.project_id, line_number, part_id, t.vendor_id, transaction_date, quantity, discount,
      tax, return_flag, line_status, amount_aed) AS transaction_key,
    t.project_id, line_number, part_id, t.vendor_id, transaction_date, quantity, discount, tax, return_flag, line_status,
    project_key, employee_key, vendor_key, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
    amount_aed AS amount, payment_status
  FROM approved t
  LEFT JOIN dim_project p ON p.project_id = t.project_id
  LEFT JOIN dim_vendor v ON v.vendor_id = t.vendor_id
  LEFT JOIN dimension d ON d.employee_id = t.approved_by AND t.transaction_date BETWEEN d.valid_from AND d.valid_to)"""
# Both PROJECTS and DIMENSION begin with the PEOPLE tables.
DIMENSION_ONLY = DIMENSION.replace(f"{PEOPLE}, ", "", 1)
STAR = f"{PROJECTS}, {DIMENSION_ONLY}, {TRANSACTIONS}, {APPROVED}, {DIM_PROJECT}, {DIM_VENDOR}, {BRIDGE}, {FACT}"

MONTHLY = """
monthly AS (
  SELECT strftime(transaction_date, '%Y-%m') AS year_month, category, SUM(CAST(amount_aed AS DECIMAL(18,2))) AS s
  FROM {source} GROUP BY ALL)
SELECT year_month, category, CAST(s AS DOUBLE) AS monthly_spend,
  CAST(SUM(s) OVER (PARTITION BY category ORDER BY year_month ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
  ROUND(100.0::DOUBLE * (CAST(s AS DOUBLE) - LAG(CAST(s AS DOUBLE)) OVER w) / NULLIF(LAG(CAST(s AS DOUBLE)) OVER w, 0), 2)
    AS month_over_month_pct_change
FROM monthly WINDOW w AS (PARTITION BY category ORDER BY year_month)"""

BUDGET = """
budget AS (
  SELECT department, CAST(SUM(CAST(budget AS DECIMAL(18,2))) AS DOUBLE) AS total_budget,
    CAST(SUM(CAST(actual_cost AS DECIMAL(18,2))) AS DOUBLE) AS total_actual_cost
  FROM projects GROUP BY department)
SELECT department, total_budget, total_actual_cost,
  ROUND(100.0::DOUBLE * total_actual_cost / NULLIF(total_budget, 0), 2) AS spend_percentage,
  total_actual_cost > total_budget AS over_budget
FROM budget"""

PENDING = f"""WITH {PROJECTS}, {TRANSACTIONS}
SELECT c_name AS full_name, c_mktsegment AS department, n_name AS role, project_name, status, budget, actual_cost,
  amount, category, payment_status, transaction_date
FROM transactions JOIN projects USING (project_id) JOIN people ON project_manager_id = c_custkey
WHERE status NOT IN ('Completed', 'On Hold') AND payment_status = 'Pending'
  AND amount > (SELECT CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(amount) FROM transactions
                WHERE payment_status = 'Pending')"""

EVENTS = """
raw_events AS (
  SELECT *, json_extract_string(props, '$.k') AS k,
    CASE event_type WHEN 'error' THEN 'escalation_raised' WHEN 'purchase' THEN 'escalation_resolved'
      WHEN 'view' THEN 'login' WHEN 'signup' THEN 'logout' WHEN 'click' THEN 'task_completed' END AS kind
  FROM events),
ev AS (
  SELECT event_id, kind AS event_type, CASE WHEN kind NOT IN ('login', 'logout') THEN k END AS project_id, user_id,
    ts AS event_time, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour,
    strftime(ts, '%Y-%m') AS event_month, 'user-' || user_id AS resolver,
    CASE WHEN CAST(k AS INTEGER) >= 75 THEN 'Critical' WHEN CAST(k AS INTEGER) >= 50 THEN 'High'
      WHEN CAST(k AS INTEGER) >= 25 THEN 'Medium' ELSE 'Low' END AS severity
  FROM raw_events WHERE event_id IS NOT NULL AND user_id IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts, user_id, kind) = 1)"""


def _fifo(group: str) -> str:
    return f"""WITH {EVENTS},
marked AS (
  SELECT *, {group} AS g, CASE event_type WHEN 'escalation_raised' THEN 0 ELSE 1 END AS side FROM ev
  WHERE event_type IN ('escalation_raised', 'escalation_resolved') AND {group} IS NOT NULL),
summed AS (
  SELECT *, SUM(1 - side) OVER w AS opened, SUM(side) OVER w AS closed, SUM(1 - 2 * side) OVER w AS s
  FROM marked WINDOW w AS (PARTITION BY g ORDER BY event_time, side, event_id)),
floored AS (
  SELECT *, LEAST(0, MIN(s) OVER (PARTITION BY g ORDER BY event_time, side, event_id)) AS fl FROM summed),
stepped AS (
  SELECT *, COALESCE(LAG(fl) OVER (PARTITION BY g ORDER BY event_time, side, event_id), 0) AS fl_before FROM floored),
raised AS (SELECT *, opened AS nth FROM stepped WHERE side = 0),
useful AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY g ORDER BY event_time, side, event_id) AS nth
  FROM stepped WHERE side = 1 AND fl = fl_before)
SELECT r.event_id, r.project_id, r.user_id AS raised_by, r.event_time AS raised_at, r.severity,
  u.event_id IS NOT NULL AS resolved, u.resolver AS resolved_by, u.event_time AS resolved_at,
  (epoch_us(u.event_time) - epoch_us(r.event_time)) / 3600000000.0::DOUBLE AS resolution_time_hours
FROM raised r LEFT JOIN useful u ON u.g = r.g AND u.nth = r.nth"""


# --- data quality ------------------------------------------------------------


def _status(failed: str) -> str:
    return f"CASE WHEN {failed} THEN 'FAIL' ELSE 'PASS' END"


def _complete(source: str, columns: list[str], threshold: float) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {_status(f"m < {threshold}")} AS status, m AS metric
        FROM (SELECT ROUND(COUNT({c}) / CAST(COUNT(*) AS DOUBLE), 4) AS m FROM {source})"""
        for c in columns
    )


def _count(column: str, condition: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", {_status("n > 0")} AS status, CAST(n AS DOUBLE) AS metric
      FROM (SELECT COUNT(*) AS n FROM {source} WHERE {condition})"""


def _top(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", {_status("s > 0.30")} AS status, ROUND(s, 4) AS metric
      FROM (SELECT MAX(n) / CAST(SUM(n) AS DOUBLE) AS s FROM (SELECT COUNT(*) AS n FROM {source}
            WHERE {column} IS NOT NULL GROUP BY {column}))"""


def _far(column: str, source: str) -> str:
    return _count(
        column,
        f"abs({column} - (SELECT AVG({column}) FROM {source})) / (SELECT stddev_pop({column}) FROM {source}) > 3", source
    )


def _band(column: str, group: str, source: str) -> str:
    return f"""SELECT '{column} in {group} band' AS "column", {_status("n > 0")} AS status, CAST(n AS DOUBLE) AS metric
      FROM (SELECT COUNT(*) AS n FROM {source} JOIN ({quantiles(source, group, column, BAND)}) ON {group} = g
            WHERE {column} > 1.5 * p95 OR {column} < 0.5 * p05)"""


def _orphans(name: str, column: str, source: str, reference: str, ref_column: str) -> str:
    return _count(
        name, f"{column} IS NOT NULL AND {column} NOT IN (SELECT {ref_column} FROM {reference} WHERE {ref_column} IS NOT NULL)", source
    )


def _age(column: str, source: str, days: int) -> str:
    return f"""SELECT '{column}' AS "column", {_status(f"n > {days}")} AS status, CAST(n AS DOUBLE) AS metric
      FROM (SELECT date_diff('day', MAX({column}), DATE '{AS_OF}') AS n FROM {source})"""


def _unique(label: str, columns: str, source: str) -> str:
    return f"""SELECT '{label}' AS "column", {_status("t > u")} AS status, CAST(t - u AS DOUBLE) AS metric
      FROM (SELECT SUM(n) AS t, COUNT(*) AS u FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {columns}))"""


_IDLE = 'SELECT NULL AS "column", \'PASS\' AS status, CAST(NULL AS DOUBLE) AS metric'
_P_COLUMNS = ["project_id", "project_name", "department", "status", "start_date", "end_date", "budget", "actual_cost",
              "project_manager_id", "priority", "region"]
_E_COLUMNS = ["employee_id", "full_name", "email", "department", "role", "level", "hire_date", "salary", "manager_id",
              "region", "status", "years_experience"]
_T_COLUMNS = ["project_id", "line_number", "part_id", "vendor_id", "transaction_date", "amount", "quantity", "discount",
              "tax", "return_flag", "line_status", "payment_status", "approved_by", "transaction_id"]
_BAD_DATE = "hire_date IS NOT NULL AND NOT regexp_matches(hire_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')"


def _bad_or_future(day: str) -> str:
    return f"({_BAD_DATE}) OR (NOT ({_BAD_DATE}) AND TRY_CAST(hire_date AS DATE) > DATE '{day}')"


_BEFORE = "start_date <= end_date"
_SUITE: dict[str, dict[str, list[str]]] = {
    "projects": {
        "completeness": [_complete("raw_projects", _P_COLUMNS, 0.90)],
        "uniqueness": [_unique("project_id", "project_id", "raw_projects")],
        "validity_numeric": [_count(c, f"{c} < 0 OR {c} > 10000000", "raw_projects") for c in ("budget", "actual_cost")],
        "validity_date": [_count(c, f"{c} > DATE '{AS_OF}'", "raw_projects") for c in ("start_date", "end_date")],
        "consistency": [_count(_BEFORE, "start_date > end_date", "raw_projects"),
                        _count("actual_cost >= 0", "actual_cost < 0", "raw_projects")],
        "referential_integrity": [_orphans("project_manager_id -> employees.employee_id", "project_manager_id",
                                           "raw_projects", "raw_employees", "employee_id")],
        "distribution": [_top(c, "raw_projects") for c in ("department", "status", "region")],
        "freshness": [_IDLE],
        "outliers": [_far(c, "raw_projects") for c in ("budget", "actual_cost")],
    },
    "employees": {
        "completeness": [_complete("raw_employees", _E_COLUMNS, 0.85)],
        "uniqueness": [_unique("employee_id", "employee_id", "raw_employees")],
        "validity_numeric": [_count("salary", "salary < 10000 OR salary > 100000", "raw_employees"),
                             _count("years_experience", "years_experience < 0 OR years_experience > 50", "raw_employees")],
        "validity_date": [_count("hire_date", _bad_or_future(AS_OF), "raw_employees")],
        "consistency": [_count("salary >= 0", "salary < 0", "raw_employees"), _band("salary", "level", "raw_employees")],
        "referential_integrity": [_orphans("manager_id -> employees.employee_id", "manager_id", "raw_employees",
                                           "raw_employees", "employee_id")],
        "distribution": [_top(c, "raw_employees") for c in ("department", "level", "region")],
        "freshness": [_IDLE],
        "outliers": [_far("salary", "raw_employees")],
    },
    "transactions": {
        "completeness": [_complete("tx", _T_COLUMNS, 0.80)],
        "uniqueness": [_unique("transaction_id", "transaction_id", "tx")],
        "validity_numeric": [_count("amount", "amount < 0 OR amount > 1000000", "tx")],
        "validity_date": [_count("transaction_date", f"transaction_date > DATE '{AS_OF}'", "tx")],
        "consistency": [_count("amount >= 0", "amount < 0", "tx")],
        "referential_integrity": [
            _orphans("project_id -> projects.project_id", "project_id", "tx", "raw_projects", "project_id"),
            _orphans("approved_by -> employees.employee_id", "approved_by", "tx", "raw_employees", "employee_id")],
        "distribution": [_top("payment_status", "tx")],
        "freshness": [_age("transaction_date", "tx", 30)],
        "outliers": [_far("amount", "tx")],
    },
}
# RAW_EMPLOYEES begins with the PEOPLE tables RAW_PROJECTS already has.
_EMPLOYEES_ONLY = RAW_EMPLOYEES.replace(f"{PEOPLE},", "", 1)
_SUITE_TABLES = f"""{RAW_PROJECTS}, {_EMPLOYEES_ONLY}, {RAW_TRANSACTIONS},
tx AS (SELECT *, project_id || '-' || line_number AS transaction_id FROM raw_transactions)"""
_RESULTS = " UNION ALL ".join(
    f"""SELECT '{dataset}' AS dataset, '{check}' AS "check", "column", status, metric FROM ({sql})"""
    for dataset, found in _SUITE.items() for check, parts in found.items() for sql in parts
)


def _suite_part(dataset: str, check: str) -> str:
    return " UNION ALL ".join(f"({part})" for part in _SUITE[dataset][check])


def _constraint(table: str, kind: str, columns: str, count: str) -> str:
    return f"SELECT '{table}' AS table_name, '{kind}' AS \"constraint\", '{columns}' AS columns, CAST(({count}) AS BIGINT) AS violations"


def _repeats(table: str, kind: str, columns: list[str]) -> str:
    return _constraint(table, kind, "+".join(columns),
                       f"SELECT COUNT(*) FROM (SELECT ROW_NUMBER() OVER (PARTITION BY {', '.join(columns)}) AS i FROM {table}) WHERE i > 1")


def _empty(table: str, column: str) -> str:
    return _constraint(table, "not_null", column, f"SELECT COUNT(*) FROM {table} WHERE {column} IS NULL")


def _lost(table: str, column: str, ref: str, ref_column: str) -> str:
    return _constraint(table, "foreign_key", column,
                       f"SELECT COUNT(*) FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {ref_column} FROM {ref})")


_TABLE_RULES = [
    _repeats("region", "primary_key", ["r_regionkey"]), _repeats("region", "unique", ["r_name"]),
    _empty("region", "r_regionkey"), _empty("region", "r_name"),
    _repeats("nation", "primary_key", ["n_nationkey"]), _repeats("nation", "unique", ["n_name"]),
    _empty("nation", "n_nationkey"), _lost("nation", "n_regionkey", "region", "r_regionkey"),
    _repeats("customer", "primary_key", ["c_custkey"]), _repeats("customer", "unique", ["c_name"]),
    _empty("customer", "c_custkey"), _lost("customer", "c_nationkey", "nation", "n_nationkey"),
    _repeats("orders", "primary_key", ["o_orderkey"]), _empty("orders", "o_orderkey"), _empty("orders", "o_orderdate"),
    _lost("orders", "o_custkey", "customer", "c_custkey"),
    _repeats("lineitem", "primary_key", ["l_orderkey", "l_linenumber"]), _empty("lineitem", "l_orderkey"),
    _empty("lineitem", "l_linenumber"), _lost("lineitem", "l_orderkey", "orders", "o_orderkey"),
]
_STAR_RULES = [
    _repeats("dim_date", "primary_key", ["date_key"]), _repeats("dim_date", "unique", ["full_date"]),
    *[_empty("dim_date", c) for c in ("date_key", "full_date")],
    _repeats("dim_project", "primary_key", ["project_key"]), _repeats("dim_project", "unique", ["project_id"]),
    *[_empty("dim_project", c) for c in ("project_key", "project_id", "project_name")],
    _repeats("dim_employee", "primary_key", ["employee_key"]),
    *[_empty("dim_employee", c) for c in ("employee_key", "employee_id", "valid_from", "valid_to", "is_current")],
    _repeats("dim_vendor", "primary_key", ["vendor_key"]), _repeats("dim_vendor", "unique", ["vendor_id"]),
    *[_empty("dim_vendor", c) for c in ("vendor_key", "vendor_id", "vendor_name")],
    _repeats("bridge_employee_project", "primary_key", ["bridge_key"]),
    *[_empty("bridge_employee_project", c) for c in ("employee_key", "project_key")],
    _lost("bridge_employee_project", "employee_key", "dim_employee", "employee_key"),
    _lost("bridge_employee_project", "project_key", "dim_project", "project_key"),
    _repeats("fact_transactions", "primary_key", ["transaction_key"]), _empty("fact_transactions", "transaction_key"),
    _lost("fact_transactions", "project_key", "dim_project", "project_key"),
    _lost("fact_transactions", "employee_key", "dim_employee", "employee_key"),
    _lost("fact_transactions", "vendor_key", "dim_vendor", "vendor_key"),
    _lost("fact_transactions", "date_key", "dim_date", "date_key"),
]


def _classes(table: str, classes: dict[str, str | None]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS dataset, '{c}' AS column_name, {f"'{v}'" if v else "CAST(NULL AS VARCHAR)"} AS "class",
        COUNT({c}) AS filled_rows, '{"PASS" if v else "FAIL"}' AS status FROM {table}"""
        for c, v in classes.items()
    )


_LOAD_ROWS = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, '{s}' AS stage, COUNT(*) AS rows FROM {t}"
    for d, s, t in [
        ("projects", "raw", "orders"), ("projects", "clean", "projects"), ("employees", "raw", "customer"),
        ("employees", "clean", "clean_employees"), ("transactions", "raw", "lineitem"),
        ("transactions", "clean", "raw_transactions"), ("events", "raw", "events"), ("events", "clean", "ev"),
    ]
)

ORACLE: dict[str, str] = {
    "csv_round_trip": "SELECT * FROM part",
    "csv_text_round_trip": "SELECT * FROM documents",
    "null_profile_nan": """SELECT 'l_orderkey' AS column_name, 0::BIGINT AS null_rows, COUNT(*) AS total_rows FROM lineitem
      UNION ALL SELECT 'l_discount', COUNT(*) FILTER (l_orderkey % 97 = 0 OR l_discount IS NULL), COUNT(*) FROM lineitem
      UNION ALL SELECT 'l_tax', COUNT(*) - COUNT(l_tax), COUNT(*) FROM lineitem""",
    "json_round_trip": "SELECT * FROM supplier",
    "json_array_round_trip": "SELECT * FROM documents",
    "jsonl_round_trip": f"WITH {EVENTS} SELECT event_id, event_type, project_id, user_id, "
    "event_time, severity, resolver AS resolved_by FROM ev",
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_rows, COUNT(*) AS total_rows FROM customer"
        for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ),
    "partitioned_events": """
      SELECT CAST(ts AS DATE) AS event_date, event_type, COUNT(*) AS event_count,
        CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
      FROM events GROUP BY ALL""",
    "load_row_counts": f"WITH {PROJECTS}, {CLEAN_EMPLOYEES.replace(f'{PEOPLE},', '', 1)}, {RAW_TRANSACTIONS}, {EVENTS} {_LOAD_ROWS}",
    "transform_orders": f"WITH {PROJECTS} SELECT * FROM projects",
    "clean_customers": f"WITH {CLEAN_EMPLOYEES} SELECT * FROM clean_employees",
    "employee_quality_summary": f"""WITH {CLEAN_EMPLOYEES}
      SELECT
        (SELECT COUNT(*) FROM raw_employees WHERE trim(COALESCE(email, '')) = '') AS missing_email_fixed,
        (SELECT COUNT(*) FROM raw_employees WHERE regexp_matches(hire_date, '^-?[0-9]{{1,4}}$')) AS invalid_hire_date_format_fixed,
        (SELECT COUNT(*) FROM raw_employees WHERE NOT regexp_matches(hire_date, '^-?[0-9]{{1,4}}$')
           AND TRY_CAST(hire_date AS DATE) NOT BETWEEN DATE '1990-01-01' AND DATE '{HIRED_BY}') AS implausible_hire_date_fixed,
        (SELECT COUNT(*) FROM raw_employees WHERE years_experience NOT BETWEEN 0 AND 50) AS years_experience_out_of_range_fixed,
        (SELECT COUNT(*) FROM clean_employees WHERE salary_flagged_outlier) AS salary_level_mismatch_fixed,
        (SELECT COUNT(*) FROM raw_employees WHERE status = 'Active' AND manager_id IN
           (SELECT employee_id FROM raw_employees WHERE status = 'Inactive')) AS status_conflicts_found""",
    "status_conflicts": f"""WITH {RAW_EMPLOYEES}
      SELECT manager_id, COUNT(*) AS active_reports FROM raw_employees WHERE status = 'Active' AND manager_id IN
        (SELECT employee_id FROM raw_employees WHERE status = 'Inactive') GROUP BY manager_id""",
    "enrich_lineitems": f"""WITH {RAW_PROJECTS}, {RAW_TRANSACTIONS}
      SELECT t.*, project_name, department, s_name AS approver_full_name, approved_by IS NOT NULL AS is_approved,
        COALESCE(amount, 0) AS amount_aed, strftime(transaction_date, '%Y-%m') AS transaction_year_month
      FROM raw_transactions t LEFT JOIN raw_projects p ON p.project_id = t.project_id
      LEFT JOIN supplier ON s_suppkey = approved_by""",
    "winsorise_band": f"""
      WITH b AS ({quantiles("events", "event_type", "value", BAND)})
      SELECT event_id, event_type, CASE WHEN value > p95 * 1.5 OR value < p05 * 0.5 THEN p95 ELSE value END AS value,
        (value > p95 * 1.5 OR value < p05 * 0.5) AS flagged
      FROM events JOIN b ON event_type = g""",
    "value_quantiles": f"""
      SELECT g AS l_returnflag, ROUND(p05, 4) AS p05, ROUND(median, 4) AS median, ROUND(p95, 4) AS p95
      FROM ({quantiles("lineitem", "l_returnflag", "l_extendedprice", {"p05": 0.05, "median": 0.5, "p95": 0.95})})""",
    "risk_value_counts": f'WITH {PROJECTS} SELECT risk_level AS "value", COUNT(*) AS "rows" FROM projects GROUP BY risk_level',
    "dedupe_first": """
      SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate,
        l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    "agg_conditional": """
      SELECT l_linestatus, COUNT(*) AS line_count, COUNT(*) FILTER (l_returnflag = 'R') AS disputed,
        COUNT(*) FILTER (l_returnflag = 'N') AS pending,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
        CAST(MIN(l_shipdate) AS DATE) AS first_ship, CAST(MAX(l_shipdate) AS DATE) AS last_ship
      FROM lineitem GROUP BY l_linestatus""",
    "agg_distinct": """
      SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_suppkey""",
    "distinct_merged_days": f"""WITH {EVENTS}
      SELECT project_id, COUNT(DISTINCT user_id) AS unique_users FROM ev WHERE project_id IS NOT NULL GROUP BY project_id""",
    "agg_share": """
      WITH g AS (SELECT l_returnflag, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY 1)
      SELECT l_returnflag, CAST(s AS DOUBLE) AS total,
        ROUND(100.0::DOUBLE * CAST(s AS DOUBLE) / CAST((SELECT SUM(s) FROM g) AS DOUBLE), 2) AS share_pct FROM g""",
    "history_dedup": f"""WITH {_history("")}
      SELECT employee_id, effective_date, order_id, previous_salary, new_salary, CAST(terminal_states AS BIGINT) AS terminal_states
      FROM collapsed""",
    "dim_customer_scd2": f"WITH {DIMENSION} SELECT * FROM dimension",
    "scd2_multi_current": f"""WITH {DIMENSION}
      SELECT employee_id, COUNT(*) AS current_count FROM dimension WHERE is_current GROUP BY employee_id HAVING COUNT(*) > 1""",
    "scd2_version_count": f"""WITH {DIMENSION}
      SELECT employee_id, COUNT(*) AS version_count FROM dimension GROUP BY employee_id
      ORDER BY version_count DESC, employee_id LIMIT 10""",
    "scd2_overlaps": f"""WITH {DIMENSION}
      SELECT a.employee_id, a.employee_key AS version_a, b.employee_key AS version_b, a.valid_to AS a_to,
        b.valid_from AS b_from, b.valid_to AS b_to
      FROM dimension a JOIN dimension b USING (employee_id)
      WHERE b.employee_key > a.employee_key AND GREATEST(a.valid_from, b.valid_from) <= LEAST(a.valid_to, b.valid_to)""",
    "scd2_row_equation": f"""WITH {DIMENSION}
      SELECT COUNT(*) FILTER (built) AS actual_rows, COUNT(*) FILTER (NOT built) AS expected_rows
      FROM (SELECT TRUE AS built FROM dimension UNION ALL SELECT FALSE FROM collapsed
            UNION ALL SELECT FALSE FROM snapshot ANTI JOIN history USING (employee_id))""",
    "scd2_gaps": f"""WITH {DIMENSION}
      SELECT employee_id, employee_key, valid_to, LEAD(valid_from) OVER (PARTITION BY employee_id ORDER BY valid_from) AS next_valid_from
      FROM dimension QUALIFY date_diff('day', valid_to, next_valid_from) <> 1""",
    "scd2_multi_current_broken": f"""WITH {BROKEN}
      SELECT employee_id, COUNT(*) AS current_count FROM broken WHERE is_current GROUP BY employee_id HAVING COUNT(*) > 1""",
    "scd2_overlaps_broken": f"""WITH {BROKEN}
      SELECT a.employee_id, a.employee_key AS version_a, b.employee_key AS version_b, a.valid_to AS a_to,
        b.valid_from AS b_from, b.valid_to AS b_to
      FROM broken a JOIN broken b USING (employee_id)
      WHERE b.valid_from > a.valid_from AND b.valid_from <= a.valid_to""",
    "scd2_gaps_broken": f"""WITH {BROKEN}
      SELECT employee_id, employee_key, valid_to, LEAD(valid_from) OVER (PARTITION BY employee_id ORDER BY valid_from) AS next_valid_from
      FROM broken QUALIFY date_diff('day', valid_to, next_valid_from) <> 1""",
    "order_overlaps": f"""WITH {RAW_PROJECTS},
      spans AS (SELECT project_manager_id, project_id, start_date, end_date FROM raw_projects WHERE end_date >= start_date)
      SELECT b.project_manager_id, MAX({{'e': a.end_date, 'i': a.project_id}}).i AS version_a, b.project_id AS version_b,
        MAX(a.end_date) AS a_to, b.start_date AS b_from, b.end_date AS b_to
      FROM spans a JOIN spans b ON a.project_manager_id = b.project_manager_id
        AND (a.start_date, a.project_id) < (b.start_date, b.project_id) AND a.end_date >= b.start_date
      GROUP BY ALL""",
    "largest_increase": f"""WITH {DIMENSION}
      SELECT o.employee_id, n.full_name, n.valid_from AS change_date, o.salary AS previous_salary, n.salary AS new_salary,
        n.salary - o.salary AS increase_amount,
        ROUND(100.0::DOUBLE * (n.salary - o.salary) / NULLIF(o.salary, 0), 2) AS increase_pct
      FROM dimension o JOIN dimension n ON o.employee_id = n.employee_id AND n.valid_from = CAST(o.valid_to + INTERVAL 1 DAY AS DATE)
        AND NOT o.is_current
      ORDER BY increase_amount DESC, o.employee_id, change_date LIMIT 20""",
    "manager_workload": f"""WITH {PROJECTS}, {DIMENSION_ONLY}
      SELECT d.employee_id, d.full_name, d.email, COUNT(*) AS active_project_count,
        CAST(SUM(CAST(budget AS DECIMAL(18,2))) AS DOUBLE) AS combined_budget_responsibility,
        CAST(SUM(CAST(actual_cost AS DECIMAL(18,2))) AS DOUBLE) AS combined_actual_spend
      FROM projects JOIN dimension d ON d.employee_id = project_manager_id AND d.is_current
      WHERE status_category = 'Active' GROUP BY ALL HAVING COUNT(*) > 3""",
    "point_in_time_value": f"""WITH {DIMENSION}, {TRANSACTIONS}, {APPROVED}
      SELECT is_current AS version_current, COUNT(*) AS line_count,
        CAST(SUM(CAST(amount_aed AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
        CAST(SUM(CAST(salary AS DECIMAL(18,2))) AS DOUBLE) AS total_salary
      FROM approved LEFT JOIN dimension ON employee_id = approved_by AND transaction_date BETWEEN valid_from AND valid_to
      GROUP BY is_current""",
    "dim_date": f"WITH {DIM_DATE} SELECT * FROM dim_date",
    "dim_order": f"WITH {PROJECTS}, {DIM_PROJECT} SELECT * FROM dim_project",
    "dim_vendor": f"WITH {DIM_VENDOR} SELECT * FROM dim_vendor",
    "bridge_customer_order": f"WITH {PROJECTS}, {DIMENSION_ONLY}, {DIM_PROJECT}, {BRIDGE} SELECT * FROM bridge",
    "fact_lineitem": f"WITH {STAR} SELECT * FROM fact",
    "department_budget": f"WITH {PROJECTS}, {BUDGET} WHERE total_actual_cost / NULLIF(total_budget, 0) > 0.80",
    "department_budget_all": f"WITH {PROJECTS}, {BUDGET}",
    "vendor_concentration": f"""WITH {TRANSACTIONS}, {VENDORS},
      s AS (SELECT *, 100.0::DOUBLE * total_spend / CAST((SELECT SUM(CAST(total_spend AS DECIMAL(18,2))) FROM vendor_spend) AS DOUBLE) AS share
            FROM vendor_spend)
      SELECT vendor_name, total_spend, transaction_count, ROUND(share, 2) AS percentage_of_total_spend,
        CASE WHEN share > 10 THEN 'HIGH' WHEN share > 5 THEN 'MEDIUM' ELSE 'NORMAL' END AS risk_flag
      FROM s WHERE share > 5""",
    "open_issues": f"""WITH {PROJECTS}, {TRANSACTIONS}
      SELECT project_id, project_name, department, p.status AS project_status, COUNT(*) AS open_transaction_count,
        CAST(SUM(CAST(amount_aed AS DECIMAL(18,2))) AS DOUBLE) AS open_transaction_value
      FROM transactions JOIN projects p USING (project_id) WHERE payment_status IN ('Pending', 'Disputed')
      GROUP BY ALL HAVING SUM(CAST(amount_aed AS DECIMAL(18,2))) > 50000""",
    "monthly_spend": f"WITH {TRANSACTIONS}, {MONTHLY.format(source='transactions')}",
    "monthly_spend_trailing": f"""WITH {TRANSACTIONS}, recent AS (SELECT * FROM transactions WHERE transaction_date >
        (SELECT MAX(transaction_date) - INTERVAL 12 MONTH FROM transactions)), {MONTHLY.format(source='recent')}""",
    "pending_above_average": PENDING,
    "pending_above_average_sql": PENDING,
    "issue_rate": f"""WITH {PROJECTS}, flagged AS (
        SELECT project_id, project_name, status, project_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS had_issue
        FROM projects)
      SELECT *, (SELECT ROUND(100.0::DOUBLE * COUNT(*) FILTER (had_issue) / COUNT(*), 2) FROM flagged) AS issue_pct FROM flagged""",
    "kpi_cards": f"""WITH {PROJECTS}
      SELECT CAST(SUM(CAST(budget AS DECIMAL(18,2))) AS DOUBLE) AS total_budget,
        CAST(SUM(CAST(actual_cost AS DECIMAL(18,2))) AS DOUBLE) AS total_actual_spend,
        ROUND(100.0::DOUBLE * COUNT(*) FILTER (is_over_budget) / COUNT(*), 2) AS pct_over_budget_projects,
        (SELECT COUNT(*) FROM lineitem) AS total_transactions
      FROM projects""",
    "top10_variance": f"""WITH {PROJECTS}
      SELECT project_id, project_name, department, region, status, status_category, priority, budget, actual_cost,
        budget_variance, is_over_budget, risk_level
      FROM projects ORDER BY budget_variance DESC, project_id LIMIT 10""",
    "top5_plus_other": f"""WITH {TRANSACTIONS}, {VENDORS},
      ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY total_spend DESC, vendor_name) AS rn FROM vendor_spend)
      SELECT vendor_name, total_spend FROM ranked WHERE rn <= 5
      UNION ALL SELECT 'Other', CAST(SUM(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) FROM ranked WHERE rn > 5""",
    "all_orders_slicer": f"""WITH {PROJECTS}
      SELECT project_id, project_name, department, region, status, status_category, priority,
        CAST(year(start_date) AS INTEGER) AS project_year, budget, actual_cost, budget_variance, is_over_budget, risk_level
      FROM projects""",
    "validate_events_dirty": f"""WITH {EVENTS}
      SELECT event_id, event_type, project_id, user_id, event_time, event_date, event_hour, event_month FROM ev
      WHERE event_id % 89 <> 0""",
    "validate_events": f"""WITH {EVENTS}
      SELECT event_id, event_type, project_id, user_id, event_time, event_date, event_hour, event_month FROM ev""",
    "project_activity_summary": f"""WITH {EVENTS}
      SELECT project_id, COUNT(*) AS total_events, COUNT(*) FILTER (event_type = 'escalation_raised') AS escalation_count,
        COUNT(*) FILTER (event_type = 'task_completed') AS task_completions,
        COUNT(*) FILTER (event_type = 'document_uploaded') AS document_uploads, MAX(event_time) AS last_event_timestamp,
        COUNT(DISTINCT user_id) AS unique_users, COUNT(DISTINCT event_type) AS unique_event_types
      FROM ev WHERE project_id IS NOT NULL GROUP BY project_id""",
    "user_activity_summary": f"""WITH {EVENTS}
      SELECT user_id, COUNT(*) FILTER (event_type = 'login') AS login_count, COUNT(*) FILTER (event_type = 'logout') AS logout_count,
        COUNT(*) FILTER (event_type NOT IN ('login', 'logout')) AS actions_taken, COUNT(DISTINCT project_id) AS projects_touched,
        MIN(event_time) AS first_active, MAX(event_time) AS last_active, COUNT(DISTINCT event_date) AS active_days
      FROM ev GROUP BY user_id""",
    "escalation_log": _fifo("project_id"),
    "escalation_log_by_user": _fifo("user_id"),
    "daily_event_volume": f"""WITH {EVENTS}, daily AS (SELECT event_date, event_type, COUNT(*) AS event_count FROM ev GROUP BY ALL)
      SELECT *, CAST(SUM(event_count) OVER (PARTITION BY event_type ORDER BY event_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_count
      FROM daily""",
    "peak_usage_analysis": f"""WITH {EVENTS}
      SELECT event_date, event_hour, COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS unique_users,
        COUNT(DISTINCT event_type) AS event_types_per_hour
      FROM ev GROUP BY ALL ORDER BY total_events DESC, event_date, event_hour LIMIT 20""",
    "dq_completeness": f"WITH {RAW_PROJECTS} {_suite_part('projects', 'completeness')}",
    "dq_uniqueness": " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, status, metric, details FROM (
          SELECT CASE WHEN t > u THEN 'FAIL' ELSE 'PASS' END AS status, CAST(t - u AS DOUBLE) AS metric,
            u || ' keys in ' || t || ' rows' AS details
          FROM (SELECT CAST(SUM(n) AS BIGINT) AS t, COUNT(*) AS u FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {k})))"""
        for t, k in [("lineitem", "l_orderkey, l_linenumber"), ("customer", "c_custkey"), ("documents", "doc_id")]
    ),
    "dq_numeric_range": _count("c_acctbal", "c_acctbal < 0 OR c_acctbal > 9000", "customer"),
    "dq_date": f"""WITH {RAW_PROJECTS}, {_EMPLOYEES_ONLY} ({_count("hire_date", _bad_or_future(HIRED_BY), "raw_employees")})
      UNION ALL {_suite_part('projects', 'validity_date')}""",
    "dq_consistency": f"""WITH {RAW_PROJECTS} {_suite_part('projects', 'consistency')}
      UNION ALL ({_count("start_date < end_date", "start_date >= end_date", "raw_projects")})
      UNION ALL ({_band("value", "event_type", "events")})""",
    "dq_foreign_keys": f"""
      ({_orphans("l_orderkey -> orders.o_orderkey", "l_orderkey", "lineitem", "orders", "o_orderkey")})
      UNION ALL ({_orphans("l_partkey -> supplier.s_suppkey", "l_partkey", "lineitem", "supplier", "s_suppkey")})
      UNION ALL SELECT 'l_suppkey -> absent.s_suppkey', 'SKIPPED', NULL""",
    "dq_distribution": f"({_top('lang', 'documents')}) UNION ALL ({_top('source', 'documents')})",
    "dq_freshness": f"WITH {RAW_PROJECTS} {_age('start_date', 'raw_projects', 30)}",
    "dq_outliers": f"({_far('n_chars', 'documents')}) UNION ALL ({_far('c_acctbal', 'customer')})",
    "dq_results": f"WITH {_SUITE_TABLES} {_RESULTS}",
    "dq_suite": f"""WITH {_SUITE_TABLES}, results AS ({_RESULTS}),
      per_check AS (SELECT dataset, "check", MAX(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) AS failed FROM results GROUP BY ALL)
      SELECT dataset, COUNT(*) AS checks_run, COUNT(*) FILTER (failed = 0) AS checks_passed,
        COUNT(*) FILTER (failed = 1) AS checks_failed FROM per_check GROUP BY dataset""",
    "dq_gate": f"WITH {_SUITE_TABLES} " + " UNION ALL ".join(
        f"""SELECT '{d}' AS dataset, '{k}' AS key_column, m AS completeness, m >= 0.80 AS passed
        FROM (SELECT ROUND(COUNT({k}) / CAST(COUNT(*) AS DOUBLE), 4) AS m FROM {t})"""
        for d, k, t in [("projects", "project_id", "raw_projects"), ("employees", "employee_id", "raw_employees"),
                        ("transactions", "approved_by", "raw_transactions")]
    ),
    "dq_table_constraints": " UNION ALL ".join(_TABLE_RULES),
    "dq_star_constraints": f"""WITH {STAR}, {DIM_DATE}, dim_employee AS (SELECT * FROM dimension),
      bridge_employee_project AS (SELECT * FROM bridge), fact_transactions AS (SELECT * FROM fact)
      {" UNION ALL ".join(_STAR_RULES)}""",
    "stream_ingest": f"WITH {EVENTS} SELECT event_type, event_id, project_id, user_id, severity FROM ev",
    "stream_counts": f"WITH {EVENTS} SELECT event_type, COUNT(*) AS event_count FROM ev GROUP BY event_type",
    "stream_critical": f"""WITH {EVENTS} SELECT event_id, event_type, project_id, user_id, severity FROM ev
      WHERE event_type = 'escalation_raised' AND severity = 'Critical'""",
    "stream_summary": f"""WITH {EVENTS}
      SELECT COUNT(*) AS total_consumed, COUNT(DISTINCT event_type) AS event_types,
        COUNT(*) FILTER (event_type = 'escalation_raised' AND severity = 'Critical') AS critical_forwarded FROM ev""",
    "stream_dedupe": f"WITH {EVENTS} SELECT event_id, event_type, user_id FROM ev",
    "stream_daily": f"WITH {EVENTS} SELECT event_date, event_type, COUNT(*) AS event_count FROM ev GROUP BY ALL",
    "stream_unique_late": f"WITH {EVENTS} SELECT event_id, event_type, user_id FROM ev",
    "stream_daily_restated": f"""WITH {EVENTS} SELECT event_date, event_type, SUM(1 + (event_id % 10 = 0)::INT)::BIGINT AS event_count
      FROM ev GROUP BY ALL""",
    "column_classes": " UNION ALL ".join([
        _classes("customer", {"c_custkey": "Internal", "c_name": "PII", "c_nationkey": "Internal",
                              "c_acctbal": "Confidential", "c_mktsegment": "Internal"}),
        _classes("orders", {"o_orderkey": "Internal", "o_custkey": "PII", "o_orderstatus": "Internal",
                            "o_totalprice": "Confidential", "o_orderdate": "Internal", "o_orderpriority": None}),
    ]),
    "persona_view": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "persona_view_aggregated": """
      SELECT c_mktsegment, COUNT(*) AS headcount, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_balance
      FROM customer GROUP BY c_mktsegment""",
    "retention_split": f"""
      SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
        CASE WHEN o_orderdate + INTERVAL 60 MONTH <= DATE '{AS_OF}' THEN 'delete'
             WHEN o_orderdate + INTERVAL 12 MONTH <= DATE '{AS_OF}' THEN 'archive' ELSE 'keep' END AS disposition
      FROM orders""",
    "pseudonymise": f"""
      SELECT CASE WHEN c_acctbal < 0 THEN sha256('{SALT}' || c_custkey) ELSE CAST(c_custkey AS VARCHAR) END AS c_custkey,
        CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment
      FROM customer""",
    "free_text_audit": "SELECT source, COUNT(*) AS texts, " + ", ".join(
        f"CAST(SUM(len(regexp_extract_all(text, '{pattern}'))) AS BIGINT) AS {name}" for name, pattern in PERSONAL_DATA.items()
    ) + " FROM documents GROUP BY source",
}
ORACLE["repeated_write"] = ORACLE["daily_event_volume"]
ORACLE["value_quantiles_nan"] = f"""
  SELECT g AS l_returnflag, ROUND(p05, 4) AS p05, ROUND(median, 4) AS median, ROUND(p95, 4) AS p95
  FROM ({quantiles("(SELECT * FROM lineitem WHERE l_orderkey % 97 <> 0) AS kept", "l_returnflag", "l_extendedprice",
                   {"p05": 0.05, "median": 0.5, "p95": 0.95})})"""
# the same answers whichever way the operators take
for _plain, _scaled in (
    ("enrich_lineitems", "enrich_lineitems_shuffled"), ("value_quantiles", "value_quantiles_sliced"),
    ("point_in_time_value", "point_in_time_value_merged"), ("fact_lineitem", "fact_lineitem_shuffled"),
    ("escalation_log", "escalation_log_sliced"),
):
    ORACLE[_scaled] = ORACLE[_plain]
