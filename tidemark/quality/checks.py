"""The checks. Each returns rows of (check, column, status, metric, details).

Checks that only need one look at each row share a single aggregate; uniqueness,
references, distribution, outliers and bands need their own.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import count_where, is_filled, parse_date, parse_number
from tidemark.operators.lookup import missing_references
from tidemark.operators.quantile import flag_outside_band
from tidemark.quality.config import Checks

PASS, FAIL, SKIPPED = "PASS", "FAIL", "SKIPPED"
ALL_CHECKS = (
    "completeness", "uniqueness", "validity_numeric", "validity_date", "consistency",
    "referential_integrity", "distribution", "freshness", "outliers",
)
COLUMNS = ["check", "column", "status", "metric", "details"]


def _fail_if(condition: Column) -> Column:
    return F.when(condition, FAIL).otherwise(PASS)


def _entry(check: str, column: str | None, status: Column, metric: Column, details: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        status.alias("status"),
        metric.cast("double").alias("metric"),
        details.cast("string").alias("details"),
    )


def _number(c: str) -> Column:
    return parse_number(F.col(f"`{c}`"))


def _day(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType
    return parse_date(F.col(c)) if isinstance(kind, T.StringType) else F.col(c).cast("date")


class _OneLook:
    """Collects the aggregates and result rows that share one pass."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.aggregates: list[Column] = [F.count(F.lit(1)).alias("_rows")]
        self.entries: list[Column] = []

    def measure(self, aggregate: Column) -> Column:
        name = f"_m{len(self.aggregates)}"
        self.aggregates.append(aggregate.alias(name))
        return F.col(name)

    def add(self, check: str, column: str | None, status: Column, metric: Column, details: Column) -> None:
        self.entries.append(_entry(check, column, status, metric, details))

    def result(self) -> DataFrame:
        one_row = self.df.agg(*self.aggregates)
        return one_row.select(F.explode(F.array(*self.entries)).alias("e")).select("e.*")


def _completeness(look: _OneLook, checks: Checks) -> None:
    for c in look.df.columns:
        filled = look.measure(count_where(is_filled(look.df, c)))
        share = F.round(filled / F.nullif(F.col("_rows"), F.lit(0)), 4)
        look.add("completeness", c, _fail_if(share < checks.completeness), share,
                 F.concat(filled, F.lit(" filled / "), F.col("_rows"), F.lit(" rows")))


def _validity_numeric(look: _OneLook, checks: Checks) -> None:
    for c, (low, high) in checks.ranges.items():
        if c in look.df.columns:
            below = look.measure(count_where(_number(c) < F.lit(float(low))))
            above = look.measure(count_where(_number(c) > F.lit(float(high))))
            look.add("validity_numeric", c, _fail_if(below + above > 0), below + above,
                     F.concat(below, F.lit(f" below {low}, "), above, F.lit(f" above {high}")))


def _validity_date(look: _OneLook, checks: Checks, as_of: date) -> None:
    for c in checks.dates:
        if c in look.df.columns:
            day = _day(look.df, c)
            invalid = look.measure(count_where(F.col(c).isNotNull() & day.isNull()))
            future = look.measure(count_where(day > F.lit(as_of)))
            look.add("validity_date", c, _fail_if(invalid + future > 0), invalid + future,
                     F.concat(invalid, F.lit(" unparseable, "), future, F.lit(" in the future")))


def _freshness(look: _OneLook, checks: Checks, as_of: date) -> None:
    c = checks.fresh_column
    if c and c in look.df.columns and checks.fresh_days is not None:
        newest = look.measure(F.max(_day(look.df, c)))
        age = F.datediff(F.lit(as_of), newest)
        look.add("freshness", c, _fail_if(age > checks.fresh_days), age,
                 F.coalesce(F.concat(F.lit("newest value is "), age, F.lit(f" days old, limit {checks.fresh_days}")),
                            F.lit("no valid dates")))


def _before(df: DataFrame, rule: dict) -> tuple[str, Column]:
    """Violated when the first date is after the second (``strict``: or equal)."""
    first, second = rule["columns"]
    a, b = _day(df, first), _day(df, second)
    strict = rule.get("strict", False)
    return f"{first} {'<' if strict else '<='} {second}", a >= b if strict else a > b


def _non_negative(df: DataFrame, rule: dict) -> tuple[str, Column]:
    return f"{rule['column']} >= 0", _number(rule["column"]) < 0


# Row rules by type: each gives a name and the condition of a violation.
ROW_RULES: dict[str, Callable[[DataFrame, dict], tuple[str, Column]]] = {
    "before": _before,
    "non_negative": _non_negative,
}


def _rule_columns(rule: dict) -> list[str]:
    return [*rule.get("columns", ()), *(rule[k] for k in ("column", "group") if k in rule)]


def _consistency(look: _OneLook, checks: Checks) -> None:
    for rule in checks.rules:
        if rule["type"] in ROW_RULES and set(_rule_columns(rule)) <= set(look.df.columns):
            name, violated = ROW_RULES[rule["type"]](look.df, rule)
            n = look.measure(count_where(violated))
            look.add("consistency", name, _fail_if(n > 0), n, F.concat(n, F.lit(" violations")))


def one_look(df: DataFrame, checks: Checks, as_of: date) -> DataFrame:
    """Completeness, ranges, dates, row rules and freshness from one aggregate."""
    look = _OneLook(df)
    _completeness(look, checks)
    _validity_numeric(look, checks)
    _validity_date(look, checks, as_of)
    _consistency(look, checks)
    _freshness(look, checks, as_of)
    return look.result()


def _rows_from(df: DataFrame, *entry) -> DataFrame:
    return df.select(_entry(*entry).alias("e")).select("e.*")


def uniqueness(df: DataFrame, checks: Checks) -> DataFrame:
    """Distinct key tuples against rows; null counts as a value."""
    per_key = df.groupBy(*checks.key).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(F.count(F.lit(1)).alias("unique"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    repeated = F.col("total") - F.col("unique")
    return _rows_from(
        totals, "uniqueness", "+".join(checks.key), _fail_if(repeated > 0), repeated,
        F.concat(F.col("unique"), F.lit(" keys in "), F.col("total"), F.lit(" rows")),
    )


def bands(df: DataFrame, checks: Checks, slices: int | None = None) -> list[DataFrame]:
    """Values far outside the p5-p95 band of their group."""
    out = []
    for rule in checks.rules:
        if rule["type"] == "band" and set(_rule_columns(rule)) <= set(df.columns):
            value, group = rule["column"], rule["group"]
            narrow = df.select(F.col(group), _number(value).alias(value))
            flagged = flag_outside_band(narrow, group, value, "_outside", fix="none", slices=slices)
            n = flagged.agg(count_where(F.col("_outside")).alias("n"))
            out.append(_rows_from(n, "consistency", f"{value} in {group} band", _fail_if(F.col("n") > 0), F.col("n"),
                                  F.concat(F.col("n"), F.lit(" violations"))))
    return out


def referential_integrity(df: DataFrame, checks: Checks, references: dict[str, DataFrame]) -> list[DataFrame]:
    """Non-null values missing in the referenced column; an absent table is skipped."""
    out = []
    for c, (table, ref_column) in checks.references.items():
        name = f"{c} -> {table}.{ref_column}"
        if c not in df.columns or table not in references:
            one = df.sparkSession.range(1)
            out.append(_rows_from(one, "referential_integrity", name, F.lit(SKIPPED), F.lit(None),
                                  F.lit("skipped, no such table was given")))
            continue
        orphans = missing_references(df, c, references[table], ref_column)
        n = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
        out.append(_rows_from(n, "referential_integrity", name, _fail_if(F.col("n") > 0), F.col("n"),
                              F.concat(F.col("n"), F.lit(" rows point to nothing"))))
    return out


def distribution(df: DataFrame, checks: Checks) -> list[DataFrame]:
    """Share of the most common non-null value, all columns in one pass."""
    present = [c for c in checks.distribution if c in df.columns]
    if not present:
        return []
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in present])
    counted = (
        df.select(F.explode(pairs).alias("p"))
        .filter(F.col("p.v").isNotNull())
        .groupBy("p.c", "p.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    share = counted.groupBy("c").agg((F.max("n") / F.sum("n")).alias("share"))
    result = share.select(
        F.lit("distribution").alias("check"),
        F.col("c").alias("column"),
        _fail_if(F.col("share") > checks.top_share).alias("status"),
        F.round("share", 4).alias("metric"),
        F.concat(F.lit("the most common value holds "), F.round(F.col("share") * 100, 1), F.lit(" percent")).alias("details"),
    )
    return [result]


def outliers(df: DataFrame, checks: Checks) -> list[DataFrame]:
    """Values more than ``max_z`` population standard deviations from the mean."""
    present = [c for c in checks.outliers if c in df.columns]
    if not present:
        return []
    stats = df.agg(
        F.struct(
            *[F.avg(_number(c)).alias(f"mean{i}") for i, c in enumerate(present)],
            *[F.stddev_pop(_number(c)).alias(f"std{i}") for i, c in enumerate(present)],
        )
    ).scalar()
    far = []
    for i, c in enumerate(present):
        mean, std = stats[f"mean{i}"], stats[f"std{i}"]
        distance = F.when(std > 0, F.abs(_number(c) - mean) / std)
        far.append(count_where(distance > checks.max_z).alias(f"n{i}"))
    counted = df.agg(*far)
    entries = [
        _entry("outliers", c, _fail_if(F.col(f"n{i}") > 0), F.col(f"n{i}"),
               F.concat(F.col(f"n{i}"), F.lit(f" values lie more than {checks.max_z:g} deviations off")))
        for i, c in enumerate(present)
    ]
    return [counted.select(F.explode(F.array(*entries)).alias("e")).select("e.*")]


def run_checks(
    df: DataFrame,
    dataset: str,
    checks: Checks,
    *,
    references: dict[str, DataFrame] | None = None,
    as_of: date,
    slices: int | None = None,
) -> DataFrame:
    """All nine checks: (dataset, check, column, status, metric, details).

    A check without rules gives one PASS row, so each check always appears. Hand in
    a stored table when ``df`` is costly: about six passes read it.
    """
    parts = [
        one_look(df, checks, as_of),
        uniqueness(df, checks),
        *bands(df, checks, slices),
        *referential_integrity(df, checks, references or {}),
        *distribution(df, checks),
        *outliers(df, checks),
    ]
    idle = _without_rules(df, checks)
    if idle:
        one = df.sparkSession.range(1)
        entries = [_entry(c, None, F.lit(PASS), F.lit(None), F.lit("not configured")) for c in idle]
        parts.append(one.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    merged = reduce(DataFrame.unionByName, [p.select(*COLUMNS) for p in parts])
    return merged.select(F.lit(dataset).alias("dataset"), *COLUMNS)


def _without_rules(df: DataFrame, checks: Checks) -> list[str]:
    here = set(df.columns)
    idle = {
        "validity_numeric": not here & set(checks.ranges),
        "validity_date": not here & set(checks.dates),
        "consistency": not any(set(_rule_columns(r)) <= here for r in checks.rules),
        "referential_integrity": not checks.references,
        "distribution": not here & set(checks.distribution),
        "freshness": checks.fresh_column not in here or checks.fresh_days is None,
        "outliers": not here & set(checks.outliers),
    }
    return [check for check, unused in idle.items() if unused]


def check_statuses(results: DataFrame) -> DataFrame:
    """One row per dataset and check: FAIL if any of its rows failed."""
    return results.groupBy("dataset", "check").agg(
        _fail_if(count_where(F.col("status") == FAIL) > 0).alias("status")
    )


def suite_totals(results: DataFrame) -> DataFrame:
    """Checks run, passed and failed per dataset."""
    passed = count_where(F.col("status") == PASS)
    return check_statuses(results).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("checks_run"),
        passed.alias("checks_passed"),
        (F.count(F.lit(1)) - passed).alias("checks_failed"),
    )
