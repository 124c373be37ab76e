"""Primary key, not-null and foreign key constraints as counted violations."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_where
from tidemark.operators.lookup import missing_references


@dataclass(frozen=True)
class Constraints:
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)


# Constraints of the star schema.
STAR: dict[str, Constraints] = {
    "dim_date": Constraints(("date_key",), (("full_date",),), ("date_key", "full_date")),
    "dim_project": Constraints(("project_key",), (("project_id",),), ("project_key", "project_id", "project_name")),
    "dim_employee": Constraints(
        ("employee_key",), (), ("employee_key", "employee_id", "valid_from", "valid_to", "is_current")
    ),
    "dim_vendor": Constraints(("vendor_key",), (("vendor_id",),), ("vendor_key", "vendor_id", "vendor_name")),
    "bridge_employee_project": Constraints(
        ("bridge_key",), (), ("employee_key", "project_key"),
        {"employee_key": ("dim_employee", "employee_key"), "project_key": ("dim_project", "project_key")},
    ),
    "fact_transactions": Constraints(
        ("transaction_key",), (), ("transaction_key",),
        {
            "project_key": ("dim_project", "project_key"),
            "employee_key": ("dim_employee", "employee_key"),
            "vendor_key": ("dim_vendor", "vendor_key"),
            "date_key": ("dim_date", "date_key"),
        },
    ),
}


def constrained_columns(table: str, constraints: dict[str, Constraints] = STAR) -> list[str]:
    """The columns of a table that any constraint looks at."""
    rule = constraints[table]
    own = [*rule.primary_key, *(c for u in rule.unique for c in u), *rule.not_null, *rule.foreign_keys]
    referred = [column for r in constraints.values() for name, column in r.foreign_keys.values() if name == table]
    return list(dict.fromkeys([*own, *referred]))


def violations(tables: dict[str, DataFrame], constraints: dict[str, Constraints] = STAR) -> DataFrame:
    """(table, constraint, columns, violations) for every declared constraint."""
    rows = []
    for name, rule in constraints.items():
        df = tables[name]
        for kind, columns in [("primary_key", rule.primary_key), *[("unique", u) for u in rule.unique]]:
            extra = (
                df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
                .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
            )
            rows.append(_row(extra, name, kind, "+".join(columns)))
        if rule.not_null:
            counted = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in rule.not_null])
            pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in rule.not_null])
            nulls = counted.select(F.explode(pairs).alias("p"))
            rows.append(nulls.select(
                F.lit(name).alias("table_name"), F.lit("not_null").alias("constraint"),
                F.col("p.c").alias("columns"), F.col("p.n").cast("long").alias("violations"),
            ))
        for column, (table, target) in rule.foreign_keys.items():
            lost = missing_references(df, column, tables[table], target)
            n = lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
            rows.append(_row(n, name, "foreign_key", column))
    return reduce(DataFrame.unionByName, rows)


def _row(df: DataFrame, table: str, kind: str, columns: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("constraint"), F.lit(columns).alias("columns"),
        F.col("violations").cast("long").alias("violations"),
    )
