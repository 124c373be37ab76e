"""Governance policies as table operations."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.files import write_table

# Classification levels.
PUBLIC, INTERNAL, CONFIDENTIAL, PII = "Public", "Internal", "Confidential", "PII"

# Access of each persona to each dataset.
NONE, READ, WRITE, MASKED, AGGREGATED = "None", "Read", "Read + Write", "Read (masked)", "Read (aggregated)"
ACCESS = {
    "Data Engineer": {
        "projects": WRITE, "employees": WRITE, "transactions": WRITE, "salary_history": READ, "events": WRITE,
    },
    "BI Analyst": {
        "projects": READ, "employees": MASKED, "transactions": READ, "salary_history": NONE, "events": AGGREGATED,
    },
    "Finance Team": {
        "projects": READ, "employees": NONE, "transactions": WRITE, "salary_history": READ, "events": NONE,
    },
    "HR Team": {
        "projects": NONE, "employees": WRITE, "transactions": NONE, "salary_history": WRITE, "events": NONE,
    },
    "Executive": {
        "projects": READ, "employees": AGGREGATED, "transactions": AGGREGATED, "salary_history": NONE,
        "events": AGGREGATED,
    },
}


@dataclass(frozen=True)
class Retention:
    """Months after which rows are archived and deleted; ``None`` skips the step."""

    archive_after: int | None
    delete_after: int


# Retention per dataset, in months. Employees and salary history
# count from the leaving date.
RETENTION = {
    "projects": Retention(24, 84),
    "employees": Retention(None, 84),
    "transactions": Retention(12, 60),
    "salary_history": Retention(None, 120),
    "events": Retention(None, 24),
}


class AccessDenied(PermissionError):
    """The persona may not read the dataset in this form."""


def classify_columns(df: DataFrame, dataset: str, classes: dict[str, str]) -> DataFrame:
    """Class of every column of ``df`` with its filled rows; an unclassified column FAILs."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(classes.get(c)).cast("string").alias("class"),
                F.col(f"n{i}").alias("filled_rows"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return filled.select(F.explode(entries).alias("e")).select(
        F.lit(dataset).alias("dataset"), "e.*",
        F.when(F.col("e.class").isNull(), "FAIL").otherwise("PASS").alias("status"),
    )


def persona_view(
    df: DataFrame,
    dataset: str,
    persona: str,
    *,
    hidden: list[str] | None = None,
    group: list[str] | None = None,
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """What ``persona`` may see of ``dataset``.

    Masked access drops the ``hidden`` columns; aggregated access returns
    ``measures`` per ``group`` only; no access raises :class:`AccessDenied`.
    """
    level = ACCESS[persona][dataset]
    if level == NONE:
        raise AccessDenied(f"{persona} has no access to {dataset}")
    if level == MASKED:
        if not hidden:
            raise AccessDenied(f"{persona} reads {dataset} only without its restricted columns; name them")
        return df.drop(*hidden)
    if level == AGGREGATED:
        if not measures:
            raise AccessDenied(f"{persona} reads {dataset} only as aggregates")
        return df.groupBy(*(group or [])).agg(*[m.alias(n) for n, m in measures.items()])
    return df


def retention_split(df: DataFrame, day: str, as_of: date, policy: Retention) -> DataFrame:
    """Mark every row ``keep``, ``archive`` or ``delete`` by its age; undated rows are kept."""
    def older(months: int) -> Column:
        return F.add_months(F.col(day), months) <= F.lit(as_of)

    disposition = F.when(older(policy.delete_after), "delete")
    if policy.archive_after is not None:
        disposition = disposition.when(older(policy.archive_after), "archive")
    return df.withColumn("disposition", disposition.otherwise("keep"))


def write_by_disposition(df: DataFrame, path: str) -> int:
    """Keep and archive go to their own folder; delete is not written. Returns the rows kept."""
    return write_table(df.filter(F.col("disposition") != "delete"), path, partition_by=["disposition"])


def pseudonymise(df: DataFrame, *, ids: list[str], names: list[str], salt: str, expired: Column | None = None) -> DataFrame:
    """Replace ids by salted hashes and blank direct identifiers, for the ``expired`` rows."""
    due = F.lit(True) if expired is None else F.coalesce(expired, F.lit(False))

    def value(c: str) -> Column:
        column = F.col(c)
        if c in ids:
            hashed = F.sha2(F.concat(F.lit(salt), column.cast("string")), 256)
            return F.when(due, hashed).otherwise(column.cast("string")).alias(c)
        if c in names:
            return F.when(~due, column).alias(c)
        return column

    return df.select(*[value(c) for c in df.columns])


# Shapes of personal data looked for in free text.
PERSONAL_DATA = {
    "emails": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ip_addresses": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "phone_numbers": r"\+?[0-9]{1,3}[ -][0-9]{3}[ -][0-9]{3,4}[ -]?[0-9]{0,4}",
}


def free_text_audit(df: DataFrame, text: str, group: str) -> DataFrame:
    """Personal-data findings in whole texts, summed per ``group``."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("texts"),
        *[
            F.coalesce(F.sum(F.regexp_count(F.col(text), F.lit(pattern))), F.lit(0)).alias(name)
            for name, pattern in PERSONAL_DATA.items()
        ],
    )
