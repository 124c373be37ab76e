"""The gate: nothing downstream runs when a key column is too empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_where, is_filled

# Share of rows that must carry their key, and the key per dataset.
CRITICAL_COMPLETENESS = 0.80
KEY_COLUMNS = {"projects": "project_id", "employees": "employee_id", "transactions": "transaction_id"}


class QualityGateError(ValueError):
    """Key completeness below the critical threshold."""


def key_completeness(
    frames: dict[str, DataFrame],
    keys: dict[str, str] = KEY_COLUMNS,
    threshold: float = CRITICAL_COMPLETENESS,
) -> DataFrame:
    """One row per dataset: filled share of its key and whether it passes; an absent key counts as empty."""
    rows = []
    for name, df in frames.items():
        filled = is_filled(df, keys[name]) if keys[name] in df.columns else F.lit(False)
        share = F.round(count_where(filled) / F.nullif(F.count(F.lit(1)), F.lit(0)), 4)
        rows.append(df.agg(F.coalesce(share, F.lit(0.0)).alias("completeness")).select(
            F.lit(name).alias("dataset"), F.lit(keys[name]).alias("key_column"), "completeness",
            (F.col("completeness") >= threshold).alias("passed"),
        ))
    return reduce(DataFrame.unionByName, rows)


def gate(
    frames: dict[str, DataFrame],
    keys: dict[str, str] = KEY_COLUMNS,
    threshold: float = CRITICAL_COMPLETENESS,
) -> dict[str, DataFrame]:
    """Return ``frames`` unchanged, or raise naming every dataset that fails.

    Only one row per dataset comes to the driver.
    """
    failed = key_completeness(frames, keys, threshold).filter(~F.col("passed")).collect()
    if failed:
        found = "; ".join(f"{r.dataset}.{r.key_column} {r.completeness:.1%} < {threshold:.0%}" for r in failed)
        raise QualityGateError(f"too many rows without a key, load stopped: {found}")
    return frames
