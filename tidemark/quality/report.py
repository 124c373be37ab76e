"""Markdown and text reports from small result frames."""

from __future__ import annotations

import logging
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.quality.checks import ALL_CHECKS, FAIL, run_checks
from tidemark.quality.config import DATASETS, Checks, checks_for
from tidemark.session import stage

logger = logging.getLogger(__name__)


def check_dataset(
    df: DataFrame,
    dataset: str,
    *,
    references: dict[str, DataFrame] | None = None,
    as_of: date,
    datasets: dict[str, Checks] = DATASETS,
) -> DataFrame:
    """All checks configured for ``dataset``, landed, failures logged; an unknown name raises."""
    checks = checks_for(dataset, datasets)
    found = stage(run_checks(df, dataset, checks, references=references, as_of=as_of), "checks")
    log_failures(found)
    return found


def log_failures(results: DataFrame) -> int:
    """One warning per failed row of the results; returns how many there were."""
    failed = results.filter(F.col("status") == FAIL).collect()
    for r in failed:
        logger.warning("check failed: %s %s %s (%s)", r.dataset, r.check, r.column, r.details)
    return len(failed)


def quality_report(results: DataFrame, dataset: str) -> str:
    """One Markdown table for ``dataset``; results hold a few rows per column."""
    rows = results.filter(F.col("dataset") == dataset).collect()
    failed = {r.check for r in rows if r.status == FAIL}
    lines = [
        f"# Data quality: {dataset}",
        "",
        f"Checks run: {len(ALL_CHECKS)}, passed: {len(ALL_CHECKS) - len(failed)}, failed: {len(failed)}",
        "",
        "| Check | Status | Details |",
        "|---|---|---|",
    ]
    for check in ALL_CHECKS:
        found = sorted((r for r in rows if r.check == check), key=lambda r: r.column or "")
        text = "; ".join(f"{r.column}: {r.details}" if r.column else r.details for r in found)
        lines.append(f"| {check} | {'**FAIL**' if check in failed else 'PASS'} | {text} |")
    return "\n".join(lines) + "\n"


def stage_rows(frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(dataset, stage, rows) for frames keyed by (dataset, stage)."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(dataset).alias("dataset"), F.lit(stage).alias("stage"), "rows"
        )
        for (dataset, stage), df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def run_report(rows: DataFrame, decisions: list[str], seconds: float, budget_seconds: float) -> str:
    """Text summary of a run: measured rows per stage, decisions, and time against the budget."""
    lines = ["Run report", "", "Rows:"]
    lines += [f"  {r.dataset} {r.stage}: {r.rows}" for r in rows.orderBy("dataset", "stage").collect()]
    lines += ["", "Decisions:", *[f"  - {d}" for d in decisions]]
    verdict = "PASS" if seconds < budget_seconds else "FAIL"
    lines += ["", f"Elapsed {seconds:.2f} s of {budget_seconds:g} s: {verdict}"]
    return "\n".join(lines) + "\n"
