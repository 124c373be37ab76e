"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stage, staging_path

__all__ = [
    "class_sizes", "forget", "fresh_names", "held_out", "logistic_1d", "release_freed", "slices_for", "stage", "staging_path", "table",
    "training_rows", "whole_text", "worker_cache",
]

_KEPT: dict[tuple[str, ...], Any] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def worker_cache(owner: tuple[str, ...], make: Callable[[], Any]) -> Any:
    """What a Python worker keeps between tasks, of one owner at a time.

    Workers outlive a stage: what another operator, or an earlier model, has kept is let go first.
    """
    if owner not in _KEPT:
        forget()
        _KEPT[owner] = make()
    return _KEPT[owner]


def forget() -> None:
    """Let go of what the worker keeps."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
    release_freed()


def release_freed() -> None:
    """Hand freed memory back to the system, also that of the C library: idle workers count towards an executor's memory."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names close to the wanted ones that no column of ``df`` carries."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def held_out(column: str = "doc_id", folds: int = 5) -> Column:
    """Rows never learned from: crc32 of the id as text divisible by ``folds``. Null ids count as held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(t, y): at most ``per_class`` labelled texts of each class, the first by a hash of their id.

    The bound is a parameter of every classifier here; held-out rows, null
    labels and ids without a document are never among them, and of rows that
    share an id one counts. Ids are picked from the labels by top-k and
    broadcast, two times ``per_class`` at most, so only the sample's texts move.
    """
    marked = labels.filter(~held_out() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    picked = [
        marked.filter(F.col("y") == y).withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(per_class).drop("h")
        for y in (0, 1)
    ]
    rows = docs.select("doc_id", whole_text().alias("t")).join(F.broadcast(reduce(DataFrame.unionAll, picked)), "doc_id")
    return rows.groupBy("doc_id", "y").agg(F.min("t").alias("t")).select("t", "y")


def class_sizes(labels: DataFrame, label: str) -> tuple[int, int]:
    """Labelled rows of class 0 and 1 outside the held-out fold, counted over the whole table."""
    found = labels.filter(~held_out() & F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    counted = {int(r[label]): int(r["n"]) for r in found.collect()}
    return counted.get(0, 0), counted.get(1, 0)


def logistic_1d(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit, targets smoothed towards one half."""
    n1, n0 = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    spread = max(float(x.std()), 1e-9)
    z = np.c_[(x - x.mean()) / spread, np.ones(len(x))]
    w = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        g = z.T @ (weight * (p - target)) + 1e-3 * w
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / spread), float(w[1] - w[0] * x.mean() / spread)


def slices_for(spark: SparkSession, size: float, per_slice: float) -> int:
    """Tasks for ``size`` units of work: at least the session's shuffle partitions, more as the input grows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), int(size // per_slice) + 1)
