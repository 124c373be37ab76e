"""Approximate nearest neighbours by collision-counting hashing.

Every hash is the projection of a unit vector on one random line. Per line the
projections are kept as a sorted array; a query opens a window around its own
projection. Windows widen from round to round (virtual rehashing: the same
arrays serve every radius), and a vector's collisions are the lines whose window
holds it. Vectors that reach the collision threshold are verified by their
cosine.

Two unit vectors at distance s differ on a line by a normal number of deviation
s, so collisions of a vector at distance s are binomial with a known
probability. A query ends at a width at which its k-th verified vector is so near
that any vector as near has reached the threshold with probability ``CERTAIN``;
windows grow towards that width, and hold all vectors at last.

Vectors are indexed in parts of some ``PART`` rows, every row in one, and queries
are dealt in blocks of some ``QUERIES``; each (part, block) is one task's group, so
no group grows with the data. A part's best are ranked together per query.
The work grows with queries times parts, as the whole-table query set asks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, as query or candidate; vectors are compared with those
of their own length only; null ids are no queries; repeated ids are rows of
their own, each a candidate of the other; an empty table gives an empty result;
further columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stage

NEAREST = 5
EVERY = 50  # ids divisible by it are the queries
LINES = 64  # random lines: one sorted array each
THRESHOLD = 0.62  # share of the lines on which a vector must collide to be verified
CERTAIN = 0.98  # probability that a vector as near as the k-th found has been verified
WIDTHS = 2.2  # growth of the windows from round to round, at most
FIRST = 0.2  # half-width of the first windows
PART = 16_384  # vectors of an index
QUERIES = 2048  # queries of a block
SEED = 20240311


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles, those that can take part."""
    for batch in batches:
        ids, keys = [], []
        for id_, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not v or any(x is None for x in v):
                continue
            row = np.array(v, "<f8")
            with np.errstate(over="ignore"):
                size = float(np.sqrt((row * row).sum()))
            if np.isfinite(size) and size > 0:
                ids.append(id_)
                keys.append(row.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["id", "key"])


def cosines(rows: np.ndarray, norms: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision; a row's value does not depend on the rows around it."""
    return (rows * query).sum(axis=1) / (norms * np.sqrt((query * query).sum()))


@cache
def lines(dimension: int) -> np.ndarray:
    """``LINES`` random directions, the same in every task."""
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, LINES))


def _tail(p: float, least: int) -> float:
    """P(binomial(LINES, p) >= least)."""
    if p >= 1:
        return 1.0
    if p <= 0:
        return 0.0
    logs = [
        math.lgamma(LINES + 1) - math.lgamma(k + 1) - math.lgamma(LINES - k + 1) + k * math.log(p) + (LINES - k) * math.log1p(-p)
        for k in range(least, LINES + 1)
    ]
    return min(1.0, math.fsum(map(math.exp, logs)))


@cache
def sure_ratio() -> float:
    """Half-width over distance at which a vector reaches the threshold with probability ``CERTAIN``, found by halving."""
    least = math.ceil(THRESHOLD * LINES)
    low, high = 0.0, 100.0
    for _ in range(60):
        ratio = (low + high) / 2
        low, high = (low, ratio) if _tail(math.erf(ratio / math.sqrt(2)), least) >= CERTAIN else (ratio, high)
    return high


class SortedLines:
    """Sorted projections of one part's unit vectors, an array for every line."""

    def __init__(self, units: np.ndarray):
        projected = (units @ lines(units.shape[1])).T
        self.size = len(units)
        order = np.argsort(projected, axis=1, kind="stable")
        # All arrays in one: line i is shifted by i times more than the numbers on a line can differ.
        self.shift = (4 * float(np.abs(projected).max(initial=1)) + 8) * np.arange(LINES)
        self.sorted = (np.take_along_axis(projected, order, axis=1) + self.shift[:, None]).ravel()
        self.order = order.ravel()


class Windows:
    """The windows of one query, and the collisions that they hold."""

    def __init__(self, index: SortedLines, query: np.ndarray):
        self.index = index
        reach = np.maximum(2, index.shift[1] / 4)  # no vector lies farther from the arrays' middle
        self.centre = np.clip(query @ lines(query.size), -reach, reach) + index.shift
        self.first = np.arange(LINES) * index.size
        self.begin = self.end = np.searchsorted(index.sorted, self.centre)
        self.counts = np.zeros(index.size, np.int64)
        self.taken = np.zeros(index.size, bool)

    def widen(self, width: float) -> np.ndarray:
        """Vectors that reach the threshold once all windows have the half-width ``width``."""
        order, size = self.index.order, self.index.size
        width = min(width, float(self.index.shift[1]) / 2)
        both = np.searchsorted(self.index.sorted, np.r_[self.centre - width, self.centre + width])
        begin = np.minimum(np.maximum(both[:LINES], self.first), self.begin)
        end = np.maximum(np.minimum(both[LINES:], self.first + size), self.end)
        # Only what the wider windows add is counted.
        new = [order[a:b] for a, b in zip(begin.tolist(), self.begin.tolist(), strict=True) if a < b]
        new += [order[a:b] for a, b in zip(self.end.tolist(), end.tolist(), strict=True) if a < b]
        self.begin, self.end = begin, end
        if new:
            self.counts += np.bincount(np.concatenate(new), minlength=size)
        reached = np.flatnonzero((self.counts >= math.ceil(THRESHOLD * LINES)) & ~self.taken)
        self.taken[reached] = True
        return reached


def nearest(vectors: np.ndarray, places: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int):
    """(query, vector, cosine) of up to ``k`` nearest found for every query; ``own`` are the queries' places."""
    index = SortedLines(vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    widest = 2 * sure_ratio()  # unit vectors are at most 2 apart
    hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q, (query, place) in enumerate(zip(queries, own, strict=True)):
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        windows = Windows(index, query / np.sqrt((query * query).sum()))
        width, needed = FIRST, widest
        while True:
            new = windows.widen(width) if width < widest else np.flatnonzero(~windows.taken)
            new = new[places[new] != place]
            if new.size:
                found, scores = np.r_[found, new], np.r_[scores, cosines(vectors[new], norms[new], query)]
                if found.size > k:
                    least = np.partition(scores, found.size - k)[found.size - k]
                    found, scores = found[scores >= least], scores[scores >= least]
                best = np.lexsort((places[found], ids[found], -scores))[:k]
                found, scores = found[best], scores[best]
            if found.size == k:  # wide enough once all as near as the k-th must have been verified
                needed = sure_ratio() * math.sqrt(max(2 - 2 * scores[-1], 0))
            if width >= min(needed, widest):
                break
            width = min(width * WIDTHS, needed)
        hits.append((np.full(found.size, q), found, scores))
    return tuple(np.concatenate(c) for c in zip(*hits, strict=True)) if hits else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _compared(k: int):
    def run(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"at": [], "query_id": [], "vec_id": [], "place": [], "score": []}).astype(
                {"at": "int64", "query_id": "int64", "vec_id": "Int64", "place": "int64", "score": "float64"})
        vectors = np.frombuffer(b"".join(left["key"]), "<f8").reshape(len(left), -1)
        queries = np.frombuffer(b"".join(right["key"]), "<f8").reshape(len(right), -1)
        ids = left["id"].astype("Int64")
        # Null ids come after all others among equal scores.
        order = ids.fillna(np.iinfo(np.int64).max).to_numpy(np.int64)
        q, found, scores = nearest(vectors, left["at"].to_numpy(), order, queries, right["at"].to_numpy(), k)
        return pd.DataFrame({
            "at": right["at"].to_numpy()[q], "query_id": right["id"].to_numpy(np.int64)[q], "vec_id": ids.to_numpy()[found],
            "place": left["at"].to_numpy()[found], "score": scores})

    return run


def nearest_neighbours(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST, every: int = EVERY,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose id is divisible by ``every``."""
    kept = stage(
        table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        .mapInArrow(_vectors, "id bigint, key binary").withColumn("at", F.monotonically_increasing_id()),
        "ann-vectors")
    asked = kept.filter(F.col("id") % every == 0)
    size = F.length("key").alias("size")
    # One row per vector length.
    sizes = kept.groupBy(size).agg(F.count(F.lit(1)).alias("n")).select(
        "size", F.ceil(F.col("n") / PART).alias("parts"))
    blocks = asked.groupBy(size).agg(F.count(F.lit(1)).alias("n")).select("size", F.ceil(F.col("n") / QUERIES).alias("blocks"))
    grid = stage(sizes.join(blocks, "size"), "ann-grid")

    def dealt(frame: DataFrame, own: str, count: str, other: str, others: str) -> DataFrame:
        return (
            frame.withColumn("size", F.length("key")).join(grid, "size")
            .withColumn(own, F.pmod(F.xxhash64("at"), F.col(count)))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)))
            .select(*[F.col(c).alias(c) for c in ("size", "part", "block", "at", "id", "key")])
        )

    left = dealt(kept, "part", "parts", "block", "blocks").groupBy("size", "part", "block")
    right = dealt(asked, "block", "blocks", "part", "parts").groupBy("size", "part", "block")
    found = left.cogroup(right).applyInPandas(_compared(k), "at bigint, query_id bigint, vec_id bigint, place bigint, score double")
    best = Window.partitionBy("at").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "place")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
