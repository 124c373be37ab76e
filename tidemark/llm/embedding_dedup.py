"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most
sqrt(2 - 2c) = reach. Vectors sit in nested levels of nodes whose radii halve
from level to level; a pair of nodes is left out when the distance of their
centres exceeds both covering radii and the reach, and counted whole when even
the farthest points are within reach. Everything between is compared.

* Upper levels: farthest-first centres of a bounded sample give the nested nets
  (the k-th centre is as far from the earlier ones as its level's radius says).
  Every vector goes to its nearest bottom centre; covering radii are measured
  over all vectors. Traversing this tree against itself gives the pairs of
  bottom nodes that must meet.
* Bottom nodes of more than ``NODE`` vectors are dealt into parts, so one dense
  spot, even with a third of all rows, is many tasks.
* Lower levels: each task builds the levels of its two parts and traverses them
  against each other, down to blocks that are multiplied.

Equal vectors are one vector with a weight. Counts are added up, and only the
links that hold a component together leave a task.

Defined cases: null, zero or empty vectors and vectors with null or non-finite
components link with nothing; vectors of different length never link; rows
that repeat an id count as vectors of their own; an empty table gives an empty
result; further columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.llm.components import connected_components

SIMILARITY = 0.95
SAMPLE = 4096  # vectors that the upper levels are fitted on
NODE = 8192  # vectors of a part
BLOCK = 1024  # vectors below which a node is not divided further
FANOUT = 16
ROUND = 1e-9  # slack of all bounds against rounding


def _units(keys: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(keys), "<f8").reshape(len(keys), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; null where they can't link."""
    for batch in batches:
        keys = []
        for v in batch.column(1).to_pylist():
            row = np.array([np.nan] if v is None else [np.nan if x is None else x for x in v], "<f8") + 0.0
            with np.errstate(over="ignore"):
                size = np.linalg.norm(row)
            keys.append(row.tobytes() if row.size and np.isfinite(size) and size > 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["id", "key"])


def farthest_first(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of centres, each farthest from the earlier ones, and that distance."""
    chosen, far = [0], [2.0]
    distance = _distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)):
        k = int(distance.argmax())
        if distance[k] <= ROUND:
            break
        chosen.append(k)
        far.append(float(distance[k]))
        distance = np.minimum(distance, _distances(points, points[k : k + 1])[:, 0])
    return np.array(chosen), np.array(far)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class Node:
    def __init__(self, centre: np.ndarray, radius: float, children: list[Node], members):
        self.centre, self.radius, self.children, self.members = centre, radius, children, members


def upper_tree(centres: np.ndarray, far: np.ndarray, radii: np.ndarray) -> Node:
    """The nested levels over the bottom centres: level i holds the centres farther than 2 / 2^i from earlier ones."""
    level = np.floor(np.log2(2 / np.maximum(far, 1e-12))).astype(int)
    nodes = [Node(centres[k], float(radii[k]), [], k) for k in range(len(centres))]
    for i in sorted(set(level.tolist()), reverse=True):
        above = np.flatnonzero(level < i)
        here = np.flatnonzero(level == i)
        if not above.size:
            above = here[:1]
        parent = above[_distances(centres[here], centres[above]).argmin(axis=1)]
        for k, p in zip(here.tolist(), parent.tolist(), strict=True):
            if k != p:
                own = nodes[p]
                if isinstance(own.members, int):  # the centre itself stays as a child on the next level
                    own = nodes[p] = Node(centres[p], own.radius, [own], None)
                own.children.append(nodes[k])
                gap = float(_distances(centres[p : p + 1], centres[k : k + 1])[0, 0])
                own.radius = max(own.radius, gap + nodes[k].radius)
    return nodes[0]


def lower_tree(points: np.ndarray) -> Node:
    """Levels of one part: nodes are divided while a division brings the radius down."""

    def grow(members: np.ndarray, centre: np.ndarray) -> Node:
        radius = float(_distances(points[members], centre[None]).max())
        if members.size <= BLOCK or radius <= ROUND:
            return Node(centre, radius, [], members)
        chosen, far = farthest_first(points[members], FANOUT)
        own = _distances(points[members], points[members[chosen]]).argmin(axis=1)
        if far[-1] > 0.75 * radius:  # even so many centres don't cover with smaller balls
            return Node(centre, radius, [], members)
        parts = [grow(members[own == k], points[members[c]]) for k, c in enumerate(chosen) if (own == k).any()]
        return Node(centre, radius, parts, members)

    return grow(np.arange(len(points)), points[0])


def traverse(a: Node, b: Node, same: bool, reach: float) -> Iterator[tuple[Node, Node, bool, bool]]:
    """(node, node, whether both are one, whether all pairs are within reach) that must be looked at."""
    todo = [(a, b, same)]
    while todo:
        a, b, same = todo.pop()
        gap = 0.0 if same else float(np.sqrt(max(2 - 2 * float(a.centre @ b.centre), 0)))
        if gap > a.radius + b.radius + reach + ROUND:
            continue
        if gap + a.radius + b.radius < reach - ROUND and a.members is not None and b.members is not None:
            yield a, b, same, True
        elif not a.children and not b.children:
            yield a, b, same, False
        elif same:
            kids = a.children
            todo += [(x, y, i == j) for i, x in enumerate(kids) for j, y in enumerate(kids) if i <= j]
        elif a.children and (not b.children or a.radius >= b.radius):
            todo += [(x, b, False) for x in a.children]
        else:
            todo += [(a, x, False) for x in b.children]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Least node of each node's component, by spreading the least label over the pairs."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare_parts(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray, same: bool, similarity: float):
    """(links per row of a, links per row of b, pairs (i, j) that keep what is linked connected)."""
    reach = float(np.sqrt(2 - 2 * similarity))
    na, nb, stars = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), []
    tree_a = lower_tree(a)
    tree_b = tree_a if same else lower_tree(b)
    for x, y, one, whole in traverse(tree_a, tree_b, same, reach):
        if whole:
            na[x.members] += wb[y.members].sum()
            if one:
                na[x.members] -= wb[x.members]
            else:
                nb[y.members] += wa[x.members].sum()
            stars.append(np.c_[np.repeat(x.members[:1], y.members.size), y.members])
            stars.append(np.c_[x.members, np.repeat(y.members[:1], x.members.size)])
            continue
        for k in range(0, x.members.size, BLOCK):
            rows = x.members[k : k + BLOCK]
            for m in range(0, y.members.size, BLOCK):
                columns = y.members[m : m + BLOCK]
                if one and m < k:
                    continue
                hit = a[rows] @ b[columns].T >= similarity
                if one and m == k:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                i, j = np.nonzero(hit)
                na[rows] += hit @ wb[columns]
                if not (one and m == k):
                    nb[columns] += wa[rows] @ hit
                label = _forest(i, j + rows.size, rows.size + columns.size)
                # Star of each component around its least row.
                touched = np.unique(np.r_[i, j + rows.size])
                root, far = label[touched], touched
                keep = root != far
                root, far = root[keep], far[keep]
                everything = np.r_[rows, columns]
                side = np.r_[np.zeros(rows.size, bool), np.ones(columns.size, bool)]
                stars.append(np.c_[everything[root], np.where(side[far], everything[far], -1 - everything[far])])
    return na, nb, np.concatenate(stars) if stars else np.zeros((0, 2), np.int64)


def _joined(similarity: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        left = group[group["side"] <= 1]
        right = group[group["side"] >= 1]
        same = bool((group["side"] == 1).all())
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype({"a": "int64", "b": "Int64", "n": "int64"})
        ia, ib = left["id"].to_numpy(), right["id"].to_numpy()
        a = _units(list(left["key"]))
        b = a if same else _units(list(right["key"]))
        na, nb, stars = compare_parts(a, left["weight"].to_numpy(), b, right["weight"].to_numpy(), same, similarity)
        if same:
            na, nb = na + nb, np.zeros(0, np.int64)
        other = np.where(stars[:, 1] >= 0, ib[np.maximum(stars[:, 1], 0)] if len(ib) else 0, ia[np.maximum(-1 - stars[:, 1], 0)])
        edges = np.unique(np.c_[ia[stars[:, 0]], other], axis=0) if len(stars) else np.zeros((0, 2), np.int64)
        counted = np.r_[ia[na > 0], ib[nb > 0] if not same else ia[:0]]
        n = np.r_[na[na > 0], nb[nb > 0] if not same else na[:0]]
        b_side = pd.Series(np.r_[np.zeros(len(counted), np.int64), edges[:, 1]], dtype="Int64")
        b_side[: len(counted)] = pd.NA
        return pd.DataFrame({"a": np.r_[counted, edges[:, 0]], "b": b_side, "n": np.r_[n, np.zeros(len(edges), np.int64)]})

    return run


def _links_of(vectors: DataFrame, size: int, similarity: float) -> DataFrame:
    """(a, null, n) links of a vector and (a, b, 0) links that hold components together, for vectors of one length."""
    spark = vectors.sparkSession
    sample = _units([bytes(r["key"]) for r in vectors.select("key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).collect()])
    chosen, far = farthest_first(sample, max(1, min(SAMPLE, -(-size // NODE))))
    centres = sample[chosen]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_units(batch.column(1).to_pylist()), centres)
                own = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(own.astype(np.int32)), pa.array(d[np.arange(len(own)), own])],
                    ["id", "key", "weight", "leaf", "distance"])

    placed = stage(vectors.select("id", "key", "weight").mapInArrow(
        assign, "id bigint, key binary, weight bigint, leaf int, distance double"), "cover-leaves")
    # One row per centre: at most SAMPLE.
    leaves = {r["leaf"]: r for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("r")).collect()}
    radii = np.array([leaves[k]["r"] + ROUND if k in leaves else 0.0 for k in range(len(centres))])
    parts = [-(-leaves[k]["n"] // NODE) if k in leaves else 0 for k in range(len(centres))]
    root = upper_tree(centres, far, radii)
    reach = float(np.sqrt(2 - 2 * similarity))
    # A whole-reach pair of bottom nodes is still compared below, where it is counted whole without looking at vectors.
    near = [(x.members, y.members) for x, y, _, _ in traverse(root, root, True, reach)]
    met = spark.createDataFrame(
        [(min(x, y), max(x, y), parts[min(x, y)], parts[max(x, y)]) for x, y in near if parts[x] and parts[y]],
        "x int, y int, nx int, ny int")
    pairs = (
        met.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
        .filter("x < y OR i <= j")
        .select(F.format_string("%d.%d-%d.%d", "x", "i", "y", "j").alias("pair"), "x", "i", "y", "j")
    )
    one = F.expr("x = y AND i = j")
    uses = pairs.select("pair", F.col("x").alias("leaf"), F.col("i").alias("part"), F.when(one, 1).otherwise(0).alias("side")).unionByName(
        pairs.filter(~one).select("pair", F.col("y").alias("leaf"), F.col("j").alias("part"), F.lit(2).alias("side")))
    many = spark.createDataFrame([(k, n) for k, n in enumerate(parts) if n], "leaf int, parts int")
    dealt = placed.join(F.broadcast(many), "leaf").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    met_rows = dealt.join(uses, ["leaf", "part"]).select("pair", "side", "id", "weight", "key")
    return met_rows.groupBy("pair").applyInPandas(_joined(similarity), "a bigint, b bigint, n bigint")


def embedding_groups(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similarity: float = SIMILARITY
) -> DataFrame:
    """id, n_links (other vectors linked directly) and component_id (least id reachable), one row per input row."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).mapInArrow(_keyed, "id bigint, key binary")
    members = stage(rows.withColumn("at", F.monotonically_increasing_id()), "vectors")
    # Equal vectors are one; the row number stands in for ids that are null or given twice.
    distinct = stage(
        members.filter("key IS NOT NULL").groupBy("key")
        .agg(F.min("at").alias("id"), F.count(F.lit(1)).alias("weight"), F.min("id").alias("least")),
        "distinct-vectors",
    )
    found = None
    # One round per vector length; embeddings of one model have one.
    for r in distinct.groupBy(F.length("key").alias("bytes")).agg(F.count(F.lit(1)).alias("n")).collect():
        links = _links_of(distinct.filter(F.length("key") == r["bytes"]), r["n"], similarity)
        found = links if found is None else found.unionByName(links)
    if found is None:
        return members.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    found = stage(found, "vector-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    components = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    named = (
        distinct.select("key", F.col("id").alias("node"), "weight", "least")
        .join(counts, "node", "left").join(components, "node", "left")
        .select("key", "least", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    )
    named = stage(named, "vector-groups")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = named.join(least, "component").select("key", "n_links", "component_id")
    return members.join(by_key, "key", "left").select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
