"""Ranked lexical search: exact inner products over sparse ball trees.

A term that occurs tf times in a document has the integer impact
``1e9 * tf div (1000 * tf + 8 * m)``, m growing with the document's length; a
query is its terms' integer weights. The score is their inner product.

1. Items are taken in blocks of some ``ITEMS``; the terms of one block are sent to
   all tasks. One scan counts every document's terms: the length, and the
   frequencies of the block's terms. That table is written; lengths, document
   frequencies and with them all weights come from all its rows.
2. A task reads the table, up to ``TREE_ENTRIES`` frequencies at a time, and builds
   a ball tree over these sparse vectors: nodes are halved along the line
   between two far points, and keep a centroid and the largest distance to it.
   Dimensions are scaled by the root of their weight, which leaves inner
   products as they are and keeps common terms from widening the balls.
3. Nodes are visited best first by centroid product plus radius times the
   query's norm, rounded up by more than the rounding errors can be. A subtree
   is left out only when its bound is below the item's k-th best score so far.
   Leaves are scored in 64-bit integers.
4. The best of every task are ranked together.

Defined cases: a null text has no term, neither as item nor as document; a
document without terms of the item has score 0 and is not returned; repeated
ids are documents (or items) of their own, null ids come last among equal
scores; an empty table gives an empty result; further columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stage

TOP = 10
ITEMS = 512  # items searched together
CHUNK_BYTES = 8 << 20  # text counted at a time
TREE_ENTRIES = 1_500_000  # term frequencies of one tree
TREE_ROWS = 8192  # documents of one tree
CENTRE_VALUES = 4_000_000  # numbers of all centroids of a tree
LEAF = 48  # documents of a leaf
# Fixed values of the score: impact scale, saturation, share of the length in per cent.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 1000, 75

_BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

VECTORS = "doc bigint, place bigint, n bigint, terms array<int>, tfs array<bigint>"


def terms_of(data: bytes) -> pa.Array:
    """Terms in order, dictionary coded: runs of letters, digits and all that is not ASCII, lower-cased in A-Z."""
    words = pc.split_pattern(pa.array([data.translate(_TABLE)], pa.large_binary()), b" ").flatten()
    return words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
    ids, places, texts, size = [], [], [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            ids.append(batch.column(0)[k].as_py())
            places.append(batch.column(1)[k].as_py())
            texts.append(batch.column(2)[k].as_py())
            size += len(texts[-1]) + 64
            if size >= CHUNK_BYTES:
                yield ids, places, texts
                ids, places, texts, size = [], [], [], 0
    if ids:
        yield ids, places, texts


def count_terms(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text; then (text, term, tf) of the vocabulary's terms, in this order."""
    coded = terms_of(b"".join(t + b" " + _BREAK + b" " for t in texts))
    distinct = coded.dictionary.to_pylist()
    at = coded.indices.to_numpy(zero_copy_only=False)
    term = np.array([vocabulary.get(w, -1) for w in distinct], np.int64)
    stop = distinct.index(_BREAK) if _BREAK in distinct else -1
    ends = at == stop
    text = np.cumsum(ends) - ends
    n = np.bincount(text[~ends], minlength=len(texts))
    known = term[at] >= 0
    key, tf = np.unique((text[known].astype(np.int64) << 32) + term[at][known], return_counts=True)
    return n, key >> 32, key & 0xFFFFFFFF, tf


def _vectors(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, places, texts in _texts(batches):
            n, text, term, tf = count_terms(texts, vocabulary)
            offsets = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(n.astype(np.int64)),
                 pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64)))],
                ["doc", "place", "n", "terms", "tfs"])

    return run


class Rows:
    """Sparse integer vectors: of row i the entries begin[i] to begin[i + 1]."""

    def __init__(self, begin: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.begin, self.term, self.value = begin, term, value

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.begin[rows + 1] - self.begin[rows]
        begin = np.r_[0, np.cumsum(sizes)]
        entry = np.repeat(self.begin[rows] - begin[:-1], sizes) + np.arange(begin[-1])
        return Rows(begin, self.term[entry], self.value[entry])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of every row with a dense vector, in the type of both."""
        sums = np.r_[0, np.cumsum(dense[self.term] * self.value)] if self.value.dtype == np.int64 else None
        if sums is not None:
            return sums[self.begin[1:]] - sums[self.begin[:-1]]
        row = np.repeat(np.arange(self.begin.size - 1), np.diff(self.begin))
        return np.bincount(row, dense[self.term] * self.value, self.begin.size - 1)


class Ball:
    __slots__ = ("centre", "radius", "kids", "members")

    def __init__(self, centre: np.ndarray, radius: float, kids: tuple[int, int] | None, members: np.ndarray | None):
        self.centre, self.radius, self.kids, self.members = centre, radius, kids, members


def ball_tree(rows: Rows, width: int, leaf: int = LEAF) -> list[Ball]:
    """Nodes of the tree, the root first. Halves are of equal size, so the depth is the logarithm of the rows."""
    balls: list[Ball] = []
    rows.value = rows.value.astype(np.float64)
    square = np.bincount(np.repeat(np.arange(rows.begin.size - 1), np.diff(rows.begin)), rows.value**2, rows.begin.size - 1)

    def grow(members: np.ndarray) -> int:
        own, size2 = rows.take(members), square[members]
        centre = np.bincount(own.term, own.value, width) / members.size

        def far(point: np.ndarray) -> np.ndarray:
            return np.maximum(size2 - 2 * own.dot(point) + point @ point, 0)

        away = far(centre)
        # Squared distances are differences of larger numbers: the slack covers their rounding.
        slack = 1e-9 * (float(size2.max()) + float(centre @ centre))
        at = len(balls)
        balls.append(Ball(centre, math.sqrt(float(away.max()) + slack), None, members))
        if members.size > leaf:
            def point(k: int) -> np.ndarray:
                entries = slice(int(own.begin[k]), int(own.begin[k + 1]))
                return np.bincount(own.term[entries], own.value[entries], width)

            first = point(int(away.argmax()))
            to_first = far(first)
            to_second = far(point(int(to_first.argmax())))
            order = np.argsort(to_first - to_second, kind="stable")
            half = members.size // 2
            left, right = np.sort(members[order[:half]]), np.sort(members[order[half:]])
            balls[at].kids = (grow(left), grow(right))
            balls[at].members = None
        return at

    grow(np.arange(rows.begin.size - 1))
    return balls


class Queries:
    """A block's items as sparse vectors over its vocabulary, with the weights of the whole corpus."""

    def __init__(self, items: list[tuple[int, Counter]], weight: np.ndarray):
        self.weight = weight
        self.scale = np.sqrt(weight.astype(np.float64))
        self.items = [
            (number, np.array(sorted(terms), np.int64), np.array([terms[t] for t in sorted(terms)], np.int64))
            for number, terms in items if terms
        ]


def search_tree(
    rows: Rows, order: np.ndarray, queries: Queries, best: dict[int, list], top: int, leaf: int = LEAF,
) -> int:
    """Improve every item's ``best`` (heap of (score, -order)) by the rows; the number of leaves scored.

    ``order`` numbers the rows in the order in which equal scores are ranked.
    """
    width = queries.weight.size
    balls = ball_tree(Rows(rows.begin, rows.term, queries.scale[rows.term] * rows.value), width, leaf)
    centres = np.array([b.centre for b in balls])
    radii = np.array([b.radius for b in balls])
    leaves: dict[int, Rows] = {}
    visited = 0
    dense = np.zeros(width, np.int64)
    for number, terms, times in queries.items:
        scaled = queries.scale[terms] * times
        norm = math.sqrt(float(scaled @ scaled))
        towards = centres[:, terms] @ scaled
        bounds = towards + radii * norm
        # Far above the rounding of sums of ``width`` products.
        bounds += 1e-9 * (np.abs(towards) + radii * norm + 1) + 1
        found = best[number]
        dense[terms] = queries.weight[terms] * times
        queue = [(-float(bounds[0]), 0)]
        while queue:
            bound, at = heapq.heappop(queue)
            if len(found) == top and -bound < found[0][0]:
                break
            ball = balls[at]
            if ball.kids is not None:
                for kid in ball.kids:
                    heapq.heappush(queue, (max(bound, -float(bounds[kid])), kid))
                continue
            visited += 1
            if at not in leaves:
                leaves[at] = rows.take(ball.members)
            scores = leaves[at].dot(dense)
            floor = found[0][0] if len(found) == top else 1
            for k in np.flatnonzero(scores >= floor).tolist():
                entry = (int(scores[k]), -int(order[ball.members[k]]))
                if len(found) < top:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
        dense[terms] = 0
    return visited


def impacts(n: np.ndarray, sizes: np.ndarray, tf: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Impacts of terms that occur ``tf`` times, ``sizes`` of them in each of the documents of ``n`` terms.

    ``documents`` and ``terms`` count the whole corpus.
    """
    m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * documents // terms for x in n.tolist()], np.int64)
    return SCALE * tf // (SATURATION * tf + 8 * np.repeat(m, sizes))


def _searched(queries: Queries, documents: int, terms: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {number: [] for number, _, _ in queries.items}
        names: dict[int, tuple] = {}
        seen = 0
        held: list[pa.RecordBatch] = []
        size = count = 0
        # Centroids are dense over the block's terms: fewer rows a tree where there are many.
        most = max(LEAF, min(TREE_ROWS, CENTRE_VALUES // queries.weight.size * LEAF // 4))

        def search() -> None:
            nonlocal seen
            table = pa.Table.from_batches(held).combine_chunks()
            sizes = pc.list_value_length(table["terms"]).to_numpy()
            term = pc.list_flatten(table["terms"]).to_numpy().astype(np.int64)
            tf = pc.list_flatten(table["tfs"]).to_numpy().astype(np.int64)
            begin = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
            n = table["n"].to_numpy()
            ids, places = table["doc"].to_pylist(), table["place"].to_pylist()
            # Of equal scores the least id, then the first row: rows get numbers in that order.
            by_id = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, places[k]))
            rank = np.empty(len(ids), np.int64)
            rank[by_id] = np.arange(len(ids))
            value = impacts(n, sizes, tf, documents, terms)
            fresh: dict[int, list] = {}
            for number, kept in best.items():
                # Best so far take part through their scores alone; their rows are not in this tree.
                fresh[number] = [(score, -(1 << 62) + k) for k, (score, _) in enumerate(kept)]
                heapq.heapify(fresh[number])
            search_tree(Rows(begin, term, value), rank, queries, fresh, top)
            for number, kept in best.items():
                new = [(s, ids[by_id[-o]], places[by_id[-o]]) for s, o in fresh[number] if o > -(1 << 61)]
                both = [(s, *names[o]) for s, o in kept] + new
                both.sort(key=lambda e: (-e[0], e[1] is None, e[1] or 0, e[2]))
                best[number] = []
                for s, doc, place in both[:top]:
                    names[seen] = (doc, place)
                    best[number].append((s, seen))
                    seen += 1
            alive = {o for kept in best.values() for _, o in kept}
            for o in [o for o in names if o not in alive]:
                del names[o]

        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))
            for begin in range(0, batch.num_rows, min(most, 1024)):
                part = batch.slice(begin, min(most, 1024))
                held.append(part)
                size += int(pc.sum(pc.list_value_length(part.column("terms"))).as_py() or 0)
                count += part.num_rows
                if size >= TREE_ENTRIES or count >= most:
                    search()
                    held, size, count = [], 0, 0
        if held:
            search()
        rows = [(number, s, *names[o]) for number, kept in best.items() for s, o in kept]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "score", "doc", "place"])

    return run


def ranked_search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", top: int = TOP,
) -> DataFrame:
    """item_id, rank, doc_id, score: every item's ``top`` documents by score, of those above 0."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.monotonically_increasing_id().alias("place"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    asked = stage(
        items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col).cast("binary"), F.lit(b"")).alias("t"))
        .withColumn("item", F.monotonically_increasing_id()),
        "search-items")
    blocks = max(1, -(-asked.count() // ITEMS))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = None
    # Some ITEMS items a block: one pass over the documents each.
    for number in range(blocks):
        vocabulary: dict[bytes, int] = {}
        wanted = []
        for r in asked.filter(block == number).select("item", "t").collect():
            coded = terms_of(bytes(r["t"]))
            words = [vocabulary.setdefault(w, len(vocabulary)) for w in coded.dictionary.to_pylist()]
            wanted.append((r["item"], Counter(words[k] for k in coded.indices.to_pylist())))
        if not vocabulary:
            continue
        words = spark.sparkContext.broadcast(vocabulary)
        vectors = stage(texts.mapInArrow(lambda batches, words=words: _vectors(words.value)(batches), VECTORS), "search-vectors")
        counted = vectors.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not counted["docs"]:
            break
        # One row per term of the block's items.
        df = np.zeros(len(vocabulary))
        for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
            df[r["term"]] = r["df"]
        weight = np.array([math.floor(1000 * math.log((2 * counted["docs"] + 2) / (2 * int(k) + 1))) for k in df], np.int64)
        sent = spark.sparkContext.broadcast((Queries(wanted, weight), counted["docs"], counted["terms"]))
        hits = vectors.filter("n > 0").mapInArrow(
            lambda batches, sent=sent: _searched(*sent.value, top)(batches), "item bigint, score bigint, doc bigint, place bigint")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return asked.filter("false").select(
            "item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last(), "place")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score")
