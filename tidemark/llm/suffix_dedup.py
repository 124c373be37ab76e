"""Removal of repeated passages: suffix sorting in shards by external induction.

A byte goes when a string of ``WIDTH`` bytes that covers it also starts
anywhere else, in the same document or another. Matches never cross documents
and are judged on the input.

1. Sharding. Each window of ``WIDTH`` bytes is represented by the block of half
   its size with the least hash in it, the leftmost of equals. Equal windows
   have equal blocks at equal places, so windows meet by block, and a block
   that occurs once in the corpus needs no further look. Neighbouring windows
   with the same block form a run, and the bytes that a run covers a snippet.
2. Pre-aggregation. Equal snippets of a block (copies of documents) become one
   with a count; all windows of one that occurs twice are repeated.
3. Suffix sorting. Blocks with several different snippets are dealt over shards.
   A shard's snippets are one text, sorted by external induced sorting
   (``induced.py``): disk-backed queues carry suffixes and common prefixes, so a
   shard may be far larger than memory. A window is repeated when its suffix has
   a common prefix of ``WIDTH`` bytes with a neighbour's.
4. A block with more than ``HOT`` different snippets (a line that very many
   documents hold in different surroundings) would make one shard long; its
   windows are counted by a 128-bit hash instead, combined before the shuffle.
5. Spans go back to the documents that hold the snippets.

Blocks and equal snippets are told apart by two independent 64-bit hashes of
their content.

Defined cases: a null text counts as empty; texts shorter than ``WIDTH`` keep
all; null and repeated ids are rows of their own (repeated rows repeat each
other); an empty table gives an empty result; further columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices_for, stage
from tidemark.llm.induced import Scratch, sorted_suffixes

WIDTH = 200
HOT = 4096
SHARD_BYTES = 8 << 20
BROADCAST_BYTES = 32 << 20  # ids or blocks up to which a filter is broadcast; a shuffle does it beyond
BATCH_BYTES = 1 << 20  # text hashed at a time; the arrays over it take some 80 times as much

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_RANDOM = np.random.default_rng(20240229).integers(0, 1 << 64, (2, 256), dtype=np.uint64)  # a random number per byte
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(n + 1, base)
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def _sums(content: np.ndarray, which: int) -> np.ndarray:
    """Prefix sums from which the hash of any stretch follows."""
    out = np.zeros(len(content) + 1, np.uint64)
    np.cumsum(_RANDOM[which][content] * _powers(len(content))[1][: len(content)], dtype=np.uint64, out=out[1:])
    return out


def _stretch(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _mixed((sums[end] - sums[begin]) * _powers(len(sums))[0][begin])


def window_runs(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, block hash, snippet hash) of all runs of windows with one block."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    content = np.frombuffer(b"".join(texts), np.uint8)
    empty = np.zeros(0, np.int64)
    if len(content) < width:
        return empty, empty, empty, empty, empty
    block = width // 2
    sums = _sums(content, 0)
    places = np.arange(len(content) - block + 1)
    value = hashes = _stretch(sums, places, places + block)
    least, span, room = places.astype(np.int32), 1, width - block + 1
    while span < room:  # least hash of ever longer stretches, leftmost of equals
        step = min(span, room - span)
        left = value[:-step] <= value[step:]
        least = np.where(left, least[:-step], least[step:])
        value = np.minimum(value[:-step], value[step:])
        span += step
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    inside = np.flatnonzero(np.arange(len(least)) + width <= ends[owner])
    if not inside.size:
        return empty, empty, empty, empty, empty
    own, anchor = owner[inside], least[inside]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])])
    count = np.diff(np.r_[new, inside.size])
    first = inside[new]
    second = _sums(content, 1)
    snippet = _mixed(_stretch(second, first, first + count + width - 1) + count.astype(np.uint64))
    text = own[new]
    return text, first - (ends - sizes)[text], count, hashes[anchor[new]].view(np.int64), snippet.view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        texts = [(t or "").encode() for t in batch.column(column).to_pylist()]
        begin = 0
        while begin < len(texts):
            stop, size = begin, 0
            while stop < len(texts) and (stop == begin or size < BATCH_BYTES):
                size += len(texts[stop])
                stop += 1
            yield batch.slice(begin, stop - begin), texts[begin:stop]
            begin = stop


def _blocks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _slices(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array(window_runs(texts, width)[3])], ["block"])

    return run


def _runs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _slices(batches, 1):
            text, first, count, block, snippet = window_runs(texts, width)
            rid = batch.column(0).take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [rid, pa.array(first), pa.array(count), pa.array(block), pa.array(snippet)], ["rid", "first", "windows", "block", "snippet"])

    return run


def _cut(width: int):
    """The bytes of the asked snippets of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _slices(batches, 0):
            asked = batch.column(1).to_pylist()
            rows = [
                (a["block"], a["snippet"], text[a["first"] : a["first"] + a["windows"] + width - 1])
                for text, wanted in zip(texts, asked, strict=True) for a in wanted
            ]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["block", "snippet", "content"])

    return run


def repeated_starts(contents: Iterator[bytes], width: int, **sorting) -> Iterator[tuple[int, int, int]]:
    """(number of the content, first and behind last repeated window) by external induced sorting."""
    scratch = Scratch()
    try:
        path, begins = scratch.path(), [0]
        with open(path, "wb") as out:
            for content in contents:  # symbols are moved up by one, 0 stands between
                out.write(np.append(np.frombuffer(content, np.uint8).astype("<u2") + 1, 0).astype("<u2").tobytes())
                begins.append(begins[-1] + len(content) + 1)
        if begins[-1] == 0:
            return
        text = np.memmap(path, "<u2", "r")
        hit = scratch.array(len(text) + 1, np.uint8)
        before = 0
        for position, common in sorted_suffixes(text, scratch, **sorting):
            at = np.flatnonzero(common >= width)
            hit[position[at]] = 1
            hit[np.r_[before, position[:-1]][at]] = 1
            before = int(position[-1])
        for k in range(len(begins) - 1):
            own = hit[begins[k] : max(begins[k], begins[k + 1] - width)]  # windows that end within the content
            if own.any():
                edge = np.flatnonzero(np.diff(np.r_[0, own.astype(np.int8), 0]))
                for a, b in edge.reshape(-1, 2).tolist():
                    yield k, a, b
    finally:
        scratch.close()


def _shard(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, snippets = [], []

        def contents() -> Iterator[bytes]:
            for batch in batches:
                blocks.append(batch.column(0).to_numpy())
                snippets.append(batch.column(1).to_numpy())
                for c in batch.column(2):
                    yield c.as_buffer().to_pybytes()

        found = np.array(list(repeated_starts(contents(), width)), np.int64).reshape(-1, 3)
        if len(found):
            block, snippet = np.concatenate(blocks), np.concatenate(snippets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[found[:, 0]]), pa.array(snippet[found[:, 0]]), pa.array(found[:, 1]), pa.array(found[:, 2])],
                ["block", "snippet", "a", "b"])

    return run


def _window_hashes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                content = np.frombuffer(batch.column(2)[k].as_buffer(), np.uint8)
                at = np.arange(len(content) - width + 1)
                one, two = (_stretch(_sums(content, w), at, at + width).view(np.int64) for w in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(two), pa.array(np.full(len(at), batch.column(0)[k].as_py())),
                     pa.array(np.full(len(at), batch.column(1)[k].as_py())), pa.array(at)],
                    ["one", "two", "block", "snippet", "a"])

    return run


def _kept(rows: DataFrame, wanted: DataFrame, column: str, how: str) -> DataFrame:
    """Rows whose id or block is among the (staged) wanted ones; broadcast where those are proven small."""
    size = wanted.count() * 16
    return rows.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, column, how)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, id, t) with unique rid: the id where it is a unique integer, else a row number written with the text."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    if rows.schema["id"].dataType.typeName() in ("long", "integer", "short", "byte"):
        unsound = rows.groupBy("id").count().filter("id IS NULL OR count > 1")
        if unsound.isEmpty():
            return rows.select(F.col("id").cast("long").alias("rid"), "id", "t")
    return stage(rows.select(F.monotonically_increasing_id().alias("rid"), "id", "t"), "repeat-rows")


def _spans(rows: DataFrame, width: int, hot: int) -> DataFrame:
    """(rid, spans): begin and end of the repeated bytes of each run of a document that has some, not yet merged."""
    spark = rows.sparkSession
    text = rows.select("rid", "t")
    blocks = stage(
        text.mapInArrow(_blocks(width), "block bigint").groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("block"), "repeat-blocks")
    every = text.mapInArrow(_runs(width), "rid bigint, first bigint, windows bigint, block bigint, snippet bigint")
    runs = stage(_kept(every, blocks, "block", "left_semi"), "repeat-runs")
    groups = stage(
        runs.groupBy("block", "snippet").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "first", "windows")).alias("at")),
        "repeat-snippets")
    variants = stage(groups.groupBy("block").agg(F.count(F.lit(1)).alias("v")).filter("v > 1"), "repeat-variants")
    # Of a snippet that occurs more than once all windows are repeated; it is sorted only as the others' partner.
    asked = stage(
        groups.join(variants, "block")
        .select("block", "snippet", "v", "at.rid", F.struct("block", "snippet", "at.first", "at.windows").alias("ask")), "repeat-asked")
    wanted = stage(asked.select("rid").distinct(), "repeat-wanted")
    bytes_asked = asked.agg(F.sum(F.col("ask.windows") + width)).first()[0] or 0

    def contents(part: DataFrame) -> DataFrame:
        lists = part.groupBy("rid").agg(F.collect_list("ask").alias("asked"))  # bounded by the document's length
        found = _kept(text, wanted, "rid", "left_semi").join(lists, "rid").select("t", "asked")
        return found.mapInArrow(_cut(width), "block bigint, snippet bigint, content binary")

    shards = slices_for(spark, bytes_asked, SHARD_BYTES)
    sorted_ = contents(asked.filter(F.col("v") <= hot)).repartition(shards, "block").mapInArrow(
        _shard(width), "block bigint, snippet bigint, a bigint, b bigint")
    outcome = [groups.filter("n > 1").selectExpr("block", "snippet", "CAST(0 AS BIGINT) AS a", "at.windows AS b"), sorted_]
    crowded = asked.filter(F.col("v") > hot)
    if not crowded.isEmpty():
        hashed = stage(contents(crowded).mapInArrow(_window_hashes(width), "one bigint, two bigint, block bigint, snippet bigint, a bigint"), "repeat-hashed")
        twice = hashed.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        outcome.append(hashed.join(twice, ["one", "two"]).selectExpr("block", "snippet", "a", "a + 1 AS b"))
    found = outcome[0]
    for more in outcome[1:]:
        found = found.unionByName(more)
    found = stage(found, "repeat-found")
    covered = runs.join(found, ["block", "snippet"]).select(
        "rid", F.struct((F.col("first") + F.col("a")).alias("begin"), (F.col("first") + F.col("b") + width - 1).alias("end")).alias("span"))
    return stage(covered.groupBy("rid").agg(F.collect_list("span").alias("spans")), "repeat-spans")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in _slices(batches, 1):
        rows = []
        for text, spans in zip(texts, batch.column(2).to_pylist(), strict=True):
            gone, kept, at = merged([(s["begin"], s["end"]) for s in spans or []]), [], 0
            for begin, end in gone:
                kept.append(text[at:begin])
                at = end
            kept.append(text[at:])
            content = b"".join(kept)
            rows.append((len(text), len(text) - len(content), gone, content, hashlib.sha256(content).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        spans = pa.array([[{"begin": a, "end": b} for a, b in g] for g in columns[2]], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), spans,
             pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.string())],
            ["id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, hot: int = HOT
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, spans (maximal removed runs), kept (bytes), kept_sha256."""
    rows = _rows(docs, id_col, text_col)
    spans = _spans(rows, width, hot)
    some = spans.select("rid")
    kind = dict(rows.dtypes)["id"]
    shape = "ARRAY<STRUCT<begin: BIGINT, end: BIGINT>>"
    changed = _kept(rows, some, "rid", "left_semi").join(spans, "rid").select("id", "t", "spans").mapInArrow(
        _finished, f"id {kind}, n_bytes bigint, n_removed bigint, spans {shape}, kept binary, kept_sha256 string")
    content = F.col("t").cast("binary")
    whole = _kept(rows, some, "rid", "left_anti").select(
        "id", F.octet_length("t").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.expr(f"CAST(array() AS {shape})").alias("spans"), content.alias("kept"), F.sha2(content, 256).alias("kept_sha256"))
    return changed.unionByName(whole)
