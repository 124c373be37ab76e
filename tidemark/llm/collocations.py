"""Phrase collocations by stripes: a prefix keys the counter of the words that follow it.

Texts are lower-cased in A-Z, split at marks and line breaks into pieces and at
blanks into words, and counted per language.

1. The stripe of the empty prefix is the count of every word of a language.
   Words below ``min_count`` can be in no candidate.
2. Stripes of one word, then of two. A task counts its texts into local stripes
   and emits them whole; stripes of a prefix meet in one task and are merged
   element by element. One merged stripe gives the phrases that extend its
   prefix (entries of ``min_count`` and more), the prefix's own total (all
   entries, with one for occurrences that no frequent word follows) and its
   largest extension, which decides whether the prefix is subsumed.
3. Cuts are scored from the totals, in decimals of 38 digits; the order of
   ties is settled by the text of the phrase.

Words are handled as 62-bit hashes of language and word. Hashes shared by a
frequent word and another one are found over all words and get numbers of their
own, so counts are exact. What is worth counting at the next length is asked
from a bitmap of the frequent phrases so far (16 bits a phrase, ``BITMAP`` bits
at most): false positives cost time and never change a count.

Stripes of prefixes with more than a quarter of a task's share of all words are
cut into segments by the following word, so that no stripe outgrows a task.

Defined cases: a null text counts as empty, a null language as ``und``; ids play
no part, repeated rows count each time; an empty table gives an empty result;
further columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import slices_for, stage

MIN_COUNT = 10
SUBSUMED = 50  # percent of a phrase's occurrences that a longer one must have to replace it
TOP = 2000
UNKNOWN = "und"

HASH_BITS = 62
BITMAP = 1 << 28  # bits of the filter at most: 32 MB broadcast
CHUNK_BYTES = 6 << 20  # text counted at a time
ENTRIES = 1_000_000  # entries of local stripes that a task holds before it emits them
PAGE = 4096  # entries of an emitted stripe; longer ones take several rows
WORDS_PER_SLICE = 4_000_000
REST = 0  # the entry of a stripe for occurrences that no frequent word follows

_BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = bytes(range(0x61, 0x7B))
for _mark in (*b".,;:!?", *range(0x0A, 0x0E)):
    _TABLE[_mark] = _BREAK[0]
_TABLE[0x09] = 0x20
_TABLE = bytes(_TABLE)

STRIPE = "p1 bigint, p2 bigint, seg int, nexts array<bigint>, counts array<bigint>"


def piece_words(data: bytes) -> tuple[np.ndarray, list[bytes], int]:
    """(number of the word at each place, distinct words, number of the break or -1)."""
    spaced = data.translate(_TABLE).replace(_BREAK, b" " + _BREAK + b" ")
    words = pc.split_pattern(pa.array([spaced], pa.large_binary()), b" ").flatten()
    coded = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    return numbers, distinct, distinct.index(_BREAK) if _BREAK in distinct else -1


def word_codes(lang: str, words: list[bytes], renamed: dict[tuple[str, bytes], int]) -> np.ndarray:
    """Codes of words: hashes of ``HASH_BITS`` bits, but the given numbers where hashes are shared."""
    if not words:
        return np.zeros(0, np.int64)
    key = f"{pd.util.hash_array(np.array([lang], object))[0]:016x}"
    codes = (pd.util.hash_array(np.array(words, object), hash_key=key, categorize=False) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    codes[codes == REST] = 1
    if renamed:
        codes = np.array([renamed.get((lang, w), c) for w, c in zip(words, codes.tolist(), strict=True)], np.int64)
    return codes


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(language, texts joined by breaks), some ``CHUNK_BYTES`` at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for k in range(batch.num_rows):
            text = batch.column(1)[k].as_py()
            held.setdefault(batch.column(0)[k].as_py(), []).append(text)
            size += len(text) + 64
            if size >= CHUNK_BYTES:
                yield from ((lang, _BREAK.join(texts)) for lang, texts in held.items())
                held, size = {}, 0
    yield from ((lang, _BREAK.join(texts)) for lang, texts in held.items())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, data in _chunks(batches):
        numbers, distinct, stop = piece_words(data)
        n = np.bincount(numbers, minlength=len(distinct)).astype(np.int64)
        codes = word_codes(lang, distinct, {})
        keep = np.arange(len(distinct)) != stop
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * int(keep.sum()), pa.string()), pa.array(distinct, pa.binary()).filter(pa.array(keep)),
             pa.array(codes[keep]), pa.array(n[keep])],
            ["lang", "word", "code", "n"])


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One well-spread number of a phrase's two codes."""
    with np.errstate(over="ignore"):
        x = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _bit_of(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(first, second) & np.uint64(bits - 1)).astype(np.int64)


def _has(bitmap: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    bit = _bit_of(first, second, 8 * bitmap.size)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _bitmap(phrases: DataFrame, count: int) -> np.ndarray:
    """Bits of (p1, p2), built in blocks of 4 KB by Spark and put together here: ``BITMAP`` bits at most."""
    bits = 1 << 16
    while bits < min(16 * count, BITMAP):
        bits *= 2

    def bit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bit_of(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 15), pa.array(at & 32767)], ["block", "place"])

    blocks = (
        phrases.select("p1", "p2").mapInArrow(bit, "block bigint, place bigint")
        .groupBy("block").agg(F.bitmap_construct_agg("place").alias("b"))
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in blocks.collect():
        out[r["block"] * 4096 : (r["block"] + 1) * 4096] = np.frombuffer(bytes(r["b"]), np.uint8)
    return out


def _summed(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows in order, equal ones added up."""
    if not n.size:
        return columns, n
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]
    begin = np.flatnonzero(new)
    return [c[begin] for c in columns], np.add.reduceat(n[order], begin)


def _stripe_rows(columns: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted (p1, p2, seg, next) with counts as stripes of at most ``PAGE`` entries."""
    if not n.size:
        return
    p1, p2, seg, following = columns
    new = np.r_[True, (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1]) | (seg[1:] != seg[:-1])]
    start = np.maximum.accumulate(np.where(new, np.arange(n.size), 0))
    begin = np.flatnonzero(new | ((np.arange(n.size) - start) % PAGE == 0))
    for k in range(0, begin.size, 1 << 16):
        rows = begin[k : k + (1 << 16)]
        stop = int(begin[k + rows.size]) if k + rows.size < begin.size else n.size
        offsets = pa.array(np.r_[rows, stop] - rows[0], pa.int32())
        entries = slice(int(rows[0]), stop)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p1[rows]), pa.array(p2[rows]), pa.array(seg[rows].astype(np.int32)),
             pa.ListArray.from_arrays(offsets, pa.array(following[entries])), pa.ListArray.from_arrays(offsets, pa.array(n[entries]))],
            ["p1", "p2", "seg", "nexts", "counts"])


def local_stripes(
    length: int, words_map: np.ndarray, pairs_map: np.ndarray | None, renamed: dict, hot: np.ndarray, segments: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stripes of prefixes of ``length`` words (1 or 2) over a task's texts."""

    def counted(lang: str, data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
        numbers, distinct, _ = piece_words(data)
        codes = word_codes(lang, distinct, renamed)
        known = np.array([w != _BREAK for w in distinct], bool) & (codes != REST)
        known &= _has(words_map, codes, np.zeros_like(codes))
        here = known[numbers] if numbers.size else np.zeros(0, bool)
        after = np.r_[here[1:], False]
        at = numbers.astype(np.int64)
        if length == 1:
            first = np.flatnonzero(here)
            behind = np.where(after[first], np.r_[at[1:], 0][first], -1)
            key, n = np.unique((at[first] << 32) + behind + 1, return_counts=True)
            p1, p2 = codes[key >> 32], np.zeros(key.size, np.int64)
        else:
            first = np.flatnonzero(here & after)
            pair, place = np.unique((at[first] << 32) + np.r_[at[1:], 0][first], return_inverse=True)
            a, b = codes[pair >> 32], codes[pair & 0xFFFFFFFF]
            good = _has(pairs_map, a, b)
            is_pair = np.zeros(at.size + 1, bool)
            is_pair[first] = good[place]
            number = np.zeros(at.size + 1, np.int64)
            number[first] = place
            first = np.flatnonzero(is_pair)
            behind = np.where(is_pair[first + 1], np.r_[at, 0, 0][first + 2], -1)
            key, n = np.unique((number[first] << 32) + behind + 1, return_counts=True)
            p1, p2 = a[key >> 32], b[key >> 32]
        behind = (key & 0xFFFFFFFF) - 1
        following = np.where(behind >= 0, codes[behind], REST) if codes.size else np.zeros(0, np.int64)
        return [p1, p2, following], n.astype(np.int64)

    def emitted(held: list[tuple[list[np.ndarray], np.ndarray]]) -> Iterator[pa.RecordBatch]:
        p1, p2, following = (np.concatenate([h[0][c] for h in held]) for c in range(3))
        is_hot = np.isin(p1 if length == 1 else _mixed(p1, p2).astype(np.int64), hot)
        seg = np.where(is_hot, following % segments, 0)
        yield from _stripe_rows(*_summed([p1, p2, seg, following], np.concatenate([h[1] for h in held])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for lang, data in _chunks(batches):
            held.append(counted(lang, data))
            size += held[-1][1].size
            if size >= ENTRIES:
                yield from emitted(held)
                held, size = [], 0
        if held:
            yield from emitted(held)

    return run


def merged_stripes(min_count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stripes in order of (p1, p2, seg), those of one key added entry by entry.

    Leaves each stripe's total and its entries of ``min_count`` and more. Only
    the last key of a batch is carried over, merged.
    """

    def finished(columns: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        p1, p2, seg, following = columns
        begin = np.flatnonzero(np.r_[True, (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1]) | (seg[1:] != seg[:-1])])
        total = np.add.reduceat(n, begin)
        keep = (n >= min_count) & (following != REST)
        sizes = np.add.reduceat(keep.astype(np.int64), begin)
        offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(p1[begin]), pa.array(p2[begin]), pa.array(total),
             pa.ListArray.from_arrays(offsets, pa.array(following[keep])), pa.ListArray.from_arrays(offsets, pa.array(n[keep]))],
            ["p1", "p2", "total", "nexts", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, carried = [np.zeros(0, np.int64)] * 4, np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = pc.list_value_length(batch.column("nexts")).to_numpy()
            flat = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64), sizes) for c in ("p1", "p2", "seg")]
            flat.append(batch.column("nexts").flatten().to_numpy())
            n = np.r_[carried, batch.column("counts").flatten().to_numpy()]
            columns, n = _summed([np.r_[c, f] for c, f in zip(carry, flat, strict=True)], n)
            last = (columns[0] == flat[0][-1]) & (columns[1] == flat[1][-1]) & (columns[2] == flat[2][-1])
            carry, carried = [c[last] for c in columns], n[last]
            if not last.all():
                yield from finished([c[~last] for c in columns], n[~last])
        if carried.size:
            yield from finished(carry, carried)

    return run


def _times(*factors: Column | int) -> str:
    return " * ".join(str(f) if isinstance(f, int) else f"CAST({f} AS DECIMAL(20, 0))" for f in factors)


def _score(a: str, left: str, right: str) -> Column:
    return F.expr(f"({_times(1_000_000, a, a)}) div ({_times(left, right)})")


def _top_phrases(scored: DataFrame, top: int) -> DataFrame:
    """Candidates that can be among a language's first ``top``: all down to the (score, a) that completes them.

    Equal (score, a) are one row here, so the windows hold at most ``top`` rows a language.
    """
    order = [F.col("score").desc(), F.col("a").desc()]
    best = (
        scored.groupBy("lang", "score", "a").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("at") <= top)
    )
    running = Window.partitionBy("lang").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    cut = best.withColumn("before", F.coalesce(F.sum("rows").over(running), F.lit(0))).filter(F.col("before") < top)
    return scored.join(cut.select("lang", "score", "a"), ["lang", "score", "a"], "left_semi")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
    subsumed: int = SUBSUMED, top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's strongest phrases of two and three words."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))

    words = stage(
        texts.mapInArrow(_word_counts, "lang string, word binary, code bigint, n bigint")
        .groupBy("lang", "word", "code").agg(F.sum("n").alias("n")),
        "phrase-words")
    # Hashes that several words share, of which one is frequent: expected below one per thousand million words.
    shared = words.groupBy("code").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("m")).filter((F.col("k") > 1) & (F.col("m") >= min_count))
    renamed: dict[tuple[str, bytes], int] = {}
    for r in words.join(shared, "code", "left_semi").select("lang", "word", "n").orderBy("lang", "word").collect():
        renamed[(r["lang"], bytes(r["word"]))] = (1 << HASH_BITS) + len(renamed) if r["n"] >= min_count else REST
    frequent = words.filter(F.col("n") >= min_count)
    if renamed:
        given = spark.createDataFrame([(*k, v) for k, v in renamed.items()], "lang string, word binary, own bigint")
        frequent = frequent.join(given, ["lang", "word"], "left").withColumn("code", F.coalesce("own", "code")).drop("own")
    frequent = stage(frequent.select("lang", "word", "code", "n"), "phrase-frequent")
    sizes = stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-languages")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    slices = slices_for(spark, total, WORDS_PER_SLICE)
    share = max(total / (4 * slices), PAGE)  # prefixes above it are fewer than four a slice

    def stripes(length: int, hot: DataFrame, words_map: np.ndarray, pairs_map: np.ndarray | None) -> DataFrame:
        codes = hot.select("p1", "p2").toPandas().astype("int64")
        keys = codes["p1"].to_numpy() if length == 1 else _mixed(codes["p1"].to_numpy(), codes["p2"].to_numpy()).astype(np.int64)
        held = spark.sparkContext.broadcast((words_map, pairs_map, renamed, np.sort(keys)))

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, second, names, large = held.value
            return local_stripes(length, first, second, names, large, slices)(batches)

        together = texts.mapInArrow(emit, STRIPE).repartition(slices, "p1", "p2", "seg").sortWithinPartitions("p1", "p2", "seg")
        merged = stage(
            together.mapInArrow(merged_stripes(min_count), "p1 bigint, p2 bigint, total bigint, nexts array<bigint>, counts array<bigint>"),
            f"stripes-{length}")
        # A stripe in segments is one again: totals and largest extensions add up over them.
        whole = merged.groupBy("p1", "p2").agg(F.sum("total").alias("total"), F.max(F.array_max("counts")).alias("longest"))
        entries = merged.filter(F.size("nexts") > 0).select("p1", "p2", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
        return stage(
            entries.select("p1", "p2", F.col("e.nexts").alias("next"), F.col("e.counts").alias("a"))
            .join(whole, ["p1", "p2"]),
            f"phrases-{length + 1}")

    one = frequent.select(F.col("code").alias("p1"), F.lit(0).cast("long").alias("p2"), "n")
    words_map = _bitmap(one, frequent.count())
    two = stripes(1, one.filter(F.col("n") > share), words_map, None)
    pairs = two.select("p1", F.col("next").alias("p2"), "a")
    three = stripes(2, pairs.filter(F.col("a") > share), words_map, _bitmap(pairs, two.count()))

    # Cut after the first word, and after the second; totals of the parts are stripes' totals and entries.
    named = frequent.select(F.col("code").alias("c"), "lang", "word", F.col("n").alias("f"))
    scored2 = (
        two.withColumnRenamed("total", "l").join(named.select(F.col("c").alias("next"), "lang", F.col("f").alias("r")), "next")
        .select("lang", F.col("p1").alias("c1"), F.col("next").alias("c2"), F.lit(None).cast("long").alias("c3"), "a", "l", "r",
                _score("a", "l", "r").alias("score"))
    )
    longer = three.groupBy("p1", "p2").agg(F.max("longest").alias("m")).unionByName(
        three.groupBy(F.col("p2").alias("p1"), F.col("next").alias("p2")).agg(F.max("a").alias("m")))
    longer = longer.groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(F.max("m").alias("m"))
    scored2 = scored2.join(longer, ["c1", "c2"], "left").filter(F.expr(f"m IS NULL OR 100 * m < {subsumed} * a")).drop("m")
    scored3 = (
        three.select("p1", "p2", "next", "a", F.col("total").alias("l2"))
        .join(two.select("p1", F.col("next").alias("p2"), F.col("total").alias("l1")), ["p1", "p2"])
        .join(two.select(F.col("p1").alias("p2"), "next", F.col("a").alias("r1")), ["p2", "next"])
        .join(named.select(F.col("c").alias("next"), "lang", F.col("f").alias("r2")), "next")
        .withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
        .select("lang", F.col("p1").alias("c1"), F.col("p2").alias("c2"), F.col("next").alias("c3"), "a",
                F.expr("IF(s2 < s1, l2, l1)").alias("l"), F.expr("IF(s2 < s1, r2, r1)").alias("r"), F.least("s1", "s2").alias("score"))
    )
    best = stage(_top_phrases(stage(scored2.unionByName(scored3), "phrases-scored"), top), "phrases-best")
    for k in (1, 2, 3):
        best = best.join(named.select(F.col("c").alias(f"c{k}"), F.col("word").cast("string").alias(f"w{k}")), f"c{k}", "left")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (
        best.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
        .withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
        .join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
