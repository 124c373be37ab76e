"""Near duplicates by order-preserving MinHash and banded alignment.

* Words are lower-cased tokens without marks. The k-mers are five consecutive
  words, labelled with how often they occurred before in the document.
* Each of ``SKETCHES`` hash functions takes the ``KEPT`` labelled k-mers with
  the least hashes and keeps them in text order: documents agree in a sketch
  when the same k-mers come in the same order, which follows edit similarity
  (shared words in another order agree less).
* Documents that agree in a sketch are candidates; they are linked when
  1 - edits / words of the longer one is at least ``SIMILARITY``, edits being
  word insertions, deletions and replacements counted by a bit-parallel
  alignment within the band that the threshold allows.

Documents that agree in a sketch are always compared or already proven to be
connected; a bucket ends only then. First each bucket compares with one leader
at a time, the member whose buckets are largest: the text that the others were
made from is in most of them. Leaders leave the bucket, as they met all of it,
and a bucket ends when the rest of it is connected. What is left (after
``LEVELS`` leaders at most) is split by bands of length and into blocks that
meet in pairs; only members of one component are not compared. There, bounds
that any two near documents keep (common words, common pairs of neighbouring
words) are taken for a whole block at once, and only what passes is aligned.
Exact copies are one member.

Words are compared by 32 bits of their hash. As with every MinHash, two near
documents can differ in all sketches; for a pair that shares 80 % of its
k-mers that has a probability below 0.00001.

Defined cases: null counts as empty; texts without words are near only to
exact copies; texts of fewer than five words have one k-mer, all of them; null
ids form classes of their own text; of a class the least id stays.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import forget, fresh_names, release_freed, stage, worker_cache
from tidemark.llm.components import connected_components

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 12
KEPT = 2
LEVELS = 3  # leaders that a bucket is compared with, one at a time, before its blocks meet
JOINED = 2  # another leader is asked where the largest part is at least a half of what is outside it
BLOCK = 512  # members of a block at most
BLOCK_WORDS = 1 << 19  # words of a block, about
REMEMBERED = 400_000  # words a worker keeps
BATCH_BYTES = 4 << 20
MARKS = re.compile(r"[\W_]+")


def word_codes(texts: list[str]) -> list[np.ndarray]:
    """Per text its words as 32-bit hashes."""
    tokens = [t.split() for t in texts]
    present = set().union(*tokens) if tokens else set()
    seen: dict[str, int] = worker_cache(("word codes",), dict)
    if len(seen) + len(present) > REMEMBERED:
        kept = {w: seen[w] for w in present if w in seen}
        seen.clear()
        seen.update(kept)
    for w in present.difference(seen):
        plain = MARKS.sub("", w.lower())
        seen[w] = xxhash.xxh32_intdigest(plain.encode()) if plain else -1
    out = []
    for t in tokens:
        codes = np.fromiter(map(seen.__getitem__, t), np.int64, len(t))
        out.append(codes[codes >= 0].astype(np.uint32))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def order_sketches(docs: list[np.ndarray]) -> np.ndarray:
    """(documents, SKETCHES) keys; rows of documents without words are meaningless."""
    n = len(docs)
    keys = np.zeros((n, SKETCHES), np.int64)
    sizes = np.fromiter(map(len, docs), np.int64, n)
    some = np.flatnonzero(sizes)
    if not some.size:
        return keys
    words = np.concatenate([docs[i] for i in some]).astype(np.uint64) + np.uint64(1)
    sizes = sizes[some]
    begins = np.cumsum(sizes) - sizes
    grams = np.maximum(sizes - WORDS + 1, 1)
    starts = np.cumsum(grams) - grams
    owner = np.repeat(np.arange(some.size), grams)
    at = np.arange(owner.size) - starts[owner] + begins[owner]  # place of each k-mer's first word
    gram = np.zeros(owner.size, np.uint64)
    ends = (begins + sizes)[owner]
    for k in range(WORDS):
        here = at + k < ends
        gram = _mixed(gram + np.where(here, words[np.minimum(at + k, words.size - 1)], np.uint64(0)))
    # Occurrence numbers: rank among the equal k-mers of the document, in text order.
    order = np.lexsort((gram, owner))
    same = np.zeros(owner.size, bool)
    same[1:] = (gram[order][1:] == gram[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    run = np.arange(owner.size)
    number = np.empty(owner.size, np.int64)
    number[order] = run - np.maximum.accumulate(np.where(same, 0, run))
    gram = _mixed(gram + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    last = np.uint64(0xFFFFFFFFFFFFFFFF)
    for j in range(SKETCHES):
        value = _mixed(gram ^ np.uint64(0xA0761D6478BD642F * (j + 1) & 0xFFFFFFFFFFFFFFFF))
        places = np.empty((some.size, KEPT), np.int64)
        for k in range(KEPT):
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == least[owner])
            first = hit[np.unique(owner[hit], return_index=True)[1]]
            places[:, k] = first
            value[first] = last
        places.sort(axis=1)
        key = np.full(some.size, np.uint64(j + 1))
        for k in range(KEPT):
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + gram[places[:, k]])
        keys[some, j] = key.view(np.int64)
    return keys


def distance_within(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether the word edit distance is at most ``limit``: bit-parallel alignment inside the band of that width."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return False
    n = len(b)
    differ = np.flatnonzero(a[:n] != b)
    front = int(differ[0]) if differ.size else n
    a, b = a[front:], b[front:]
    n = len(b)
    if n:
        differ = np.flatnonzero(a[len(a) - n :][::-1] != b[::-1])
        back = int(differ[0]) if differ.size else n
        a, b = a[: len(a) - back], b[: n - back]
    if not len(b) or len(a) <= limit:
        return len(a) <= limit
    if not limit:
        return False
    # What one text has more of than the other bounds the distance from below.
    kinds, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    surplus = np.bincount(inverse[: len(a)], minlength=len(kinds)) - np.bincount(inverse[len(a) :], minlength=len(kinds))
    if max(int(surplus[surplus > 0].sum()), -int(surplus[surplus < 0].sum())) > limit:
        return False
    places: dict[int, int] = {}
    for i, w in enumerate(inverse[: len(a)].tolist()):
        places[w] = places.get(w, 0) | (1 << i)
    width = 2 * limit + 1
    full = (1 << width) - 1
    up, down = (full << limit) & full, 0  # vertical differences of +1 and -1 in the window
    edge, row = 1 << (width - 1), 1 << (width - 2)
    shift, now = -limit, limit
    slack = 2 * limit + len(b) - len(a)
    diagonal = len(a) - limit
    for j, w in enumerate(inverse[len(a) :].tolist()):
        match = places.get(w, 0)
        match = (match >> shift if shift >= 0 else match << -shift) & full
        zero = ((((match & up) + up) ^ up) | match | down) & full
        plus = down | (full & ~(zero | up))
        minus = zero & up
        if j < diagonal:
            now += not zero & edge
            if now > slack:
                return False
        else:
            now += bool(plus & row) - bool(minus & row)
            row >>= 1
        half = zero >> 1
        up = minus | (full & ~(half | plus))
        down = half & plus
        shift += 1
    return now <= limit


def near(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    longest = max(len(a), len(b))
    return bool(longest) and distance_within(a, b, int(longest * (1 - similarity) + 1e-9))


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    texts = [t or "" for t in batch.column(column).to_pylist()]
    begin = 0
    while begin < len(texts):
        stop, size = begin, 0
        while stop < len(texts) and (stop == begin or size < BATCH_BYTES):
            size += len(texts[stop])
            stop += 1
        yield batch.slice(begin, stop - begin), texts[begin:stop]
        begin = stop


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch, texts in _parts(whole, 0):
            codes = word_codes(texts)
            keys = order_sketches(codes)
            some = [len(c) > 0 for c in codes]
            lists = pa.array([k.tolist() if s else None for k, s in zip(keys, some, strict=True)], pa.list_(pa.int64()))
            sizes = pa.array([len(c) for c in codes], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(1), lists, sizes], ["digest", "keys", "words"])
    release_freed()


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch, texts in _parts(whole, 1):
            codes = pa.array([c.tobytes() for c in word_codes(texts)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), codes, batch.column(2)], ["member", "words", "keys"])
    release_freed()


def _verifier(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # all words are coded and written by now
        for batch in batches:
            one, other = batch.column(4), batch.column(5)
            linked = [
                near(np.frombuffer(one[k].as_buffer(), np.uint32), np.frombuffer(other[k].as_buffer(), np.uint32), similarity)
                for k in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in range(4)), pa.array(linked, pa.bool_())], ["leader", "member", "own", "part", "linked"])

    return run


def _verified(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """(leader, member, own, part, linked) of the pairs. A leader with very many members is an inner join that is split."""
    both = (
        pairs.join(words.withColumnRenamed("words", "w1"), "member")
        .join(words.select(F.col("member").alias("leader"), F.col("words").alias("w2")), "leader")
        .select("leader", "member", "own", "part", "w1", "w2")
    )
    return both.mapInArrow(_verifier(similarity), "leader string, member string, own string, part string, linked boolean")


def _joined_parts(found: DataFrame) -> DataFrame:
    """(node, component) of the parts that verified links join.

    A member has at most SKETCHES leaders. It is tied to the part of the least
    one, and the parts of all its leaders to that one too; members with the same
    leaders tie them once. So the search gets about one edge a member, however
    many links a large group has.
    """
    asked = found.filter("linked").groupBy("member", "part").agg(F.array_sort(F.collect_set("own")).alias("owns"))
    tied = stage(asked.groupBy("part", "owns").agg(F.count(F.lit(1)).alias("n")).select("part", "owns"), "near-tied")
    first = F.col("owns")[0]
    among = tied.select("owns").distinct().select(F.explode("owns").alias("a"), first.alias("b")).filter("a <> b")
    return stage(connected_components(tied.select(F.col("part").alias("a"), first.alias("b")).unionByName(among)), "near-joined")


def _hashed(docs: list[np.ndarray], wide: int, dims: int) -> np.ndarray:
    """(documents, dims) counts of hashed runs of ``wide`` words, each labelled with its occurrence number.

    The product of two rows is never less than the number of runs that the documents share.
    """
    out = np.zeros((len(docs), dims), np.float32)
    for row, doc in zip(out, docs, strict=True):
        n = len(doc) - wide + 1
        if n < 1:
            continue
        run = np.zeros(n, np.uint64)
        for k in range(wide):
            run = _mixed(run + doc[k : k + n].astype(np.uint64) + np.uint64(1))
        order = np.argsort(run, kind="stable")
        again = np.zeros(n, bool)
        again[1:] = run[order][1:] == run[order][:-1]
        place = np.arange(n)
        number = place - np.maximum.accumulate(np.where(again, 0, place))
        run = _mixed(run[order] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        row += np.bincount((run % np.uint64(dims)).astype(np.int64), minlength=dims)
    return out


def _possible(one: list[np.ndarray], other: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(whether each pair can be near, bound on its common words).

    Each edit of the longer text takes at most one of its words and two of its pairs of neighbouring words away.
    """
    na, nb = (np.fromiter(map(len, d), np.int64, len(d)) for d in (one, other))
    longest = np.maximum(na[:, None], nb[None, :])
    limit = np.floor(longest * (1 - similarity) + 1e-9).astype(np.int64)
    dims = 1 << max(10, int(4 * longest.max()).bit_length())
    common = _hashed(one, 1, dims) @ _hashed(other, 1, dims).T
    can = (np.abs(na[:, None] - nb[None, :]) <= limit) & (common >= longest - limit - 0.5)
    if can.any():
        can &= _hashed(one, 2, dims) @ _hashed(other, 2, dims).T >= longest - 1 - 2 * limit - 0.5
    return can, common


def _block_links(similarity: float):
    """Links between two blocks of a bucket (or inside one): (leader, member)."""

    def run(group: tuple, table: pa.Table) -> pa.Table:
        key, low, high = group[0].as_py(), group[2].as_py(), group[3].as_py()
        block = table.column("block").to_numpy()
        member, part = table.column("member").to_pylist(), table.column("part").to_pylist()
        home = np.array(table.column("home").to_pylist(), bool)
        kinds = {c: k for k, c in enumerate(dict.fromkeys(part))}
        part = np.array([kinds[c] for c in part], np.int64)
        docs = [np.frombuffer(w.as_buffer(), np.uint32) for w in table.column("words").combine_chunks()] if len(member) else []
        keys = np.array(table.column("keys").to_pylist(), np.int64).reshape(len(member), -1)
        a = np.flatnonzero(block == low)
        b = np.flatnonzero(block == high)
        links: list[tuple[str, str]] = []
        if len(a) and len(b):
            can = (part[a][:, None] != part[b][None, :]) & (home[a][:, None] | home[b][None, :])
            # A pair meets in the first sketch that it agrees in.
            first = np.full(can.shape, -1, np.int64)
            for j in range(keys.shape[1] - 1, -1, -1):
                first[keys[a, j][:, None] == keys[b, j][None, :]] = j
            can &= (first >= 0) & (keys[a][np.arange(len(a))[:, None], first] == key)
            if low == high:
                can &= a[:, None] < b[None, :]
            if can.any():
                # Only what still has a partner is counted.
                ra, rb = np.flatnonzero(can.any(axis=1)), np.flatnonzero(can.any(axis=0))
                bound, common = _possible([docs[i] for i in a[ra]], [docs[i] for i in b[rb]], similarity)
                x, y = np.nonzero(can[np.ix_(ra, rb)] & bound)
                order = np.argsort(-common[x, y], kind="stable")
                root = list(range(len(kinds)))

                def find(c: int) -> int:
                    while root[c] != c:
                        root[c] = root[root[c]]
                        c = root[c]
                    return c

                for i, j in zip(a[ra[x[order]]].tolist(), b[rb[y[order]]].tolist(), strict=True):
                    p, q = find(part[i]), find(part[j])
                    if p != q and near(docs[i], docs[j], similarity):
                        root[p] = q
                        links.append((member[i], member[j]))
        return pa.table({"leader": pa.array([x for x, _ in links], pa.string()), "member": pa.array([y for _, y in links], pa.string())})

    return run


def _bands(similarity: float) -> Column:
    """Documents that are near lie in one band of lengths or in neighbouring ones."""
    return F.floor(F.log(F.col("size").cast("double")) / -math.log(similarity) + 1e-9).cast("int")


def _exhaustive(rows: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """(leader, member) links of all that is left: members outside a bucket's main component meet each other and the main
    ones. Each row is in its own band of lengths and the next; a group holds two blocks, whatever the bucket's size."""
    banded = rows.withColumn("band", _bands(similarity)).withColumn("length", F.explode(F.array("band", F.col("band") + 1)))
    banded = banded.select("key", "length", "member", "part", "minor", (F.col("band") == F.col("length")).alias("home"))
    fits = F.greatest(F.lit(1), F.least(F.lit(float(BLOCK)), F.lit(float(BLOCK_WORDS)) / F.pow(F.lit(1 / similarity), F.col("length") + 1)))
    counted = banded.groupBy("key", "length").agg(
        F.sum(F.col("minor").cast("long")).alias("few"), F.sum((~F.col("minor")).cast("long")).alias("many"), F.max("home").alias("some"))
    counted = counted.filter("few > 0 AND few + many > 1 AND some").select(
        "key", "length", F.ceil(F.col("few") / fits).cast("int").alias("few"), F.ceil(F.col("many") / fits).cast("int").alias("many"))
    salt = F.xxhash64("member")
    dealt = banded.join(counted, ["key", "length"]).withColumn(
        "block", F.when(F.col("minor"), F.pmod(salt, "few")).otherwise(F.col("few") + F.pmod(salt, "many")).cast("int"))
    met = F.when(F.col("minor"), F.col("few") + F.col("many")).otherwise(F.col("few"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), met - 1))).select(
        "key", "length", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "member", "part", "home")
    return dealt.join(words, "member").groupBy("key", "length", "low", "high").applyInArrow(
        _block_links(similarity), "leader string, member string")


def near_links(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(members, links): every row's digest, and links between digests that join what verified links join."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("digest"), text.alias("t"))
    members = stage(plain.select("id", "digest"), "near-members")
    # One text of each digest goes on. Sketching a copy is cheaper than moving its text to find out that it is one.
    sketches = stage(
        plain.select("t", "digest").mapInArrow(_sketched, "digest string, keys array<bigint>, words int")
        .filter("words > 0").groupBy("digest").agg(F.first("keys").alias("keys"), F.first("words").alias("words")),
        "near-sketches",
    )
    single = sketches.select(F.col("digest").alias("member"), F.col("words").alias("size"), F.explode("keys").alias("key"))
    buckets = single.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A member has at most SKETCHES rows.
    score = F.sum("n").over(Window.partitionBy("member"))
    rows = stage(
        single.join(buckets, "key").withColumn("score", score)
        .select("key", "member", "size", "score", F.col("member").alias("part"), F.lit(True).alias("minor")),
        "near-buckets",
    )
    wanted = rows.select(F.col("member").alias("digest")).distinct().join(sketches.select("digest", "keys"), "digest")
    words = stage(
        plain.join(wanted, "digest").select(F.col("digest").alias("member"), "t", "keys")
        .mapInArrow(_coded, "member string, words binary, keys array<bigint>")
        .groupBy("member").agg(F.first("words").alias("words"), F.first("keys").alias("keys")),
        "near-words",
    )
    coded = words.select("member", "words")
    links: list[DataFrame] = []
    known: DataFrame | None = None
    for _ in range(LEVELS):
        best = rows.filter("minor").groupBy("key").agg(F.max(F.struct("score", "member", "size", "part")).alias("l"))
        led = rows.join(best.select("key", F.col("l.member").alias("leader"), F.col("l.size").alias("led"), F.col("l.part").alias("own")), "key")
        fits = F.abs(F.col("size") - F.col("led")) <= F.floor(F.greatest("size", "led") * F.lit(1 - similarity) + 1e-9)
        pairs = led.filter(fits & (F.col("part") != F.col("own"))).select("leader", "member", "own", "part").distinct()
        if known is not None:
            pairs = pairs.join(known, ["leader", "member"], "left_anti")
        found = stage(_verified(pairs, coded, similarity), "near-verified")
        met = found.select("leader", "member")
        known = met if known is None else known.unionByName(met)
        # Parts that were joined before are one node of this turn's search.
        classes = _joined_parts(found)
        links.append(classes.select(F.col("node").alias("leader"), F.col("component").alias("member")))
        # The leader met all of its bucket and leaves it. The rest goes on where it is not yet connected.
        rest = stage(
            led.filter("member <> leader").select("key", "member", "size", "score", "part")
            .join(classes.withColumnRenamed("node", "part"), "part", "left")
            .select("key", "member", "size", "score", F.coalesce("component", "part").alias("part")),
            "near-rest")
        parts = rest.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
        main = parts.groupBy("key").agg(F.max(F.struct("n", "part")).alias("m"), F.sum("n").alias("n")).filter("m.n < n")
        rows = stage(
            rest.join(main.select("key", F.col("m.part").alias("main"), F.col("m.n").alias("most"), (F.col("n") - F.col("m.n")).alias("few")), "key")
            .select("key", "member", "size", "score", "part", (F.col("part") != F.col("main")).alias("minor"), "few", "most"),
            "near-open")
        # Another leader is asked where a bucket would need several blocks, unless its members are hardly joined: then
        # they share a passage and are no copies of one text, and the blocks compare them as well.
        if rows.filter((F.col("few") > BLOCK) & (F.col("most") * JOINED >= F.col("few"))).isEmpty():
            break
    links.append(stage(_exhaustive(rows, words, similarity), "near-blocks"))
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    return members, edges


def _classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """(digest, component, least): every text's class and least id."""
    classes = connected_components(links)
    return stage(
        members.groupBy("digest").agg(F.min("id").alias("least"))
        .join(classes.withColumnRenamed("node", "digest"), "digest", "left")
        .select("digest", "least", F.coalesce("component", "digest").alias("component")),
        "near-classes")


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """id, class_id (least id of the class) and kept (whether it is the row that stays), one row per input row."""
    members, links = near_links(docs, id_col, text_col, similarity)
    named = _classes(members, links)
    least = named.groupBy("component").agg(F.min("least").alias("class_id"))
    by_digest = named.join(least, "component").select("digest", "class_id")
    return members.join(by_digest, "digest").select("id", "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row of each class, with all its columns: of the text that has the class's least id, the row with the least id.

    Ids name rows only within a text: rows without an id and different texts under one id are told apart by their text. Where
    a class has no id at all, and where several texts share the least one, the text with the least digest stays.
    """
    named = _classes(*near_links(docs, id_col, text_col, similarity))
    best = named.groupBy("component").agg(F.min(F.struct(F.col("least").isNull(), "least", "digest")).alias("b"))
    key, at = fresh_names(docs, "kept_digest", "kept_at")
    texts = docs.withColumn(key, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    kept = texts.join(best.select(F.col("b.digest").alias(key)), key, "left_semi")
    first = Window.partitionBy(key).orderBy(F.col(id_col).asc_nulls_last())
    return kept.withColumn(at, F.row_number().over(first)).filter(F.col(at) == 1).select(*docs.columns)
