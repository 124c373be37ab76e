"""Order MinHash, alignment, components and cover trees against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import components, embedding_dedup, near_dedup
from tidemark.llm.components import connected_components
from tidemark.llm.embedding_dedup import compare_parts, embedding_groups
from tidemark.llm.near_dedup import distance_within, drop_near_duplicates, near_duplicate_classes, order_sketches


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_alignment_within_the_band():
    rng = random.Random(2)
    for _ in range(800):
        a = [rng.randrange(rng.choice([2, 3, 8])) for _ in range(rng.randrange(0, 25))]
        b = list(a)
        for _ in range(rng.randrange(0, 8)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randrange(2)] = [rng.randrange(8)] * rng.randrange(2)
        distance = edit_distance(a, b)
        for limit in range(10):
            assert distance_within(np.array(a, np.uint32), np.array(b, np.uint32), limit) == (distance <= limit)


def test_sketches_follow_order_and_occurrence():
    words = np.arange(200, dtype=np.uint32)
    swapped = np.r_[words[100:], words[:100]]
    same, other, order, repeated = order_sketches([words, words + 1000, swapped, np.r_[words, words]])
    assert (order_sketches([words])[0] == same).all()
    assert not (same == other).any()
    assert 0 < (same == order).sum() < len(same)  # pairs on both sides of the cut changed their order
    assert not (same == repeated).all()


def family(rng, words, copies, edits):
    out = []
    for _ in range(copies):
        new = list(words)
        for _ in range(edits):
            new[rng.randrange(len(new))] = f"e{rng.randrange(10**6)}"
        out.append(new)
    return out


@pytest.mark.parametrize("levels", [3, 1])
def test_classes_equal_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(near_dedup, "LEVELS", levels)
    rng = random.Random(7)
    texts = []
    for size, copies, edits in ((120, 6, 2), (400, 9, 8), (60, 4, 1), (90, 3, 30)):
        texts += family(rng, [f"w{rng.randrange(5000)}" for _ in range(size)], copies, edits)
    shared = [f"p{k}" for k in range(70)]  # a passage that many documents hold
    texts += [[f"w{rng.randrange(5000)}" for _ in range(90)] + shared for _ in range(25)]
    texts += [[f"w{rng.randrange(5000)}" for _ in range(150)] for _ in range(15)]
    texts += [texts[0], texts[0], texts[12]]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    label = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            longest = max(len(a), len(b))
            if distance_within(*(np.array([hash(w) & 0xFFFFFFFF for w in t], np.uint32) for t in (a, b)), int(0.2 * longest)):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {x: label.index(x) for x in set(label)}
    found = {r["id"]: r["class_id"] for r in near_duplicate_classes(docs).collect()}
    assert found == {k: least[x] for k, x in enumerate(label)}


def star(rng, copies, stretches=3, length=13):
    """A text and copies with own insertions: each near the text, most not near each other."""
    hub = [f"w{rng.randrange(5000)}" for _ in range(300)]
    out = [hub]
    for c in range(copies):
        new = list(hub)
        for s in range(stretches):
            k = rng.randrange(len(new) + 1)
            new[k:k] = [f"c{c}s{s}i{i}" for i in range(length)]
        out.append(new)
    return out


@pytest.mark.parametrize("levels,copies,block", [(3, 2000, 512), (0, 150, 40)])
def test_a_star_is_one_class(spark, monkeypatch, levels, copies, block):
    monkeypatch.setattr(near_dedup, "LEVELS", levels)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = star(random.Random(11), copies)
    docs = spark.createDataFrame([((k + 7) % len(texts), " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    found = near_duplicate_classes(docs)
    assert [(r["class_id"], r["count"]) for r in found.groupBy("class_id").count().collect()] == [(0, copies + 1)]


@pytest.mark.parametrize("levels", [0])
def test_agreement_in_one_sketch_leads_to_a_comparison(spark, monkeypatch, levels):
    monkeypatch.setattr(near_dedup, "LEVELS", levels)
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    rng = random.Random(5)
    shared = [f"p{k}" for k in range(110)]  # most of each text, so that third texts lead the buckets
    texts = []
    for _ in range(40):
        own = [f"w{rng.randrange(10**6)}" for _ in range(70)]
        texts.append(shared + own)
        other = shared + own
        for k in rng.sample(range(180), 30):
            other[k] = f"e{rng.randrange(10**6)}"
        texts.append(other)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    codes = near_dedup.word_codes([" ".join(t) for t in texts])
    agree = order_sketches(codes)
    expected = [k // 2 * 2 if (agree[k // 2 * 2] == agree[k // 2 * 2 + 1]).any() else k for k in range(len(texts))]
    assert sum(k != e for k, e in enumerate(expected)) > 15
    found = {r["id"]: r["class_id"] for r in near_duplicate_classes(docs).collect()}
    assert [found[k] for k in range(len(texts))] == expected


def test_bounds_keep_all_near_pairs():
    rng = random.Random(3)
    docs = [np.array([rng.randrange(40) for _ in range(rng.randrange(1, 60))], np.uint32) for _ in range(30)]
    docs += [np.delete(np.where(np.array([rng.random() for _ in d]) < 0.1, 99, d), slice(0, rng.randrange(3))).astype(np.uint32) for d in docs]
    docs = [d for d in docs if len(d)]
    can, _ = near_dedup._possible(docs, docs, 0.8)
    close = np.array([[near_dedup.near(a, b, 0.8) for b in docs] for a in docs])
    assert close.sum() > len(docs) and not (close & ~can).any()


def test_near_edge_cases(spark, rows):
    data = [(1, None, 1), (2, "", 2), (3, "...", 3), (4, "one two", 4), (5, "ONE two.", 5), (None, "x y z a b c", 6),
            (7, "long " * 40_000, 7), (7, "long " * 40_000, 7), (8, "one three", 8)]
    docs = spark.createDataFrame(data, "doc_id long, text string, digest long")
    assert rows(near_duplicate_classes(docs), "id", "class_id") == sorted(
        [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (None, None), (7, 7), (7, 7), (8, 8)], key=repr)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id", "digest") == sorted([(1, 1), (3, 3), (4, 4), (None, 6), (7, 7), (8, 8)], key=repr)
    assert near_duplicate_classes(docs.limit(0)).count() == drop_near_duplicates(docs.limit(0)).count() == 0


def near_kept(rows, similarity=0.8):
    """Brute force of the pipeline's stage: classes of texts by alignment, then the row that stays."""
    texts = sorted({t or "" for _, t in rows})
    codes = near_dedup.word_codes(texts)
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(codes[i]) and len(codes[j]) and root[i] != root[j] and near_dedup.near(codes[i], codes[j], similarity):
                root = [root[j] if r == root[i] else r for r in root]
    best = {}
    for id_, t in rows:
        text = t or ""
        order = (id_ is None, id_ or 0, hashlib.sha256(text.encode()).hexdigest())
        best.setdefault(root[texts.index(text)], []).append((order, id_, text))
    return sorted(((min(c)[1], min(c)[2]) for c in best.values()), key=repr)


def test_rows_with_shared_and_missing_ids_stay(spark, rows):
    rng = random.Random(31)
    prose = [" ".join(f"w{rng.randrange(5000)}" for _ in range(40)) for _ in range(9)]
    data = [(None, prose[0]), (None, prose[1]), (None, prose[2]), (5, prose[3]), (5, prose[4]), (7, prose[5]), (7, prose[6]),
            (8, prose[3]), (9, prose[7] + " one more"), (None, prose[7]), (10, prose[7]), (None, prose[0]), (11, ""), (12, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("doc_id", "coalesce(text, '') AS text", "doc_id AS kept_at")
    expected = near_kept(data)
    assert len(expected) == 9
    assert rows(drop_near_duplicates(docs), "doc_id", "text") == expected


def labels_of(monkeypatch, module):
    """The labels that the module stages from now on."""
    seen, write = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, label: (seen.append(label), write(df, label))[1])
    return seen


def test_stars_need_no_round(spark, rows, monkeypatch):
    staged = labels_of(monkeypatch, components)
    edges = spark.createDataFrame([(k, 0) for k in range(1, 40)] + [(100, k) for k in (101, 102)], "x long, y long")
    found = rows(connected_components(edges.filter("y < 100")), "node", "component")
    assert found == sorted([(k, 0) for k in range(40)], key=repr)
    assert staged == ["edges"]
    found = rows(connected_components(edges), "node", "component")
    assert found == sorted([(k, 0) for k in range(40)] + [(k, 100) for k in (100, 101, 102)], key=repr)


def test_no_further_leader_for_texts_that_share_a_passage(spark, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    rng = random.Random(3)
    shared = [f"p{k}" for k in range(70)]
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(90)] + shared for _ in range(60)]
    texts += family(rng, texts[0], 2, 2)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    staged = labels_of(monkeypatch, near_dedup)
    found = rows(near_duplicate_classes(docs), "id", "class_id")
    assert found == sorted([(k, k if k < 60 else 0) for k in range(len(texts))], key=repr)
    assert staged.count("near-verified") == 1


def test_components(spark, rows):
    path = [(k + 1, k) for k in range(30)] + [(100, 101), (102, 101), (5, 5), (100, 101), (200, 200)]
    found = rows(connected_components(spark.createDataFrame(path, "x long, y long")), "node", "component")
    assert found == sorted([(k, 0) for k in range(31)] + [(k, 100) for k in (100, 101, 102)], key=repr)
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


def brute_links(vectors, similarity):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = units @ units.T >= similarity
    np.fill_diagonal(hit, False)
    label = np.arange(len(units))
    while True:
        new = np.array([min([label[k], *label[hit[k]]]) for k in range(len(units))])
        if (new == label).all():
            return hit.sum(axis=1), label
        label = new


def cloud(seed, n, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    return np.concatenate([centres[rng.integers(12, size=n)] + spread * rng.normal(size=(n, 16)), rng.normal(size=(n // 2, 16))])


@pytest.mark.parametrize("spread", [0.02, 0.3])
def test_parts_against_brute_force(monkeypatch, spread):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    points = cloud(1, 300, spread)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    ones = np.ones(len(points), np.int64)
    links, _, stars = compare_parts(points, ones, points, ones, True, 0.95)
    # within one part each unordered pair is met once, counted on both of its sides
    na, nb, _ = compare_parts(points, ones, points, ones, True, 0.95)
    assert (na + nb == brute_links(points, 0.95)[0]).all()
    a, b = points[:200], points[200:]
    na, nb, _ = compare_parts(a, ones[:200], b, ones[200:], False, 0.95)
    hit = a @ b.T >= 0.95
    assert (na == hit.sum(axis=1)).all() and (nb == hit.sum(axis=0)).all()


@pytest.mark.parametrize("node", [8192, 40])
def test_groups_against_brute_force(spark, rows, monkeypatch, node):
    monkeypatch.setattr(embedding_dedup, "NODE", node)
    points = np.concatenate([cloud(3, 150, 0.05), cloud(3, 150, 0.05)[:40] * 2.5])
    points = np.concatenate([points, points[:10]])
    links, label = brute_links(points, 0.95)
    table = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(points)], "vec_id long, embedding array<double>, n_links int")
    assert rows(embedding_groups(table)) == sorted(
        ((k, int(n), int(c)) for k, (n, c) in enumerate(zip(links, label, strict=True))), key=repr)


def test_embedding_edge_cases(spark, rows):
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [math.nan, 1.0]), (7, [1.0, None]),
            (8, [math.inf, 1.0]), (9, [1.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [0.0, 1.0]), (11, [0.0, 3.0])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows(embedding_groups(table)) == sorted(
        [(1, 3, 1), (2, 3, 1), (10, 3, 1), (10, 3, 1), (None, 1, 11), (11, 1, 11), *[(k, 0, k) for k in (3, 4, 5, 6, 7, 8, 9)]], key=repr)
    assert embedding_groups(table.limit(0)).count() == 0
