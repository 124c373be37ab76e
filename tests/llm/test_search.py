"""Ball trees and collision counting against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ann_search, lexical_search
from tidemark.llm.ann_search import nearest_neighbours
from tidemark.llm.lexical_search import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, top=10):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(1 for t in terms if t), sum(map(len, terms))
    df = Counter(w for t in terms for w in set(t))
    out = []
    for item, text in items:
        asked = TERM.findall((text or "").translate(LOWER))
        scores = []
        for (doc, _), t in zip(docs, terms, strict=True):
            tf = Counter(t)
            m = 25 + 75 * len(t) * n_docs // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 8 * m))
                for w in asked if tf[w])
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, s[2], -s[0]) for k, s in enumerate(scores[:top])]
    return out


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n)) + rng.choice(["", "\n", "!", "\x00É", " ́x"])


@pytest.mark.parametrize("small", [False, True])
def test_ranking_equals_the_definition(spark, monkeypatch, small):
    if small:  # several blocks, chunks and trees
        for name, value in {"ITEMS": 4, "CHUNK_BYTES": 2000, "TREE_ENTRIES": 300, "LEAF": 3}.items():
            monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.5)) % 400}" for _ in range(300)] + ["Über", "über", "a_b", "C3PO"]
    docs = [(k, prose(rng, words, rng.choice([0, 1, 5, 30, 400]))) for k in range(180)]
    docs += [(500, docs[20][1]), (501, docs[20][1]), (7, docs[30][1]), (None, docs[20][1]), (900, None), (901, ""), (902, "... ")]
    items = [(k, prose(rng, words, rng.choice([1, 4, 20, 60]))) for k in range(10)]
    items += [(20, docs[20][1]), (21, None), (22, ""), (23, "absent"), (24, "w1 w1 w1"), (None, "w1"), (24, "w1")]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, score int, item_id int, rank int")
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = ranked_search(df.repartition(3), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(ranked(docs, items), key=repr)


def test_bounds_prune_and_lose_nothing():
    """Documents of forty topics: subtrees of other topics are left out."""
    rng = np.random.default_rng(4)
    rows, topics = 2000, 40
    base = [(np.sort(rng.choice(400, 12, replace=False)), rng.integers(200_000, 1_000_000, 12)) for _ in range(topics)]
    topic = rng.integers(0, topics, rows)
    term = np.concatenate([base[t][0] for t in topic])
    value = np.concatenate([base[t][1] + rng.integers(-9000, 9000, 12) for t in topic])
    begin = np.arange(rows + 1) * 12
    weight = rng.integers(1, 20_000, 400)
    asked = [Counter({int(t): 1 + k % 2 for k, t in enumerate(base[number][0])}) for number in range(10)] + [Counter({3: 1, 9: 2})]
    queries = lexical_search.Queries(list(enumerate(asked)), weight)
    best = {number: [] for number in range(11)}
    visited = lexical_search.search_tree(
        lexical_search.Rows(begin, term, value), np.arange(rows), queries, best, 10, 16)
    dense = np.zeros((rows, 400), np.int64)
    np.put_along_axis(dense, term.reshape(rows, 12), value.reshape(rows, 12), axis=1)
    for number, terms, times in queries.items:
        score = dense[:, terms] @ (weight[terms] * times)
        expected = sorted(((int(s), -k) for k, s in enumerate(score) if s > 0), reverse=True)[:10]
        assert sorted(best[number], reverse=True) == expected
    assert visited < 0.4 * 11 * 128


def test_empty_search(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search(docs.limit(0), items).collect() == []
    assert ranked_search(docs, items.limit(0)).collect() == []
    assert [tuple(r) for r in ranked_search(docs, items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@pytest.mark.parametrize("kind", ["random", "clustered", "low"])
def test_recall_of_collision_counting(spark, monkeypatch, kind):
    monkeypatch.setattr(ann_search, "PART", 700)
    monkeypatch.setattr(ann_search, "QUERIES", 16)
    rng = np.random.default_rng(5)
    size = 4 if kind == "low" else 48
    vectors = rng.standard_normal((2000, size)) * 3
    if kind == "clustered":
        vectors = vectors[rng.integers(0, 40, 2000)] + rng.standard_normal((2000, size)) * 0.4
    vectors = vectors.astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = nearest_neighbours(df).collect()
    exact = unit(vectors.astype(float))
    hit = total = 0
    for q in range(0, 2000, 50):
        cosine = exact @ exact[q]
        cosine[q] = -2
        truth = np.argsort(-cosine, kind="stable")[:5].tolist()
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(cosine[v] - s) < 1e-12 for _, v, s in mine)
        hit += len(set(truth) & {v for _, v, _ in mine})
        total += 5
    assert hit / total >= 0.95


def test_collisions_are_counted_as_defined():
    rng = np.random.default_rng(6)
    units = unit(rng.standard_normal((300, 16)))
    index, query = ann_search.SortedLines(units), unit(rng.standard_normal((1, 16)))[0]
    gaps = np.abs(units @ ann_search.lines(16) - query @ ann_search.lines(16))
    seen, windows = set(), ann_search.Windows(index, query)
    for width in (0.01, 0.3, 0.31, 0.8, 1.3, 2, 5, 100):
        new = windows.widen(width).tolist()
        assert not seen & set(new)
        seen |= set(new)
        assert (windows.counts == (gaps <= width).sum(axis=1)).all()
        expected = np.flatnonzero((gaps <= width).sum(axis=1) >= math.ceil(ann_search.THRESHOLD * ann_search.LINES))
        assert seen == set(expected.tolist())


def test_a_query_ends_when_its_neighbours_are_sure():
    ratio = ann_search.sure_ratio()
    assert ann_search._tail(math.erf(ratio / math.sqrt(2)), math.ceil(ann_search.THRESHOLD * ann_search.LINES)) >= ann_search.CERTAIN
    rng = np.random.default_rng(9)
    caught = 0
    for _ in range(300):
        near = unit(rng.standard_normal((1, 32)))
        query = unit(near + rng.standard_normal((1, 32)) * 0.1)[0]
        windows = ann_search.Windows(ann_search.SortedLines(near), query)
        caught += windows.widen(ratio * float(np.linalg.norm(near[0] - query))).size
    assert caught / 300 > ann_search.CERTAIN - 0.04


def test_neighbours_of_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (50, [0.0, 3.0]), (100, [0.0, 0.0]), (150, None),
        (200, [1.0, None]), (250, [float("nan"), 1.0]), (300, [float("inf"), 1.0]), (350, []), (400, [1.0, 2.0, 3.0]),
        (None, [-1.0, 0.0]), (450, [1e300, 1e300]),
    ]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, score int, rank int")
    got = {}
    for r in nearest_neighbours(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 50}
    assert sorted(got[0], key=lambda r: r[0]) == [(1, 1, 1.0), (2, 2, 1.0), (3, 2, 1.0), (4, 50, 0.0), (5, None, -1.0)]
    assert [v for _, v, _ in sorted(got[50], key=lambda r: r[0])] == [0, 1, 2, 2, None]
    assert nearest_neighbours(df.limit(0)).collect() == []
    assert nearest_neighbours(df.filter("vec_id = 50")).collect() == []
