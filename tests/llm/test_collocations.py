"""Stripes against direct counting."""

import random
import re
from collections import Counter

import pytest

from tidemark.llm import collocations as module
from tidemark.llm.collocations import collocations


def counted(docs, min_count=10, subsumed=50, top=2000):
    """The definition, phrase by phrase."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    found[(lang if lang is not None else "und", tuple(words[i : i + k]))] += 1
    out = []
    langs = {lang for lang, _ in found}
    for lang in langs:
        f = {p: n for (x, p), n in found.items() if x == lang}
        n = sum(c for p, c in f.items() if len(p) == 1)
        rows = []
        for p, a in f.items():
            if len(p) < 2 or a < min_count:
                continue
            if any(len(q) > len(p) and c >= min_count and 100 * c >= subsumed * a and p in (q[:2], q[1:]) for q, c in f.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        rows.sort()
        out += [(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n, -r[0]) for i, r in enumerate(rows[:top])]
    return sorted(out)


def corpus(rng, rows):
    vocabulary = ["a", "B", "b", "über", "Ü", "c d", "x-y", "the", "of", "\x00", "\x1c", "q"]
    docs = []
    for _ in range(rows):
        words = []
        for _ in range(rng.randrange(0, 40)):
            words.append("the" if rng.random() < 0.33 else rng.choice(vocabulary))
            if rng.random() < 0.2:
                words[-1] += rng.choice([".", ",", "\n", "\x0b", "?", " \t "])
        docs.append((rng.choice([" ", "  ", "\t"]).join(words), rng.choice(["en", "en", "de", None, ""])))
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_equal_to_direct_counting(spark, rows, monkeypatch, small):
    if small:  # several chunks, emissions, pages, segments and shared hashes
        for name, value in {"CHUNK_BYTES": 300, "ENTRIES": 50, "PAGE": 4, "WORDS_PER_SLICE": 500}.items():
            monkeypatch.setattr(module, name, value)
    docs = corpus(random.Random(7), 150) + [(None, "en"), ("", None), ("lone", "xx"), ("The the THE " * 400, "de")]
    df = spark.createDataFrame([(i, t, lang, 1, 2) for i, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string, n int, rank int")
    got = collocations(df.repartition(5))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows(got) == sorted(counted(docs), key=repr)


def test_shared_hashes_are_told_apart(spark, rows, monkeypatch):
    monkeypatch.setattr(module.pd.util, "hash_array", lambda x, **_: module.np.array([len(w) % 3 for w in x], module.np.uint64) << module.np.uint64(60))
    docs = corpus(random.Random(8), 60)
    df = spark.createDataFrame(docs, "text string, lang string")
    assert rows(collocations(df.coalesce(1), top=7)) == sorted(counted(docs, top=7), key=repr)


def test_local_stripes_with_shared_hashes():
    """Renamed words keep numbers of their own, rare ones the entry of all others."""
    renamed = {("en", b"a"): 1 << 62, ("en", b"b"): (1 << 62) + 1, ("en", b"c"): 0}
    codes = module.word_codes("en", [b"a", b"b", b"c", b"d"], renamed)
    assert codes[:3].tolist() == [1 << 62, (1 << 62) + 1, 0]
    assert 0 < codes[3] < 1 << 62
    assert module.word_codes("de", [b"a"], renamed)[0] < 1 << 62


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations(empty).collect() == []
    assert collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).collect() == []


def test_score_is_exact(spark):
    big = 999_999_999_999_937
    df = spark.createDataFrame([(big, big + 12, big + 30)], "a long, l long, r long")
    assert df.select(module._score("a", "l", "r")).first()[0] == 1_000_000 * big * big // ((big + 12) * (big + 30))
