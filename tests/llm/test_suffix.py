"""External induced sorting and the removal of repeats against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import induced
from tidemark.llm.induced import DiskQueue, Scratch, sorted_suffixes
from tidemark.llm.suffix_dedup import merged, remove_repeats, repeated_starts


def brute_order(text):
    order = sorted(range(len(text)), key=lambda i: text[i:], reverse=True)

    def common(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k

    return order, [0] + [common(text[a:], text[b:]) for a, b in zip(order, order[1:], strict=False)]


@pytest.mark.parametrize("internal", [1, 3, 1 << 20])
def test_suffixes_and_common_prefixes(internal, monkeypatch):
    monkeypatch.setattr(induced, "BUFFER", 3)  # queues go to disk at once
    rng = random.Random(internal)
    for _ in range(150):
        text = [rng.randrange(rng.choice([1, 2, 5, 30])) for _ in range(rng.randrange(1, 60))]
        if rng.random() < 0.5:
            text = (text[: max(1, len(text) // 3)] * 4)[: len(text)]
        scratch = Scratch()
        pieces = list(sorted_suffixes(np.array(text, np.uint16), scratch, rng.choice([2, 5, 64]), internal))
        scratch.close()
        assert (np.concatenate([p for p, _ in pieces]).tolist(), np.concatenate([c for _, c in pieces]).tolist()) == brute_order(text)


def test_a_queue_spills_and_keeps_its_order():
    scratch = Scratch()
    queue = DiskQueue(scratch, buffer=4)
    for k in range(10):
        queue.push(np.array([[k, -k]]))
    assert queue.written == 10 and [queue.pop(3)[:, 0].tolist() for _ in range(4)] == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]
    scratch.close()


def test_starts_never_cross_contents():
    contents = [b"xabcdefy", b"abcdef", b"zabcd", b"efgh", b""]
    found = sorted(repeated_starts(iter(contents), 4, chunk=3, internal=2))
    assert found == [(0, 1, 4), (1, 0, 3), (2, 1, 2)]


def brute(texts, width):
    counted = {}
    for t in texts:
        for k in range(len(t) - width + 1):
            counted[t[k : k + width]] = counted.get(t[k : k + width], 0) + 1
    out = []
    for t in texts:
        spans = merged([(k, k + width) for k in range(len(t) - width + 1) if counted[t[k : k + width]] > 1])
        kept = b"".join(t[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[b for b, _ in spans], len(t)], strict=True))
        out.append((len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)

    def words(n, kinds=400):
        return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))

    passage, line = words(60), "a line that very many documents hold in other surroundings"
    texts = [words(rng.randrange(0, 200)) for _ in range(25)]
    texts += [f"{words(20)} {passage} {words(20)}" for _ in range(8)]
    texts += [f"{words(15)}\n{line}\n{words(15)}" for _ in range(30)]
    texts += [texts[3]] * 3 + ["é" * 150, "é" * 90, "ab" * 500, None, "", "short", "short", words(4000)]
    return texts


@pytest.mark.parametrize(("hot", "width"), [(4096, 200), (1, 200), (4096, 40), (3, 40)])
def test_against_brute_force(spark, rows, hot, width):
    texts = corpus(hot)
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = remove_repeats(docs, width=width, hot=hot).selectExpr("id", "n_bytes", "n_removed", "CAST(size(spans) AS INT) n", "kept_sha256")
    expected = brute([(t or "").encode() for t in texts], width)
    assert rows(found) == sorted(((k, *e) for k, e in enumerate(expected)), key=repr)


def test_rows_without_a_sound_id_are_rows_of_their_own(spark, rows):
    texts = ["q" * 210, "q" * 210, "r" * 100 + "s" * 150, "t" * 150]
    ids = [None, None, 4, 4]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    found = remove_repeats(docs).select("id", "n_bytes", "n_removed")
    assert rows(found) == sorted([(None, 210, 210), (None, 210, 210), (4, 250, 0), (4, 150, 0)], key=repr)
    assert remove_repeats(docs.limit(0)).count() == 0
