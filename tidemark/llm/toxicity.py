"""Toxicity by a subsequence string kernel, Nystroem landmarks and a linear SVM.

* Kernel: two words are compared by the subsequences of three letters they
  share, each weighted by ``DECAY`` per skipped letter, up to ``SPAN`` letters
  wide, and normalised. Letters put in between ("id-iot", "i.d.i.o.t") or
  missing lower the value a little instead of to zero. The square of a kernel
  is a kernel, so squares are used; values below ``FLOOR`` are zero by definition.
* A sentence is compared with a landmark by its most similar word.
* Landmarks are the word parts that tell the labelled classes apart most; the inverse square root of their kernel matrix
  gives the Nystroem features, on which a squared-hinge SVM is trained.
* Labels are per document, so training alternates: take the worst sentence of
  each document under the present machine, train on those, repeat. Sentences of
  toxic documents with a word that harmless ones hardly hold always count.
* A document scores as its worst sentence; a logistic fit, weighted back to the
  true share of the classes, turns margins into probabilities.

Only labelled rows outside the held-out fold are learned from, at most
``PER_CLASS`` texts of a class; language, source and id are never looked at.
Each distinct word is compared once per worker. A bound that needs one number
per subsequence proves most words to be below the floor for all landmarks.

Defined cases: null and empty texts have no sentence and get the score of a
harmless one; without labels of both classes every score is the share of the
class that exists (0 without any); repeated rows score alike.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import class_sizes, fresh_names, logistic_1d, release_freed, training_rows, worker_cache

PER_CLASS = 2500  # labelled texts of each class to learn from
LANDMARKS = 128
DECAY = 0.6  # weight of each skipped letter
SPAN = 5
FLOOR = 0.5  # kernel values below are zero
WINDOW = 12  # longer words are compared window by window
LEAST_RATIO = 8.0  # log-likelihood ratio that a landmark needs
SURE = 0.6  # squared kernel value from which a sentence holds a landmark
BITS = 20
REMEMBERED = 400_000  # words a worker keeps; it starts anew beyond
LEARNED = 5_000  # words compared with the landmarks at a time
REJECTED = 0.5  # score from which a document counts as toxic
PATTERNS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]  # second and third letter's distance from the first
MARKS = re.compile(r"[\W_]+")


def _plain(token: str) -> str:
    """The token without marks, behind a sign for its beginning: "i.d-iot" reads "^idiot"."""
    low = token.lower()
    return "^" + (low if low.isalnum() else MARKS.sub("", low))


def _windows(word: str) -> list[str]:
    word = _plain(word)
    if len(word) <= WINDOW:
        return [word]
    return [word[k : k + WINDOW] for k in range(0, len(word) - WINDOW + 4, 4)]


def _codes(words: list[str]) -> Iterator[tuple[float, np.ndarray]]:
    """Per pattern its weight and the subsequence codes, -1 beyond a word's end: (words, places)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    longest = max(SPAN, int(sizes.max(initial=0)))
    letters = np.zeros((len(words), longest), np.uint64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    letters[np.arange(longest) < sizes[:, None]] = flat
    for a, b in PATTERNS:
        first, second, third = letters[:, : longest - b], letters[:, a : longest - b + a], letters[:, b:]
        mixed = (first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F) + third * np.uint64(0x165667B19E3779F9))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        code = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
        code[third == 0] = -1
        yield DECAY ** (b - 2), code


def _self_kernel(words: list[str]) -> np.ndarray:
    """k(w, w) of each word: squared weight of each different subsequence, occurrences added up."""
    codes, weights = [], []
    for weight, code in _codes(words):
        codes.append(code)
        weights.append(np.where(code >= 0, weight, 0.0))
    code, weight = np.concatenate(codes, axis=1), np.concatenate(weights, axis=1)
    order = np.argsort(code, axis=1, kind="stable")
    code, weight = np.take_along_axis(code, order, 1), np.take_along_axis(weight, order, 1)
    new = np.ones(code.shape, bool)
    new[:, 1:] = code[:, 1:] != code[:, :-1]
    group = np.cumsum(new.ravel()) - 1
    sums = np.bincount(group, weight.ravel())
    row = np.flatnonzero(new.ravel()) // code.shape[1]
    return np.bincount(row, sums * sums, len(words))


class KernelMap:
    """Similarity of words with the landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        m = len(landmarks)
        sizes = np.sqrt(np.maximum(_self_kernel(landmarks), 1e-12))
        rows: dict[int, int] = {}
        parts: list[tuple[int, int, float]] = []
        for weight, code in _codes(landmarks):
            for j, k in zip(*np.nonzero(code >= 0), strict=True):
                parts.append((rows.setdefault(int(code[j, k]), len(rows) + 1), j, weight / sizes[j]))
        self.weights = np.zeros((len(rows) + 1, m), np.float32)  # row 0: subsequences of no landmark
        for row, j, weight in parts:
            self.weights[row, j] += weight
        self.row_of = np.zeros((1 << BITS) + 1, np.int32)  # the last place is that of code -1
        self.row_of[list(rows)] = list(rows.values())
        self.most_of = self.weights.max(axis=1)[self.row_of]

    def similar(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words with a value of at least ``FLOOR``, and their squared kernel values."""
        if not words:
            return np.zeros(0, np.int64), np.zeros((0, len(self.landmarks)), np.float32)
        bound, least, found = np.zeros(len(words)), np.zeros(len(words)), []
        for weight, code in _codes(words):
            bound += weight * self.most_of[code].sum(axis=1)
            least += weight * weight * (code >= 0).sum(axis=1)
            found.append((weight, code))
        near = np.flatnonzero(bound >= FLOOR * np.sqrt(least) - 1e-6)
        near = near[least[near] > 0]
        if not near.size:
            return near, np.zeros((0, len(self.landmarks)), np.float32)
        value = np.zeros((near.size, len(self.landmarks)), np.float32)
        for weight, code in found:
            row = self.row_of[code[near]]
            for k in range(row.shape[1]):
                hit = np.flatnonzero(row[:, k])
                value[hit] += weight * self.weights[row[hit, k]]
        value /= np.sqrt(_self_kernel([words[i] for i in near]))[:, None]
        value[value < FLOOR] = 0
        some = value.any(axis=1)
        return near[some], value[some] ** 2


class ToxicityModel:
    def __init__(self, kernel: KernelMap, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.kernel, self.weights, self.bias, self.slope, self.shift = kernel, weights, bias, slope, shift
        self.features: dict[str, np.ndarray | None] = {}
        self.near: set[str] = set()  # the words whose features are not None
        self.key = uuid.uuid4().hex

    def __getstate__(self):
        return self.__dict__ | {"features": {}, "near": set()}

    def _learn_words(self, words: list[str]) -> None:
        for begin in range(0, len(words), LEARNED):
            part = words[begin : begin + LEARNED]
            windows = [_windows(w) for w in part]
            owner = np.repeat(np.arange(len(part)), [len(w) for w in windows])
            at, value = self.kernel.similar(list(chain.from_iterable(windows)))
            self.features.update(dict.fromkeys(part))
            for i, v in zip(owner[at].tolist(), value, strict=True):
                known = self.features[part[i]]
                # a copy: a word kept for long would hold on to the values of all words learned with it
                self.features[part[i]] = v.copy() if known is None else np.maximum(known, v)
                self.near.add(part[i])

    def sentences(self, texts: list[str]) -> list[list[np.ndarray]]:
        """Per text the landmark values of its sentences; sentences near no landmark are left out."""
        tokens = [t.split() for t in texts]
        spelled = [self._spelled(t) for t in tokens]
        words = set(chain.from_iterable(tokens)).union(*spelled)
        new = words.difference(self.features)
        if len(self.features) + len(new) > REMEMBERED:
            self.features = {w: self.features[w] for w in words.difference(new)}
            self.near = {w for w, v in self.features.items() if v is not None}
        self._learn_words(list(new))
        out = []
        for text, token, joined in zip(texts, tokens, spelled, strict=True):
            hits = self.near.intersection(token)
            found = [self.features[w] for w in joined if w in self.near]
            if hits:
                found += self._by_sentence(text, hits)
            out.append(found)
        return out

    def _by_sentence(self, text: str, hits: set[str]) -> list[np.ndarray]:
        """A sentence ends with its line, or behind a token that ends with a full stop or the like."""
        found = []
        for line in text.split("\n"):
            line_tokens = line.split()
            if hits.isdisjoint(line_tokens):
                continue
            held = None
            for token in line_tokens:
                if token in hits:
                    value = self.features[token]
                    held = value if held is None else np.maximum(held, value)
                if held is not None and token[-1] in ".!?":
                    found.append(held)
                    held = None
            if held is not None:
                found.append(held)
        return found

    @staticmethod
    def _spelled(tokens: list[str]) -> list[str]:
        """Letters spelled one by one, put together: runs of four or more one-letter tokens."""
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        edge = np.diff(np.r_[0, (size == 1).astype(np.int8), 0])
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return ["".join(tokens[b:e]) for b, e in zip(begins.tolist(), ends.tolist(), strict=True) if e - b >= 4]

    def margins(self, texts: list[str]) -> np.ndarray:
        return np.array([
            self.bias + max(0.0, float((np.stack(found) @ self.weights).max())) if found else self.bias
            for found in self.sentences(texts)
        ])

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -60, 60)))


def choose_landmarks(texts: list[str], toxic: np.ndarray, count: int) -> list[str]:
    """Word parts of 4 to 8 letters (and whole short words) by the log-likelihood ratio of their document counts."""
    words = [{w for w in map(_plain, set(t.split())) if len(w) > 3} for t in texts]
    in_toxic, in_other = Counter(), Counter()
    for found, y in zip(words, toxic, strict=True):
        (in_toxic if y else in_other).update(found)
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    suspects = [w for w, n in sorted(in_toxic.items()) if n >= 2 and n / n1 > 3 * in_other[w] / n0]

    def parts(word: str) -> set[str]:
        if len(word) <= 4:
            return {word}
        return {word[i : i + k] for k in range(4, min(8, len(word)) + 1) for i in range(len(word) - k + 1)}

    weight = Counter()
    for w in suspects:
        for p in sorted(parts(w)):
            weight[p] += in_toxic[w]
    candidates = {p for p, _ in weight.most_common(40 * count)}
    holders: dict[str, list[str]] = {p: [] for p in candidates}
    for w in in_toxic.keys() | in_other.keys():
        if len(w) <= 40:
            for p in parts(w) & candidates:
                holders[p].append(w)
    covered: set[str] = set()

    def ratio(p: str) -> float:
        """Log-likelihood ratio of a part over the words that no chosen part covers."""
        left = [w for w in holders[p] if w not in covered]
        x, y = min(sum(in_toxic[w] for w in left), n1), min(sum(in_other[w] for w in left), n0)
        if x / n1 <= y / n0:
            return 0.0
        share = (x + y) / (n1 + n0)
        return 2 * (x * np.log(x / (n1 * share)) + (y * np.log(y / (n0 * share)) if y else 0))

    def worth(p: str) -> float:
        """Longer parts count more: they are less likely by chance and leave less to guess."""
        return -round(ratio(p) * len(p) ** 0.5, 6)

    queue = [(worth(p), p) for p in candidates]
    heapq.heapify(queue)
    chosen: list[str] = []
    while queue and len(chosen) < count:
        before, p = heapq.heappop(queue)
        now = worth(p)
        if ratio(p) < LEAST_RATIO:
            continue
        if now > before:  # words were covered meanwhile
            heapq.heappush(queue, (now, p))
            continue
        chosen.append(p)
        covered.update(holders[p])
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM in the primal by Newton steps on the present support vectors."""
    x1 = np.c_[x, np.ones(len(x))]
    penalty = np.diag(np.r_[np.full(x.shape[1], ridge), 1e-3])
    w, support = np.zeros(x1.shape[1]), np.ones(len(x), bool)
    for _ in range(30):
        s = x1[support] * weight[support, None]
        w = np.linalg.solve(penalty + s.T @ x1[support], s.T @ y[support])
        now = y * (x1 @ w) < 1
        if (now == support).all():
            break
        support = now
    return w[:-1], float(w[-1])


def train(texts: list[str], toxic: np.ndarray, sizes: tuple[int, int] | None = None) -> ToxicityModel:
    """The machine from labelled texts; ``sizes``: rows of class 0 and 1 the texts were taken from."""
    toxic = np.asarray(toxic, bool)
    n0, n1 = sizes or (int((~toxic).sum()), int(toxic.sum()))
    if not toxic.any() or toxic.all():
        share = float(toxic.any())
        return ToxicityModel(KernelMap(["none"]), np.zeros(1), 0.0, 0.0, 40.0 * (2 * share - 1))
    kernel = KernelMap(choose_landmarks(texts, toxic, LANDMARKS) or ["none"])
    m = len(kernel.landmarks)
    whole = np.zeros((m, m))
    at, value = kernel.similar(kernel.landmarks)
    whole[at] = value
    whole = (whole + whole.T) / 2
    spread, axes = np.linalg.eigh(whole)
    root = axes @ np.diag(1 / np.sqrt(np.maximum(spread, 1e-2))) @ axes.T
    model = ToxicityModel(kernel, np.ones(m), 0.0, 1.0, 0.0)
    bags = []
    for k in range(0, len(texts), 500):
        bags += model.sentences(texts[k : k + 500])
    # All sentences in one matrix, behind one empty sentence of every text.
    owner = np.r_[np.arange(len(texts)), np.repeat(np.arange(len(texts)), [len(found) for found in bags])]
    every = np.concatenate([np.zeros((len(texts), m), np.float32), *[np.stack(found) for found in bags if found]])
    order = np.argsort(owner, kind="stable")
    owner, every = owner[order], every[order]
    starts = np.searchsorted(owner, np.arange(len(texts)))

    def worst(weights: np.ndarray) -> np.ndarray:
        """The sentence of highest margin of each text."""
        value = every @ weights
        top = np.maximum.reduceat(value, starts)
        at = np.flatnonzero(value == top[owner])
        return every[at[np.searchsorted(owner[at], np.arange(len(texts)))]]

    # Landmarks that hardly any harmless document comes near: all their sentences count, not only the worst.
    held = np.maximum.reduceat(every, starts) >= SURE
    a, b = held[toxic].sum(axis=0), held[~toxic].sum(axis=0)
    pure = (a >= max(3, 0.01 * toxic.sum())) & (b * toxic.sum() <= 0.05 * a * (~toxic).sum())
    sure = toxic[owner] & (every[:, pure] >= SURE).any(axis=1)
    y = np.r_[np.where(toxic, 1.0, -1.0), np.ones(sure.sum())]
    weight = np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
    for _ in range(5):
        w, model.bias = _svm(np.r_[worst(model.weights), every[sure]] @ root, y, weight)
        model.weights = root @ w
    margin = worst(model.weights) @ model.weights + model.bias
    prior = np.where(toxic, n1 / max(1, toxic.sum()), n0 / max(1, (~toxic).sum()))
    model.slope, model.shift = logistic_1d(margin, toxic.astype(float), prior)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> ToxicityModel:
    """Train on the bounded labelled sample."""
    rows = sorted(training_rows(docs, labels, label, per_class).collect())  # in one order, so that training repeats
    texts, y = [r["t"] for r in rows], np.array([r["y"] for r in rows], float)
    return train(texts, y > 0, class_sizes(labels, label))


def with_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all, unless given) and ``toxicity``, the probability of the toxic class."""
    kept = docs.columns if keep is None else keep
    sent = kept if text_col in kept else [*kept, text_col]  # the text goes to Python once
    at = sent.index(text_col)
    (score,) = fresh_names(docs, "toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the landmarks' tables: a few MB whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = worker_cache(("toxicity", shared.value.key), lambda: shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            found = [machine.scores(texts[k : k + 1000]) for k in range(0, len(texts), 1000)]
            values = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], values], [f"c{k}" for k in range(len(kept) + 1)])
        release_freed()

    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(sent)])
    kinds = "".join(f"{c} {t}, " for c, t in rows.dtypes[: len(kept)])
    return rows.mapInArrow(run, f"{kinds}c{len(kept)} double").toDF(*kept, score)
