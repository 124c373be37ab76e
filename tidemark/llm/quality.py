"""Quality by compression: which labelled text does a document resemble?

Two zstandard dictionaries are built, one from good and one from bad labelled
texts. A document is compressed block by block with both; the difference of
the compressed sizes per byte says which dictionary explains it better, and a
logistic fit weighted to the true class shares turns that into a probability.
Blocks keep a long document from becoming its own dictionary, so every part of
the whole text counts alike.

The dictionaries come from one half of the sampled texts and the fit from the
other half, so the calibration never sees text that a dictionary holds.

Only labelled rows outside the held-out fold are learned from, at most
``PER_CLASS`` texts of a class; language, source and id are never looked at.

Defined cases: null and empty texts have difference 0 and get the score that
belongs to it; where a class has fewer than ``LEAST`` texts no dictionary can
be built and every score is the share of class 1 (0.5 without labels);
repeated rows score alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import class_sizes, fresh_names, logistic_1d, training_rows

PER_CLASS = 3000  # labelled texts of each class to learn from
LEAST = 8
DICTIONARY = 112 << 10
BLOCK = 2048
LEVEL = 3
ACCEPTED = 0.3  # score from which a document counts as good


class QualityModel:
    def __init__(self, good: bytes, bad: bytes, slope: float, shift: float):
        self.good, self.bad, self.slope, self.shift = good, bad, slope, shift
        self.key = uuid.uuid4().hex
        self._ready: tuple | None = None

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def _packers(self) -> tuple:
        if self._ready is None:
            self._ready = tuple(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False)
                for d in map(self._dictionary, (self.good, self.bad))
            )
        return self._ready

    @staticmethod
    def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
        made = zstandard.ZstdCompressionDict(content)
        made.precompute_compress(level=LEVEL)
        return made

    def difference(self, text: str) -> float:
        """Compressed bytes that the good dictionary saves against the bad one, per byte of text; 0 for no text."""
        if not self.good:
            return 0.0
        good, bad = self._packers()
        content = text.encode()
        saved = 0
        for k in range(0, len(content), BLOCK):
            part = content[k : k + BLOCK]
            saved += len(bad.compress(part)) - len(good.compress(part))
        return saved / max(1, len(content))

    def scores(self, texts: list[str]) -> np.ndarray:
        d = np.array([self.difference(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.slope * d + self.shift, -40, 40)))


def _blocks(texts: list[str]) -> list[bytes]:
    return [b for t in texts for c in [t.encode()] for k in range(0, len(c), BLOCK) if len(b := c[k : k + BLOCK]) >= 16]


def _trained(texts: list[str]) -> bytes:
    blocks = _blocks(texts)
    size = min(DICTIONARY, max(1024, sum(map(len, blocks)) // 8))
    return zstandard.train_dictionary(size, blocks, k=512, d=8, level=LEVEL).as_bytes()


def train(texts: list[str], good: np.ndarray, sizes: tuple[int, int] | None = None) -> QualityModel:
    """Dictionaries from the even texts of each class, the calibration from the odd ones."""
    good = np.asarray(good, bool)
    n0, n1 = sizes or (int((~good).sum()), int(good.sum()))
    share = (n1 + 1) / (n0 + n1 + 2)
    constant = QualityModel(b"", b"", 0.0, float(np.log(share / (1 - share))))
    halves = {y: [t for t, g in zip(texts, good, strict=True) if g == y] for y in (True, False)}
    if min(len(h) for h in halves.values()) < 2 * LEAST:
        return constant
    try:
        model = QualityModel(_trained(halves[True][::2]), _trained(halves[False][::2]), 1.0, 0.0)
    except zstandard.ZstdError:  # too little text for a dictionary
        return constant
    rest = halves[True][1::2] + halves[False][1::2]
    y = np.r_[np.ones(len(halves[True][1::2])), np.zeros(len(halves[False][1::2]))]
    d = np.array([model.difference(t) for t in rest])
    prior = np.where(y == 1, n1 / y.sum(), n0 / (1 - y).sum())
    model.slope, model.shift = logistic_1d(d, y, prior)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> QualityModel:
    """Train on the bounded labelled sample."""
    rows = sorted(training_rows(docs, labels, label, per_class).collect())  # in one order, so that training repeats
    y = np.array([r["y"] for r in rows], float)
    return train([r["t"] for r in rows], y > 0, class_sizes(labels, label))


_MODELS: dict[str, QualityModel] = {}


def with_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all, unless given) and ``quality_score``, the probability of the good class."""
    kept = docs.columns if keep is None else keep
    sent = kept if text_col in kept else [*kept, text_col]  # the text goes to Python once
    at = sent.index(text_col)
    (score,) = fresh_names(docs, "quality_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries: 224 KB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _MODELS.setdefault(shared.value.key, shared.value)
        for batch in batches:
            values = pa.array(own.scores([t or "" for t in batch.column(at).to_pylist()]), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], values], [f"c{k}" for k in range(len(kept) + 1)])

    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(sent)])
    kinds = "".join(f"{c} {t}, " for c, t in rows.dtypes[: len(kept)])
    return rows.mapInArrow(run, f"{kinds}c{len(kept)} double").toDF(*kept, score)
