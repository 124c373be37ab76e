"""License scan: a trained paragraph classifier, confirmed by templates.

* A paragraph is a line. Its features are the one- to three-word n-grams over
  the words of the license templates (all other words look alike).
* A multinomial logistic regression tells the license families and "unknown"
  apart. It is trained on the templates with words dropped, replaced and put
  around them, against paragraphs of the corpus (a bounded sample, first by
  hash) and sentences that talk about licenses without granting one.
* Calibration: a temperature is fitted on every fourth example, which the
  weights never see; a paragraph is unknown unless a family's calibrated
  probability reaches ``ACCEPTED``.
* A prediction stands when the paragraph holds enough of the n-grams of one of
  the family's templates; others are only counted as unconfirmed.

Every template has telling words, chosen from the templates alone: the n-grams without any of
them are fewer than ``CONFIRMED`` of the template. Where a template consists mostly of words that any text
holds, the n-grams that a line's words allow are counted instead. Lines with no telling word that
cannot reach ``CONFIRMED`` are not classified, and not counted as unconfirmed.

Defined cases: null and empty texts have no license; several licenses in a
document are all listed, the likeliest first; repeated rows scan alike; an
empty corpus trains against the built-in sentences only.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import logistic_1d

# Usual wordings of license notices, by family.
TEMPLATES: dict[str, list[str]] = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is available under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the 3-clause BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Text is available under CC BY 3.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Available for noncommercial use under CC BY-NC 3.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GPL v2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Licensed under the MIT license. See the LICENSE file for details.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved. No part of this document may be reproduced without written permission.",
        "Copyright the author. All rights reserved.",
        "This software is proprietary and confidential; unauthorized copying is prohibited.",
    ],
}
# Sentences about licenses that grant none.
NO_GRANT = [
    "The driver showed a license at the border and was let through.",
    "A license was needed to fish in the lake, and the version of the rules had changed.",
    "The committee released a report under a new name.",
    "Rights were discussed, and permission to speak was given to the public.",
    "They released the prisoners under the terms of the peace.",
    "The general spoke to the public about the work of the foundation.",
    "The library opened its source of free books to any person.",
    "Version 2.0 of the program was faster than version 1.0.",
    "Common people made creative use of the commons.",
    "The terms of the file were subject to change.",
]

UNKNOWN = "unknown"
FAMILIES = [*sorted(TEMPLATES), UNKNOWN]
ACCEPTED = 0.5
CONFIRMED = 0.6  # share of a template's n-grams
BACKGROUND = 1000  # paragraphs of the corpus to train against
VARIANTS = 24  # altered copies of each template
# Template words that any text holds; they are never telling.
COMMON = frozenset(
    "a all and any are as available be by can charge conditions details document extent file files following for form found free "
    "general granted has hereby in is it law may met no not obtaining of or part person possible program project provided public "
    "published related released rights see source subject terms text that the this to under use version with without work "
    "written you your author code dedicated domain except international library".split())
ALLOWED = 200_000  # sets of words remembered
LONG = 400  # words of a paragraph looked at together; longer ones are scanned in overlapping stretches
WORD = re.compile(r"[a-z0-9]+(?:[.\-'][a-z0-9]+)*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(words: list[str], known: frozenset[str]) -> Counter:
    """One- to three-word n-grams; words of no template are all "*"."""
    seen = [w if w in known else "*" for w in words]
    found = Counter()
    for n in (1, 2, 3):
        for k in range(len(seen) - n + 1):
            part = seen[k : k + n]
            if part.count("*") < n:
                found[" ".join(part)] += 1
    return found


def telling_words(template: set[str]) -> tuple[list[str], bool]:
    """Words outside ``COMMON``, and whether any text that has ``CONFIRMED`` of the template's n-grams holds one of them."""
    left, chosen = set(template), []
    while len(left) >= CONFIRMED * len(template):
        counts = Counter(w for g in left for w in set(g.split()) - COMMON)
        if not counts:
            return chosen, False
        chosen.append(min(counts, key=lambda w: (-counts[w], w)))
        left = {g for g in left if chosen[-1] not in g.split()}
    return chosen, True


class LicenseModel:
    def __init__(self, background: list[str], seed: int = 7):
        self.key = uuid.uuid4().hex
        self.known = frozenset(w for texts in TEMPLATES.values() for t in texts for w in words_of(t))
        self.templates = {f: [set(grams(words_of(t), self.known)) for t in texts] for f, texts in TEMPLATES.items()}
        told = [(t, *telling_words(t)) for own in self.templates.values() for t in own]
        self.telling_set = frozenset(w for _, words, _ in told for w in words)
        self.telling_of = {f: frozenset(w for t in own for w in telling_words(t)[0]) for f, own in self.templates.items()}
        self.plain = [(len(t), [frozenset(g.split()) for g in t]) for t, _, enough in told if not enough]
        self.plain_words = frozenset(w for _, parts in self.plain for g in parts for w in g)
        self.allowed: dict[frozenset[str], bool] = {}
        self.span = max(len(words_of(t)) for texts in TEMPLATES.values() for t in texts)
        self._train(background, np.random.default_rng(seed))

    def _examples(self, background: list[str], rng: np.random.Generator) -> tuple[list[list[str]], list[int]]:
        fill = [w for t in background for w in words_of(t)] or ["some", "other", "words"]
        words, y = [], []
        for family, texts in TEMPLATES.items():
            for t in texts:
                own = words_of(t)
                for v in range(VARIANTS):
                    part = own if v < 4 else [
                        fill[rng.integers(len(fill))] if x < 0.05 else w for w in own for x in [rng.random()] if x > 0.04 or len(own) < 5]
                    if v % 2:
                        around = [fill[i] for i in rng.integers(len(fill), size=int(rng.integers(1, 60)))]
                        cut = int(rng.integers(len(around) + 1))
                        part = around[:cut] + part + around[cut:]
                    words.append(part)
                    y.append(FAMILIES.index(family))
        for t in NO_GRANT * 10:
            own = words_of(t)
            words.append(own if rng.random() < 0.3 else [w for w in own if rng.random() > 0.15])
            y.append(len(FAMILIES) - 1)
        for t in background:
            own = words_of(t)
            if max((self.similarity(own, f) for f in TEMPLATES), default=0) < 0.3:
                words.append(own)
                y.append(len(FAMILIES) - 1)
        return words, y

    def _train(self, background: list[str], rng: np.random.Generator) -> None:
        words, y = self._examples(background, rng)
        found = [grams(w, self.known) for w in words]
        counts = Counter(g for c in found for g in c)
        self.column = {g: k for k, g in enumerate(sorted(g for g, n in counts.items() if n >= 3))}
        x = np.stack([self._row(c) for c in found])
        target = np.eye(len(FAMILIES))[y]
        held = np.arange(len(y)) % 4 == 3
        share = target[~held].sum(axis=0)
        weight = (1 / np.maximum(share, 1))[np.argmax(target, axis=1)]
        weight /= weight[~held].mean()
        w, b = np.zeros((x.shape[1], len(FAMILIES))), np.zeros(len(FAMILIES))
        vw, vb, rate = np.zeros_like(w), np.zeros_like(b), 2.0
        for _ in range(150):  # full-batch gradient steps with momentum
            p = self._softmax(x[~held] @ w + b)
            g = (p - target[~held]) * weight[~held, None] / (~held).sum()
            vw, vb = 0.9 * vw - rate * (x[~held].T @ g + 1e-4 * w), 0.9 * vb - rate * g.sum(axis=0)
            w, b = w + vw, b + vb
        self.weights, self.bias = w, b
        # One temperature, from the margin of the right class over the best other one on unseen examples.
        z = x[held] @ w + b
        best = z.argmax(axis=1)
        right = (best == np.array(y)[held]).astype(float)
        top = np.sort(z, axis=1)
        slope, _ = logistic_1d(top[:, -1] - top[:, -2], right, np.ones(len(right)))
        self.temperature = 1 / min(max(slope, 0.2), 5.0)
        self.accuracy = float(right.mean())

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def _row(self, found: Counter) -> np.ndarray:
        row = np.zeros(len(self.column))
        for g, n in found.items():
            if g in self.column:
                row[self.column[g]] = 1 + np.log(n)
        return row / max(1.0, float(np.sqrt((row * row).sum())))

    def similarity(self, words: list[str], family: str) -> float:
        """Share of a template's n-grams that the words hold, of the family's best template."""
        own = set(grams(words, self.known))
        return max(len(own & t) / len(t) for t in self.templates[family])

    def classify(self, words: list[str]) -> tuple[str, float, float]:
        """(family or unknown, probability, template similarity)."""
        p = self._softmax(((self._row(grams(words, self.known)) @ self.weights + self.bias) / self.temperature)[None])[0]
        k = int(p.argmax())
        if FAMILIES[k] == UNKNOWN or p[k] < ACCEPTED:
            return UNKNOWN, float(p[-1]), 0.0
        return FAMILIES[k], float(p[k]), self.similarity(words, FAMILIES[k])

    def _allows(self, words: list[str]) -> bool:
        """Whether a template without enough telling words can reach ``CONFIRMED`` by these words, in any order."""
        own = self.plain_words.intersection(words)
        if own not in self.allowed:
            if len(self.allowed) >= ALLOWED:
                self.allowed.clear()
            self.allowed[own] = any(sum(g <= own for g in parts) >= CONFIRMED * n for n, parts in self.plain)
        return self.allowed[own]

    def paragraphs(self, text: str) -> Iterator[tuple[int, str, float, float]]:
        """(line number, family, probability, similarity) of every license of a line."""
        for n, line in enumerate(text.lower().split("\n")):
            words = words_of(line)
            if not self.telling_set.isdisjoint(words) or self._allows(words):
                best: dict[str, tuple[str, float, float]] = {}
                for k in range(0, max(1, len(words) - LONG // 2), LONG // 2):
                    for found in self._within(words[k : k + LONG]):
                        family = found[0]
                        if family != UNKNOWN and (family not in best or (found[2] >= CONFIRMED, found[1]) > (best[family][2] >= CONFIRMED, best[family][1])):
                            best[family] = found
                # Every confirmed family; where there is none, the likeliest.
                sure = [found for found in best.values() if found[2] >= CONFIRMED]
                for found in sure or sorted(best.values(), key=lambda x: (-x[1], x[0]))[:1]:
                    yield (n, *found)

    def _within(self, words: list[str]) -> Iterator[tuple[str, float, float]]:
        """The stretch, and around its telling words what a notice's length covers."""
        yield self.classify(words)
        # Several licenses that the words can hold, each with a telling word of its own: each is asked for without those of
        # the others.
        alike = sorted(
            ((-self.similarity(words, f), f) for f, own in self.telling_of.items() if not own.isdisjoint(words)))
        here: list[str] = []
        for less, f in alike:
            if -less >= CONFIRMED and not (self.telling_of[f] & set(words)) <= frozenset().union(*[self.telling_of[g] for g in here]):
                here.append(f)
        for f in here if len(here) > 1 else ():
            others = frozenset().union(*[self.telling_of[g] for g in here if g != f]) - self.telling_of[f]
            yield self.classify([w for w in words if w not in others])
        telling = [k for k, w in enumerate(words) if w in self.telling_set]
        if telling and len(words) > 40:
            begin = telling[0]
            for a, b in zip(telling, [*telling[1:], 1 << 30], strict=True):
                if b - a > 12:
                    yield self.classify(words[max(0, begin - 4) : a + 5])
                    yield self.classify(words[max(0, begin - self.span) : a + self.span + 1])
                    begin = b


def _least_lines(background: int):
    """The first ``background`` distinct (hash, line) of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple[int, str]] = []
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            near = np.arange(len(hashes)) if len(least) < background else np.flatnonzero(hashes <= least[-1][0])
            lines = batch.column(1).take(pa.array(near)).to_pylist()
            least = sorted({*least, *zip(hashes[near].tolist(), lines, strict=True)})[:background]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in least], pa.int64()), pa.array([t for _, t in least], pa.string())], ["h", "line"])

    return run


def fit(docs: DataFrame, text_col: str = "text", background: int = BACKGROUND) -> LicenseModel:
    """Train against the first ``background`` distinct lines of the corpus by hash."""
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line"))
    lines = lines.filter(F.trim("line") != "")
    least = lines.select(F.xxhash64("line").alias("h"), "line").mapInArrow(_least_lines(background), "h bigint, line string")
    sample = least.distinct().orderBy("h", "line").limit(background)
    return LicenseModel([r["line"] for r in sample.select("line").collect()])


_MODELS: dict[str, LicenseModel] = {}


def scan_licenses(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, licenses (confirmed, likeliest first), confirmed and unconfirmed paragraphs, and the
    best confirmed paragraph's probability and template similarity."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # weights of some thousand n-grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _MODELS.setdefault(shared.value.key, shared.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found = list(own.paragraphs(text or ""))
                sure = sorted((x for x in found if x[3] >= CONFIRMED), key=lambda x: (-x[2], x[1]))
                rows.append((
                    list(dict.fromkeys(x[1] for x in sure)), len(sure), len(found) - len(sure),
                    sure[0][2] if sure else 0.0, sure[0][3] if sure else 0.0))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.list_(pa.string()), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], [f"c{k}" for k in range(6)])

    rows = docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("t"))
    kind = rows.dtypes[0][1]
    out = rows.mapInArrow(run, f"c0 {kind}, c1 array<string>, c2 bigint, c3 bigint, c4 double, c5 double")
    return out.toDF(id_col, "licenses", "n_confirmed", "n_unconfirmed", "probability", "similarity")
