"""Held-out accuracy and defined cases of the trained operators, and the pipeline."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import license_scan, quality, toxicity
from tidemark.llm.common import held_out, training_rows

FOLDER = "/root/testdata/sf0.01"
LABELLED = "/root/testdata/sf0.1"  # enough labels for a held-out fold
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def area(score, y):
    order = np.argsort(np.argsort(score, kind="stable"))
    return (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())


def speech(rng, n, extra=()):
    words = [rng.choice(["the", "river", "walked", "quiet", "garden", "morning", "letter", "street"]) for _ in range(n)]
    for w in extra:
        words[rng.randrange(n)] = w
    return " ".join(words) + "."


def test_kernel_tolerates_insertions():
    kernel = toxicity.KernelMap(["^numpty"])
    value = {}
    for w in ("numpty", "num-pty", "n.u.m.p.t.y", "numxpty", "numpt", "garden", "sympathy"):
        at, v = kernel.similar(toxicity._windows(w))
        value[w] = float(v[0, 0]) if len(at) else 0.0
    assert value["numpty"] == value["num-pty"] == value["n.u.m.p.t.y"] == pytest.approx(1)
    assert 0.3 < value["numxpty"] < 1 and 0.3 < value["numpt"] < 1
    assert value["garden"] == value["sympathy"] == 0


def test_self_kernel_counts_repeats():
    # "aaaa" holds "aaa" 4 times: twice in three letters, twice with one letter skipped
    assert toxicity._self_kernel(["^aaaa"[1:]])[0] == pytest.approx((2 + 2 * toxicity.DECAY) ** 2)


def test_toxicity_learns_words_it_is_shown():
    rng = random.Random(1)
    texts = [speech(rng, 40, ["numpty"] if k % 4 == 0 else ["twerp"] if k % 4 == 1 else []) for k in range(400)]
    model = toxicity.train(texts, np.array([k % 4 < 2 for k in range(400)]))
    score = model.scores([
        "what a numpty you are", "a real n-u-m-p-t-y", "such a twwerp", "N U M P T Y", "the quiet garden", "", "x" * 100_000])
    assert (score[:4] > 0.5).all() and (score[4:] < 0.1).all()


def test_one_class_or_no_labels():
    assert toxicity.train(["a b c"], np.array([False])).scores(["a"])[0] < 1e-6
    assert toxicity.train(["a b c"], np.array([True])).scores([""])[0] > 1 - 1e-6
    assert quality.train([], np.zeros(0)).scores(["a"])[0] == pytest.approx(0.5)
    assert quality.train(["a"] * 50, np.ones(50)).scores([""])[0] > 0.9


def test_training_leaves_held_out_rows_out(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 7 != 0, (F.col("doc_id") % 2).cast("int")).alias("toxic"))
    found = training_rows(docs, labels, "toxic", 50).collect()
    assert len(found) == 100 and all(zlib.crc32(r["t"].encode()) % 5 and int(r["t"]) % 7 and int(r["t"]) % 2 == r["y"] for r in found)
    assert spark.createDataFrame([(None,)], "doc_id long").select(held_out()).first()[0] is True


def scored(spark, module, score, label):
    docs, labels = (spark.read.parquet(f"{LABELLED}/{t}.parquet") for t in ("documents", "labels"))
    model = module.fit(docs, labels)
    frame = (module.with_quality if module is quality else module.with_toxicity)(docs, model, keep=["doc_id"])
    rows = frame.join(labels, "doc_id").filter(held_out()).select(score, label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


@needs_tables
def test_held_out_accuracy(spark):
    score, y = scored(spark, quality, "quality_score", "quality")
    assert area(score, y) > 0.98
    score, y = scored(spark, toxicity, "toxicity", "toxic")
    assert area(score, y) > 0.85
    assert ((score >= 0.5) & (y == 0)).mean() < 0.05


def test_defined_scores_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "text", None), (2, "", 0.5)], "doc_id long, text string, toxicity double")
    rng = random.Random(3)
    machine = toxicity.train([speech(rng, 20, ["oaf"] * (k % 2)) for k in range(60)], np.array([k % 2 == 1 for k in range(60)]))
    found = toxicity.with_toxicity(docs, machine)
    assert found.columns == ["doc_id", "text", "toxicity", "_toxicity"]
    values = {r["_toxicity"] for r in found.collect()}
    assert len(values) == 1 and found.limit(0).count() == 0


BACKGROUND = [speech(random.Random(k), 30) for k in range(200)]


@pytest.fixture(scope="module")
def licenses():
    return license_scan.LicenseModel(BACKGROUND)


def test_licenses(spark, rows, licenses):
    rng = random.Random(9)
    texts = {
        "apache": f"{speech(rng, 30)}\nLicensed under the Apache License, Version 2.0.\n{speech(rng, 9)}",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "cc-by-nc": "licensed under cc by-nc 4.0",
        "gpl": speech(rng, 300) + " This work is licensed under the GNU General Public License, version 3.",
    }
    data = [(k, t, 1) for k, t in texts.items()]
    data += [("", speech(rng, 50), 1), ("", None, 1), ("", "", 1), ("", "He had a license to fish, apache or not.", 1)]
    docs = spark.createDataFrame(data, "doc_id string, text string, licenses int")
    found = license_scan.scan_licenses(docs, licenses)
    assert sorted((r["doc_id"], r["licenses"]) for r in found.collect()) == sorted((d, [d] if d else []) for d, _, _ in data)
    assert license_scan.scan_licenses(docs.limit(0), licenses).count() == 0


def test_several_licenses_of_a_line(licenses):
    mit = "Licensed under the MIT license. See the LICENSE file for details."
    apache = "Licensed under the Apache License, Version 2.0."
    gpl = "This program is released under the GNU General Public License, version 3."
    sure = lambda text: {f for _, f, _, s in licenses.paragraphs(text) if s >= license_scan.CONFIRMED}
    assert sure(f"{mit} {apache}") == sure(f"{apache} {mit}") == {"mit", "apache"}
    rng = random.Random(5)
    assert sure(f"{speech(rng, 60)} {mit} {speech(rng, 90)} {apache}") == {"mit", "apache"}
    assert sure(f"{mit}\n{apache}\n{gpl}") >= {"mit", "apache"}
    assert sure(f"{speech(rng, 60)} the license of fishing was lost") == set()


def test_every_template_is_its_family(licenses):
    for family, templates in license_scan.TEMPLATES.items():
        for t in templates:
            assert [f for _, f, _, s in licenses.paragraphs(t) if s >= license_scan.CONFIRMED] == [family], t


def test_licenses_among_common_words_and_common_notices(spark):
    rng = random.Random(3)
    plain = [speech(rng, 12) + " text is available, and released under the terms" for _ in range(400)]
    notices = ["Released under the GPL v2.", "Text is available under CC BY 3.0.", "Released under the MIT License."]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(plain + notices * 60)], "doc_id long, text string")
    model = license_scan.fit(docs)
    assert [[f for _, f, _, s in model.paragraphs(t) if s >= license_scan.CONFIRMED] for t in notices] == [["gpl"], ["cc-by"], ["mit"]]


def test_all_that_a_template_confirms_is_classified(licenses):
    rng = random.Random(4)
    for texts in license_scan.TEMPLATES.values():
        for t in texts:
            words = license_scan.words_of(t)
            for _ in range(40):
                part = [w for w in words if rng.random() > 0.12]
                if any(licenses.similarity(part, f) >= license_scan.CONFIRMED for f in license_scan.TEMPLATES):
                    assert not licenses.telling_set.isdisjoint(part) or licenses._allows(part), part


def test_an_empty_corpus_trains(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert list(license_scan.fit(docs).paragraphs("Released under the MIT License."))[0][1] == "mit"


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept, counted = docs, {}
    for name, step in corpus_pipeline.STAGES:
        before = kept
        kept = corpus_pipeline.stage(step(spark, before, FOLDER), f"test-{name}")
        counted[name] = (before.count(), kept.count())
        if name != "sentencepiece":
            assert kept.columns == docs.columns
        if name == "toxicity":
            clean = labels.filter("toxic = 0").join(docs, "doc_id").select("doc_id")
            assert clean.join(kept, "doc_id", "left_anti").count() < 0.03 * clean.count()
        if name == "exact_dedup":
            texts = {}
            for r in before.collect():
                texts[r["text"]] = max(r["doc_id"], texts.get(r["text"], -1))
            assert sorted(r["doc_id"] for r in kept.collect()) == sorted(texts.values())
    assert counted["near_dedup"][1] < counted["near_dedup"][0]
    assert abs(counted["sentencepiece"][1] / counted["near_dedup"][1] - 1) < 0.2
    assert kept.filter("decoded <> text OR size(token_ids) = 0").count() == 0
