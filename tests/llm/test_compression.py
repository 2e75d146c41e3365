"""The compression classifier: its sizes against zstandard itself, its scores by held-out labels."""

import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from feedwell.llm.compression import BLOCK, GOOD, LEVEL, QualityModel, fit_quality, make_dictionary
from feedwell.llm.shared import Scratch


def corpus(size, seed):
    """(id, text, quality): plain sentences are good; shouting, marks after every word and one word over and over are bad."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(["an", "the", "in", "tion", "er", "ou", "st", "ly"], k=rng.randint(1, 4))) for _ in range(400)]
    rows = []
    for i in range(size):
        own, kind = rng.choices(words, k=rng.randint(20, 200)), i % 6
        text = " ".join(own)
        if kind == 0:
            text = text.upper()
        elif kind == 1:
            text = " ".join(w + rng.choice(["&&&", "###"]) for w in own)
        elif kind == 2:
            text = (own[0] + " ") * 200
        rows.append((i, text, int(kind > 2)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(900, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 4], "doc_id long, quality int")
    with Scratch(spark) as scratch:
        return rows, docs, fit_quality(docs, labels, scratch)


def test_held_out_labels(fitted):
    rows, docs, model = fitted
    found = {r.doc_id: r for r in model.score(docs).collect()}
    held = [(found[i].score, q) for i, _, q in rows if i % 4 == 0]
    assert all(0 <= s <= 1 for s, _ in held)
    assert np.mean([(s >= GOOD) == q for s, q in held]) >= 0.95
    good, bad = ([s for s, q in held if q == label] for label in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.98


def test_scores_are_calibrated(fitted):
    rows, docs, model = fitted
    found = {r.doc_id: r.score for r in model.score(docs).collect()}
    held = np.array([(found[i], q) for i, _, q in rows if i % 4 == 0])
    assert abs(held[:, 0].mean() - held[:, 1].mean()) < 0.06
    assert np.mean((held[:, 0] - held[:, 1]) ** 2) < 0.05


def test_sizes_are_those_of_zstandard(spark, fitted, make_docs):
    rows, _, model = fitted
    texts = [None, "", "x", "é" * BLOCK, "long words " * 100_000, *[t for _, t, _ in rows[:20]]]
    dictionaries = [zstandard.ZstdCompressionDict(d) for d in (model.good, model.bad)]
    found = model.score(make_docs(texts)).collect()
    assert len(found) == len(texts)
    column = {r.doc_id: r.s for r in make_docs(texts).select("doc_id", model.column("text").alias("s")).collect()}
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        sizes = []
        for d in dictionaries:
            compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(compressor.compress(data[n : n + BLOCK])) for n in range(0, len(data), BLOCK)))
        x = (sizes[1] - sizes[0]) / max(len(data), 1)
        score = 1 / (1 + np.exp(-(model.slope * x + model.bias)))
        assert (r.n_bytes, r.good_bytes, r.bad_bytes) == (len(data), *sizes)
        assert abs(r.score - score) < 1e-12 and r.predicted == (score >= GOOD) and column[r.doc_id] == r.score


def test_odd_tables(spark, make_docs, fitted):
    _, _, model = fitted
    rows = model.score(make_docs([(None, "a"), (1, None), (1, None), (2, "")])).collect()
    assert sorted(((r.doc_id, r.n_bytes) for r in rows), key=repr) == sorted([(None, 1), (1, 0), (1, 0), (2, 0)], key=repr)
    assert model.score(make_docs([])).count() == 0
    docs = make_docs(["good text"] * 5 + ["BAD"])
    for labels in ([], [(0, 1), (1, 1)], [(0, 1), (0, 0)], [(9, 1), (8, 0)], [(None, 1), (0, None)], [(0, 1), (5, 0)]):
        with Scratch(spark) as scratch:
            found = fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), scratch)
        assert isinstance(found, QualityModel) and all(0 <= r.score <= 1 for r in found.score(docs).collect())


def test_copies_and_long_texts_do_not_fill_a_dictionary(spark):
    rows = corpus(300, 6) + [(1000 + n, "copy of one text " * 30, 1) for n in range(500)] + [(2000, "very long one " * 50_000, 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    with Scratch(spark) as scratch:
        model = fit_quality(docs, labels, scratch)
    found = {r.doc_id: r.predicted for r in model.score(docs).collect()}
    assert np.mean([found[i] == q for i, _, q in rows[:300]]) >= 0.95


def test_small_samples_are_their_own_dictionary():
    assert make_dictionary([b"ab", b"cd"]) == b"abcd" and make_dictionary([]) == b""
