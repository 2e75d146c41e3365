"""Toxicity: held-out accuracy, located sentences, gradient, odd rows."""

import math
import random
import re

import numpy as np
import pytest

from feedwell.llm import toxicity
from feedwell.llm.shared import Scratch
from feedwell.llm.toxicity import ToxicityModel, _fit, fit_toxicity

INSULTS = ["grumbleface", "dolt", "knave"]


def corpus(n=600, seed=0):
    """Every fifth document has insults in one or two of its sentences; in another language they vary in their ends."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("aeioumnrst", k=rng.randint(2, 7))) for _ in range(400)]
    texts, labels = [], []
    for k in range(n):
        sentences = [[rng.choice(words) for _ in range(rng.randint(4, 12))] for _ in range(rng.randint(1, 40))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 2)):
                insult = rng.choice(INSULTS) if k % 2 else "zorkel" + rng.choice(words)
                own = rng.choice(sentences)
                own[rng.randrange(len(own))] = insult
        texts.append(" ".join(" ".join(s).capitalize() + "." for s in sentences))
        labels.append(int(toxic))
    return texts, labels


@pytest.fixture(scope="module")
def fitted(spark, make_docs):
    texts, labels = corpus()
    docs = make_docs(texts)
    known = spark.createDataFrame([(n, y, "x") for n, y in enumerate(labels) if n % 3], "doc_id long, toxic int, text string")
    with Scratch(spark) as scratch:
        return docs, texts, labels, fit_toxicity(docs, known, scratch)


def test_documents_that_were_not_learnt_from(fitted):
    docs, _, labels, model = fitted
    rows = {r.doc_id: r for r in model.score(docs).collect()}
    held = [n for n in range(len(labels)) if n % 3 == 0]
    assert len(rows) == len(labels) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    assert sum(rows[n].predicted != labels[n] for n in held) <= 0.03 * len(held)
    as_column = {r.doc_id: r.s for r in docs.select("doc_id", model.column("text").alias("s")).collect()}
    assert as_column == {n: pytest.approx(r.score) for n, r in rows.items()}


def test_offending_sentences_are_located(fitted):
    docs, texts, labels, model = fitted
    right = total = 0
    for r in model.score(docs).collect():
        if not r.predicted:
            assert r.sentences == []
        elif labels[r.doc_id]:
            total += 1
            found = [texts[r.doc_id][s.start : s.stop].lower() for s in r.sentences]
            right += any(i in f for f in found for i in [*INSULTS, "zorkel"])
    assert right >= 0.95 * total


def test_odd_rows(fitted, make_docs):
    rows = [(1, None), (2, ""), (3, "..."), (None, "you dolt"), (4, "You dolt! " * 20000), (5, "dolt"), (5, "dolt"), (6, "fine " * 50000)]
    found = sorted(((r.doc_id, round(r.score, 9)) for r in fitted[3].score(make_docs(rows)).collect()), key=repr)
    assert len(found) == len(rows)
    scores = dict(found)
    assert scores[1] == scores[2] < 0.5 and scores[4] > 0.99 and found.count((5, scores[5])) == 2
    assert fitted[3].score(make_docs([])).count() == 0


def test_without_labels_nothing_is_toxic(spark, make_docs):
    docs = make_docs(["a", "b"])
    for rows in ([], [(0, 1)], [(0, None), (1, 0)], [(None, 1), (1, 0)], [(7, 1), (8, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        with Scratch(spark) as scratch:
            model = fit_toxicity(docs, labels, scratch)
        assert [r.predicted for r in model.score(docs).collect()] == [0, 0]


def test_noisy_or():
    model = ToxicityModel({"bad$": 3.0, "good$": -2.0}, -1.0)
    scorer = toxicity._Scorer(model.weights, model.bias)
    p = lambda x: 1 / (1 + np.exp(-x))
    expected = 1 - (1 - p(2.0)) * (1 - p(-1.0)) * (1 - p(-3.0))
    assert scorer.many(["A bad one. Plain! good"])[0] == pytest.approx(expected)


def test_fit_lowers_the_loss():
    """The gradient is right: the fit separates bags that one feature decides."""
    class Bag:
        def __init__(self, toxic, plain, pairs):
            self.toxic, self.plain, self.found = toxic, plain, np.array(pairs, "<i4").reshape(-1, 2).tobytes()

    bags = [Bag(1, 5, [(0, 0), (1, 1)]) for _ in range(50)] + [Bag(0, 5, [(0, 1), (1, 1)]) for _ in range(150)]
    weights, bias = _fit(bags, 2, 0.25)
    assert weights[0] + bias > 1 and weights[1] + bias < -3 and bias < -3


def plain_score(text, model):
    """Noisy-or over sentences, word by word."""
    harmless, now = 1.0, model.bias
    for part in re.findall(r"[^\W\d_]+|[.!?…。\n]+|[ ]", (text or "").casefold()):
        if part[0].isalpha():
            now += model.weights.get(part + "$", 0.0) + sum(model.weights.get(part[:n], 0.0) for n in range(4, 8) if n <= len(part))
        elif part != " ":
            harmless *= 1 - 1 / (1 + math.exp(-now))
            now = model.bias
    return 1 - harmless * (1 - 1 / (1 + math.exp(-now)))


def test_scores_equal_a_plain_noisy_or(fitted, make_docs):
    _, texts, _, model = fitted
    odd = [None, "", "...", "zorkel!!! Dolt?\n\nknave", "GRUMBLEFACE…dolt", "dolt. " * 3000, "no end of dolt", "dolt_knave9grumbleface", " . . zorkelish ."]
    rows = [*odd, *texts[:80]]
    found = {r.doc_id: r.score for r in model.score(make_docs(rows)).collect()}
    assert found == {n: pytest.approx(plain_score(t, model), abs=1e-9) for n, t in enumerate(rows)}
