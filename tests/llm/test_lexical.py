"""Ranked search against plain sums over all documents."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedwell.llm import lexical
from feedwell.llm.lexical import search, terms_of
from feedwell.llm.shared import Scratch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=20):
    """(item row, rank, doc_id, score) by scoring every document."""
    counted = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    df = Counter(t for _, c in counted for t in c)
    n_docs, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    found = []
    for row, (item, text) in enumerate(items):
        scored = []
        for i, c in counted:
            score = 0
            for t in TERM.findall((text or "").translate(FOLD)):
                if c[t]:
                    m = 75 + 25 * sum(c.values()) * n_docs // length
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score:
                scored.append((-score, i is None, i or 0, i))
        found += [(item, n, i, -s) for n, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def found(spark, docs, items, **how):
    with Scratch(spark) as scratch:
        queries = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x"))
        rows = search(docs, queries, scratch, **how)
        assert rows.columns == ["item_id", "rank", "doc_id", "score"]
        return sorted(map(tuple, rows.collect()), key=repr)


def corpus(size, seed, words=200):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" if n % 3 else f"é{n}Ü" for n in range(words)]
    weights = [1 / (n + 1) for n in range(words)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 3, 10, 40])))) for i in range(size)]


def test_terms():
    assert terms_of("Ab-c ÉÜ_9\tİK Z\x7f.z") == [t.encode() for t in TERM.findall("Ab-c ÉÜ_9\tİK Z\x7f.z".translate(FOLD))]
    assert terms_of(None) == terms_of("") == terms_of(" .,\n") == []


@pytest.mark.parametrize("k, rows, postings, step, chars", [
    (20, 16_384, 2_000_000, 32, 10**6), (3, 50, 10**6, 1, 10**6), (5, 10**6, 300, 2, 40), (1, 7, 10**6, 4, 1)])
def test_equals_plain_sums(spark, make_docs, monkeypatch, k, rows, postings, step, chars):
    """Small blocks and steps, several passes, and every row a task of many."""
    monkeypatch.setattr(lexical, "BLOCK_ROWS", rows)
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(lexical, "STEP", step)
    docs = corpus(600, k)
    items = [(i, t) for i, (_, t) in enumerate(corpus(25, 99))] + [(100, "w1 w1 W1 w150 nothing"), (101, "absent"), (102, None)]
    assert found(spark, make_docs(docs), items, k=k, query_chars=chars) == plain(docs, items, k)


def test_odd_rows_and_ties(spark, make_docs):
    same = [(i, "tie of terms") for i in range(60, 0, -1)]
    docs = [*same, (7, "tie of terms"), (None, "tie of terms"), (None, None), (-5, ""), (200, "Tie " * 50_000), (201, "!!")]
    items = [(1, "tie terms tie"), (1, "of"), (2, ""), (None, "TIE"), (3, None)]
    assert found(spark, make_docs(docs), items) == plain(docs, items)
    assert found(spark, make_docs([]), items) == [] and found(spark, make_docs(docs), []) == []
    assert found(spark, make_docs([(1, None), (2, "")]), items) == []


def test_reading_stops_before_the_end(monkeypatch):
    """Lists that agree on their top are not read to the end."""
    import numpy as np

    size, scored = 5_000, []
    n, doc = np.full(size, 100), np.repeat(np.arange(size), 2)
    tf = np.repeat(np.where(np.arange(size) < 30, 40, 1), 2)
    lists = lexical._Lists(n, doc, np.tile([0, 1], size), tf, lexical.Corpus(size * 3, size * 100, np.array([size, size])))
    direct = lexical._Lists._direct
    monkeypatch.setattr(lexical._Lists, "_direct", lambda self, docs, terms: scored.append(len(docs)) or direct(self, docs, terms))
    docs, scores = lists.best(np.array([0, 1]), np.array([1, 2]), 20)
    assert set(range(20)) <= set(docs.tolist()) and sum(scored) < 200
