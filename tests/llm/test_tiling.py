"""Benchmark passages in documents: tiles against a plain greedy search, both ways of joining."""

import random

import numpy as np
import pytest

from feedwell.llm import tiling
from feedwell.llm.tiling import contaminated, tile

RNG = random.Random(2)
WORDS = ["".join(RNG.choices("abcdefgh", k=4)) for _ in range(300)]
PASSAGES = [" ".join(RNG.choices(WORDS, k=n)) for n in (30, 12, 5, 60)]


def greedy(text, item, least):
    """Longest common unmarked run, first in the item, then in the text, again and again."""
    free_text, free_item, covered = [True] * len(text), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n] and free_item[i + n] and free_text[t + n]):
                    n += 1
                if n > best[0]:
                    best = (n, i, t)
        n, i, t = best
        if n < least:
            return covered
        free_item[i : i + n] = [False] * n
        free_text[t : t + n] = [False] * n
        covered += n


def test_tiles_cover_what_a_plain_search_covers():
    rng = np.random.default_rng(0)
    for _ in range(150):
        item = rng.integers(0, 6, rng.integers(1, 30)).astype(np.uint64)
        text = rng.integers(0, 6, rng.integers(0, 60)).astype(np.uint64)
        found = tile(text, item, 3)
        marked_item, marked_text = set(), set()
        for t, i, n in found:
            assert n >= 3 and (text[t : t + n] == item[i : i + n]).all()
            assert not marked_item & set(range(i, i + n)) and not marked_text & set(range(t, t + n))
            marked_item |= set(range(i, i + n))
            marked_text |= set(range(t, t + n))
        assert len(marked_item) == greedy(text.tolist(), item.tolist(), 3)


def noise(n):
    return " ".join(RNG.choices(WORDS, k=n))


def documents():
    a, b, c, d = PASSAGES
    w = a.split()
    half = a.split()[:20]
    return [
        (1, f"{noise(50)} {a} {noise(40)}"), (2, f"{noise(9)} {' '.join(w[15:])} {noise(30)} {' '.join(w[:15])}"),  # reordered
        (3, a.upper().replace(" ", ", ")), (4, " ".join(half)), (5, noise(400)), (6, None), (7, ""), (8, f"{b} {noise(5)} {d}"),
        (9, c), (10, f"{noise(9000)} {a} {noise(9000)}"), (None, b), (8, f"{b} {noise(5)} {d}"), (11, " ".join(x + " " + noise(1) for x in w)),
        (12, " ".join(w[:9] + ["changed"] + w[10:20] + ["again"] + w[21:])),
    ]


EXPECTED = {(1, 0), (2, 0), (3, 0), (8, 1), (8, 3), (9, 2), (10, 0), (None, 1), (12, 0)}


@pytest.mark.parametrize("joined", [False, True])
def test_documents_with_passages(spark, make_docs, monkeypatch, joined):
    if joined:
        monkeypatch.setattr(tiling, "MOST_ITEMS", 0)
    items = [(n, p, "x") for n, p in enumerate(PASSAGES)] + [(90, None, "x"), (91, "", "x"), (92, "two words", "x"), (93, "!!!", "x")]
    df = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    rows = contaminated(make_docs(documents()), df).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == EXPECTED
    assert len(rows) == len(EXPECTED) + 2  # the repeated document
    for r in rows:
        assert r.coverage == r.covered / r.n_words >= 0.8 and r.covered == sum(t.words for t in r.tiles)
    none = df.limit(0)
    assert contaminated(make_docs(documents()), none).count() == 0 and contaminated(make_docs([]), df).count() == 0


def test_share_and_length_are_parameters(spark, make_docs):
    df = spark.createDataFrame([(0, PASSAGES[0])], "item_id long, text string")
    found = {r.doc_id for r in contaminated(make_docs(documents()), df, share=0.6).collect()}
    assert 4 in found and 5 not in found


@pytest.mark.parametrize("joined", [False, True])
def test_repetitive_and_short_passages(spark, make_docs, monkeypatch, joined):
    if joined:
        monkeypatch.setattr(tiling, "MOST_ITEMS", 0)
    rest = " ".join(f"w{n}" for n in range(20))
    items = [(0, "la " * 80 + rest), (1, "tick tock " * 40 + rest), (2, "Forty two"), (3, "yes"), (4, "one two three four"), (5, "a b c " * 30), (6, "a b c " * 30)]
    df = spark.createDataFrame(items, "item_id long, text string")
    docs = [(0, "x " + "la " * 80), (1, "tick tock " * 40 + "x"), (2, "it is forty, two!"), (3, "forty and two"), (4, "No. Yes."), (5, "one two three"),
            (6, "zero one two three four five"), (7, "la " * 60), (8, "c " + "a b c " * 30), (9, None), (2, "it is forty, two!")]
    found = sorted((r.doc_id, r.item_id, r.covered) for r in contaminated(make_docs(docs), df).collect())
    assert found == [(0, 0, 80), (1, 1, 80), (2, 2, 2), (2, 2, 2), (4, 3, 1), (6, 4, 4), (8, 5, 90), (8, 6, 90)]
