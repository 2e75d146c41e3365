"""The Jaccard join and connected components against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest

from feedwell.llm import jaccard
from feedwell.llm.components import components
from feedwell.llm.jaccard import link_documents, prefix_size, shared_least, spanning_links
from feedwell.llm.shared import Scratch


def sets_of(text, width):
    words = [bytes(w) for w in (text or "").encode().lower().split()]
    if not words:
        return set()
    return {tuple(words[n : n + width]) for n in range(len(words) - width + 1)} or {tuple(words)}


def expected(rows, width, percent):
    sets = [sets_of(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and rows[a][0] is not None and rows[b][0] is not None and 100 * both >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return sorted(((i, len(s), least[find(n)] if i is not None else None) for n, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def linked(spark, docs, width, percent):
    with Scratch(spark) as scratch:
        return sorted((tuple(r) for r in link_documents(docs, scratch, width, percent).collect()), key=repr)


def corpus(seed, n=120):
    """Copies, near copies with words replaced, a common line, short and empty texts."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcde", k=3)) for _ in range(60)]
    line = "this very common line stands in many of the texts here"
    texts, base = [], [rng.choice(words) for _ in range(120)]
    for k in range(n):
        kind = k % 6
        if kind < 3:
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(words) + str(rng.randrange(50))
        elif kind == 3:
            own = [rng.choice(words) for _ in range(rng.randint(0, 40))] + line.split()
        elif kind == 4:
            own = [rng.choice(words[:3]) for _ in range(rng.randint(0, 4))]
        else:
            own = line.split() * rng.randint(1, 3)
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("seed,width,percent", [(1, 3, 90), (2, 5, 80), (3, 1, 50)])
def test_components_are_exact(spark, make_docs, seed, width, percent):
    rows = [(n * 3, t) for n, t in enumerate(corpus(seed))]
    assert linked(spark, make_docs(rows), width, percent) == expected(rows, width, percent)


def test_components_are_exact_with_long_lists_and_small_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT", 3)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 900)
    monkeypatch.setattr(jaccard, "COUNTED", 500)
    rows = list(enumerate(corpus(5)))
    assert linked(spark, make_docs(rows), 3, 90) == expected(rows, 3, 90)


def test_odd_rows(spark, make_docs):
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "One"), (9, "oNE"), (10, "one two"), (11, "two one"), (None, "one two"),
        (12, "É a b"), (13, "é a b"), (14, "\xa0"), (3, "one two"), (3, "one two"), (3, "x y z"), (2, "X Y\x0bZ"), (20, "w " * 30000),
        (21, "w " * 29999),
    ]
    assert linked(spark, make_docs(rows), 3, 90) == expected(rows, 3, 90)


def test_empty_table(spark, make_docs):
    assert linked(spark, make_docs([]), 3, 90) == []


def test_prefixes_are_within_sets_and_long_enough():
    for n in range(1, 3000):
        for percent in (50, 80, 90, 100):
            size = prefix_size(n, percent)
            assert n - -(-percent * n // 100) + shared_least(n) == size <= max(n, 1) or n < 3


def test_spanning_links_join_all_that_is_similar():
    rng = np.random.default_rng(4)
    sets = [np.unique(np.concatenate([np.arange(60), rng.integers(60, 70, 6)])).astype(np.uint64) for _ in range(40)]
    links = list(spanning_links(list(range(40)), sets, 85))
    assert len(links) <= 39
    similar = [(a, b) for a, b in combinations(range(40), 2)
               if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]
    group = {n: n for n in range(40)}
    for a, b in links:
        assert (min(a, b), max(a, b)) in similar
        old, new = group[a], group[b]
        group = {k: new if v == old else v for k, v in group.items()}
    assert all(group[a] == group[b] for a, b in similar)


@pytest.mark.parametrize("links,groups", [
    ([], []), ([(1, 1)], []), ([(2, 1), (1, 2), (2, 3)], [{1, 2, 3}]), ([(n, n + 1) for n in range(100)], [set(range(101))]),
    ([(0, n) for n in range(1, 50)] + [(100, 101)], [set(range(50)), {100, 101}]),
])
def test_components(spark, links, groups):
    df = spark.createDataFrame(links, "a long, b long")
    with Scratch(spark) as scratch:
        found = {}
        for r in components(df, scratch).collect():
            found.setdefault(r.label, set()).add(r.node)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups))
    assert all(label in nodes for label, nodes in found.items())


def test_tasks_give_a_prefix_once(spark, make_docs):
    line = " ".join(f"w{n}" for n in range(40))
    rows = [(None, line), *((n, line) for n in range(6)), (6, "a b c d"), (7, ""), (8, f"{line} x")]
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    found = jaccard._profiles(make_docs(rows).coalesce(1), 3, 90, none).collect()
    groups = {r.a for r in found if r.n}
    given = [r for r in found if r.prefix is not None]
    assert len(groups) == 3 and sorted(r.a for r in given) == sorted(groups)
    assert all(r.doc_id is not None and len(r.prefix) == prefix_size(r.n, 90) for r in given)


def test_lists_hold_a_group_once(spark):
    short, long = [(7, 1, 50), (7, 2, 50)], [(9, n, 50) for n in range(2 * jaccard.SHORT)]
    postings = spark.createDataFrame((short + long) * 3, "token long, a long, na long")
    found = jaccard._listed(postings, 80).collect()
    assert [(r.a, r.b) for r in found if r.token is None] == [(1, 2)]
    assert sorted(r.a for r in found if r.token == 9) == [a for _, a, _ in long]
