"""Repair of conversations against a plain search over whole audits, and damage against its definition."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from feedwell.llm import conversations as c
from feedwell.llm.conversations import Audits, cheapest, damage, join_segments, repair, segment_paths
from feedwell.llm.shared import Scratch

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    found = []
    for conv, turn, role, text in rows:
        key = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(key, text)
        found += [(conv, turn, "user" if key == 4 else role, text)] * {0: 0, 3: 2}.get(key, 1)
    return found


def plain_repair(rows):
    """Per conversation what the contract names, by keeping for each state the least (cost, audit, text)."""
    result = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        own = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [r[1] for r in own if r[1] is not None]
        counts, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}, set(), []
        for _, _, role, text in own:
            text_end = text.rstrip(c.SPACE)
            fault = "blank" if not text_end else "duplicate" if (role, text) in seen else "" if text_end[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        # States are the text of initials reduced to its last; every option is kept by cost and audit alone.
        best = {"": (0, "", [])}

        def legal(last, initial, best=best):
            return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[last]

        def insertions(options):
            for _ in range(3):
                for last, (cost, audit, lines) in list(options.items()):
                    for role in ("user", "assistant"):
                        if legal(last, role[0]):
                            new = (cost + 2, audit + "I", [*lines, f"{role}:"])
                            if role[0] not in options or new < options[role[0]]:
                                options[role[0]] = new
            return options

        for role, text, fault in marked:
            after = {}
            for last, (cost, audit, lines) in insertions(dict(best)).items():
                options = [(last, (cost + 3, audit + "D", lines))]
                if fault not in ("blank", "duplicate"):
                    extra = fault == "truncated"
                    if role[:1] and legal(last, role[0]):
                        options.append((role[0], (cost + extra, audit + "K", [*lines, f"{role}:{text}"])))
                    for new in ("user", "assistant"):
                        if legal(last, new[0]):
                            options.append((new[0], (cost + 2 + extra, audit + "R", [*lines, f"{new}:{text}"])))
                for state, option in options:
                    if state not in after or option < after[state]:
                        after[state] = option
            best = after
        cost, audit, lines = min(v for k, v in insertions(dict(best)).items() if k in ("", "a"))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        result[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({x: F.lit("x") for x in ("pos", "audit", "key", "head", "edit", "of")})
    with Scratch(spark) as scratch:
        repairs = repair(df, scratch, **how)
        digests = {r.conv_id: r.repaired_sha256 for r in repairs.digests().collect()}
        empty = hashlib.sha256(b"").hexdigest()
        return {r.conv_id: (*r[1:], digests.get(r.conv_id, empty)) for r in repairs.audits.collect()}


def scan(symbols, size):
    """The audit of one conversation through segments of a size."""
    parts = [symbols[n : n + size] for n in range(0, len(symbols), size)]
    paths = [segment_paths(p, n > 0) for n, p in enumerate(parts)]
    packed = [[(p.enter, p.leave, p.cost, p.rank, c.rolling(p.audit), pow(c.BASE, len(p.audit), c.PRIME)) for p in s] for s in paths]
    cost, closing, states = join_segments(packed)
    audit = "".join(next(p.audit for p in s if (p.enter, p.leave) == e) for s, e in zip(paths, states))
    return cost, audit + "I" * closing


def rows_of_symbols(symbols):
    role = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    return [(1, n, role.get(x.lower(), "user"), "" if x == "-" else f"t{n}" + ("" if x.isupper() else ".")) for n, x in enumerate(symbols)]


def test_all_short_conversations_equal_a_plain_search():
    for length in range(1, 5):
        for symbols in map("".join, product("suaxUA-", repeat=length)):
            cost, audit = plain_repair(rows_of_symbols(symbols))[1][5:7]
            assert scan(symbols, 64) == scan(symbols, 2) == (cost, audit), symbols


def test_long_conversations_and_ties_in_segments():
    rng = random.Random(5)
    for length in (17, 60, 150):
        for letters in ("ua", "suax", "-U", "suaxSUAX-", "x", "aaU"):
            symbols = "".join(rng.choices(letters, k=length))
            expected = plain_repair(rows_of_symbols(symbols))[1][5:7]
            assert scan(symbols, 1) == scan(symbols, 8) == scan(symbols, 4096) == expected


def test_audits_compare_as_texts_even_when_hashes_collide():
    rng = random.Random(1)
    for colliding in (False, True):
        tree, texts = Audits(), {0: ""}
        layer = [0]
        for _ in range(40):
            grown = []
            for node in layer:
                for label in rng.sample("DIKR", 2):
                    hashed = 0 if colliding else c.rolling(label)
                    new = tree.add(node, label, hashed, 0 if colliding else c.BASE)
                    texts[new] = texts[node] + label
                    grown.append(new)
            layer = rng.sample(grown, min(len(grown), 6))
            for a, b in product(layer, repeat=2):
                assert "".join(tree.labels(a)) == texts[a]
                assert tree.less(a, "K", b, "R") == (texts[a] + "K" < texts[b] + "R")


def test_cheapest_shares_prefixes():
    audits, best = cheapest((c._EDGES[s] for s in "ua" * 500), c.START)
    assert best[c.ASSISTANT][0] == 0 and set(audits.labels(best[c.ASSISTANT][1])) == {"K"}
    assert len(audits.up) <= 4 * 1000 + 1 and max(map(len, audits.up)) <= 11


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    texts = ["Fine.", "Cut", "", " \t\n", "Well!", "So? ", "no end,\x0b", "Ünï.", " ", "x" * 70 + ".", "x" * 70 + "!"]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, most)):
            if rng.random() < 0.9:
                rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), rng.choice(texts) + rng.choice(["", str(turn) + "."])))
    return rows


@pytest.mark.parametrize("segment", [1, 4, 4096])
def test_repair_equals_the_plain_one(spark, segment):
    rows = random_rows(3, 60, 9) + [(1000, t, "user" if t % 3 else "assistant", f"Row {t % 50}.") for t in range(300)]
    assert found(spark, rows, segment=segment) == plain_repair(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (5, None, "user", "A."), (5, None, "assistant", "B."), (5, 2, "assistant", "C."),
            (6, 1, "user", "Long. " * 100_000), (6, 9, "assistant", "Same."), (6, 9, "assistant", "Same."), (7, 1, "", "x."), (8, -4, "system", "S.")]
    # Rows of one turn go by role.
    expected = plain_repair([(k, t, " " if r is None else r, " " if x is None else x) for k, t, r, x in sorted(rows, key=lambda r: (r[2] or "", r[3] or ""))])
    assert found(spark, rows) == expected
    assert found(spark, []) == {}
    with pytest.raises(ValueError, match="power of two"):
        found(spark, rows, segment=3)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "First."), (1, 1, "user", "Cut"), (1, 2, "user", "Next?"), (1, 3, "user", "Next?")]
    with Scratch(spark) as scratch:
        repairs = repair(spark.createDataFrame(rows, SCHEMA), scratch)
        assert [r.audit for r in repairs.audits.collect()] == [plain_repair(rows)[1][6]]
        lines = [f"{r.role}:{r.text}" for r in repairs.rows.orderBy("conv_id", "pos", "sub").collect()]
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == plain_repair(rows)[1][7]


def test_damage(spark):
    rows = random_rows(8, 40, 8) + [(None, 1, "user", None), (3, None, None, "a.b?c!"), (4, None, "system", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, damage(df).collect()), key=repr) == sorted(plain_damage(rows), key=repr)


def test_one_conversation_is_spread_over_tasks(spark):
    rows = spark.range(20_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    with Scratch(spark) as scratch:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        placed = c._ordered(rows, scratch)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        sizes = [r["count"] for r in placed.groupBy(F.shiftright("pos", 33)).count().collect()]
        assert len(sizes) > 4 and max(sizes) < 5_000
        repairs = repair(rows, scratch, segment=256)
        assert [tuple(r)[1:7] for r in repairs.audits.collect()] == [(0, 0, 0, 0, 0, 0)]
        assert repairs.audits.first().audit == "K" * 20_000
