"""Spans of secrets against Python's patterns, strings that look random, redaction."""

import math
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedwell.llm.secret_scan import BASE, BIN, BINS, ENCODINGS, find_secrets, listed, redact, scan, spans, threshold
from feedwell.llm.shared import Scratch

PATTERNS = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 16), (re.compile(r"[0-9a-f]+"), 0, 32),
]


def base(text):
    found = [(m.start(), n, m.end()) for n, (p, g, least) in enumerate(PATTERNS) for m in p.finditer(text or "") if len(m[g]) >= least]
    return sorted(found)


def texts():
    rng = random.Random(7)
    hexed = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    out = [
        None, "", "no secrets", f"password={hexed(18)}", f"é漢🙂 TOKEN = \"{hexed(40)}\" and AKIA{'A1B2' * 5}", "secret=token : abcdefgh12",
        "token=ab token: cd", "password=secret=abcdefghij", f"{hexed(64)}{hexed(3)}", "a" * 31 + " " + "a" * 32, "AKIAAKIA" + "A" * 11,
        "api_key:'abcdefgh' apikey=\"zzzzzzzz\" Api_Key  abcdefgh", f"passwd='{hexed(8)}'" * 300, "x" * 100000 + f" token={hexed(9)}",
        "\n".join(f"line {n} secret: {hexed(n)}" for n in range(40)), "ſecret=abcdefghi", "toKen=abcdefgh.ijk",
    ]
    alphabet = ["password", "token", "=", ":", " ", '"', "'", "AKIA", "B7", "deadbeef", "é", "\n", "secret", "abcdefgh", "-", "."]
    return out + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(200)]


def test_base_spans_equal_python(make_docs):
    rows = list(enumerate(texts()))
    docs = make_docs(rows)
    found = {r.doc_id: r for r in find_secrets(docs).select("doc_id", "_base", listed("_base").alias("l"), listed("_secrets").alias("s")).collect()}
    kinds = list(BASE)
    for i, text in rows:
        expected = base(text)
        assert [tuple(s) for s in found[i]["_base"]] == expected, repr(text)
        assert found[i].l == ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in expected)
        assert set(found[i].l.split(",")) <= set(found[i].s.split(",")) or not expected


def test_spans_of_any_pattern(make_docs):
    rows = make_docs(["", "aXbX", "XX", "éX漢X", "no"], clash=False).select("doc_id", spans("text", "X").alias("s"))
    found = {r.doc_id: [(s.start, s.stop) for s in r.s] for r in rows.collect()}
    assert found == {0: [], 1: [(1, 2), (3, 4)], 2: [(0, 1), (1, 2)], 3: [(1, 2), (3, 4)], 4: []}


def test_random_strings_are_added_and_ordinary_ones_are_not(make_docs):
    rng = random.Random(11)
    letters = string.ascii_letters + string.digits
    random_ones = ["".join(rng.choices(letters, k=rng.randint(32, 60))) for _ in range(40)]
    ordinary = ["internationalization_of_the_process", "abcdefghijklmnopqrstuvwxyz", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz", "12345678901234567890123456",
                "ThisIsAVeryLongCamelCaseIdentifierName", "com/example/project/module/submodule/File", "thndhendatatreoningthathewhan", "=" * 60,
                "2024-01-31-12-30-59-000-000-000", "ABABABABABABABABABABABABABABABAB1"]
    rows = [f"see {s} here" for s in random_ones + ordinary * 4]
    found = {r.doc_id: r.s for r in find_secrets(make_docs(rows)).select("doc_id", listed("_secrets").alias("s")).collect()}
    hits = [n for n in range(40) if found[n] == f"random:4:{4 + len(random_ones[n])}"]
    assert len(hits) >= 36
    assert {rows[n]: found[n] for n in range(40, len(rows)) if found[n]} == {}


def above(z):
    t = 1.5976 * z + 0.070565992 * z**3
    return max(0.0, t) + math.log1p(math.exp(-abs(t)))


def fisher(parts):
    total = sum(parts)
    return total - math.log(sum(total**k / math.factorial(k) for k in range(len(parts))))


def runs_of(s):
    return sum(1 for k, c in enumerate(s) if not k or s[k - 1] != c)


def battery(value):
    """Evidence against "ordinary", and whether the value fits uniform symbols, symbol by symbol."""
    body = value.rstrip("=")
    alphabet, (two, three) = next((al, eq) for p, al, eq in ENCODINGS.values() if re.search(p, value))
    a, n, counts = len(alphabet), len(body), Counter(body)
    if n < 3 or n * math.log2(a) < 100:
        return 0.0, False
    kinds = [string.ascii_lowercase, string.ascii_uppercase, string.digits, "+/_=-"]
    squares = sum(k * k for k in counts.values())
    chi = (squares * a / n - n - (a - 1)) / math.sqrt(2 * (a - 1) * (1 - 1 / n))
    shares = [(k, sum(x in k for x in alphabet) / a) for k in kinds]
    shares = [(k, p) for k, p in shares if p]
    ranks = [alphabet.find(c) - (a - 1) / 2 for c in body]
    half = (runs_of([alphabet.find(c) < a // 2 for c in body]) - (n + 1) / 2) / math.sqrt((n - 1) / 4)
    serial = sum(x * y for x, y in zip(ranks, ranks[1:])) / ((a * a - 1) / 12) / math.sqrt(n - 1)
    both = lambda z: max(above(abs(z)) - math.log(2), 0.0)
    tests = [above(chi), both(half), both(serial)]
    if len(shares) > 1:
        by_kind = sum((sum(counts[c] for c in k) - n * p) ** 2 / (n * p) for k, p in shares)
        tests.append(above((by_kind - len(shares) + 1) / math.sqrt(2 * (len(shares) - 1))))
    if fisher(tests) >= -math.log(1e-5):
        return 0.0, False
    pairs = n * (n - 1) / 2
    spread = math.sqrt(pairs * two * (1 - two) + n * (n - 1) * (n - 2) * max(three - two * two, 0.0))
    alike = (pairs * two - sum(k * (k - 1) / 2 for k in counts.values()) - 0.5) / spread
    kind_of = [next(i for i, k in enumerate(kinds) if c in k) for c in body]
    changes = (runs_of(kind_of) - 1.5 - 0.1 * (n - 1)) / math.sqrt(0.09 * (n - 1))
    letters = [(x.lower() in "aeiou") != (y.lower() in "aeiou") for x, y in zip(body, body[1:]) if x.isalpha() and y.isalpha()]
    m, heard = len(letters), 0.0
    if m:
        heard = above((0.62 * m - sum(letters) - 0.5) / math.sqrt(m * 0.62 * 0.38))
    return fisher([above(alike), above(changes), heard]), True


def strings():
    rng = random.Random(5)
    alphabets = [string.ascii_lowercase, string.ascii_uppercase, string.digits + "ABCDEF", string.ascii_letters + string.digits + "+/",
                 string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits, string.ascii_letters + "-_",
                 string.ascii_uppercase + string.digits]
    drawn = ["".join(rng.choices(al, k=rng.randint(20, 90))) for al in alphabets for _ in range(12)]
    plain = ["internationalization", "counterrevolutionaries", "thndhendatatreoningthathewhan", "abcdefghijklmnopqrstuvwxyz", "b" * 40,
             "com/example/project/module/File", "1234567890" * 4, "=" * 30, "-" * 25 + "=", "AbCd" * 9, "THEQUICKBROWNFOXJUMPSOVERTHELAZYDOG"]
    return [s for s in drawn + plain if not re.search(r"[0-9a-f]{32,}|AKIA[A-Z0-9]{12}", s)]


def test_battery_and_threshold_equal_plain_python(make_docs):
    values = strings()
    docs = make_docs([f"see {v} here" for v in values])
    scanned = scan(docs).select(F.col("_row.doc_id").alias("doc_id"), "_random", "_tried")
    found = {r.doc_id: r for r in scanned.collect()}
    plain = [battery(v) for v in values]
    assert len({fits for _, fits in plain}) == 2
    for n, (evidence, fits) in enumerate(plain):
        assert found[n]["_tried"] == 1 and len(found[n]["_random"]) == fits, values[n]
        if fits:
            assert found[n]["_random"][0].test.evidence == pytest.approx(evidence, rel=1e-9, abs=1e-9), values[n]
    levels = sorted((min(math.floor(e / BIN), BINS) for e, fits in plain if fits), reverse=True)
    least = min((k * BIN for n, k in enumerate(levels) if math.exp(-k * BIN) <= 0.01 * sum(x >= k for x in levels) / len(values)), default=math.inf)
    assert threshold(scanned, 0.01) == pytest.approx(least)
    out = {r.doc_id: r.s for r in find_secrets(docs).select("doc_id", listed("_secrets").alias("s")).collect()}
    expected = {n: f"random:4:{4 + len(v)}" if fits and math.floor(e / BIN) * BIN >= least - 1e-9 else "" for n, (v, (e, fits)) in enumerate(zip(values, plain))}
    assert out == expected


def test_strings_of_one_kind_are_found(make_docs):
    rng = random.Random(3)
    drawn = ["".join(rng.choices(al, k=64)) for al in (string.ascii_lowercase, string.ascii_uppercase) for _ in range(20)]
    words = ["pseudohypoparathyroidisms", "electroencephalographically", "thequickbrownfoxjumpsoverthelazydog", "HYPERCHOLESTEROLEMIAPATIENTS"]
    rows = [f"see {v} here" for v in drawn + words * 5]
    found = [r.s for r in find_secrets(make_docs(rows)).select("doc_id", listed("_secrets").alias("s")).orderBy("doc_id").collect()]
    assert sum(s == "random:4:68" for s in found[:40]) >= 36 and set(found[40:]) == {""}


def test_what_lies_beside_a_base_span_is_judged(make_docs):
    rng = random.Random(13)
    drawn = ["".join(rng.choices("GHJKMNPQRSTVWXYZghjkmnpqrstvwxyz23456789", k=48)) for _ in range(30)]
    hexed = "".join(rng.choices("0123456789abcdef", k=40))
    # On both sides of a hexadecimal string, without a space.
    rows = [f"é G{d}Z{hexed}Z{d}G." for d in drawn] + [f"G{'x' * 10}Z{hexed}Z"]
    found = {r.doc_id: r for r in find_secrets(make_docs(rows)).select("doc_id", "_base", listed("_secrets").alias("s")).collect()}
    assert all([tuple(b) for b in r["_base"]] == base(rows[n]) for n, r in found.items())
    both = [n for n in range(30) if found[n].s == "random:2:52,hex:52:92,random:92:142"]
    assert len(both) >= 27 and found[30].s == "hex:12:52"
    assert [redact(make_docs(rows)).filter(F.col("doc_id") == n).first().text for n in both[:1]] == ["é [SECRET]."]


def test_many_spans_in_one_text(spark, make_docs):
    rng = random.Random(17)
    hexed = ["".join(rng.choices("0123456789abcdef", k=33)) for _ in range(5000)]
    text = "é " + " ".join(f"{h} token={h[:9]}" for h in hexed)
    with Scratch(spark) as scratch:
        found = find_secrets(make_docs([text, None], clash=False), scratch=scratch).orderBy("doc_id").collect()
        assert [tuple(s) for s in found[0]["_base"]] == base(text) and found[0].text == text and found[1]["_base"] == []
    with Scratch(spark) as scratch:
        clean = redact(make_docs([text]), scratch=scratch).first().text
    assert clean == "é " + " ".join(["[SECRET]"] * 10000)
    with Scratch(spark) as scratch:
        assert "text" not in find_secrets(make_docs([text]), scratch=scratch, texts=False).columns


def test_redaction(make_docs):
    hexed = "0123456789abcdef" * 3
    rows = [f"a password={hexed} b", hexed, f"{hexed}", None, "", "clean", f"é token: {'q' * 9}; secret={'z' * 8}", f"token={hexed}"]
    docs = make_docs(rows)
    out = {r.doc_id: r.text for r in redact(docs).collect()}
    assert out == {0: "a [SECRET] b", 1: "[SECRET]", 2: "[SECRET]", 3: None, 4: "", 5: "clean", 6: "é [SECRET]; [SECRET]", 7: "[SECRET]"}
    assert redact(docs).columns == docs.columns


def test_empty_table_and_clashing_names(make_docs):
    assert find_secrets(make_docs([])).count() == 0
    names = ["_base", "_secrets", "_row", "_whole", "_hex", "_random"]
    docs = make_docs(["a token=abcdefgh1"]).withColumns({n: F.lit("own") for n in names})
    clean = redact(docs).first()
    assert clean.text == "a [SECRET]" and all(clean[n] == "own" for n in names) and redact(docs).columns == docs.columns
    found = find_secrets(docs).first()
    assert [tuple(s) for s in found["_base"]] == [(2, 0, 17)] and found["_row"] == found["_hex"] == "own"


def test_no_python_in_the_plan(make_docs):
    plan = redact(make_docs(["x"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
