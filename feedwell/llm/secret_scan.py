"""Secrets in texts: assignments, access keys and hexadecimal strings, and strings that look random.

Only DataFrame functions. Patterns give the base spans. Other long runs of letters, digits and
base64 symbols are candidates, also what is left of a run beside a base span: each is read in the
smallest encoding that holds its symbols, and a battery of tests looks at it twice.

* As uniform random symbols: chi-squared over the alphabet and over its kinds of symbols, runs above and
  below its middle, and serial correlation. Their p-values, combined by Fisher's method, must not refuse it.
* As an ordinary name, word or number: there symbols are less uniform (chi-squared, as pairs of equal
  symbols), runs of one kind of symbols (lower case, upper case, digits, others) are longer, and vowels and consonants
  alternate more (serial correlation of neighbours). Each test gives the chance that an ordinary string
  of this length looks so random; Fisher's method combines the three.

The combined chances of all candidates of the corpus go through Benjamini-Hochberg in narrow bins of their
logarithm, so that among the strings reported at most a share ``fdr`` is expected to be ordinary.
Strings of under 20 symbols or 100 bits are not judged, as no test could tell them apart.

Work grows with the length of a text and the number of its spans: arrays are read in blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwell.llm.shared import Scratch

#: The base kinds in order: pattern, group that must be long, its least length (fixed values).
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    # The same spans as runs of any length of which those under 32 are dropped.
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
#: Runs that the battery looks at, and the least information in bits that its tests can judge.
LEAST, LEAST_BITS = 20, 100
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST
#: Ordinary strings: chance that neighbours are of different kinds, and that of two neighbouring letters one is a vowel.
CHANGE, ALTERNATE = 0.1, 0.62
#: Ordinary strings: chance that two symbols, and that three, are equal; by letters, and by digits where these prevail.
LETTERS, NUMBERS = (0.0655, 0.0055), (0.1, 0.01)
#: -ln of the least combined p-value of uniform random symbols.
FIT = -math.log(1e-5)
#: Width and number of the bins of -ln(p).
BIN, BINS = 0.05, 1200
#: Elements of a block, as a power of two.
BLOCK_BITS = 8

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Kinds of symbols.
KINDS = (_LOWER, _LOWER.upper(), _DIGITS, "+/_=-")
#: Encodings from the smallest alphabet up: what all symbols must match, their order, ordinary equal symbols.
ENCODINGS = {
    "hex": ("^[0-9a-f]+$", _DIGITS + "abcdef", NUMBERS),
    "HEX": ("^[0-9A-F]+$", _DIGITS + "ABCDEF", NUMBERS),
    "lower": ("^[a-z]+$", _LOWER, LETTERS),
    "upper": ("^[A-Z]+$", _LOWER.upper(), LETTERS),
    "base32": ("^[A-Z2-7]+=*$", _LOWER.upper() + "234567", LETTERS),
    "base36": ("^[0-9a-z]+$", _DIGITS + _LOWER, LETTERS),
    "BASE36": ("^[0-9A-Z]+$", _DIGITS + _LOWER.upper(), LETTERS),
    "base64": ("^[A-Za-z0-9+/]+=*$", _LOWER.upper() + _LOWER + _DIGITS + "+/", LETTERS),
    "base64url": (".*", _LOWER.upper() + _LOWER + _DIGITS + "-_", LETTERS),
}
_PIECE = "struct<start:int,stop:int,value:string>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(items: Column) -> Column:
    """The array cut into arrays of a block each; one empty block for an empty array."""
    def cut(all_: Column) -> Column:
        last = F.greatest(F.shiftright(F.size(all_) - 1, BLOCK_BITS), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda n: F.slice(all_, F.shiftleft(n, BLOCK_BITS) + 1, 1 << BLOCK_BITS))

    return _let(items, cut)


def _running(items: Column, zero: Column, step, kind: str) -> Column:
    """What ``step(state, item)`` gives beside the next state, of every item in order.

    Results are appended to those of their block, blocks to one another: an append copies one of them.
    """
    def one(s: Column, item: Column) -> Column:
        state, out = step(s["state"], item)
        return F.struct(state.alias("state"), F.concat(s["out"], F.array(out)).alias("out"))

    def block(s: Column, own: Column) -> Column:
        none = F.expr(f"cast(array() as array<{kind}>)")
        inner = F.aggregate(own, F.struct(s["state"].alias("state"), none.alias("out")), one)
        return _let(inner, lambda i: F.struct(i["state"].alias("state"), F.concat(s["out"], F.array(i["out"])).alias("out")))

    none = F.expr(f"cast(array() as array<array<{kind}>>)")
    whole = F.aggregate(_blocks(items), F.struct(zero.alias("state"), none.alias("out")), block)
    return F.flatten(whole["out"])


def spans(text: str, pattern: str) -> Column:
    """Leftmost matches that do not overlap, as structs of start, stop (code points) and value.

    What lies between the matches gives their positions.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    # What follows the last match has none of its own.
    pieces = F.zip_with(found, between, lambda v, b: F.struct(F.length(b).alias("gap"), v.alias("value")))

    def place(at: Column, piece: Column) -> tuple[Column, Column]:
        start = at + piece["gap"]
        stop = start + F.length(piece["value"])
        return stop, F.struct(start.alias("start"), stop.alias("stop"), piece["value"].alias("value"))

    placed = F.filter(_running(pieces, F.lit(0), place, _PIECE), lambda s: s["value"].isNotNull())
    return F.when(F.col(text).rlike(pattern), placed).otherwise(F.expr(f"cast(array() as array<{_PIECE}>)"))


def _outside(runs: str, base: str) -> Column:
    """The parts of ``runs`` that no base span covers and that are long enough, in one pass over both in order."""
    end = F.lit(2**31 - 1)

    def event(start: Column, run: int, stop: Column, value: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(run).alias("run"), stop.alias("stop"), value.alias("value"))

    events = F.sort_array(F.concat(
        F.transform(base, lambda b: event(b["start"], 0, b["stop"], F.lit(""))),
        F.transform(runs, lambda r: event(r["start"], 1, r["stop"], r["value"])),
        F.array(event(end, 1, end, F.lit("")))))

    def state(start: Column, stop: Column, value: Column, until: Column) -> Column:
        return F.struct(start.alias("start"), stop.alias("stop"), value.alias("value"), until.alias("until"))

    def step(s: Column, e: Column) -> tuple[Column, Column]:
        # What is open and not covered so far ends where the next span or run starts.
        start, stop = F.greatest(s["start"], s["until"]), F.least(s["stop"], e["start"])
        value = F.when(stop - start >= LEAST, F.substring(s["value"], start - s["start"] + 1, stop - start)).otherwise("")
        fresh = state(e["start"], e["stop"], e["value"], s["until"])
        covered = state(s["start"], s["stop"], s["value"], F.greatest(s["until"], e["stop"]))
        piece = F.struct(start.alias("start"), stop.alias("stop"), value.alias("value"))
        return F.when(e["run"] == 1, fresh).otherwise(covered), piece

    nothing = state(F.lit(0), F.lit(0), F.lit(""), F.lit(0))
    parts = F.filter(_running(events, nothing, step, _PIECE), lambda p: p["value"] != "")
    return F.when((F.size(runs) == 0) | (F.size(base) == 0), F.col(runs)).otherwise(parts)


def _minus_log_above(z: Column) -> Column:
    """-ln of the chance of a standard normal above z: Page's logistic form, without underflow."""
    form = lambda x: 1.5976 * x + 0.070565992 * x * x * x
    return _let(_let(z, form), lambda t: F.greatest(F.lit(0.0), t) + F.log1p(F.exp(-F.abs(t))))


def _either(z: Column) -> Column:
    """-ln of the chance of a deviation as large, to either side."""
    return F.greatest(_minus_log_above(F.abs(z)) - math.log(2), F.lit(0.0))


def _fisher(*evidence: Column) -> Column:
    """-ln of the combined p-value of tests that give -ln(p) each: a chi-squared tail in closed form."""
    def tail(total: Column) -> Column:
        terms = F.lit(1.0)
        for n in range(1, len(evidence)):
            terms = terms + F.pow(total, F.lit(n)) / math.factorial(n)
        return total - F.log(terms)

    return _let(sum(evidence[1:], evidence[0]), tail)


def _runs(body: Column) -> Column:
    return F.regexp_replace(body, r"(.)\1+", "$1")


def _encoding(value: Column) -> Column:
    """The first encoding that holds the symbols: its alphabet, the share of each kind in it, ordinary equal symbols."""
    out = None
    for pattern, alphabet, (two, three) in reversed(ENCODINGS.values()):
        a = len(alphabet)
        shares = [sum(x in kind for x in alphabet) / a for kind in KINDS]
        own = F.struct(
            F.lit(alphabet).alias("alphabet"), F.lit("L" * (a // 2) + "H" * (a - a // 2)).alias("halves"),
            F.lit(float(a)).alias("a"), F.array(*[F.lit(x) for x in shares]).alias("shares"),
            F.lit(float(sum(x > 0 for x in shares) - 1)).alias("freedom"), F.lit(two).alias("two"), F.lit(three).alias("three"))
        out = own if out is None else F.when(value.rlike(pattern), own).otherwise(out)
    return out


def _as_random(x: Column) -> Column:
    """-ln(p) of the hypothesis "uniform random symbols"."""
    body, n, e = x["body"], x["n"], x["encoding"]
    a, freedom = e["a"], e["freedom"]
    chi = (x["squares"] * a / n - n - (a - 1)) / F.sqrt(2 * (a - 1) * (1 - 1 / n))
    by_kind = F.lit(0.0)
    for k, kind in enumerate(KINDS):
        share = F.get(e["shares"], F.lit(k))
        term = _let(n - F.length(F.translate(body, kind, "")) - n * share, lambda off: off * off / (n * share))  # noqa: B023
        by_kind = by_kind + F.when(share > 0, term).otherwise(0.0)
    kinds = _minus_log_above((by_kind - freedom) / F.sqrt(2 * freedom))
    runs = F.length(_runs(F.call_function("translate", body, e["alphabet"], e["halves"])))
    runs = (runs - (n + 1) / 2) / F.sqrt((n - 1) / 4)
    ranks = F.transform(F.split(body, ""), lambda c: F.instr(e["alphabet"], c) - 1 - (a - 1) / 2)
    products = _let(ranks, lambda r: F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r)), lambda i, j: i * j))
    serial = F.aggregate(products, F.lit(0.0), lambda s, i: s + i) / ((a * a - 1) / 12) / F.sqrt(n - 1)
    tests = [_minus_log_above(chi), _either(runs), _either(serial)]
    return F.when(freedom > 0, _fisher(*tests, kinds)).otherwise(_fisher(*tests))


def _as_ordinary(x: Column) -> Column:
    """-ln(p) of the hypothesis "ordinary name, word or number"."""
    body, n, two, three = x["body"], x["n"], x["encoding"]["two"], x["encoding"]["three"]
    pairs = n * (n - 1) / 2
    spread = F.sqrt(pairs * two * (1 - two) + n * (n - 1) * (n - 2) * F.greatest(three - two * two, F.lit(0.0)))
    few_alike = (pairs * two - (x["squares"] - n) / 2 - 0.5) / spread
    kinds = F.translate(body, "".join(KINDS), "".join(c * len(k) for c, k in zip("aA0-", KINDS)))
    expected = CHANGE * (n - 1)
    many_changes = (F.length(_runs(kinds)) - 1 - 0.5 - expected) / F.sqrt(expected * (1 - CHANGE))
    sounds = "".join("v" if c in "aeiou" else "c" for c in _LOWER)
    speech = F.translate(F.lower(body), _LOWER + _DIGITS + "+/_=-", sounds + "-" * 15)

    def heard(own: Column) -> Column:
        letters = lambda t: F.length(F.translate(t, "-", ""))
        words = letters(_runs(F.translate(own, "v", "c")))
        neighbours, alternating = letters(own) - words, letters(_runs(own)) - words
        z = (neighbours * ALTERNATE - alternating - 0.5) / F.sqrt(neighbours * ALTERNATE * (1 - ALTERNATE))
        return F.when(neighbours > 0, _minus_log_above(z)).otherwise(0.0)

    return _fisher(_minus_log_above(few_alike), _minus_log_above(many_changes), _let(speech, heard))


def _judged(span: Column) -> Column:
    """The span with its evidence -ln(p) against "ordinary", and whether it fits uniform random symbols."""
    body = F.rtrim(span["value"], F.lit("="))
    counts = F.transform(
        F.array_distinct(F.split(body, "")), lambda c: (F.length(body) - F.length(F.replace(body, c, F.lit("")))).cast("double"))
    squares = F.aggregate(counts, F.lit(0.0), lambda s, k: s + k * k)
    facts = F.struct(
        body.alias("body"), F.length(body).cast("double").alias("n"), squares.alias("squares"), _encoding(span["value"]).alias("encoding"))

    def tests(x: Column) -> Column:
        enough = (x["n"] > 2) & (x["n"] * F.log2(x["encoding"]["a"]) >= LEAST_BITS)
        fits = F.when(enough, _as_random(x) < FIT).otherwise(False)
        return F.struct(F.when(fits, _as_ordinary(x)).otherwise(0.0).alias("evidence"), fits.alias("fits"))

    return F.struct(span["start"].alias("start"), span["stop"].alias("stop"), _let(facts, tests).alias("test"))


def _long(pattern: str, group: int, least: int):
    """Whether a group of the match (0: all of it) is long enough."""
    if group:
        return lambda s: F.length(F.regexp_extract(s["value"], pattern, group)) >= least
    return lambda s: F.length(s["value"]) >= least


def _of_kind(number: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["stop"].alias("stop"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` (all columns of ``docs``), ``_base`` (structs start, kind number, stop), ``_random``
    (judged candidates that fit) and ``_tried`` (how many there were)."""
    out = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_whole"))
    for kind, (pattern, group, least) in BASE.items():
        out = out.withColumn(f"_{kind}", F.filter(spans("_whole", pattern), _long(pattern, group, least)))
    named = [F.transform(f"_{kind}", _of_kind(n)) for n, kind in enumerate(BASE)]
    out = out.withColumn("_base", F.sort_array(F.concat(*named)))
    out = out.withColumn("_runs", spans("_whole", CANDIDATE)).withColumn("_apart", _outside("_runs", "_base"))
    judged = F.filter(F.transform("_apart", _judged), lambda s: s["test"]["fits"])
    # Candidates that do not fit count too: the corpus decides how strict the threshold is.
    return out.select("_row", "_base", judged.alias("_random"), F.size("_apart").alias("_tried"))


def threshold(scanned: DataFrame, fdr: float) -> float:
    """Least evidence -ln(p) that Benjamini-Hochberg accepts over all candidates; reads at most BINS counts."""
    # One more bin, below zero, counts those that a test has refused.
    level = F.transform("_random", lambda s: F.least(F.floor(s["test"]["evidence"] / BIN), F.lit(BINS)).cast("int"))
    refused = F.array_repeat(F.lit(-1), F.col("_tried") - F.size("_random"))
    bins = scanned.select(F.explode(F.concat(level, refused)).alias("bin")).groupBy("bin").count().collect()
    tried, passed, least = sum(row["count"] for row in bins), 0, math.inf
    for row in sorted((r for r in bins if r.bin >= 0), key=lambda r: -r.bin):
        passed += row["count"]
        if math.exp(-row.bin * BIN) <= fdr * passed / tried:
            least = row.bin * BIN
    return least


def _found(docs: DataFrame, fdr: float, text: str, scratch: Scratch | None, texts: bool = True) -> DataFrame:
    """``_row``, ``_base`` and ``_secrets``; the threshold needs all candidates before the first answer."""
    scanned = scan(docs, text)
    if not texts:
        scanned = scanned.withColumn("_row", F.col("_row").dropFields(text))
    if scratch is None:
        scanned_first = scan(docs.select(text), text)
    else:
        scanned = scanned_first = scratch.result(scanned, "scanned")
    least = F.lit(threshold(scanned_first.select("_random", "_tried"), fdr))
    added = F.filter("_random", lambda s: s["test"]["evidence"] >= least)
    added = F.transform(added, _of_kind(len(BASE)))
    return scanned.select("_row", "_base", F.sort_array(F.concat("_base", added)).alias("_secrets"))


def find_secrets(
    docs: DataFrame, fdr: float = 0.01, text: str = "text", scratch: Scratch | None = None, texts: bool = True,
) -> DataFrame:
    """``docs`` with ``_base`` and ``_secrets``: structs start, kind, stop, by start, then kind.

    Kinds are numbered as in BASE, then ``len(BASE)`` for strings that look random; ``_base`` lacks those. Null
    and empty texts have none; rows that repeat are kept; an empty table stays empty; columns that
    have these two names are replaced, all others stay. With ``scratch`` texts are scanned once, else twice; without
    ``texts`` the column of texts is left out (there must be another).
    """
    return _found(docs.drop("_base", "_secrets"), fdr, text, scratch, texts).select("_row.*", "_base", "_secrets")


def listed(column: str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*BASE, "random")])
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(
    docs: DataFrame, fdr: float = 0.01, text: str = "text", mark: str = "[SECRET]", scratch: Scratch | None = None,
) -> DataFrame:
    """``docs`` with every secret of its texts replaced by ``mark``; spans that overlap or touch become one mark.

    All other columns and all rows stay as they are; null texts stay null. With ``scratch`` texts are scanned once,
    else twice.
    """
    whole = F.col("_row")[text]
    ends = F.array(F.struct(F.length(whole).alias("start"), F.lit(-1).alias("kind"), F.length(whole).alias("stop")))

    def step(until: Column, span: Column) -> tuple[Column, Column]:
        # Text between two marks; the text before the first and after the last may be empty.
        keep = (span["start"] > until) | (until < 0) | (span["kind"] < 0)
        gap = F.struct(F.greatest(until, F.lit(0)).alias("start"), span["start"].alias("stop"), keep.alias("keep"))
        return F.greatest(until, span["stop"]), gap

    gaps = _running(F.concat("_secrets", ends), F.lit(-1), step, "struct<start:int,stop:int,keep:boolean>")

    def texts(block: Column) -> Column:
        # Positions in a text are found from its beginning: a block's part is cut out first.
        first = F.get(block, F.lit(0))["start"]
        size = F.element_at(block, -1)["stop"] - first
        cut = lambda part: F.transform(block, lambda g: F.substring(part, g["start"] - first + 1, g["stop"] - g["start"]))
        return _let(F.substring(whole, first + 1, size), cut)

    kept = F.flatten(F.transform(_blocks(F.filter(gaps, lambda g: g["keep"])), texts))
    clean = F.when(F.size("_secrets") > 0, F.array_join(kept, mark)).otherwise(whole)
    found = _found(docs, fdr, text, scratch)
    return found.select([(clean if c == text else F.col("_row")[c]).alias(c) for c in docs.columns])
