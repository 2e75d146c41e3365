"""Repairs the order of roles in conversations by the cheapest edits, with an audit of them.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Each of its rows is kept,
given another role or deleted, and empty rows of users or assistants may be inserted anywhere; the audit
is the initials of the edits in order (K, R, D, I). Blank rows and repetitions must be deleted. Of the
cheapest audits the ASCII-least is taken.

The search goes forward over rows and the four states of the pattern. Audits are paths in a tree that
all states share: a node is one more row, its label the edits that lead there, and it knows its
ancestors at distances of powers of two and a rolling hash of its whole audit. Two audits of equal cost
are compared by a search for their longest common prefix along these ancestors; equal hashes are
verified. At a state after a row, neither of two audits begins with the other: edits determine states,
so the longer one would come back to the state by insertions alone, at a cost.

A conversation may be of any length. Rows are ordered by range, so that it is spread over tasks; the
search runs on segments of ``SEGMENT`` rows from every state they may be entered in, and its results,
without audits, are joined by the same search over segments, in which a label is the rank of a
segment's audit among those from the same state. Only the output of a conversation, its audit and its
text, is ever in one place; the hash of a text is taken from sorted rows as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwell.llm.arrow import Out, rows_of
from feedwell.llm.shared import Scratch

#: Rows that are searched together.
SEGMENT = 4_096
#: White space that ends and blanks ignore.
SPACE = " \t\n\x0b\x0c\r"
#: Costs of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

START, SYSTEM, USER, ASSISTANT = range(4)
#: From each state, the roles that may follow, by initial.
NEXT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
#: From each state, the role that an inserted or changed row takes: only one is legal.
FILL = ["u", "u", "a", "u"]
ROLES = {"u": "user", "a": "assistant"}
#: Insertions that end a conversation in each state.
CLOSING = [0, 2, 1, 0]
#: A rolling hash modulo a prime (fixed values: a Mersenne prime, and any large base).
PRIME, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681


def rolling(text: str) -> int:
    value = 0
    for c in text:
        value = (value * BASE + ord(c)) % PRIME
    return value


class Audits:
    """Audits as nodes of one tree; node 0 is the empty audit."""

    def __init__(self):
        self.up: list[list[int]] = [[]]
        self.hash = [0]
        self.label: list = [None]

    def add(self, parent: int, label, hashed: int, scale: int) -> int:
        """A node behind ``parent``; ``hashed`` and ``scale`` are of the label's text: its hash, BASE to its length."""
        up, node, k = [parent], parent, 0
        while k < len(self.up[node]):
            node = self.up[node][k]
            up.append(node)
            k += 1
        self.up.append(up)
        self.hash.append((self.hash[parent] * scale + hashed) % PRIME)
        self.label.append(label)
        return len(self.up) - 1

    def labels(self, node: int) -> list:
        found = []
        while node:
            found.append(self.label[node])
            node = self.up[node][0]
        return found[::-1]

    def less(self, a: int, label_a, b: int, label_b) -> bool:
        """Whether the audit of ``a`` and then ``label_a`` comes before the other; both nodes are equally deep."""
        if a == b:
            return label_a < label_b
        if self.hash[a] == self.hash[b] and self.labels(a) == self.labels(b):
            return label_a < label_b
        x, y = a, b
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        before_x, before_y = self.up[x][0], self.up[y][0]
        if before_x != before_y and self.labels(before_x) != self.labels(before_y):
            return self.labels(a) < self.labels(b)  # two audits of one hash
        return self.label[x] < self.label[y]


@dataclass(frozen=True)
class Edge:
    """One row, or one segment, from a state to a state."""

    enter: int
    leave: int
    cost: int
    label: object
    hash: int
    scale: int


def _row_edges(symbol: str) -> list[Edge]:
    """The cheapest edits for a row between any two states: insertions before it, then its own edit.

    The symbol is the initial of its role (x: any other), a capital if the row is truncated; - if it must go.
    """
    initial, extra = symbol.lower(), TRUNCATED * symbol.isupper()
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for enter in range(4):
        state, label, passed = enter, "", []
        while state not in passed:
            passed.append(state)
            own = [(DELETE, "D", state)]
            if symbol != "-":
                own.append((REROLE + extra, "R", NEXT[state][FILL[state]]))
                if initial in NEXT[state]:
                    own.append((extra, "K", NEXT[state][initial]))
            for cost, edit, leave in own:
                option = (cost + INSERT * len(label), label + edit)
                found[enter, leave] = min(found.get((enter, leave), option), option)
            state, label = NEXT[state][FILL[state]], label + "I"
    return [Edge(*ends, cost, label, rolling(label), pow(BASE, len(label), PRIME)) for ends, (cost, label) in found.items()]


_EDGES = {symbol: _row_edges(symbol) for symbol in "suaxSUAX-"}


def cheapest(layers: Iterable[list[Edge]], enter: int) -> tuple[Audits, dict[int, tuple[int, int]]]:
    """The tree of audits, and cost and node of the best one for every state that can be reached."""
    audits, best = Audits(), {enter: (0, 0)}
    for edges in layers:
        found: dict[int, tuple[int, int, Edge]] = {}
        for edge in edges:
            if edge.enter not in best:
                continue
            cost, node = best[edge.enter]
            cost += edge.cost
            if edge.leave in found:
                least, other, rival = found[edge.leave]
                if cost > least or cost == least and not audits.less(node, edge.label, other, rival.label):
                    continue
            found[edge.leave] = (cost, node, edge)
        best = {s: (cost, audits.add(node, e.label, e.hash, e.scale)) for s, (cost, node, e) in found.items()}
    return audits, best


@dataclass(frozen=True)
class Path:
    """The best audit of a segment between two states, and its rank among those from the same one."""

    enter: int
    leave: int
    cost: int
    rank: int
    audit: str


def segment_paths(symbols: str, inside: bool) -> tuple[Path, ...]:
    """The paths of a segment: from the start, and, if a conversation may be ``inside`` there, from all states."""
    found = []
    for enter in range(4) if inside else (START,):
        audits, best = cheapest((_EDGES[s] for s in symbols), enter)
        own = sorted(("".join(audits.labels(node)), leave, cost) for leave, (cost, node) in best.items())
        found += [Path(enter, leave, cost, rank, audit) for rank, (audit, leave, cost) in enumerate(own)]
    return tuple(found)


def join_segments(segments: list[list[tuple[int, int, int, int, int, int]]]) -> tuple[int, int, list[tuple[int, int]]]:
    """Cost, closing insertions, and the states each segment is entered and left in, of the best audit.

    A segment is its paths as (enter, leave, cost, rank, hash, scale); the first is entered at the start.
    """
    layers = [[Edge(a, b, cost, (a, rank, b), hashed, scale) for a, b, cost, rank, hashed, scale in s] for s in segments]
    audits, best = cheapest(layers, START)
    chosen = None
    for state, (cost, node) in best.items():
        option = (cost + INSERT * CLOSING[state], node, state)
        # Insertions at the end decide nothing: the audits differ before them.
        if chosen is None or option[0] < chosen[0] or option[0] == chosen[0] and audits.less(node, "", chosen[1], ""):
            chosen = option
    cost, node, state = chosen
    return cost, CLOSING[state], [(a, b) for a, _, b in audits.labels(node)]


def edits(audit: str, symbols: str, enter: int) -> Iterator[tuple[str, str, str | None]]:
    """Per row its edit, the initials of rows inserted before it, and its role if that changes."""
    state, before, row = enter, "", 0
    for edit in audit:
        if edit == "I":
            before += FILL[state]
            state = NEXT[state][FILL[state]]
            continue
        role = ROLES[FILL[state]] if edit == "R" else None
        if edit != "D":
            state = NEXT[state][FILL[state] if edit == "R" else symbols[row].lower()]
        yield edit, before, role
        before, row = "", row + 1


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with every row damaged as crc32 of ``conv_id:turn``, modulo 20, says.

    0 drops it, 1 empties its text, 2 removes ends of sentences, 3 repeats it, 4 makes it a user's.
    Nulls count as one space; conv_id and turn stay null.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(F.col("key") == 1, "").when(F.col("key") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), key.alias("key"))
    times = F.array_repeat(F.lit(1), F.when(F.col("key") == 3, 2).otherwise(1))
    return rows.filter("key <> 0").select(
        "conv_id", "turn", F.when(F.col("key") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("one")).drop("one")


@dataclass
class Repairs:
    """What a repair found and did. ``audits`` has a row per conversation, ``rows`` the repaired rows.

    audits: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    rows: conv_id, pos and sub (their order), edit, role, text.
    """

    audits: DataFrame
    rows: DataFrame

    def digests(self) -> DataFrame:
        """conv_id and repaired_sha256 of its ``role:text`` lines; a conversation without rows has no digest here.

        A hash takes its input in order, so the rows of a conversation pass through one task, sorted by
        Spark and never held.
        """

        def run(batches):
            out, now, value = Out(pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])), None, None
            for key, line in rows_of(batches, "conv_id", "line", step=256):
                if value is None or key != now:
                    if value is not None and out.add((now, value.hexdigest())):
                        yield out.batch()
                    now, value = key, hashlib.sha256()
                else:
                    value.update(b"\n")
                value.update(line.encode("utf-8", "surrogatepass"))
            if value is not None:
                out.add((now, value.hexdigest()))
            yield out.batch()

        lines = self.rows.select("conv_id", "pos", "sub", F.concat("role", F.lit(":"), "text").alias("line"))
        lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "sub").select("conv_id", "line")
        return lines.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(
    conversations: DataFrame, scratch: Scratch, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    segment: int = SEGMENT,
) -> Repairs:
    """The faults of each conversation, its cheapest audit, and its repaired rows.

    Rows are taken by turn, null first; rows of one turn by role and text (its first 64 characters, then
    a hash of it). Null roles and texts are one space; a null conv_id is a conversation. Equal rows are
    repetitions of the first. An empty table gives no rows; other columns take no part.
    """
    rows = _ordered(conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text")), scratch)
    segments = scratch.table(_segments(rows, segment))
    turns = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    joined = scratch.table(_joined(segments))
    pieces = scratch.table(_pieces(segments, joined))
    audits = turns.join(_audits(segments, joined, pieces), turns.conv_id.eqNullSafe(F.col("of"))).drop("of")
    audits = audits.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return Repairs(audits, _repaired(rows, pieces))


def _ordered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with ``pos``, ascending in the order of their conversations; no key is kept in one task."""
    keys = {"head": F.left("text", F.lit(64)), "tie": F.xxhash64("text"), "salt": F.monotonically_increasing_id() % 64}
    order = ["conv_id", "turn", "role", *keys]
    spread = rows.withColumns(keys).repartitionByRange(*order).sortWithinPartitions(*order).drop(*keys)
    return scratch.table(spread.withColumn("pos", F.monotonically_increasing_id()))


def _segments(rows: DataFrame, size: int) -> DataFrame:
    """A row per conversation and block of ``size`` rows: faults, ends, symbols, paths.

    ``size`` is a power of two, as positions run from a multiple of a large one in each partition.
    """
    bits = size.bit_length() - 1
    if size != 1 << bits:
        raise ValueError("a segment's size is a power of two")
    initial = F.left("role", F.lit(1))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(trimmed == "", "blank").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    marked = rows.select(
        "conv_id", "pos", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), fault.alias("fault"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"))
    # The first of equal rows, by its position: the rest of them are repetitions.
    firsts = marked.filter("fault <> 'blank'").groupBy("conv_id", "digest").agg(F.min("pos").alias("pos"))
    none = F.lit(None).cast("string").alias("initial")
    both = marked.select("pos", "conv_id", "initial", "fault").unionByName(firsts.select("pos", "conv_id", none, F.lit("first").alias("fault")))
    blocks = both.groupBy(F.shiftright("pos", bits).alias("block")).agg(
        F.collect_list(F.struct("pos", "conv_id", "initial", "fault")).alias("entries"))
    path = pa.struct([
        ("enter", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("audit", pa.string()),
        ("hash", pa.int64()), ("scale", pa.int64())])
    schema = pa.schema([
        ("conv_id", pa.int64()), ("at", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
        ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("symbols", pa.string()), ("paths", pa.list_(path))])

    def run(batches):
        out, known = Out(schema, rows=1024), lru_cache(1 << 13)(_stored_paths)
        for (entries,) in rows_of(batches, "entries", step=8):
            for row in _cut(entries, known):
                if out.add(row, 20 * len(row[8])):
                    yield out.batch()
        yield out.batch()

    return blocks.mapInArrow(run, (
        "conv_id long, at long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
        "symbols string, paths array<struct<enter:int,leave:int,cost:long,rank:int,audit:string,hash:long,scale:long>>"))


_LEGAL = {"su", "ua", "au"}


def _stored_paths(symbols: str, inside: bool) -> list[dict]:
    return [
        {"enter": p.enter, "leave": p.leave, "cost": p.cost, "rank": p.rank, "audit": p.audit,
         "hash": rolling(p.audit), "scale": pow(BASE, len(p.audit), PRIME)}
        for p in segment_paths(symbols, inside)]


def _cut(entries: list[dict], known: Callable[[str, bool], list[dict]]) -> Iterator[tuple]:
    """The segments of a block; only its first may lie inside a conversation that began before."""
    firsts = {e["pos"] for e in entries if e["fault"] == "first"}
    rows = sorted((e["pos"], e["conv_id"], e["initial"], e["fault"]) for e in entries if e["fault"] != "first")
    start = 0
    while start < len(rows):
        end, conv = start, rows[start][1]
        symbols, counts, initials = [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}, []
        while end < len(rows) and rows[end][1] == conv:
            pos, _, initial, fault = rows[end]
            if fault != "blank" and pos not in firsts:
                fault = "duplicate"
            counts[fault] += 1
            symbols.append("-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
            initials.append(initial)
            end += 1
        illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
        text = "".join(symbols)
        # Short conversations repeat each other's symbols.
        paths = (known if len(text) <= 32 else _stored_paths)(text, start == 0)
        yield (conv, rows[start][0], counts["blank"], counts["duplicate"], counts["truncated"], illegal,
               initials[0], initials[-1], text, paths)
        start = end


def _joined(segments: DataFrame) -> DataFrame:
    """of, cost, the pairs of rows between segments that are illegal, and the states around each segment."""
    numbers = F.transform("paths", lambda p: F.struct(*[p[c].alias(c) for c in ("enter", "leave", "cost", "rank", "hash", "scale")]))
    own = segments.groupBy("conv_id").agg(
        F.collect_list(F.struct("at", "first", "last", numbers.alias("paths"))).alias("segments"))
    path = pa.struct([("at", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32()), ("closing", pa.int32())])
    schema = pa.schema([("of", pa.int64()), ("cost", pa.int64()), ("between", pa.int64()), ("path", pa.list_(path))])

    def run(batches):
        out = Out(schema, rows=1024)
        for key, found in rows_of(batches, "conv_id", "segments", step=16):
            found.sort(key=lambda s: s["at"])
            between = sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(found, found[1:]))
            cost, closing, states = join_segments([[tuple(p.values()) for p in s["paths"]] for s in found])
            ends = [0] * (len(found) - 1) + [closing]
            path = [{"at": s["at"], "enter": a, "leave": b, "closing": c} for s, (a, b), c in zip(found, states, ends)]
            if out.add((key, cost, between, path)):
                yield out.batch()
        yield out.batch()

    return own.mapInArrow(run, "of long, cost long, between long, path array<struct<at:long,enter:int,leave:int,closing:int>>")


def _pieces(segments: DataFrame, joined: DataFrame) -> DataFrame:
    """of, at, enter, closing, symbols, and the audit of each segment."""
    chosen = joined.select("of", F.explode("path").alias("step")).select("of", "step.*")
    own = segments.select("at", "symbols", F.explode("paths").alias("p")).select("at", "symbols", "p.enter", "p.leave", "p.audit")
    return chosen.join(own, ["at", "enter", "leave"]).select("of", "at", "enter", "closing", "symbols", "audit")


def _audits(segments: DataFrame, joined: DataFrame, pieces: DataFrame) -> DataFrame:
    faults = segments.groupBy(F.col("conv_id").alias("key")).agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    whole = pieces.groupBy(F.col("of").alias("whole_of")).agg(F.array_sort(F.collect_list(F.struct("at", "audit", "closing"))).alias("parts"))
    audit = F.array_join(F.transform("parts", lambda p: F.concat(p.audit, F.repeat(F.lit("I"), p.closing))), "")
    found = joined.join(whole, F.col("of").eqNullSafe(F.col("whole_of"))).join(faults, F.col("of").eqNullSafe(F.col("key")))
    return found.select(
        "of", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("between")).alias("illegal"), "cost", audit.alias("audit"))


def _repaired(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """conv_id, pos, sub, edit, role, text of the rows that stay or are inserted."""
    schema = pa.schema([
        ("pos", pa.int64()), ("edit", pa.string()), ("new_role", pa.string()), ("before", pa.string()), ("after", pa.string())])

    def run(batches):
        out = Out(schema)
        for at, enter, closing, symbols, audit in rows_of(batches, "at", "enter", "closing", "symbols", "audit", step=64):
            last = at + len(symbols) - 1
            for n, (edit, before, role) in enumerate(edits(audit, symbols, enter)):
                # A conversation that closes by two insertions ends in a system row, by one in a user's.
                after = {0: "", 1: "a", 2: "ua"}[closing] if at + n == last else ""
                if out.add((at + n, edit, role, before, after)):
                    yield out.batch()
        yield out.batch()

    steps = pieces.mapInArrow(run, "pos long, edit string, new_role string, before string, after string")

    def inserted(initials: str) -> Column:
        each = F.filter(F.split(initials, ""), lambda c: c != "")
        role = lambda c: F.when(c == "u", ROLES["u"]).otherwise(ROLES["a"])
        return F.transform(each, lambda c: F.struct(F.lit("I").alias("edit"), role(c).alias("role"), F.lit("").alias("text")))

    own = F.struct("edit", F.coalesce("new_role", "role").alias("role"), "text")
    stay = F.filter(F.array(own), lambda r: r.edit != "D")
    parts = F.concat(inserted("before"), stay, inserted("after"))
    found = rows.join(steps, "pos").select("conv_id", "pos", F.posexplode(parts).alias("sub", "row"))
    return found.select("conv_id", "pos", "sub", "row.*")
