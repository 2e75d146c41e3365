"""Documents whose shingle sets are alike, by a grouped prefix join.

A document is the set of its distinct runs of ``width`` words. With a common order of all shingles,
two sets x, y whose Jaccard similarity reaches t share at least l of the first
|x| - ceil(t |x|) + l shingles of x and of y, for any l. The order puts frequent shingles last, so few
sets meet by chance; it decides only how much work there is.

1. Documents with equal sets become one class.
2. Classes with equal prefix and size become one group, which is listed under each prefix shingle. Each task
   gives the prefix of a group once, and no later step moves prefixes.
3. Groups of a list are paired by size. Short lists give pairs at once, and pairs that share too few
   shingles are dropped; long lists stay lists, without pairs.
4. Groups are expanded into classes, and their texts verified exactly. A list is searched breadth
   first: what is linked already is not compared again, and each found link joins something new.

A list of many texts is cut into blocks, and each pair of blocks is a task. Links are those of a
spanning forest of the similarity graph, so that connected components are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from feedwell.llm.arrow import Out, rows_of
from feedwell.llm.chunks import by_size
from feedwell.llm.components import components
from feedwell.llm.shared import Scratch
from feedwell.llm.sieve import sieve
from feedwell.llm.words import PlainWords, grams, mixed

#: Shingles counted together when looking for frequent ones, and least sets that make one frequent there.
COUNTED, FREQUENT = 1 << 21, 2
#: Frequent shingles that the order knows, at most.
KNOWN = 500_000
#: Groups of a list that is paired at once.
SHORT = 64
#: Shingles of the texts of a block.
BLOCK_SHINGLES = 400_000


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The set as ascending 64-bit hashes; fewer than ``width`` words are one shingle, none are no shingle."""
    if len(words) >= width:
        return np.unique(grams(words, width))
    # Marked with the length, so that a short text equals no run of a longer one.
    return mixed(grams(words, len(words)) + np.uint64(len(words))) if len(words) else np.empty(0, np.uint64)


def shared_least(n: int) -> int:
    """Prefix shingles that two sets must share, for the smaller set's size n."""
    return 1 + n // 32


def prefix_size(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + shared_least(n) if n else 0


def _sets(batches, width: int, *extra: str) -> Iterator[tuple]:
    """(set, *extra columns) of each row."""
    words = PlainWords()
    for group in by_size(rows_of(batches, "text", *extra), 0):
        for row, own in zip(group, words.many([r[0] or "" for r in group])):
            yield shingles(own, width), *row[1:]


def _key(found: np.ndarray, seed: int = 0) -> int:
    return xxh3_64_intdigest(found, seed) - (1 << 63)


def _frequent(docs: DataFrame, width: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, ascending, and how many sets hold them as far as counted; at most KNOWN."""

    def run(batches):
        held, size, seen = [], 0, set()

        def counted():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"shingle": values[n >= FREQUENT].view(np.int64), "n": n[n >= FREQUENT]})

        for found, in _sets(batches, width):
            if (key := _key(found)) in seen:
                continue
            seen.add(key)
            held.append(found)
            size += len(found)
            if size >= COUNTED:
                yield counted()
                held, size, seen = [], 0, set()
        if held:
            yield counted()

    counts = docs.select("text").mapInArrow(run, "shingle long, n long")
    counts = scratch.table(counts.groupBy("shingle").agg(F.sum("n").alias("n")))
    level = F.floor(F.log2("n") * 4).cast("int").alias("level")
    total, least = 0, None
    for row in sorted(counts.groupBy(level).count().collect(), key=lambda r: -r.level):  # a few hundred levels
        total += row["count"]
        if total > KNOWN:
            break
        least = row.level
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    table = counts.filter(F.floor(F.log2("n") * 4) >= least).toArrow()
    values = np.asarray(table["shingle"].to_numpy()).view(np.uint64)
    order = np.argsort(values)
    return values[order], np.asarray(table["n"].to_numpy())[order]


def _profiles(docs: DataFrame, width: int, percent: int, frequent: tuple) -> DataFrame:
    """doc_id, size and 64-bit key of each set, its group, and the prefix of the first set of a group in each task.

    A group are sets of one size and prefix. Sets of rows without an id have no prefix.
    """
    known, counts = frequent
    schema = pa.schema([*((c, pa.int64()) for c in ("doc_id", "n", "key", "a")), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        out, seen = Out(schema), set()
        for found, doc_id in _sets(batches, width, "doc_id"):
            at = np.searchsorted(known, found)
            at[at == len(known)] = 0
            weight = np.where(known[at] == found, counts[at], 0) if len(known) else np.zeros(len(found), np.int64)
            # The set is ascending, so a stable sort orders equal counts by hash.
            prefix = found[np.argsort(weight, kind="stable")[: prefix_size(len(found), percent)]]
            group = _key(prefix, len(found)) if len(found) else None
            if new := group is not None and doc_id is not None and group not in seen:
                seen.add(group)
            row = doc_id, len(found), _key(found) if len(found) else None, group, prefix.view(np.int64) if new else None
            if out.add(row, 8 * len(prefix) if new else 0):
                yield out.batch()
        yield out.batch()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, key long, a long, prefix array<long>")


def _listed(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups in short lists, and the groups of long lists: token (null: a pair), a, na, b, nb.

    Rows come sorted by token and group, and those that come again are dropped; a list is held only until it is long.
    """
    names = ("token", "a", "na", "b", "nb")
    kind = [pa.int64()] * 5

    def pairs(group: np.ndarray, sizes: np.ndarray, starts: np.ndarray, length: int) -> pa.RecordBatch:
        """All pairs of the lists of one length that begin at ``starts``."""
        i, j = np.triu_indices(length, 1)
        left, right = (starts[:, None] + i).ravel(), (starts[:, None] + j).ravel()
        x, y = sizes[left], sizes[right]
        near = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
        left, right = left[near], right[near]
        swap = group[left] > group[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        columns = [pa.nulls(len(left), pa.int64()), *(pa.array(c) for c in (group[left], sizes[left], group[right], sizes[right]))]
        return pa.RecordBatch.from_arrays(columns, names)

    def long(token: np.ndarray, group: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(token), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(group), pa.array(sizes), none, none], names)

    def closed(token, group, sizes):
        """What whole lists give."""
        starts = np.flatnonzero(np.diff(token, prepend=token[0] - 1)) if len(token) else np.empty(0, np.int64)
        lengths = np.diff(starts, append=len(token))
        for length in range(2, SHORT + 1):
            if len(own := starts[lengths == length]):
                yield pairs(group, sizes, own, length)
        rows = np.repeat(lengths > SHORT, lengths)
        if rows.any():
            yield long(token[rows], group[rows], sizes[rows])

    def run(batches):
        rest = [np.empty(0, np.int64)] * 3
        open_token = None  # of a list that is already known to be long
        before = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            if not len(new[0]):
                continue
            fresh = np.ones(len(new[0]), bool)
            fresh[1:] = (np.diff(new[0]) != 0) | (np.diff(new[1]) != 0)
            fresh[0] = (new[0][0], new[1][0]) != before
            before = new[0][-1], new[1][-1]
            new = [c[fresh] for c in new]
            token, group, sizes = (np.concatenate([r, x]) for r, x in zip(rest, new))
            if not len(token):
                continue
            if open_token is not None:
                n = int(np.searchsorted(token != open_token, True)) if (token != open_token).any() else len(token)
                if n:
                    yield long(token[:n], group[:n], sizes[:n])
                token, group, sizes = token[n:], group[n:], sizes[n:]
                if not len(token):
                    rest = [token, group, sizes]
                    continue
                open_token = None
            last = int(np.flatnonzero(token == token[-1])[0])
            if len(token) - last > SHORT:
                open_token = int(token[-1])
                yield long(token[last:], group[last:], sizes[last:])
                rest = [np.empty(0, np.int64)] * 3
            else:
                rest = [c[last:] for c in (token, group, sizes)]
            yield from closed(token[:last], group[:last], sizes[:last])
        yield from closed(*rest)
        yield pa.RecordBatch.from_arrays([pa.array([], t) for t in kind], names)

    ordered = postings.select("token", "a", "na").repartition("token").sortWithinPartitions("token", "a")
    return ordered.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def alike(a: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets reach the similarity with ``a``."""
    sizes = np.array([len(o) for o in others], np.int64)
    found = np.flatnonzero(100 * np.minimum(sizes, len(a)) >= percent * np.maximum(sizes, len(a)))
    if not len(found):
        return found
    flat = np.concatenate([others[n] for n in found])
    at = np.searchsorted(a, flat)
    at[at == len(a)] = 0
    ends = np.cumsum(sizes[found])
    common = np.diff(np.concatenate([[0], np.cumsum(a[at] == flat)])[np.concatenate([[0], ends])])
    return found[100 * common >= percent * (len(a) + sizes[found] - common)]


def spanning_links(keys: list, sets: list[np.ndarray], percent: int) -> Iterator[tuple]:
    """Links that join whatever paths of similar sets join, each joining something new."""
    rest = list(range(len(sets)))
    while rest:
        queue = [rest.pop()]
        while queue and rest:
            own = queue.pop()
            hits = alike(sets[own], [sets[n] for n in rest], percent)
            if len(hits):
                near = [rest[n] for n in hits]
                yield from ((keys[own], keys[n]) for n in near)
                queue += near
                taken = set(near)
                rest = [n for n in rest if n not in taken]


def star_links(keys: list, sets: list[np.ndarray], centres: list[int], percent: int) -> Iterator[tuple]:
    """Links between the centres and all others of a unit."""
    for own in centres:
        others = [n for n in range(len(sets)) if n != own]
        yield from ((keys[own], keys[others[n]]) for n in alike(sets[own], [sets[n] for n in others], percent))


def _verified(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b: links among the texts of each unit (unit, block_a, block_b, key, centre, text)."""

    def units(rows: Iterable[tuple]):
        name, held = None, {}
        for found, unit, a, b, key, centre in rows:
            if (unit, a, b) != name:
                if held:
                    yield held
                name, held = (unit, a, b), {}
            if _key(found) == key:  # an id may come with several texts
                held[key] = (found, centre or held.get(key, (0, False))[1])
        if held:
            yield held

    def run(batches):
        out = Out(pa.schema([("a", pa.int64()), ("b", pa.int64())]), rows=1 << 14)
        for held in units(_sets(batches, width, "unit", "block_a", "block_b", "key", "centre")):
            keys = sorted(held, key=lambda k: (len(held[k][0]), k))
            sets = [held[k][0] for k in keys]
            centres = [n for n, k in enumerate(keys) if held[k][1]]
            found = star_links(keys, sets, centres, percent) if centres else spanning_links(keys, sets, percent)
            for link in found:
                if out.add(link):
                    yield out.batch()
        yield out.batch()

    order = ["unit", "block_a", "block_b"]
    return texts.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def _blocks(members: DataFrame) -> DataFrame:
    """Each member of a unit once for every pair of blocks that its own block is in."""
    count = F.greatest(F.ceil(F.col("weight") / BLOCK_SHINGLES), F.lit(1)).cast("int")
    sized = members.groupBy("unit").agg(F.sum("n").alias("weight")).select("unit", count.alias("blocks"))
    placed = members.join(sized, "unit").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select(
        "unit", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), "key", "centre")


def _units(classes: DataFrame, profiles: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """What is to be compared: unit, key, n, centre (stars: the others are compared with it only)."""
    postings = profiles.select(F.explode("prefix").alias("token"), "a", F.col("n").alias("na"))
    listed = scratch.table(_listed(postings, percent))

    # Two sets that short lists do not pair must share all they need in long ones.
    held = listed.filter("token is not null").select("token", "a", "na")
    in_long = scratch.table(held.groupBy("a", "na").agg(F.count("*").alias("m")))
    enough = in_long.filter(F.col("m") >= 1 + F.floor(F.ceil(F.col("na") * percent / 100) / 32)).select("a")
    long = held.select("token", "a").join(enough, "a").select("token", "a")
    # Lists of the same groups are one unit.
    told = long.groupBy("token").agg(
        F.count("*").alias("c"), F.bit_xor("a").alias("x"), F.bit_xor(F.xxhash64("a")).alias("y"))
    kept = told.filter("c > 1").groupBy("c", "x", "y").agg(F.min("token").alias("token")).select("token")
    lists = long.join(kept, "token").select(F.xxhash64(F.lit("list"), "token").alias("unit"), "a", F.lit(False).alias("centre"))

    in_long = in_long.select("a", "m")
    pairs = listed.filter("token is null").groupBy("a", "na", "b", "nb").agg(F.count("*").alias("m"))
    least = 1 + F.floor(F.least("na", "nb") / 32)
    pairs = pairs.join(in_long.withColumnRenamed("m", "ma"), "a", "left")
    pairs = pairs.join(in_long.select(F.col("a").alias("b"), F.col("m").alias("mb")), "b", "left")
    pairs = pairs.filter(F.col("m") + F.coalesce(F.least("ma", "mb") * F.sign("ma") * F.sign("mb"), F.lit(0)) >= least)
    star = F.xxhash64(F.lit("star"), "a").alias("unit")
    pairs = scratch.table(pairs.select(star, "a", "b"))
    stars = pairs.select("unit", "a", F.lit(True).alias("centre")).distinct().unionByName(
        pairs.select("unit", F.col("b").alias("a"), F.lit(False).alias("centre")))

    inner = classes.groupBy("a").count().filter("count > 1").select(
        F.xxhash64(F.lit("group"), "a").alias("unit"), "a", F.lit(False).alias("centre"))
    units = lists.unionByName(stars).unionByName(inner)
    return units.join(classes.select("a", "key", "n"), "a").select("unit", "key", "n", "centre")


def link_documents(
    docs: DataFrame, scratch: Scratch, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id that links lead to, of every document.

    Words are runs without ASCII white space, A-Z in lower case. Null and empty texts have no
    shingles and are linked with nothing. Repeated rows are documents of their own with equal ids;
    one id with several texts has a row for each. Rows with a null id have a null component. An
    empty table gives no rows; other columns take no part.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    profiles = scratch.table(_profiles(rows, width, percent, _frequent(rows, width, scratch)))
    classes = profiles.filter("doc_id is not null and n > 0").groupBy("n", "key").agg(
        F.min("doc_id").alias("first"), F.min("a").alias("a"))
    classes = scratch.table(classes)
    units = scratch.table(_units(classes, profiles, percent, scratch))
    # Texts that are compared move twice: to the places of their ids, and from there to the units. Others stay.
    needed = scratch.table(_blocks(units).join(classes.select("key", F.col("first").alias("doc_id")), "key"))
    compared, _ = sieve(rows, F.xxhash64("doc_id"), needed.select(F.xxhash64("doc_id").alias("hash")).distinct(), "hash")
    links = scratch.table(_verified(needed.join(compared, "doc_id").drop("doc_id"), width, percent))

    labels = components(links, scratch)
    named = classes.select("key", "first").join(labels.withColumnRenamed("node", "key"), "key", "left")
    named = named.select("key", "first", F.coalesce("label", "key").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = named.join(least, "label").select("key", "component_id")
    out = profiles.select("doc_id", F.col("n").alias("n_shingles"), "key").join(of_class, "key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))
