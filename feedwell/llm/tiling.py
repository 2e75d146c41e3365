"""Benchmark passages in documents, found by greedy string tiling.

Words are case-folded letters and digits. Passages and documents that share a run of ``tile``
words (a seed; a shorter passage is one itself) are compared: the longest common runs that do not overlap marked words are marked,
longest first, found by running Karp-Rabin at falling lengths down to ``tile``. A document is
contaminated by a passage when the marked words are at least ``share`` of the passage, in any order.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwell.llm.arrow import Out, rows_of
from feedwell.llm.chunks import by_size
from feedwell.llm.words import FoldedWords, grams

#: Passages up to this many rows and characters together go to every task; larger tables are joined.
MOST_ITEMS, MOST_CHARS = 200_000, 32 << 20

_HITS = "doc_id long, item_id long, n_words long, covered long, coverage double, tiles array<struct<doc_word:int,item_word:int,words:int>>"
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int64()), ("covered", pa.int64()),
    ("coverage", pa.float64()),
    ("tiles", pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())]))),
])


def _matches(text: np.ndarray, item: np.ndarray, free_text: np.ndarray, free_item: np.ndarray, size: int) -> list:
    """Maximal common runs of at least ``size`` unmarked words, as (length, item start, text start)."""
    own = _unmarked_runs(free_item, size)
    there = _unmarked_runs(free_text, size)
    if not len(own) or not len(there):
        return []
    item_hash, text_hash = grams(item, size)[own], grams(text, size)[there]
    common = np.isin(text_hash, item_hash)
    there, text_hash = there[common], text_hash[common]
    order = np.argsort(item_hash, kind="stable")
    own, item_hash = own[order], item_hash[order]
    low, high = np.searchsorted(item_hash, text_hash, "left"), np.searchsorted(item_hash, text_hash, "right")
    found, seen = [], set()
    for t, a, b in zip(there.tolist(), low.tolist(), high.tolist()):
        for i in own[a:b].tolist():
            if (i - 1, t - 1) in seen:  # inside the run that began one word before
                seen.add((i, t))
                continue
            seen.add((i, t))
            length = size
            while (
                i + length < len(item) and t + length < len(text) and free_item[i + length] and free_text[t + length]
                and item[i + length] == text[t + length]
            ):
                length += 1
            if np.array_equal(item[i : i + size], text[t : t + size]):
                found.append((length, i, t))
    return found


def _unmarked_runs(free: np.ndarray, size: int) -> np.ndarray:
    """Positions at which ``size`` unmarked words begin."""
    if len(free) < size:
        return np.empty(0, np.int64)
    total = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(total[size:] - total[:-size] == size)


def tile(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: (text start, item start, length) of each tile."""
    free_text, free_item = np.ones(len(text), bool), np.ones(len(item), bool)
    tiles, size = [], max(least, len(item))
    while True:
        found = _matches(text, item, free_text, free_item, size)
        while found:
            again = False
            for length, i, t in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
                if free_item[i : i + length].all() and free_text[t : t + length].all():
                    free_item[i : i + length] = free_text[t : t + length] = False
                    tiles.append((t, i, length))
                    again = True
            # What a longer tile has cut short may still hold runs of this size.
            found = _matches(text, item, free_text, free_item, size) if again else []
        if size == least or not free_item.any():
            return sorted(tiles)
        size = max(least, size // 2)


class _Index:
    """Seeds of a bounded set of passages."""

    def __init__(self, items: Iterable[tuple], least: int):
        words = FoldedWords()
        self.items = [(key, words.of(text or "")) for key, text in items]
        short = [(key, w) for key, w in self.items if 0 < len(w) < least]
        self.items = [(key, w) for key, w in self.items if len(w) >= least]
        seeds = [grams(w, least) for _, w in self.items]
        sizes = [len(s) for s in seeds]
        hashes = np.concatenate([np.empty(0, np.uint64), *seeds])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owner = np.repeat(np.arange(len(seeds)), sizes)[order]
        self.place = np.concatenate([np.empty(0, np.int64), *(np.arange(n) for n in sizes)])[order]
        # A quick test of the hashes' low bits spares most lookups.
        self.bits = 16 + max(0, int(len(hashes)).bit_length() - 13)
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(self.hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)] = True
        # Shorter passages by their number of words: hashes, ascending, and whose they are.
        self.short = {}
        for size in sorted({len(w) for _, w in short}):
            own = [n for n, (_, w) in enumerate(short) if len(w) == size]
            hashes = np.concatenate([grams(short[n][1], size) for n in own])
            order = np.argsort(hashes, kind="stable")
            self.short[size] = hashes[order], np.array(own)[order] + len(self.items)
        self.items += short

    def candidates(self, words: np.ndarray, least: int, share: float) -> list[int]:
        """Passages whose seeds in these words could cover enough of them."""
        return self._seeded(grams(words, least), least, share) + [
            n for size, (hashes, owners) in self.short.items() for n in owners[np.isin(hashes, grams(words, size))].tolist()]

    def _seeded(self, found: np.ndarray, least: int, share: float) -> list[int]:
        low = (found & np.uint64(len(self.maybe) - 1)).astype(np.int64)
        found = np.unique(found[self.maybe[low]])
        a, b = np.searchsorted(self.hashes, found, "left"), np.searchsorted(self.hashes, found, "right")
        a, n = a[b > a], (b - a)[b > a]
        if not len(a):
            return []
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        owners, places = self.owner[at], self.place[at]
        kept = []
        for owner in np.unique(owners).tolist():
            size = len(self.items[owner][1])
            covered = np.zeros(size + 1, np.int64)
            starts = places[owners == owner]
            covered[starts] += 1
            np.subtract.at(covered, np.minimum(starts + least, size), 1)
            if (np.cumsum(covered[:size]) > 0).sum() >= share * size:
                kept.append(owner)
        return kept


def contaminated(
    docs: DataFrame, items: DataFrame, least: int = 5, share: float = 0.8,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and passage in it: words of the passage, those covered, their share, the tiles.

    A passage of fewer than ``least`` words is found as a whole run; one without words is not. Null and empty texts match nothing;
    repeated documents are reported as often as they occur, a passage that occurs twice in ``items``
    likewise; empty tables give no rows; other columns take no part.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    size = items.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    if size.n <= MOST_ITEMS and (size.chars or 0) <= MOST_CHARS:
        return _with_all(docs, [tuple(r) for r in items.collect()], least, share)
    return _with_joined(docs, items, least, share)


def _hit(key, words: np.ndarray, item: tuple, least: int, share: float) -> tuple | None:
    item_id, passage = item
    tiles = tile(words, passage, min(least, len(passage)))
    covered = sum(length for _, _, length in tiles)
    if covered < share * len(passage):
        return None
    named = [{"doc_word": t, "item_word": i, "words": n} for t, i, n in tiles]
    return key, item_id, len(passage), covered, covered / len(passage), named


def _with_all(docs: DataFrame, items: list[tuple], least: int, share: float) -> DataFrame:
    """Every task holds the seeds of all passages; documents are not shuffled."""

    def run(batches):
        index, words, out = _Index(items, least), FoldedWords(), Out(_SCHEMA)
        for group in by_size(rows_of(batches, "doc_id", "text"), 1):
            for (key, _), own in zip(group, words.many([t or "" for _, t in group])):
                for owner in index.candidates(own, least, share):
                    if (hit := _hit(key, own, index.items[owner], least, share)) and out.add(hit):
                        yield out.batch()
        yield out.batch()

    return docs.mapInArrow(run, _HITS)


def _with_joined(docs: DataFrame, items: DataFrame, least: int, share: float) -> DataFrame:
    """Seeds of documents and passages meet by their hash; then each pair is tiled."""
    seed_schema = pa.schema([("at", pa.int64()), ("seed", pa.int64())])
    place_schema = pa.schema([
        ("of", pa.int64()), ("seed", pa.int64()), ("words", pa.int64()), ("size", pa.int64()), ("places", pa.list_(pa.int64()))])

    def short_sizes(batches):
        words = FoldedWords()
        found = {len(words.of(text)) for (text,) in rows_of(batches, "text")}
        yield pa.RecordBatch.from_arrays([pa.array([n for n in found if 0 < n < least], pa.int64())], ["size"])

    def seeds(batches):
        words, out = FoldedWords(), Out(seed_schema, rows=1 << 16)
        for key, text in rows_of(batches, "at", "text"):
            own = words.of(text)
            for seed in np.unique(np.concatenate([grams(own, n) for n in sizes])).view(np.int64).tolist():
                if out.add((key, seed)):
                    yield out.batch()
        yield out.batch()

    def places(batches):
        words, out = FoldedWords(), Out(place_schema, rows=1 << 14)
        for key, text in rows_of(batches, "of", "text"):
            own = words.of(text)
            if not (size := min(least, len(own))):
                continue
            found, at = np.unique(grams(own, size), return_inverse=True)
            order = np.argsort(at, kind="stable")
            ends = np.cumsum(np.bincount(at))
            for seed, where in zip(found.view(np.int64).tolist(), np.split(order, ends[:-1])):
                if out.add((key, seed, len(own), size, where), 8 * len(where)):
                    yield out.batch()
        yield out.batch()

    def tiled(batches):
        words, out = FoldedWords(), Out(_SCHEMA)
        for key, text, item_id, passage in rows_of(batches, "doc_id", "text", "item_id", "passage", step=64):
            if (hit := _hit(key, words.of(text), (item_id, words.of(passage)), least, share)) and out.add(hit):
                yield out.batch()
        yield out.batch()

    # Texts by their own hash, so that repeated ids and rows do no harm.
    texts = docs.filter("text is not null").withColumn("at", F.xxhash64("text"))
    passages = items.filter("text is not null").withColumn("of", F.xxhash64("text"))
    wanted = passages.select("of", "text").dropDuplicates(["of"])
    # At most ``least`` different numbers of words.
    sizes = [least, *(r.size for r in wanted.select("text").mapInArrow(short_sizes, "size long").distinct().collect())]
    own = texts.select("at", "text").dropDuplicates(["at"]).mapInArrow(seeds, "at long, seed long")
    wanted = wanted.mapInArrow(places, "of long, seed long, words long, size long, places array<long>")
    pairs = own.join(wanted, "seed").groupBy("at", "of").agg(
        F.any_value("words").alias("words"), F.any_value("size").alias("size"),
        F.array_sort(F.flatten(F.collect_list("places"))).alias("places"))
    # Words of the passage under common seeds: each seed adds what reaches beyond the one before.
    after = F.transform("places", lambda p, n: F.least(
        F.col("size"), F.coalesce(F.try_element_at("places", (n + 2).cast("int")) - p, F.col("size"))))
    covered = F.aggregate(after, F.lit(0).cast("long"), lambda total, n: total + n)
    pairs = pairs.filter(covered >= F.lit(float(share)) * F.col("words")).select("at", "of")
    joined = texts.join(pairs, "at").join(passages.withColumnRenamed("text", "passage"), "of")
    return joined.select("doc_id", "text", "item_id", "passage").mapInArrow(tiled, _HITS)
