"""Packs documents, in order, into sequences of at most ``window`` tokens.

Documents in ascending order form one stream of tokens; windows cut it. Candidate cuts are the
ends of documents (free), of sentences and lines (a small penalty), and inside sentences (a larger
one): a whole window after each of those ends, and every ``STEP`` tokens of sentences longer than
``LONG``. Dynamic programming takes the cuts with the
least padding plus penalties: with f(i) the least cost up to cut i,

    f(j) = penalty(j) + min over j - window <= i < j of f(i) + window - (j - i),

so the best i minimises f(i) + i over a sliding range, which a monotone queue gives in constant
time. Windows of certain lengths need no padding (``unpadded``) and are looked up by position.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwell.llm.arrow import Out, rows_of
from feedwell.llm.chunks import ByteTokens

#: Tokens of cutting at the end of a sentence or line, and inside a sentence.
SENTENCE_PENALTY, WORD_PENALTY = 2, 12
#: Sentences beyond this many tokens may be cut at every STEP tokens.
LONG, STEP = 256, 64
#: Tokens that are planned at once; the last window of a run is planned again with the next.
RUN_TOKENS = 1 << 18

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, ids binary"
)


def plan_cuts(ends: np.ndarray, penalties: np.ndarray, window: int, unpadded: tuple[int, ...]) -> list[int]:
    """The chosen cuts of a stream, the last included. ``ends`` ascend, gaps at most ``window``, the last is the end."""
    places = np.concatenate([[0], ends])
    exact = []  # per length without padding, the cut that lies just so far before each cut, or -1
    for length in unpadded:
        at = np.searchsorted(places, places - length)
        exact.append(np.where(places[at] == places - length, at, -1).tolist())
    where, cost, back = places.tolist(), [0], [0]
    keys, numbers, head = [0], [0], 0  # the queue: cost + position and number of cuts, both ascending
    for number, penalty in enumerate(penalties.tolist(), 1):
        position = where[number]
        while where[numbers[head]] < position - window:
            head += 1
        least, best = keys[head] + window - position, numbers[head]
        for before in exact:
            other = before[number]
            if other >= 0 and cost[other] <= least:
                least, best = cost[other], other
        least += penalty
        cost.append(least)
        back.append(best)
        key = least + position
        while len(keys) > head and keys[-1] >= key:
            keys.pop()
            numbers.pop()
        keys.append(key)
        numbers.append(number)
    cuts, number = [], len(where) - 1
    while number:
        cuts.append(where[number])
        number = back[number]
    return cuts[::-1]


def candidates(
    doc_ends: list[int], sentence_ends: list[np.ndarray], window: int
) -> tuple[np.ndarray, np.ndarray]:
    """All places where the stream may be cut, ascending, and the penalty of each."""
    docs = np.asarray(doc_ends, np.int64)
    soft = np.union1d(docs, np.concatenate([np.empty(0, np.int64), *sentence_ends]))
    gaps = np.diff(soft, prepend=0)
    far = np.flatnonzero(gaps > LONG)
    hard = [np.arange(soft[n] - gaps[n] + STEP, soft[n], STEP) for n in far]
    full = soft[: np.searchsorted(soft, docs[-1] - window)] + window
    places = np.union1d(soft, np.concatenate([full, *hard]))
    penalties = np.full(len(places), WORD_PENALTY)
    penalties[np.searchsorted(places, soft)] = SENTENCE_PENALTY
    penalties[np.searchsorted(places, docs)] = 0
    return places, penalties


class _Packer:
    """Turns ordered documents into pieces, a run at a time."""

    def __init__(self, window: int, unpadded: tuple[int, ...], first_sequence: int):
        self.window, self.unpadded, self.sequence = window, unpadded, first_sequence
        self.docs: list[tuple] = []  # (doc_id, its tokens, tokens before this run, doc_tokens)
        self.ends: list[np.ndarray] = []  # of sentences, within the document's tokens in this run
        self.size = 0

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.ends.append(ends)
        self.size += len(ids)
        if self.size >= RUN_TOKENS:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        sizes = np.array([len(d[1]) for d in self.docs], np.int64)
        doc_ends = np.cumsum(sizes)
        begins = doc_ends - sizes
        places, penalties = candidates(doc_ends.tolist(), [e + b for e, b in zip(self.ends, begins)], self.window)
        cuts = plan_cuts(places, penalties, self.window, self.unpadded)
        if not last:
            cuts.pop()  # the last window may yet be filled
        stop = cuts[-1] if cuts else 0
        bounds = np.union1d(doc_ends[doc_ends < stop], np.asarray(cuts, np.int64))
        firsts = np.concatenate([[0], bounds[:-1]])
        owners = np.searchsorted(doc_ends, firsts, side="right")
        windows = np.searchsorted(cuts, firsts, side="right")
        window_begins = np.concatenate([[0], np.asarray(cuts, np.int64)])
        for first, bound, owner, number in zip(firsts.tolist(), bounds.tolist(), owners.tolist(), windows.tolist()):
            doc_id, ids, before, total = self.docs[owner]
            begin = int(begins[owner])
            raw = ids[first - begin : bound - begin].tobytes()
            yield (
                doc_id, before + first - begin, bound - first, zlib.crc32(raw), total,
                self.sequence + number, first - int(window_begins[number]), raw,
            )
        self.sequence += len(cuts)
        self._keep(stop, begins, doc_ends)

    def _keep(self, stop: int, begins: np.ndarray, doc_ends: np.ndarray) -> None:
        """What lies behind the last cut begins the next run."""
        first = int(np.searchsorted(doc_ends, stop, side="right"))
        docs, ends = self.docs[first:], self.ends[first:]
        if docs:
            gone = max(0, stop - int(begins[first]))
            doc_id, ids, before, total = docs[0]
            docs[0] = (doc_id, ids[gone:], before + gone, total)
            ends[0] = ends[0][bisect_left(ends[0], gone + 1) :] - gone
        self.docs, self.ends, self.size = docs, ends, sum(len(d[1]) for d in docs)


def pack_sequences(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = 1024, unpadded: tuple[int, ...] | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: which tokens of which document lie where in which sequence, with the ids.

    Documents are packed in ascending id order (null first; equal ids by text). Each has its text's
    ids (null text: none) and ``end_id``, so that an empty one is a piece of one token. Repeated rows are packed each
    by itself; other columns take no part; an empty table gives no rows. Each task plans a range of
    ids by itself, which costs at most one padded window per task.
    ``unpadded`` are the lengths up to ``window`` that need no padding: by default the powers of two from a quarter of it.
    """
    if unpadded is None:
        unpadded = tuple(n for n in (window // 4, window // 2, window) if n and n & (n - 1) == 0)
    if window < max(LONG, STEP):
        raise ValueError(f"window must hold {max(LONG, STEP)} tokens at least")
    # A worker builds the tables of the vocabulary once, whatever the number of its tasks.
    vocabulary = docs.sparkSession.sparkContext.broadcast(ByteTokens(tokenizer))
    schema = pa.schema([
        *((c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
        ("ids", pa.binary()),
    ])

    def run(batches):
        tokens, out, end = vocabulary.value, Out(schema), np.array([end_id], "<u4")
        packer = _Packer(window, unpadded, TaskContext.get().partitionId() << 40)

        def pieces():
            for key, value in rows_of(batches, "doc_id", "text", step=64):
                ids = tokens.ids(value or "")
                yield from packer.add(key, np.concatenate([ids, end]).astype("<u4"), tokens.sentence_ends(ids))
            yield from packer.flush(last=True)

        for piece in pieces():
            if out.add(piece, len(piece[-1])):
                yield out.batch()
        yield out.batch()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, _PIECES)


def utilisation(pieces: DataFrame, window: int = 1024) -> DataFrame:
    """Sequences, tokens and padding of packed pieces; a length that is a power of two has no padding."""
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.expr("bit_count(n) = 1")
    return sizes.agg(
        F.count("*").alias("sequences"), F.sum("n").alias("tokens"),
        F.sum(F.when(power, 0).otherwise(window - F.col("n"))).alias("padding"),
    )
