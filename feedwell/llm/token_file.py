"""Token ids of documents in a compact binary file format, and back.

Ids are replaced by their rank in the corpus (0: most frequent), so that most take one byte. A
block holds whole documents: the ranks' bytes, least significant first and without leading
zeros, in one stream, and their lengths, two bits each, in a separate stream of control bytes.
Decoding looks the four lengths of a control byte up in a table and gathers the bytes with numpy.

The files are Parquet written by Spark, one row per block, on any storage that Spark reaches; a
task that is run again replaces its file. ``ranks`` is a second table of at most one row per id
of the vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwell.llm.arrow import Out, rows_of
from feedwell.llm.chunks import WordTokens, by_size, load_tokenizer
from feedwell.llm.shared import Scratch

#: Tokens after which a block is closed; a block holds whole documents.
BLOCK_TOKENS = 1 << 18

#: Bytes of each of the four values of a control byte, lowest bits first.
LENGTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3).astype(np.uint8) + np.uint8(1)

_TOKENS = "doc_id long, n_tokens long, ids_crc32 long, ids binary"
#: ``n_tokens`` of the row in which a task tells how often it met each id.
_COUNTS = -1
_BLOCKS = (
    "file_no int, block_no int, start_in_file long, n_tokens long, "
    "doc_ids array<long>, doc_sizes array<long>, control binary, data binary"
)
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    most = int(ranks.max(initial=0))
    width = 1 if most <= 0xFF else 2 if most <= 0xFFFF else 4
    ranks = np.ascontiguousarray(ranks, f"<u{width}")
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    own = codes[: len(ranks)]
    for bits in range(8, 8 * width, 8):
        own += ranks > (1 << bits) - 1
    data = ranks.view(np.uint8).reshape(-1, width)
    data = data[np.arange(width, dtype=np.uint8) <= own[:, None]]
    control = codes.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)
    return control.sum(axis=1, dtype=np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values behind ``pack``'s two streams."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    stream = np.frombuffer(data, np.uint8)
    starts = np.cumsum(lengths, dtype=np.int32 if len(stream) < 1 << 31 else np.int64)
    starts -= lengths
    values = stream[starts].astype(np.uint32)
    for byte in range(1, int(lengths.max(initial=1))):
        more = np.flatnonzero(lengths > byte)
        values[more] |= stream[starts[more] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


@dataclass
class TokenFiles:
    """Written blocks and ranks; ``read`` decodes them."""

    blocks: DataFrame
    ranks: DataFrame

    def read(self) -> DataFrame:
        """One row per document: doc_id, start, n_tokens, ids_crc32 of its decoded ids."""
        id_of = _id_of(self.ranks)
        # One row per file: where its ids begin among those of all files.
        sizes = {r.file_no: r.n for r in self.blocks.groupBy("file_no").agg(F.sum("n_tokens").alias("n")).collect()}
        before, begins = 0, {}
        for file_no in sorted(sizes):
            begins[file_no], before = before, before + sizes[file_no]

        def decode(batches):
            out = Out(pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]))
            names = ("file_no", "start_in_file", "n_tokens", "doc_ids", "doc_sizes", "control", "data")
            for file_no, start, n, doc_ids, doc_sizes, control, data in rows_of(batches, *names, step=4):
                ids = np.ascontiguousarray(id_of[unpack(control, data, n)])
                at = 0
                for doc_id, size in zip(doc_ids, doc_sizes):
                    crc = zlib.crc32(ids[at : at + size])
                    if out.add((doc_id, begins[file_no] + start + at, size, crc)):
                        yield out.batch()
                    at += size
            yield out.batch()

        return self.blocks.mapInArrow(decode, _READ)


def _id_of(ranks: DataFrame) -> np.ndarray:
    """Ids by rank; bounded by the vocabulary."""
    found = {r.rank: r.id for r in ranks.collect()}
    return np.array([found[n] for n in range(len(found))], "<u4")


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each whole text (null: empty) and ``end_id``, as little-endian unsigned integers of ``_width`` bytes.

    Rows that repeat are kept, each by itself; a null id stays null; other columns take no part. The
    checksum is that of 32-bit integers. A last row of each task has n_tokens -1 and counts by id.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        tokens, out, end = WordTokens(tokenizer), Out(schema), np.array([end_id], "<u4")
        counts, kind = np.zeros(size, np.int64), f"<u{width}"
        for group in by_size(rows_of(batches, "doc_id", "text"), 1):
            found = tokens.many([t or "" for _, t in group])
            for (key, _), ids in zip(group, found):
                ids = np.concatenate([ids, end]).astype("<u4")
                if out.add((key, len(ids), zlib.crc32(ids), ids.astype(kind).tobytes()), width * len(ids)):
                    yield out.batch()
            counts += np.bincount(np.concatenate(found), minlength=size)
            counts[end_id] += len(group)
        out.add((None, _COUNTS, 0, counts.astype("<i8").tobytes()))
        yield out.batch()

    size = max(load_tokenizer(tokenizer).get_vocab_size(), end_id + 1)
    width = _width(size)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _TOKENS)


def _width(size: int) -> int:
    """Bytes of an id below ``size``."""
    return 2 if size <= 1 << 16 else 4


def _counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs, from the tasks' own counts."""

    def run(batches):
        for (raw,) in rows_of(batches, "ids", step=16):
            found = np.frombuffer(raw, "<i8")
            seen = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], names=["id", "n"])

    rows = tokens.filter(F.col("n_tokens") == _COUNTS).select("ids")
    return rows.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, scratch: Scratch, doc_id: str = "doc_id", text: str = "text"
) -> TokenFiles:
    """Token files of all documents in ascending ``doc_id`` order (null first; equal ids by size and checksum).

    An empty table gives files without blocks. ``scratch`` keeps the files after its block.
    """
    tokens = scratch.table(tokenize(docs, tokenizer, end_id, doc_id, text))
    # The vocabulary bounds this list.
    counts = sorted(_counts(tokens).collect(), key=lambda r: (-r.n, r.id))
    ranks = scratch.result(docs.sparkSession.createDataFrame(
        [(n, r.id, r.n) for n, r in enumerate(counts)], "rank int, id long, n long").coalesce(1), "ranks")
    rank_of = np.zeros(max((r.id for r in counts), default=0) + 1, "<u4")
    for n, r in enumerate(counts):
        rank_of[r.id] = n

    kind = f"<u{_width(max(load_tokenizer(tokenizer).get_vocab_size(), end_id + 1))}"
    schema = pa.schema([
        ("file_no", pa.int32()), ("block_no", pa.int32()), ("start_in_file", pa.int64()), ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())),
        ("control", pa.binary()), ("data", pa.binary()),
    ])

    def blocks(rows) -> Iterator[tuple]:
        keys, held, size, start, block = [], [], 0, 0, 0
        file_no = TaskContext.get().partitionId()
        for key, raw in rows:
            keys.append(key)
            held.append(np.frombuffer(raw, kind))
            size += len(held[-1])
            if size >= BLOCK_TOKENS:
                yield (file_no, block, start, size, keys, [len(h) for h in held], *pack(rank_of[np.concatenate(held)]))
                keys, held, size, start, block = [], [], 0, start + size, block + 1
        if keys:
            yield (file_no, block, start, size, keys, [len(h) for h in held], *pack(rank_of[np.concatenate(held)]))

    def write(batches):
        out = Out(schema)
        for row in blocks(rows_of(batches, "doc_id", "ids", step=64)):
            if out.add(row, len(row[-1])):
                yield out.batch()
        yield out.batch()

    order = ["doc_id", "n_tokens", "ids_crc32"]
    rows = tokens.filter(F.col("n_tokens") != _COUNTS)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    return TokenFiles(scratch.result(ordered.mapInArrow(write, _BLOCKS), "blocks"), ranks)
