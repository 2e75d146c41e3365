"""Quality of documents by how well two dictionaries compress them, one of good and one of bad text.

A text is cut into short blocks, and zstandard compresses each block twice, with a dictionary made
from blocks of good documents and with one from bad ones. Text that looks like the good ones comes
out smaller with the first. The score is a logistic function of the difference

    x = (bytes with the bad dictionary - bytes with the good one) / bytes of the text,

whose two numbers are fitted on labelled documents that neither dictionary was made from. Blocks
keep the difference comparable between short and long texts, which otherwise compress themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwell.llm.arrow import Out, rows_of
from feedwell.llm.shared import Scratch

#: Labelled documents used, at most about so many of each label: half for the dictionaries, half for the score.
SAMPLE = 8_000
#: Blocks that a dictionary is made from, at most; bytes of a block, of a dictionary; zstandard's level.
BLOCKS, BLOCK, DICTIONARY, LEVEL = 8_000, 256, 64 << 10, 3
#: Least score of a document that is predicted to be good.
GOOD = 0.7


@dataclass
class QualityModel:
    """Two dictionaries and the logistic function of the difference; without dictionaries every score is equal."""

    good: bytes
    bad: bytes
    slope: float
    bias: float

    def column(self, text: str) -> Column:
        """The score of a text, as a column beside any others."""
        model = self

        @F.pandas_udf("double")
        def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            sizes = _Sizes(model)
            for part in parts:
                yield pd.Series([model._logistic(*sizes.of(t)) for t in part], dtype="float64")

        return score(F.col(text))

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """doc_id, n_bytes, good_bytes, bad_bytes, score and predicted of every row.

        Null and empty texts have no difference and the score of that; null ids stay and repeated rows
        are kept; an empty table gives no rows; other columns take no part.
        """
        model = self
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("good_bytes", pa.int64()), ("bad_bytes", pa.int64()),
            ("score", pa.float64()), ("predicted", pa.int32()),
        ])

        def run(batches):
            sizes, out = _Sizes(model), Out(schema)
            for key, own in rows_of(batches, "doc_id", "text", step=64):
                found = sizes.of(own)
                value = model._logistic(*found)
                if out.add((key, *found, value, int(value >= GOOD))):
                    yield out.batch()
            yield out.batch()

        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        return rows.mapInArrow(
            run, "doc_id long, n_bytes long, good_bytes long, bad_bytes long, score double, predicted int")

    def _logistic(self, n_bytes: int, good: int, bad: int) -> float:
        return float(1 / (1 + np.exp(-(self.slope * (bad - good) / max(n_bytes, 1) + self.bias))))


class _Sizes:
    """Bytes of a text, and of its blocks compressed with either dictionary."""

    def __init__(self, model: QualityModel):
        self.compress = [_compressor(d) for d in (model.good, model.bad)]

    def of(self, text: str | None) -> tuple[int, int, int]:
        data = (text or "").encode("utf-8", "surrogatepass")
        blocks = _blocks(data)
        good, bad = (sum(len(c(b)) for b in blocks) for c in self.compress)
        return len(data), good, bad


def _blocks(data: bytes) -> list[bytes]:
    return [data[n : n + BLOCK] for n in range(0, len(data), BLOCK)]


def _compressor(dictionary: bytes):
    own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False).compress


def make_dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; of samples too few to train on, their own bytes."""
    if sum(map(len, samples)) > 4 * size:
        return zstandard.train_dictionary(size, samples).as_bytes()
    return b"".join(samples)[-size:]


def _sample_blocks(rows: DataFrame, label: int, most: int) -> list[bytes]:
    """Distinct blocks of the documents with the label, chosen and ordered by a hash."""

    def cut(batches):
        for batch in batches:
            for text in batch.column(0):
                found = _blocks((text.as_py() or "").encode("utf-8", "surrogatepass"))
                for n in range(0, len(found), 4096):
                    yield pa.RecordBatch.from_pydict({"block": pa.array(found[n : n + 4096], pa.binary())})

    blocks = rows.filter(F.col("label") == label).select("text").mapInArrow(cut, "block binary").distinct()
    return [bytes(r.block) for r in blocks.orderBy(F.xxhash64("block"), "block").limit(most).collect()]


def fit_quality(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE, blocks: int = BLOCKS,
    doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
) -> QualityModel:
    """A model from labelled documents: about ``sample`` of each label, chosen by a hash of the id.

    A dictionary is made from at most ``blocks`` blocks. Rows without a label, an id or a document are
    left out; an id with several labels counts as bad if one says so; copies of a text count once.
    Without both labels nothing is learnt: every score is 0.5.
    """
    nothing = QualityModel(b"", b"", 0.0, 0.0)
    known = labels.select(F.col(doc_id).alias("doc_id"), (F.col(quality) > 0).cast("int").alias("label")).dropna()
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return nothing
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    rate = F.when(F.col("label") == 1, sample / counts[1]).otherwise(sample / counts[0])
    # About twice ``sample`` ids of two numbers each: a bounded broadcast.
    chosen = F.broadcast(known.filter(part < rate))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, "doc_id")
    rows = rows.groupBy(F.xxhash64("text").alias("key")).agg(F.any_value("text").alias("text"), F.min("label").alias("label"))
    rows = scratch.table(rows.select("text", "label", (F.pmod("key", F.lit(2)) == 0).alias("first")))
    first, second = rows.filter("first"), rows.filter("not first")
    good, bad = (make_dictionary(_sample_blocks(first, label, blocks)) for label in (1, 0))
    if not good or not bad:
        return nothing
    model = QualityModel(good, bad, 1.0, 0.0)
    held = model.score(second.withColumn("label", F.col("label").cast("long")), "label").collect()
    label = np.array([r.doc_id for r in held], float)
    if not 0 < label.sum() < len(label):
        return nothing
    x = np.array([(r.bad_bytes - r.good_bytes) / max(r.n_bytes, 1) for r in held])
    prior = counts[1] / (counts[0] + counts[1])
    slope, bias = _calibrate(x, label, np.where(label > 0, prior / label.mean(), (1 - prior) / (1 - label.mean())))
    return QualityModel(good, bad, slope, bias)


def _calibrate(x: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and bias of greatest likelihood by Newton's method, on x scaled to unit spread."""
    spread = x.std() or 1.0
    rows = np.stack([x / spread, np.ones_like(x)], axis=1)
    params = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ params, -30, 30)))
        slope = rows.T @ (weight * (p - label)) + ridge * params
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        # A long step may overshoot where the labels are nearly parted.
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        params = params - step
        if np.abs(step).max() < 1e-10:
            break
    return float(params[0] / spread), float(params[1])
