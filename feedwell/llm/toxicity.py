"""Toxic documents and the sentences that make them so, learnt from labels of whole documents.

Multiple-instance learning: a sentence has a logistic score over the words and word beginnings in
it, and a document is toxic unless all its sentences are harmless (noisy-or),

    p(document) = 1 - product over sentences of (1 - sigmoid(w . x + b)).

Only document labels are needed to fit w and b; the sentence scores then show where the offence is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwell.llm.arrow import Out, rows_of
from feedwell.llm.chunks import ChunkTable, by_size, ragged
from feedwell.llm.shared import Scratch

#: Labelled documents that the model is fitted on, at most about so many of each label, and features it uses.
SAMPLE, FEATURES = 6_000, 3_000
#: Least documents, standard deviations and ratio by which a feature is more frequent in toxic documents.
LEAST_DOCS, LEAST_Z, LEAST_LIFT = 5, 4.0, 2.0
#: Lengths of word beginnings that are features.
BEGINNINGS = range(4, 8)
#: Penalty of squared weights, steps and step size of the fit.
RIDGE, STEPS, RATE = 2e-5, 400, 0.1

_PARTS = re.compile(r"[^\W\d_]+|[.!?…。\n]+")
_SENTENCE = re.compile(r"[^.!?…。\n]*[^\s.!?…。][^.!?…。\n]*[.!?…。]*")


def features(word: str) -> list[str]:
    """A case-folded word and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if n <= len(word))]


@dataclass
class ToxicityModel:
    """Weights by feature, and the score of a sentence without any."""

    weights: dict[str, float]
    bias: float

    def column(self, text: str) -> Column:
        """The score of a text, as a column beside any others."""
        weights, bias = self.weights, self.bias

        @F.pandas_udf("double")
        def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorer = _Scorer(weights, bias)
            for part in parts:
                groups = by_size(((t or "",) for t in part), 0)
                yield pd.Series([x for g in groups for x in scorer.many([t for (t,) in g])], dtype="float64")

        return score(F.col(text))

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """doc_id, score, predicted and the offending sentences (start, stop in code points, score).

        Null and empty texts are one harmless sentence; null ids stay and repeated rows are kept;
        an empty table gives no rows; other columns take no part.
        """
        weights, bias = self.weights, self.bias
        sentence = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())])
        schema = pa.schema([
            ("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("sentences", pa.list_(sentence)),
        ])

        def run(batches):
            scorer, out = _Scorer(weights, bias), Out(schema)
            for group in by_size(rows_of(batches, "doc_id", "text"), 1):
                for (key, own), score in zip(group, scorer.many([t or "" for _, t in group])):
                    toxic = score >= 0.5
                    if out.add((key, score, int(toxic), scorer.sentences(own) if toxic else [])):
                        yield out.batch()
            yield out.batch()

        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        kind = "array<struct<start:int,stop:int,score:double>>"
        return rows.mapInArrow(run, f"doc_id long, score double, predicted int, sentences {kind}")


class _Features:
    """Feature numbers of texts in order, with -1 at the ends of sentences."""

    def __init__(self, names: list[str]):
        self.number = {name: n for n, name in enumerate(names)}
        self.table = ChunkTable(np.int32)

    def _encode(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        return ragged([self._of(c.casefold()) for c in chunks], np.int32)

    def _of(self, chunk: str) -> list[int]:
        found = []
        for part in _PARTS.findall(chunk):
            if part[0].isalpha():
                found += [n for f in features(part) if (n := self.number.get(f)) is not None]
            else:
                found.append(-1)
        return found

    def many(self, texts: list[str]) -> list[np.ndarray]:
        parts = [t.split(" ") for t in texts]
        values, sizes = self.table.rows([c for p in parts for c in p], self._encode)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([len(p) for p in parts])]
        return np.split(values, ends[:-1])


def _log_harmless(score: np.ndarray) -> np.ndarray:
    """ln(1 - sigmoid(score))"""
    return -np.logaddexp(0.0, score)


class _Scorer:
    def __init__(self, weights: dict[str, float], bias: float):
        self.features = _Features(list(weights))
        self.weights, self.bias = np.array(list(weights.values()) or [0.0]), bias

    def _document(self, found: np.ndarray) -> float:
        number = np.cumsum(found < 0)
        hits = found >= 0
        sums = np.bincount(number[hits], self.weights[found[hits]])
        with_hits = np.bincount(number[hits]) > 0
        total = (int(number[-1]) if len(number) else 0) + 1
        harmless = _log_harmless(sums[with_hits] + self.bias).sum()
        harmless += (total - with_hits.sum()) * _log_harmless(np.float64(self.bias))
        return float(-np.expm1(harmless))

    def many(self, texts: list[str]) -> list[float]:
        return [self._document(found) for found in self.features.many(texts)]

    def sentences(self, text: str) -> list[dict]:
        """The sentences of a toxic text that are likelier offending than not; else the likeliest one."""
        found = []
        for m in _SENTENCE.finditer(text):
            hits = [n for n in self.features._of(m[0].casefold()) if n >= 0]
            score = float(1 / (1 + np.exp(-(self.bias + self.weights[hits].sum()))))
            found.append({"start": m.start(), "stop": m.end(), "score": score})
        certain = [s for s in found if s["score"] >= 0.5]
        return certain or sorted(found, key=lambda s: -s["score"])[:1]


def _feature_counts(sample: DataFrame) -> DataFrame:
    """In how many toxic and in how many other documents each feature occurs."""

    def run(batches):
        toxic, clean = Counter(), Counter()
        for text, label in rows_of(batches, "text", "toxic"):
            words = {p for p in _PARTS.findall((text or "").casefold()) if p[0].isalpha()}
            (toxic if label else clean).update({f for w in words for f in features(w)})
        names = list(toxic | clean)
        for start in range(0, len(names), 1 << 16):
            part = names[start : start + (1 << 16)]
            yield pa.RecordBatch.from_pydict({
                "feature": part, "toxic": [toxic[f] for f in part], "clean": [clean[f] for f in part]})

    counts = sample.select("text", "toxic").mapInArrow(run, "feature string, toxic long, clean long")
    return counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _telling(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """The features that are most surely more frequent in toxic documents, FEATURES at most."""
    t, c = F.col("toxic") / toxic, F.col("clean") / clean
    both = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    z = (t - c) / F.sqrt(both * (1 - both) * (1 / toxic + 1 / clean))
    found = _feature_counts(sample).filter(F.col("toxic") >= LEAST_DOCS).withColumn("z", z)
    found = found.filter((F.col("z") >= LEAST_Z) & (t >= LEAST_LIFT * c))
    return [r.feature for r in found.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()]


def _bags(sample: DataFrame, names: list[str]) -> list:
    """Per sample document: its label, how many sentences have no feature, and the features of the others."""

    def run(batches):
        index = _Features(names)
        out = Out(pa.schema([("toxic", pa.int32()), ("plain", pa.int64()), ("found", pa.binary())]))
        for group in by_size(rows_of(batches, "text", "toxic"), 0):
            for (_, label), found in zip(group, index.many([t or "" for t, _ in group])):
                number, hits = np.cumsum(found < 0), found >= 0
                ids, place = np.unique(number[hits], return_inverse=True)
                plain = (int(number[-1]) if len(number) else 0) + 1 - len(ids)
                pairs = np.stack([place, found[hits]], axis=1).astype("<i4").tobytes()
                if out.add((label, plain, pairs)):
                    yield out.batch()
        yield out.batch()

    return sample.select("text", "toxic").mapInArrow(run, "toxic int, plain long, found binary").collect()


def _fit(bags: list, size: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of greatest likelihood; documents weigh so that labels occur as in the corpus."""
    labels = np.array([b.toxic for b in bags], float)
    share = labels.mean()
    weight = np.where(labels > 0, prior / share, (1 - prior) / (1 - share)) / len(bags)
    pairs = [np.frombuffer(b.found, "<i4").reshape(-1, 2) for b in bags]
    counts = np.array([int(p[:, 0].max()) + 1 if len(p) else 0 for p in pairs])
    firsts = np.cumsum(counts) - counts
    sentence = np.concatenate([p[:, 0] + f for p, f in zip(pairs, firsts)])
    feature = np.concatenate([p[:, 1] for p in pairs])
    document = np.repeat(np.arange(len(bags)), counts)
    plain = np.array([b.plain for b in bags], float)
    total = int(counts.sum())

    params = np.zeros(size + 1)
    params[-1] = -6.0
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, b = params[:-1], params[-1]
        score = np.bincount(sentence, w[feature], total) + b
        harmless = np.bincount(document, _log_harmless(score), len(bags)) + plain * _log_harmless(b)
        harmless = np.minimum(harmless, -1e-12)
        # d(-log likelihood) / d(ln harmless), then through ln(1 - sigmoid) of each sentence.
        outer = weight * np.where(labels > 0, np.exp(harmless) / -np.expm1(harmless), -1.0)
        inner = -1 / (1 + np.exp(-score)) * outer[document]
        slope = np.append(np.bincount(feature, inner[sentence], size) + 2 * RIDGE * w, 0.0)
        slope[-1] = inner.sum() - (outer * plain).sum() / (1 + np.exp(-b))
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        params = params - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return params[:-1], float(params[-1])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE,
    doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
) -> ToxicityModel:
    """A model from labelled documents, fitted on about ``sample`` of each label, chosen by a hash of the id.

    Rows without a label, an id or a document are left out; an id with several labels counts as
    toxic if one says so. Without both labels nothing is learnt: every score is near 0.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), (F.col(toxic) > 0).cast("int").alias("toxic")).dropna()
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return ToxicityModel({}, -20.0)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    rate = F.when(F.col("toxic") == 1, sample / counts[1]).otherwise(sample / counts[0])
    # About twice ``sample`` ids of two numbers each: a bounded broadcast.
    chosen = F.broadcast(known.filter(part < rate))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, "doc_id")
    # A text with many copies would make all its words telling.
    rows = scratch.table(rows.groupBy(F.xxhash64("text")).agg(
        F.any_value("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"))
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel({}, -20.0)
    names = _telling(rows, sizes[1], sizes[0])
    if not names:
        return ToxicityModel({}, -20.0)
    weights, bias = _fit(_bags(rows, names), len(names), counts[1] / (counts[0] + counts[1]))
    return ToxicityModel(dict(zip(names, weights.tolist())), bias)
