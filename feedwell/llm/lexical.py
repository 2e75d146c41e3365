"""The best documents for each query text by a weighted sum over shared terms, found by best positions.

Each block of documents is a set of impact lists: for a term, the documents that hold it with what it
adds to their score, greatest first. For a query the lists of its terms are read from the top; each
document met is scored at once by direct access to its other lists, and its place in every list is
marked as seen. The *best position* of a list is the end of its seen run from the top: a document not
yet met lies below it in every list, so the sum of the impacts there bounds its score. Reading stops
when that bound is strictly below the k-th best score, so that ties are decided by the ids. Places seen
by direct access move best positions beyond what was read, which stops sooner than a bound by the last
places read.

The score of a document is the sum over the query's terms, repeats included, of

    w * ((10**9 * tf) div (1000 * tf + 12 * m)),  w = floor(1000 * ln((2N + 2) / (2df + 1))),
    m = 100 - 25 + ((25 * n * N) div L),

with N documents that hold a term, L terms in them together, n terms in this one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedwell.llm.arrow import Out, rows_of
from feedwell.llm.shared import Scratch

#: Results per query.
BEST = 20
#: Documents and postings of a block: what a task holds at once. One document is never cut.
BLOCK_ROWS, BLOCK_POSTINGS = 16_384, 2_000_000
#: Characters of query texts that are searched in one pass over the documents; more queries take more passes.
QUERY_CHARS = 4_000_000
#: Places read from every list at once, at first; doubled each time.
STEP = 32

#: ASCII letters and digits, in lower case, and bytes of other characters make terms; all else parts them.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Corpus:
    """What weights need of the whole table: documents with a term, all their terms, and documents per query term."""

    documents: int
    length: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.floor(1000 * np.log((2 * self.documents + 2) / (2 * self.df + 1))).astype(np.int64)


class _Lists:
    """The impact lists of a block of documents, whose postings are ordered by document."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, corpus: Corpus):
        m = 100 - 25 + (25 * n * corpus.documents) // max(corpus.length, 1)
        impact = corpus.weights()[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(corpus.df) + 1))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order)) - self.starts[term[order]]
        # Direct access: of each document its terms, what they add, and their places in the lists.
        self.own_term, self.own_impact, self.own_place = term, impact, place
        self.own_starts = np.searchsorted(doc, np.arange(len(n) + 1))

    def _direct(self, docs: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The postings of the documents that are of the terms: number of document, number of term, posting."""
        counts = self.own_starts[docs + 1] - self.own_starts[docs]
        ends = np.cumsum(counts)
        take = np.arange(ends[-1]) + np.repeat(self.own_starts[docs] - (ends - counts), counts)
        which = np.minimum(np.searchsorted(terms, self.own_term[take]), len(terms) - 1)
        held = terms[which] == self.own_term[take]
        return np.repeat(np.arange(len(docs)), counts)[held], which[held], take[held]

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores: all that are among the k best of this block and score ``least`` or more, and others.

        ``terms`` ascend; ``times`` is how often the query holds each.
        """
        sizes = self.starts[terms + 1] - self.starts[terms]
        terms, times, sizes = terms[sizes > 0], times[sizes > 0], sizes[sizes > 0]
        firsts, best = self.starts[terms], np.zeros(len(terms), np.int64)
        # One place more than the list, which is never seen.
        seen = [np.zeros(n + 1, bool) for n in sizes]
        met = np.zeros(len(self.own_starts) - 1, bool)
        docs, scores, read, step = np.empty(0, np.int64), np.empty(0, np.int64), 0, STEP
        while len(terms):
            new = np.unique(np.concatenate([self.doc[f + min(read, n) : f + min(read + step, n)] for f, n in zip(firsts, sizes)]))
            new = new[~met[new]]
            met[new] = True
            if len(new):
                owner, which, take = self._direct(new, terms)
                score = np.add.reduceat(times[which] * self.own_impact[take], np.searchsorted(owner, np.arange(len(new))))
                docs, scores = np.concatenate([docs, new]), np.concatenate([scores, score])
                order = np.argsort(which, kind="stable")
                cuts = np.searchsorted(which[order], np.arange(len(terms) + 1))
                places = self.own_place[take[order]]
                for i in range(len(terms)):
                    seen[i][places[cuts[i] : cuts[i + 1]]] = True
                    best[i] += int(np.argmin(seen[i][best[i] :]))
            read, step = read + step, step * 2
            kth = int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0
            # Lists that are seen to their end hold no document that is not met.
            below = int((times * self.impact[firsts + best - 1])[best < sizes].sum())
            if below == 0 or below < max(kth, least):
                break
        keep = (scores > 0) & (scores >= least)
        return docs[keep], scores[keep]


class _Search:
    """The k best documents of each query over the blocks of one task."""

    def __init__(self, queries: list[tuple[np.ndarray, np.ndarray]], corpus: Corpus, k: int):
        self.queries, self.corpus, self.k = queries, corpus, k
        self.ids = [np.empty(0, object)] * len(queries)
        self.scores = [np.empty(0, np.int64)] * len(queries)

    def add(self, ids: list, n: list, terms: list[bytes], tfs: list[bytes]) -> None:
        sizes = np.fromiter((len(t) // 4 for t in terms), np.int64, len(terms))
        lists = _Lists(
            np.array(n, np.int64), np.repeat(np.arange(len(n)), sizes), np.frombuffer(b"".join(terms), "<i4").astype(np.int64),
            np.frombuffer(b"".join(tfs), "<i4").astype(np.int64), self.corpus)
        keys = np.array([*ids, None], object)[:-1]
        for q, (own, times) in enumerate(self.queries):
            least = int(self.scores[q][-1]) if len(self.scores[q]) == self.k else 0
            docs, scores = lists.best(own, times, self.k, least)
            if not len(docs):
                continue
            all_ids, all_scores = np.concatenate([self.ids[q], keys[docs]]), np.concatenate([self.scores[q], scores])
            if len(all_scores) > 2 * self.k:
                # Equal scores are decided by ids, so all that reach the k-th score are sorted.
                reach = all_scores >= np.partition(all_scores, -self.k)[-self.k]
                all_ids, all_scores = all_ids[reach], all_scores[reach]
            order = sorted(range(len(all_ids)), key=lambda i: (-all_scores[i], all_ids[i] is None, all_ids[i] or 0))[: self.k]
            self.ids[q], self.scores[q] = all_ids[order], all_scores[order]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for q in range(len(self.queries)):
            yield from ((q, i, int(s)) for i, s in zip(self.ids[q], self.scores[q]))


def _postings(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """doc_id, all terms of the document, and its query terms with their counts as little-endian 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tfs", pa.binary())])

    def run(batches):
        out = Out(schema)
        for key, text in rows_of(batches, "doc_id", "text", step=64):
            words = terms_of(text)
            counts = Counter(words)
            held = sorted((number[t], counts[t]) for t in counts.keys() & number.keys())
            pairs = np.array(held, "<i4").reshape(-1, 2)
            if out.add((key, len(words), pairs[:, 0].tobytes(), pairs[:, 1].tobytes()), 8 * len(pairs)):
                yield out.batch()
        yield out.batch()

    return docs.mapInArrow(run, "doc_id long, n long, terms binary, tfs binary")


def _corpus(postings: DataFrame, size: int) -> Corpus:
    """Sums over all documents; what comes to the driver is one number per query term of a pass."""

    def count(batches):
        found = np.zeros(size, np.int64)
        for (raw,) in rows_of(batches, "terms"):
            found[np.frombuffer(raw, "<i4")] += 1
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(found[held])], names=["term", "df"])

    whole = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = np.zeros(size, np.int64)
    counts = postings.filter("length(terms) > 0").select("terms").mapInArrow(count, "term long, df long")
    for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    return Corpus(whole.documents, whole.length, df)


def _passes(queries: DataFrame, query_id: str, text: str, most: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """The queries in groups that reach ``most`` characters; the driver holds one group."""
    held, size = [], 0
    for row in queries.select(F.col(query_id).cast("long"), text).toLocalIterator():
        held.append((row[0], Counter(terms_of(row[1]))))
        size += len(row[1] or "")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(
    docs: DataFrame, queries: DataFrame, scratch: Scratch, k: int = BEST, query_chars: int = QUERY_CHARS,
    doc_id: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """item_id, rank from 1, doc_id and score of the k best documents with a score above 0 of each query row.

    Equal scores go by ascending id, null last. Null and empty texts, of documents or queries, match
    nothing; rows that repeat are documents, and queries, of their own; empty tables give no rows;
    other columns take no part.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = [_pass(rows, group, scratch, k) for group in _passes(queries, query_id, query_text, query_chars)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _pass(rows: DataFrame, group: list[tuple[int | None, Counter]], scratch: Scratch, k: int) -> DataFrame:
    number = {t: n for n, t in enumerate(sorted({t for _, own in group for t in own}))}
    postings = scratch.table(_postings(rows, number))
    corpus = _corpus(postings, len(number))
    queries = []
    for _, own in group:
        pairs = np.array(sorted((number[t], n) for t, n in own.items()), np.int64).reshape(-1, 2)
        queries.append((pairs[:, 0], pairs[:, 1]))

    def run(batches):
        task = _Search(queries, corpus, k)
        for block in _blocks(rows_of(batches, "doc_id", "n", "terms", "tfs")):
            task.add(*map(list, zip(*block)))
        found = list(task.rows())
        for n in range(0, len(found), 8192):
            q, ids, scores = zip(*found[n : n + 8192])
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["q", "doc_id", "score"])

    best = postings.filter("length(terms) > 0").mapInArrow(run, "q int, doc_id long, score long")
    # Two steps, so that no task ranks what all others found for a query.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for by in ([F.col("q"), F.pmod(F.xxhash64("doc_id"), F.lit(64))], [F.col("q")]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
    ids = rows.sparkSession.createDataFrame([(q, i) for q, (i, _) in enumerate(group)], "q int, item_id long")
    return best.join(ids, "q").select("item_id", "rank", "doc_id", "score")


def _blocks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) // 4
        if len(held) >= BLOCK_ROWS or size >= BLOCK_POSTINGS:
            yield held
            held, size = [], 0
    if held:
        yield held
