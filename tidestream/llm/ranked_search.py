"""Ranked lexical search with the Best Position Algorithm.

Every document is scored for every query by the terms they share; a query's best documents are
wanted. Documents are read once: a task counts the terms of its documents that occur in a query,
and these counts are written. Then every task takes some thousand documents at a time, makes one
list per term with the documents in order of their impact, and searches the lists of each query:

* lists are read from the top, some positions of each at a time (sorted access);
* a document seen for the first time is scored at once from all lists (direct access), and its
  positions in those lists are marked as seen too;
* the best position of a list is the last of the seen positions that follow each other from the top
  without a gap. A document not seen in any list has at most the impact at the best position, or none if
  the whole list is seen, so the sum of these impacts bounds its score;
* the search stops when the bound is strictly below the k-th best score so far, so equal scores
  are never lost to the order of ids.

The k-th best score goes on from chunk to chunk of a task. Tasks return k rows per query at most, and
these are merged. Queries travel to the tasks in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidestream.llm.storage import small_batches, text_bytes
from tidestream.llm.words import Piece, distinct, pieces
from tidestream.session import stored

TOP = 10
BLOCK_BYTES = 4 << 20
CHUNK_POSTINGS = 2_000_000
CHUNK_DOCUMENTS = 50_000
FIRST_DEPTH = 16
MERGE_GROUPS = 64

# Bytes of terms: digits, letters and everything outside ASCII.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
_FOUND = "query long, doc_id long, score long"


def term_hashes(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term of every text, A-Z folded, and where each text begins among them."""
    starts, ends, first = piece.runs(_TERM[piece.data])
    return piece.hash_spans(starts, ends, fold_case=True), first


@dataclass
class Queries:
    """A block of queries: their numbers and ids, the terms of all, and how often each query has which."""

    numbers: list[int]
    vocabulary: np.ndarray  # sorted hashes
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def of(cls, numbers: list[int], texts: list[str]) -> Queries:
        lists = []
        for piece in pieces(pa.array(texts, pa.string())):
            hashes, first = term_hashes(piece)
            lists += [hashes[a:b] for a, b in zip(first, first[1:])]
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *lists]))
        each = [np.unique(np.searchsorted(vocabulary, hashes), return_counts=True) for hashes in lists]
        return cls(numbers, vocabulary, [t for t, _ in each], [r for _, r in each])


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Rows (doc_id, n, terms, counts) of documents with a term: how often each has which term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                hashes, first = term_hashes(piece)
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
                known = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                upto = np.concatenate([[0], np.cumsum(known)])[first]
                # A term's number and its text in one number, so that counting needs one sort.
                owner = np.repeat(np.arange(len(piece)), np.diff(upto))
                both, counts = np.unique((owner.astype(np.int64) << 32) | at[known], return_counts=True)
                begin = np.searchsorted(both >> 32, np.arange(len(piece) + 1)).astype(np.int32)
                terms = pa.ListArray.from_arrays(pa.array(begin), pa.array((both & 0xFFFFFFFF).astype(np.int32)))
                often = pa.ListArray.from_arrays(pa.array(begin), pa.array(counts.astype(np.int32)))
                n = np.diff(first).astype(np.int64)
                rows = [batch.column(0)[piece.rows], pa.array(n), terms, often]
                yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "n", "terms", "counts"]).filter(pa.array(n > 0))

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, _POSTINGS)


def term_weights(table: DataFrame, size: int, documents: int) -> np.ndarray:
    """The weight of every term of the vocabulary, from the number of documents that have it."""
    weights = np.zeros(size, np.int64)
    # One row per term of the vocabulary.
    for term, df in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    return weights


def impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term adds to the score of a document of so many terms in which it occurs so often."""
    if len(lengths) and 75 * int(lengths.max()) * documents >= 2**63:
        longer = np.array([75 * int(n) * documents // total for n in lengths], np.int64)
    else:
        longer = 75 * lengths * documents // max(total, 1)
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * (25 + longer)))


class Lists:
    """The impact lists of some documents: for every term its documents, highest impact first."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, terms: np.ndarray, impact: np.ndarray, size: int):
        self.ids, self.first, self.terms, self.impact = ids, first, terms, impact
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(first))
        order = np.lexsort((-impact, terms))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.owner, self.sorted_impact = owner[order], impact[order]
        self.begin = np.searchsorted(terms[order], np.arange(size + 1))
        self.repeats = np.zeros(size, np.int64)
        self.scored, self.seen = np.zeros(len(ids), bool), np.zeros(len(order), bool)

    def _score(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: scores of documents, and the places of their postings in the query's lists."""
        sizes = self.first[docs + 1] - self.first[docs]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(upto[-1]) + np.repeat(self.first[docs] - upto[:-1], sizes)
        times = self.repeats[self.terms[at]]
        return np.add.reduceat(self.impact[at] * times, upto[:-1]), self.place[at[times > 0]]

    def search(self, terms: np.ndarray, repeats: np.ndarray, best: Best) -> int:
        """Add the documents that belong to the best of a query; returns how many were scored."""
        begin, end = self.begin[terms], self.begin[terms + 1]
        filled = end > begin
        terms, repeats, begin, end = terms[filled], repeats[filled], begin[filled], end[filled]
        if not len(terms):
            return 0
        self.repeats[terms] = repeats
        position, read, depth, touched = begin.copy(), begin.copy(), FIRST_DEPTH, []
        while True:
            stop = np.minimum(read + depth, end)
            docs = np.unique(np.concatenate([self.owner[a:b] for a, b in zip(read, stop)]))
            docs = docs[~self.scored[docs]]
            if len(docs):
                self.scored[docs] = True
                scores, places = self._score(docs)
                self.seen[places] = True
                touched.append((docs, places))
                best.add(scores, self.ids[docs])
            read, depth = stop, depth * 2
            for k, (a, b) in enumerate(zip(position, end)):
                gap = int(np.argmin(self.seen[a:b])) if a < b else 0
                position[k] = b if a < b and self.seen[a + gap] else a + gap
            # The impact at the best position; nothing is left of a list that was seen whole.
            bound = int((repeats * np.where(position < end, self.sorted_impact[np.maximum(position - 1, begin)], 0)).sum())
            if bound < best.kth or (position == end).all():
                break
        self.repeats[terms] = 0
        for docs, places in touched:
            self.scored[docs] = False
            self.seen[places] = False
        return sum(len(docs) for docs, _ in touched)


class Best:
    """The best documents of a query so far: highest score first, then the smallest id, null ids last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros((0, 2), np.int64)

    @property
    def kth(self) -> int:
        """The k-th best score; 0, which no bound of a document with a score is below, if there are fewer."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        kept = scores >= max(self.kth, 1)
        scores, ids = np.concatenate([self.scores, scores[kept]]), np.concatenate([self.ids, ids[kept]])
        order = np.lexsort((ids[:, 1], ids[:, 0], -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]).astype(np.int64), column.flatten().to_numpy()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in chunks of bounded size."""
    held, documents, entries = [], 0, 0
    for batch in batches:
        held.append(batch)
        documents, entries = documents + len(batch), entries + len(batch.column(2).flatten())
        if documents >= CHUNK_DOCUMENTS or entries >= CHUNK_POSTINGS:
            yield pa.Table.from_batches(held)
            held, documents, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _search(queries: Queries, weights: np.ndarray, documents: int, total: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries.numbers]
        useful = [weights[t] > 0 for t in queries.terms]
        for table in _chunks(batches):
            doc_id, n, terms, counts = (c.combine_chunks() for c in table.columns)
            first, terms = _flat(terms)
            _, counts = _flat(counts)
            # Ids in their order, null ids after them.
            ids = np.stack([doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.int64), doc_id.fill_null(0).to_numpy()], axis=1)
            lengths = np.repeat(n.to_numpy(), np.diff(first))
            found = impacts(weights[terms], counts.astype(np.int64), lengths, documents, total)
            lists = Lists(ids, first, terms, found, len(weights))
            for mine, t, repeats, use in zip(best, queries.terms, queries.repeats, useful):
                lists.search(t[use], repeats[use], mine)
        number = np.repeat(np.array(queries.numbers, np.int64), [len(b.scores) for b in best])
        ids = np.concatenate([b.ids for b in best])
        scores = np.concatenate([b.scores for b in best])
        columns = [pa.array(number), pa.array(ids[:, 1], mask=ids[:, 0] > 0), pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])

    return run


def _search_block(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    table = stored(postings(docs, queries.vocabulary), "search-postings")
    documents, total = table.agg(F.count("*"), F.sum("n")).first()
    weights = term_weights(table, len(queries.vocabulary), documents)
    found = table.mapInArrow(_search(queries, weights, documents, total or 0, k), _FOUND)
    return stored(found, "search-found")


def search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """The `k` best documents of every query: item_id, rank (from 1), doc_id, score.

    `queries` has the columns item_id and text. All rows of `docs` with at least one term count as
    documents and are ranked: repeated rows each for itself, and rows without an id last among
    equal scores. Equal scores are in ascending order of doc_id. Null, empty and termless texts of
    either table match nothing and give no rows, and so do empty tables; documents with a score of 0 are
    left out. Very long texts are read whole, one at a time. Every row of `queries` is a query, also
    if its id is null or repeated. Other columns are not read.
    """
    numbered = stored(queries.select("item_id", "text").withColumn("query", F.monotonically_increasing_id()), "search-queries")
    blocks = max(1, math.ceil(text_bytes(numbered) / BLOCK_BYTES))
    found = None
    for block in range(blocks):
        mine = numbered.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).select("query", "text").collect()
        if mine:
            rows = _search_block(docs, Queries.of([r.query for r in mine], [r.text for r in mine]), k)
            found = rows if found is None else found.union(rows)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _FOUND)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # In two steps: tasks return k rows each, and there may be many tasks.
    some = Window.partitionBy("query", "group").orderBy(*order)
    grouped = found.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_GROUPS)))
    few = grouped.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k).drop("rank", "group")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(numbered.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
