"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of (term, weight): its components that are not 0, by position. Queries and a block of candidates are each
inverted into one posting list per term; for each term that both have, the queries scatter query weight times posting weight into a dense array of
scores (queries x candidates of the block). Each block's k best are selected by numpy partition and merged with the best of the
blocks before, so a task holds one block of scores and k results a query; a window over the tasks' results merges them.

All queries meet all candidates. Queries travel in chunks, chosen by hash, of QUERY_CHUNK rows and QUERY_COMPONENTS components at most
in expectation. Chunks run one after the other: each is broadcast, makes one pass over the candidates, has its results
written, and is released, so driver and executors hold one chunk whatever the number of queries.

Defined results: vectors that are null or hold a null or non-finite component take no part; an empty vector has score 0 with all.
Missing components count as 0. Scores are exact whatever the weights' size: rows whose products might not fit in 64 bits are summed as Python
integers. Scores that don't fit in a long are clamped there, and tie. Scaled components beyond the largest double count as that. Ties go to the smaller vec_id, null vec_ids last;
a null vec_id is never a query. Rows that share a query's vec_id are each a query: the k best of all their pairs are ranked together, none of them with a row of that vec_id. Repeated candidates are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybeam.llm.common import materialise

SCALE, K, EVERY = 1024, 10, 100
QUERY_CHUNK, QUERY_COMPONENTS = 20_000, 4_000_000
#: Scores held at once by a task.
SCORES = 1 << 19
NO_ID = np.iinfo(np.int64).max
#: Products and sums of rows whose absolute weights sum up to less fit in 64 bits.
SMALL = float(1 << 31)
MOST = 2**63 - 1


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def weights(vectors: DataFrame, scale: int = SCALE, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """id long, weights array<double>: scale * component of the usable vectors; whoever reads them takes the floor, as a double holds it whole and a long may not."""
    largest = F.lit(float(np.finfo(float).max))
    scaled = lambda x: F.greatest(F.least(x.cast("double") * scale, largest), -largest)
    return vectors.filter(usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.transform(vector, scaled).alias("weights"))


class Rows:
    """Sparse rows by term: of each term, the numbers of the rows that have it and their weights."""

    def __init__(self, column: pa.ListArray):
        sizes = np.diff(column.offsets.to_numpy())
        flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(float))
        row = np.repeat(np.arange(len(sizes)), sizes)
        term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.n = len(sizes)
        self.norm = np.bincount(row, np.abs(flat), self.n) if len(flat) else np.zeros(self.n)
        keep = np.flatnonzero(flat)
        order = keep[np.argsort(term[keep], kind="stable")]
        self.row, self.weight, term = row[order], flat[order], term[order]
        self.terms, starts = np.unique(term, return_index=True)
        self.bounds = np.append(starts, len(term))

    def part(self, rows: np.ndarray) -> Rows:
        """The same of some rows, in their order."""
        out = object.__new__(Rows)
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        keep = place[self.row] >= 0
        out.n, out.norm, out.row, out.weight = len(rows), self.norm[rows], place[self.row[keep]], self.weight[keep]
        term = np.repeat(self.terms, np.diff(self.bounds))[keep]
        out.terms, starts = np.unique(term, return_index=True)
        out.bounds = np.append(starts, len(term))
        return out

    def as_type(self, kind: type) -> np.ndarray:
        return np.array([int(x) for x in self.weight.tolist()], object) if kind is object else self.weight.astype(kind)


def number_type(queries: Rows, candidates: Rows) -> type:
    """The least type of whole numbers that holds all weights, products and sums; Python's where none of the machine's does."""
    q, c = queries.norm.max(initial=0), candidates.norm.max(initial=0)
    if max(q, c) >= SMALL:
        return object
    return np.int32 if q * np.abs(candidates.weight).max(initial=0) < SMALL else np.int64


def spread(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, values.dtype)
    out[rows] = values
    return out


def accumulate(queries: Rows, candidates: Rows) -> np.ndarray:
    """Scores of all queries against all candidates of a block, term at a time."""
    kind = number_type(queries, candidates)
    mine, theirs, scores = queries.as_type(kind), candidates.as_type(kind), np.zeros((queries.n, candidates.n), kind)
    _, here, there = np.intersect1d(queries.terms, candidates.terms, assume_unique=True, return_indices=True)
    for i, j in zip(here.tolist(), there.tolist(), strict=True):
        a, b = slice(*queries.bounds[i : i + 2]), slice(*candidates.bounds[j : j + 2])
        rows, posting = queries.row[a], candidates.row[b]
        if 2 * len(rows) * len(posting) < scores.size:
            scores[np.ix_(rows, posting)] += mine[a][:, None] * theirs[b][None, :]
        else:  # most rows have the term: cheaper with the others' zeros than by positions
            scores += spread(rows, mine[a], queries.n)[:, None] * spread(posting, theirs[b], candidates.n)[None, :]
    if kind is object:
        return np.array([max(-MOST, min(MOST, x)) for x in scores.ravel().tolist()], np.int64).reshape(scores.shape)
    return scores


def select(scores: np.ndarray, ids: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row by score, then smaller id: (scores, ids, valid), each rows x k at most."""
    n = scores.shape[1]
    if n > k:
        keyed = np.where(valid, scores, np.iinfo(scores.dtype).min)
        least = np.partition(keyed, n - k, axis=1)[:, n - k, None]
        above = keyed > least
        # Of those at the k-th score, the smallest ids; their number differs by row, so rows are cut by a stable order of both.
        order = np.argsort(ids, axis=1, kind="stable")
        tied = np.take_along_axis(keyed == least, order, axis=1)
        room = k - above.sum(axis=1, keepdims=True)
        chosen_tied = tied & (np.cumsum(tied, axis=1) <= room)
        chosen = np.take_along_axis(above, order, axis=1) | chosen_tied
        columns = np.take_along_axis(order, np.nonzero(chosen)[1].reshape(len(scores), k), axis=1)
        scores, ids, valid = (np.take_along_axis(x, columns, axis=1) for x in (scores, ids, valid))
    return scores, ids, valid


def _search(query_ids: np.ndarray, queries: Rows, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, Rows, list[np.ndarray]]] = []
        # Queries whose products may not fit in 64 bits are scored apart, so that only they and such candidates cost Python integers.
        for small in (True, False):
            chosen = np.flatnonzero((queries.norm < SMALL) == small)
            parts.append((query_ids[chosen], queries.part(chosen), [np.zeros((len(chosen), 0), t) for t in (np.int64, np.int64, bool)]))
        step = max(64, SCORES // max(1, len(query_ids)))
        for batch in batches:
            ids, rows = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False), Rows(batch.column(1))
            for small in (True, False):
                mine = np.flatnonzero((rows.norm < SMALL) == small)
                mine = mine[np.argsort(ids[mine], kind="stable")]
                for s in range(0, len(mine), step):
                    block = mine[s : s + step]
                    held = rows.part(block)
                    for p, (own, some, best) in enumerate(parts):
                        if not len(own):
                            continue
                        scores = accumulate(some, held)
                        wide = np.broadcast_to(ids[block], scores.shape)
                        found = select(scores, wide, wide != own[:, None], k)
                        parts[p] = own, some, select(*(np.concatenate(x, axis=1) for x in zip(best, found, strict=True)), k)
        for own, _, (scores, ids, valid) in parts:
            q, c = np.nonzero(valid)
            found = ids[q, c]
            yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(found, mask=found == NO_ID), pa.array(scores[q, c])], ["query_id", "vec_id", "score"])

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, query_chunk: int = QUERY_CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k best candidates but itself. Both have id, weights; rows that share a query id are searched each and ranked together."""
    spark = candidates.sparkSession
    rows, components = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("weights")), F.lit(0))).first()
    chunks = max(1, -(-rows // query_chunk), -(-components // QUERY_COMPONENTS))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    parts = []
    for chunk in range(chunks):  # rows of an id are in one chunk
        held = queries.filter(F.pmod(F.xxhash64("id"), F.lit(chunks)) == chunk).toArrow().combine_chunks()
        if not held.num_rows:
            continue
        shared = spark.sparkContext.broadcast((held.column("id").to_numpy(), Rows(held.column("weights").combine_chunks())))
        found = candidates.mapInArrow(lambda batches, shared=shared: _search(*shared.value, k)(batches), "query_id long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if chunks > 1:
            ranked = materialise(ranked, "top-k")
            shared.unpersist()
        parts.append(ranked)
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def search_embeddings(embeddings: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """The rows whose vec_id is divisible by `every` against all rows."""
    rows = weights(embeddings, scale)
    return top_k(rows, rows.filter(F.col("id") % every == 0), k)
