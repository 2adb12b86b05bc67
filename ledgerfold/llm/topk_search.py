"""Exact top-k search by integer inner product: columnar branch-and-bound.

Components become floor(1024 * x). For each query the `k` rows with the highest inner product, ties to
the smaller id, the query's own row left out.

Method: a task turns its candidates into blocks in vertical layout, dimension by dimension, the
dimensions ordered by the queries' mass and cut into `CUTS` dimension blocks. Scores of a batch of queries grow dimension
block by dimension block. After each one a candidate can gain at most the product of both
vectors' remaining lengths (Cauchy-Schwarz); where that does not reach the query's k-th best
score so far, it is dropped. While many pairs are left, columns that no query of the batch needs are compacted away and
the next dimension block is one exact matrix product; once few are left, they go on as a list of pairs.
The k-th best score starts from a search over a sample of the queries' rows, which are
candidates themselves, and rises with what the task finds.

Defined cases: vectors that are null or hold a null or non-finite component take no part. Vectors of
different lengths are compared as if the shorter one ended in zeros. Every query row is a query of its own: repeated rows
answer each, and see each other as candidates. A candidate with a null id comes after all
others of its score; a query's id may be null if the caller passes such rows. Fewer than k candidates give all of them, no
queries or no candidates an empty result. Components too large for a long product raise. Other columns are not read.

Scale: queries go in slices of `SLICE_NUMBERS` components, a bound on what is broadcast, whatever
their number; each slice is one scan of the candidates without a shuffle of vectors. Only
hits that reach the sampled k-th best score are shuffled, k + 1 at most a query and task. Lineage ends at each slice's written hits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerfold.llm.int_vectors import dot, limb_bits, limbs, padded, vectors
from ledgerfold.llm.store import stored

K = 10
#: Components of the queries that are broadcast at once, 8 bytes each.
SLICE_NUMBERS = 2 << 20
#: Rows of the sample that gives the first bounds, about.
SAMPLE_ROWS = 2048
#: Candidates in a block, queries in a batch, and dimension blocks.
BLOCK, BATCH, CUTS = 4096, 256, 8
#: Share of pairs below which they go on as a list.
FEW = 0.05

#: Below any score (these stay within 2**61), and far enough from the end of int64 for differences.
LEAST = -(1 << 62)
HITS = "q int, query_id long, vec_id long, score long, own boolean"


@dataclass
class Queries:
    """A slice of the queries: ids (null where `null`), their matrix, and the least score that can be among the best."""

    ids: np.ndarray
    null: np.ndarray
    x: np.ndarray
    least: np.ndarray

    def cuts(self) -> list[np.ndarray]:
        order = np.argsort(-(self.x.astype(np.float64) ** 2).sum(0), kind="stable")
        return np.array_split(order, min(CUTS, max(1, len(order))))


def _left(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Length of what is left of each row after each dimension block."""
    mass = np.stack([(x[:, c] ** 2).sum(1) for c in cuts], axis=1)
    return np.sqrt((mass.sum(1)[:, None] - np.cumsum(mass, axis=1)).astype(np.float64))


def _gain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most that is still to come; never too little by rounding."""
    return a * b * (1 + 1e-9) + 1


class _Best:
    """The highest scores of every query of the slice, held as flat arrays sorted by query."""

    def __init__(self, queries: Queries, size: int):
        self.size, self.least = size, queries.least.copy()
        self.q, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.null, self.own = np.zeros(0, bool), np.zeros(0, bool)

    def add(self, q: np.ndarray, score: np.ndarray, id: np.ndarray, null: np.ndarray, own: np.ndarray) -> None:
        if not len(q):
            return
        q, score, id = (np.concatenate(x) for x in ((self.q, q), (self.score, score), (self.id, id)))
        null, own = np.concatenate([self.null, null]), np.concatenate([self.own, own])
        order = np.lexsort((id, null, ~score, q))  # ~score falls as score rises
        first = np.searchsorted(q[order], q[order])
        order = order[np.arange(len(order)) - first < self.size]
        self.q, self.score, self.id, self.null, self.own = q[order], score[order], id[order], null[order], own[order]
        full = np.flatnonzero(np.bincount(self.q, minlength=len(self.least))[self.q] == self.size)
        np.maximum.at(self.least, self.q[full[self.size - 1 :: self.size]], self.score[full[self.size - 1 :: self.size]])


def _survivors(queries: Queries, batch: slice, least: np.ndarray, cuts: list[np.ndarray], q_left: np.ndarray, x: np.ndarray, vertical: list, left: np.ndarray, size: int) -> tuple:
    """(query, candidate, score) of a batch of queries and a block of candidates, where the score can be among the best."""
    qx, bound, q_left = queries.x[batch], least[batch], q_left[batch]
    some = np.arange(len(x))
    total = np.zeros((len(qx), len(x)), np.int64)
    q, c, score = None, None, None
    for k, (cut, (bits, columns)) in enumerate(zip(cuts, vertical)):
        if q is not None:
            score = score + (qx[q[:, None], cut] * x[c[:, None], cut]).sum(1)
            alive = bound[q] - score <= _gain(q_left[q, k], left[c, k])
            q, c, score = q[alive], c[alive], score[alive]
            continue
        total += dot(limbs(qx[:, cut], bits), [m[:, some] if len(some) < len(x) else m for m in columns], bits)
        alive = bound[:, None] - total <= _gain(q_left[:, k][:, None], left[some, k][None, :])
        if k + 1 < len(cuts) and alive.mean() < FEW:
            q, at = np.nonzero(alive)
            c, score = some[at], total[q, at]
        elif k + 1 < len(cuts):
            column = alive.any(0)
            if column.mean() < 0.8:
                some, total = some[column], total[:, column]
    if q is None:
        reach = bound
        if len(some) > size:  # more than `size` of one block are needed only where they tie
            reach = np.maximum(bound, np.partition(total, len(some) - size, axis=1)[:, len(some) - size])
        q, at = np.nonzero(total >= reach[:, None])
        c, score = some[at], total[q, at]
    reached = score >= bound[q]
    return q[reached] + batch.start, c[reached], score[reached]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ids, nulls, lengths and integers of BLOCK usable vectors at a time."""
    held: list[tuple] = []
    count = 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            places, size, values = vectors(part.column(1))
            null = part.column(0).is_null().to_numpy(zero_copy_only=False)[places]
            held.append((part.column(0).fill_null(0).to_numpy()[places], null, size, values))
            count += len(places)
            if count >= BLOCK:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, count = [], 0
    if count:
        yield tuple(np.concatenate(x) for x in zip(*held))


def scan(candidates: DataFrame, queries: Queries, k: int = K, skip_own: bool = True) -> DataFrame:
    """Each task's best k + 1 candidates (id, vector) of every query of the slice, `own` where id and vector are the query's."""
    size = k + skip_own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, cuts = _Best(queries, size), queries.cuts()
        q_left = _left(queries.x, cuts)
        width = queries.x.shape[1]
        for ids, null, sizes, values in _blocks(batches):
            x = padded(sizes, values, width)
            left = _left(x, cuts)
            vertical = [(bits := limb_bits(len(c)), limbs(np.ascontiguousarray(x.T[c]), bits)) for c in cuts]
            for at in range(0, len(queries.ids), BATCH):
                q, c, score = _survivors(queries, slice(at, at + BATCH), best.least, cuts, q_left, x, vertical, left, size)
                own = (ids[c] == queries.ids[q]) & (null[c] == queries.null[q])
                own[own] = (x[c[own]] == queries.x[q[own]]).all(1)
                best.add(q, score, ids[c], null[c], own)
        yield pa.RecordBatch.from_arrays([
            pa.array(best.q.astype(np.int32)), pa.array(queries.ids[best.q], mask=queries.null[best.q]), pa.array(best.id, mask=best.null), pa.array(best.score), pa.array(best.own)],
            names=["q", "query_id", "vec_id", "score", "own"])

    return candidates.mapInArrow(run, HITS)


def _ranked(hits: DataFrame, k: int, skip_own: bool) -> DataFrame:
    """The best k of each query; of the rows like the query's own, one goes."""
    mine = Window.partitionBy("slice", "q").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), F.desc("own"))
    top = hits.withColumn("place", F.row_number().over(mine)).where(F.col("place") <= k + skip_own)
    if not skip_own:
        return top.withColumnRenamed("place", "rank")
    own = F.min(F.when(F.col("own"), F.col("place"))).over(Window.partitionBy("slice", "q"))
    left = top.withColumn("mine", F.coalesce(own, F.lit(k + 2))).where("place != mine")
    return left.withColumn("rank", F.col("place") - (F.col("place") > F.col("mine")).cast("int")).where(F.col("rank") <= k)


def _queries(rows: DataFrame, width: int) -> Queries:
    """One slice on the driver."""
    got = rows.select("query_id", "x").toArrow()
    ids, x = got.column(0).combine_chunks(), got.column(1).combine_chunks()
    size = x.value_lengths().to_numpy().astype(np.int64)
    matrix = padded(size, x.flatten().to_numpy(), width)
    return Queries(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), matrix, np.full(len(ids), LEAST))


def search(vectors_: DataFrame, wanted: DataFrame, k: int = K, *, id: str = "vec_id", vector: str = "embedding", skip_own: bool = True) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `wanted` its k best rows of `vectors_`."""
    candidates = vectors_.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, size, values = vectors(batch.column(1))
            first = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            at = pa.array(places)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.ListArray.from_arrays(first, pa.array(values))], names=["query_id", "v", "x"])

    kind = wanted.schema[vector].dataType.simpleString()
    rows = wanted.select(F.col(id).cast("long"), F.col(vector)).mapInArrow(integers, f"query_id long, v {kind}, x array<long>")
    # written with a place, so that repeated rows are dealt over the slices too
    asked = stored(rows.withColumn("place", F.xxhash64(F.monotonically_increasing_id())))
    n, width = asked.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    slices = max(1, -(-n * max(width or 0, 1) // SLICE_NUMBERS))
    found: DataFrame | None = None
    for s in range(slices if n else 0):
        mine = asked.where(F.pmod("place", F.lit(slices)) == s)
        queries = _queries(mine, width)
        if skip_own:  # the queries' rows are candidates too: k-th best among a sample of them bound what can be among the best
            every = max(1, n // SAMPLE_ROWS)
            sample = asked.where(F.pmod(F.xxhash64("place"), F.lit(every)) == 0).select("query_id", "v")
            first = _ranked(scan(sample, queries, k).withColumn("slice", F.lit(s)), k, True).where(F.col("rank") == k)
            for r in first.select("q", "score").collect():
                queries.least[r["q"]] = r["score"]
        hits = stored(scan(candidates, queries, k, skip_own).withColumn("slice", F.lit(s)))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return candidates.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _ranked(found, k, skip_own).select("query_id", "rank", "vec_id", "score")


def hundredth(table: DataFrame, *, id: str = "vec_id") -> DataFrame:
    """The query set of the registered search: every row whose id is divisible by 100."""
    return table.where(F.col(id) % 100 == 0)
