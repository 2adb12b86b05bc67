"""Vector code compression: product quantisation in integers, trained by exact rounds over all vectors.

Components become floor(1024 * x); a vector is cut into `PARTS` equal parts. Each part's
codebook starts as that part of the `ENTRIES` smallest ids' vectors. A round assigns every part to
the nearest entry (squared distance, ties to the lower index) and moves each entry to the floored
mean of its parts; entries without parts stay.

Method: the distance to an entry c is |x|^2 - 2 x.c + |c|^2. Products x.c are one matrix product
for a batch of vectors and a whole codebook. Integers are split into limbs so that a product of
limbs in float64 BLAS stays below 2^53 and is exact; limbs are recombined in int64, and the
first smallest value is taken.

Defined cases: rows whose vector is null or holds a null or non-finite component go. The width is the length
of the smallest kept id's vector among lengths that are positive multiples of `PARTS`; vectors of
another length go too. Repeated ids start the codebook in order of their vectors; null ids come
last and stay null. Fewer than `ENTRIES` vectors give smaller codebooks, none an empty result. Null labels are one
label. Components too large for a long distance raise. Other columns are not read.

Scale: a round is one scan without a shuffle of vectors: each task adds up its parts and hands on one
row for each entry it used. Codebooks (256 x width numbers) are all that is broadcast or collected, whatever the
table's size; the table is read six times and not copied. Label sums are joined as a written table, so
that they are broadcast by their true size only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerfold.llm.int_vectors import dot, limb_bits, limbs, vectors
from ledgerfold.llm.store import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Vectors assigned at once: the distances to a codebook take 8 * ENTRIES bytes each.
STEP = 4096

Books = list[np.ndarray]


def _even(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and matrix of the kept vectors of that length."""
    places, size, values = vectors(column)
    fits = size == width
    return places[fits], values[np.repeat(fits, size)].reshape(-1, width)


def start(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, *, id: str = "vec_id", vector: str = "embedding") -> Books:
    """The first codebooks, of 256 entries at most: every task hands on its smallest ids' vectors only."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # by length: (null id, id, vector)
        for batch in batches:
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            places, size, values = vectors(batch.column(1))
            ends = np.cumsum(size)
            for width in np.unique(size).tolist():
                if not width or width % parts:
                    continue
                best = held.setdefault(width, [])
                near = size == width
                if len(best) == entries and not best[-1][0]:
                    near &= ~null[places] & (ids[places] <= best[-1][1])
                new = [(bool(null[p]), int(ids[p]), values[e - width : e].tolist()) for p, e in zip(places[near], ends[near])]
                held[width] = sorted(best + new)[:entries]
        rows = [(None if x[0] else x[1], x[2]) for best in held.values() for x in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["id", "v"])

    found = table.select(F.col(id).cast("long"), F.col(vector)).mapInArrow(smallest, "id long, v array<long>")
    order = [F.col("id").asc_nulls_last(), F.col("v").asc()]
    head = found.orderBy(*order).first()
    if head is None:
        return []
    rows = found.where(F.size("v") == len(head["v"])).orderBy(*order).limit(entries).collect()
    return np.split(np.array([r["v"] for r in rows], np.int64), parts, axis=1)


class _Nearest:
    """Limbs and squared lengths of the codebooks, made once a task."""

    def __init__(self, books: Books):
        self.bits = limb_bits(books[0].shape[1])
        self.books = [(limbs(b.T, self.bits), (b * b).sum(1)) for b in books]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part: two arrays, rows by parts."""
        code, error = np.zeros((len(x), len(self.books)), np.int64), np.zeros((len(x), len(self.books)), np.int64)
        for at in range(0, len(x), STEP):
            for p, part in enumerate(np.split(x[at : at + STEP], len(self.books), axis=1)):
                book, length = self.books[p]
                far = length - 2 * dot(limbs(part, self.bits), book, self.bits)
                best = far.argmin(1)
                code[at : at + STEP, p] = best
                error[at : at + STEP, p] = far[np.arange(len(best)), best] + (part * part).sum(1)
        return code, error


def improved(table: DataFrame, books: Books, *, vector: str = "embedding") -> Books:
    """One round: assignment of all parts, then the floored means."""
    entries, cut = books[0].shape
    width = len(books) * cut

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _Nearest(books)
        total, count = np.zeros((len(books), entries, cut), np.int64), np.zeros((len(books), entries), np.int64)
        for batch in batches:
            _, x = _even(batch.column(0), width)
            code, _ = nearest.assign(x)
            for p, part in enumerate(np.split(x, len(books), axis=1)):
                order = np.argsort(code[:, p], kind="stable")
                used, first = np.unique(code[order, p], return_index=True)
                if len(used):
                    total[p, used] += np.add.reduceat(part[order], first, axis=0)
                    count[p, used] += np.diff(np.append(first, len(order)))
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    parts = table.select(vector).mapInArrow(add, "part int, entry int, n long, sums array<long>")
    cells = parts.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
    moved = [b.copy() for b in books]
    for r in cells.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        moved[r["part"]][r["entry"], r["at"]] = int(r["x"]) // r["n"]
    return moved


def train(table: DataFrame, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES, *, id: str = "vec_id", vector: str = "embedding") -> Books:
    """Codebooks, one array (entries x width of a part) for each part; an empty list for a table without usable vectors."""
    books = start(table, parts, entries, id=id, vector=vector)
    for _ in range(rounds if books else 0):
        books = improved(table, books, vector=vector)
    return books


def fingerprint(books: Books) -> str:
    return hashlib.sha256(",".join(map(str, (x for b in books for x in b.ravel().tolist()))).encode()).hexdigest()


def encode(table: DataFrame, books: Books, *, keep: tuple[str, ...] = ("vec_id", "label"), vector: str = "embedding") -> DataFrame:
    """The kept columns of every usable vector with its `code` (an entry for each part) and `error`."""
    schema = T.StructType([*(table.schema[c] for c in keep), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if {c.lower() for c in keep} & {"code", "error"}:
        raise ValueError("kept columns cannot be named code or error")
    if not books:
        return table.sparkSession.createDataFrame([], schema)
    width = sum(b.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _Nearest(books)
        for batch in batches:
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            places, x = _even(get[vector], width)
            code, error = nearest.assign(x)
            hexes = code.astype(np.uint8).tobytes().hex()
            step = 2 * len(books)
            yield pa.RecordBatch.from_arrays([*(get[c].take(pa.array(places)) for c in keep), pa.array([hexes[i : i + step] for i in range(0, len(hexes), step)], pa.string()), pa.array(error.sum(1))], names=schema.names)

    return table.select(*dict.fromkeys([*keep, vector])).mapInArrow(run, schema)


def digest(table: DataFrame, books: Books) -> DataFrame:
    """vec_id, code, error, the error of all vectors with the same label, and the codebooks' fingerprint."""
    coded = stored(encode(table, books))
    sums = stored(coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("same"))).select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))
