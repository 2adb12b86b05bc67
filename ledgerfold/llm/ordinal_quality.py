"""Quality classifier: ordinal regression with cumulative links on graded ratings.

A text's features are hashed: each distinct word (ASCII symbols cut off, lower case) with value 1;
the beginnings of its words (4 and 6 bytes) with the logarithm of their number; the shapes of its blank-separated tokens (runs of upper case, lower case, digits and each
symbol folded to one character) with their share of the tokens, scaled; and the share of
distinct words in tenths. One weight vector gives a score; ordered thresholds give the chance
that the grade is k or more, sigmoid(score - threshold k). From these come the expected grade
and the tail probability of the top grade, which selects.

Grades: 0 for bad quality, 1 for good but toxic, 2 for good. The model is fitted to a bounded
sample of rated rows (`max_rows`, those with the smallest hashes of id and rating; rows that share a rated id count each) by
maximum likelihood with FTRL-proximal steps; features of fewer than `min_rows` sampled rows are
left out, and the L1 term leaves those without evidence at 0.

Defined cases: ratings with a null are not used; null text is empty and gets the score of the
empty text; several ratings of a document count each; without ratings, or with one grade
only, everything is kept with null grade and probability 1; one row goes out for each row in.

Scale: the sample has a fixed bound, so its ids are broadcast and one task fits the model;
the weights (a fixed number) go through the driver. Scoring is one pass without a shuffle."""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerfold.llm.store import beside
from ledgerfold.llm.words import BYTE_VALUE, LOWER, SYMBOLS, Sums, chunks, mix, split_words

DIM_BITS = 18
MAX_ROWS = 20_000
GRADES = 3
MIN_TAIL = 0.5
MIN_ROWS = 5
SHAPE_SCALE = 4.0
BEGINNINGS = (4, 6)
#: Bytes of text whose features are made at once; they take many times as much memory, in every task of an executor.
PIECE_BYTES = 1 << 18

#: Upper case, lower case (and non-ASCII), digits; symbols stand for themselves.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[0x41:0x5B] = 0x41
SHAPE[0x61:0x7B] = 0x61
SHAPE[0x80:] = 0x61
SHAPE[0x30:0x3A] = 0x30


@dataclass
class Features:
    row: np.ndarray
    index: np.ndarray
    value: np.ndarray


def _distinct(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(row)), bool), (row[1:] != row[:-1]) | (key[1:] != key[:-1])]))
    return row[at], key[at], np.diff(np.append(at, len(row)))


def features(text: pa.Array) -> Features:
    n = len(text)
    words = split_words(text, SYMBOLS, LOWER)
    row, word, _ = _distinct(words.row(), words.hashes())
    tokens = split_words(text)
    shape = SHAPE[tokens.buf]
    # One character stays of each run inside a token.
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[tokens.start] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    hashes = Sums(BYTE_VALUE[shape[keep]]).hashed(place[tokens.start], place[tokens.end])
    shape_row, shape_key, times = _distinct(tokens.row(), hashes)
    count = np.maximum(tokens.count, 1)
    variety = np.bincount(row, minlength=n) * 10 // np.maximum(words.count, 1)
    starts = []
    sums = Sums(BYTE_VALUE[words.buf])
    for size in BEGINNINGS:
        long = words.end - words.start >= size
        at, key, times_ = _distinct(words.row()[long], sums.hashed(words.start[long], words.start[long] + size))
        starts.append((at, mix(key + np.uint64(size)), np.log1p(times_)))
    keys = np.concatenate([*(k for _, k, _ in starts), mix(word), mix(shape_key ^ np.uint64(0x5AFE)), mix((variety + 7919).astype(np.uint64))])
    value = np.concatenate([*(v for *_, v in starts), np.ones(len(word)), SHAPE_SCALE * times / count[shape_row], np.ones(n)])
    return Features(np.concatenate([*(r for r, *_ in starts), row, shape_row, np.arange(n)]), (keys >> np.uint64(64 - DIM_BITS)).astype(np.int32), value.astype(np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(first: np.ndarray, index: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int, *, epochs: int = 8, batch: int = 32,
        rate: float = 0.15, l1: float = 6.0, l2: float = 0.1, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative-link model. Rows are index/value[first[i]:first[i + 1]]."""
    weights = np.zeros(1 << DIM_BITS, np.float64)
    z, squares = np.zeros_like(weights), np.zeros_like(weights)
    share = np.array([(grade >= k).mean() for k in range(1, grades)])
    share = np.clip(share, 1e-3, 1 - 1e-3)
    thresholds = -np.log(share / (1 - share))
    t_squares = np.full(grades - 1, 1.0)
    order_of = np.random.Generator(np.random.PCG64(seed))
    for _ in range(epochs):
        order = order_of.permutation(len(grade))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            size = first[rows + 1] - first[rows]
            spot = np.repeat(first[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            own, idx, val = np.repeat(np.arange(len(rows)), size), index[spot], value[spot]
            score = np.bincount(own, weights[idx] * val, len(rows))
            edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
            y = grade[rows]
            upper, lower = _sigmoid(score - edges[y]), _sigmoid(score - edges[y + 1])
            slope = -(1 - upper - lower)
            # Thresholds: they bound the grade of each row from below and from above.
            chance = np.maximum(upper - lower, 1e-9)
            push = np.bincount(y, upper * (1 - upper) / chance, grades + 1)[1:grades] - np.bincount(y + 1, lower * (1 - lower) / chance, grades + 1)[1:grades]
            t_squares += push**2
            thresholds = np.maximum.accumulate(thresholds - 0.3 * push / np.sqrt(t_squares) + 1e-6 * np.arange(grades - 1))
            touched, where = np.unique(idx, return_inverse=True)
            g = np.bincount(where, slope[own] * val, len(touched))
            new = squares[touched] + g * g
            z[touched] += g - (np.sqrt(new) - np.sqrt(squares[touched])) / rate * weights[touched]
            squares[touched] = new
            pull = z[touched]
            weights[touched] = np.where(np.abs(pull) <= l1, 0.0, -(pull - np.sign(pull) * l1) / ((1 + np.sqrt(new)) / rate + l2))
    return weights, thresholds


def _frequent(size: np.ndarray, index: list[np.ndarray], value: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row starts, indexes and values without features of too few rows. The given parts are emptied on the way, so that
    all features are held once, and those of one part a second time."""
    rows = np.zeros(1 << DIM_BITS, np.int64)
    for part in index:
        rows += np.bincount(part, minlength=len(rows))
    keep = rows >= MIN_ROWS
    n = int(rows[keep].sum())
    kept_index, kept_value, left = np.empty(n, np.int32), np.empty(n, np.float32), np.zeros(len(size), np.int64)
    at = row = 0
    first = np.concatenate([[0], np.cumsum(size)])
    while index:
        part, values = index.pop(0), value.pop(0)
        good = keep[part]
        stop = at + int(good.sum())
        kept_index[at:stop], kept_value[at:stop] = part[good], values[good]
        below = np.concatenate([[0], np.cumsum(good)])
        end = int(np.searchsorted(first, first[row] + len(part), "right")) - 1
        left[row:end] = np.diff(below[first[row : end + 1] - first[row]])
        at, row = stop, end
    return np.concatenate([[0], np.cumsum(left)]), kept_index, kept_value


def _apart(values: np.ndarray) -> np.ndarray:
    """A copy in pages of its own, which the system gets back as soon as it goes; holes between other arrays stay with the process."""
    out = np.frombuffer(mmap.mmap(-1, max(values.nbytes, 1)), values.dtype, len(values))
    out[:] = values
    return out


def _trainer(grades: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rated, index, value, size = [], [], [], []
        for batch in chunks(batches, size=PIECE_BYTES):
            found = features(batch.column(0))
            order = np.argsort(found.row, kind="stable")
            index.append(_apart(found.index[order]))
            value.append(_apart(found.value[order]))
            size.append(np.bincount(found.row, minlength=batch.num_rows))
            rated.append(batch.column(1).to_numpy())
        if rated and len(np.unique(grade := np.concatenate(rated))) > 1:
            weights, thresholds = fit(*_frequent(np.concatenate(size), index, value), grade, grades)
            yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([thresholds.tolist()])], names=["weights", "thresholds"])

    return train


def train(docs: DataFrame, ratings: DataFrame, *, id: str = "doc_id", text: str = "text", grade: str = "grade", grades: int = GRADES, max_rows: int = MAX_ROWS):
    """A broadcast (weights, thresholds), or None where there is nothing to learn from."""
    spark = docs.sparkSession
    rated = ratings.select(F.col(id).alias("rated"), F.col(grade).cast("int").alias("grade")).where(f"rated IS NOT NULL AND grade BETWEEN 0 AND {grades - 1}")
    sample = rated.withColumn("rank", F.xxhash64("rated", "grade")).orderBy("rank", "rated", "grade").limit(max_rows)
    texts = docs.select(F.col(id).alias("doc"), F.col(text).alias("text")).join(F.broadcast(sample), F.col("doc") == F.col("rated"))
    # Several documents may share a rated id: the bound holds for rows.
    one = texts.orderBy("rank", "rated", "grade", F.xxhash64("text")).limit(max_rows).select("text", "grade").coalesce(1)
    row = one.mapInArrow(_trainer(grades), "weights binary, thresholds array<double>").first()
    if row is None:
        return None
    return spark.sparkContext.broadcast((np.frombuffer(row.weights, np.float32), np.array(row.thresholds)))


def _graded(batch_text: pa.Array, model) -> tuple[np.ndarray, np.ndarray]:
    weights, thresholds = model.value
    found = features(batch_text)
    score = np.bincount(found.row, weights[found.index].astype(np.float64) * found.value, len(batch_text))
    tails = _sigmoid(score[:, None] - thresholds[None, :])
    return tails.sum(1), tails[:, -1]


GRADED = T.StructType([T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def grade(docs: DataFrame, model, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", min_tail: float = MIN_TAIL) -> DataFrame:
    """The kept columns of every document with `expected_grade`, `tail_probability` and `kept`. A kept column that
    is named like one of these gets an underscore behind its name."""
    names = beside(keep, GRADED.names)
    if model is None:
        return docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.lit(None).cast("double").alias("expected_grade"), F.lit(1.0).alias("tail_probability"), F.lit(True).alias("kept"))
    schema = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for c, n in zip(keep, names, strict=True)), *GRADED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, PIECE_BYTES):
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            expected, tail = _graded(get[text], model)
            yield pa.RecordBatch.from_arrays([*(get[c] for c in keep), pa.array(np.round(expected, 4)), pa.array(np.round(tail, 4)), pa.array(tail >= min_tail)], names=schema.names)

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def select(docs: DataFrame, model, *, text: str = "text", min_tail: float = MIN_TAIL) -> DataFrame:
    """The documents whose top grade is likely enough."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, PIECE_BYTES):
            yield batch.filter(pa.array(_graded(batch.column(batch.schema.get_field_index(text)), model)[1] >= min_tail))

    return docs.mapInArrow(run, docs.schema)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from two flags: bad, good but toxic, good."""
    return labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))
