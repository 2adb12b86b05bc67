"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Texts are lower-cased (A-Z) and cut into words of digits, letters and non-ASCII characters.
A test item gives all its windows of `size` words; an item with fewer words gives one
window of them all. Hashes of the windows are broadcast; tasks look up every window of the
training texts there and compare the words of each hit, so a hash never decides alone. A
word of a document is hit if any occurrence of a test window covers it.

Defined cases: null or empty text has no words and no hits; an item without words has no
window; an item without id still hits but is not listed; repeated items and rows count as
they are; one row goes out for each row that comes in.

Scale: documents are scanned once and not shuffled. Test items are broadcast in slices of
about `max_bytes` of text, which take some 40 bytes a window and the text itself; more of them mean more scans, whose hits are merged by
document. A kept column that is named like a column of the result gets an underscore behind its name."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerfold.llm.store import beside, fresh
from ledgerfold.llm.words import LOWER, SMALL_CHUNK, SYMBOLS, Words, chunks, joined, split_words

SIZE = 10
MAX_BYTES = 8 << 20
_SLOTS = 20  # bits of the first look at a hash
HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW_HITS = [
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ("items", pa.list_(pa.string())),
]


@dataclass
class Distinct:
    """The distinct windows of one length, sorted by hash, with a bitmap over the hashes' first bits."""

    hashes: np.ndarray
    bits: np.ndarray
    start: np.ndarray  # where the words stand in the slice's text
    end: np.ndarray
    first: np.ndarray  # where each window's items begin
    items: np.ndarray


@dataclass
class TestWindows:
    """The words of a slice's items, each with a blank behind it, and the windows by length in words: about 40 bytes a window."""

    text: bytes
    ids: list[str | None]
    windows: dict[int, Distinct]


def _joined(words: Words, at: int, size: int) -> bytes:
    buf = words.buf
    return b" ".join(buf[s:e].tobytes() for s, e in zip(words.start[at : at + size], words.end[at : at + size], strict=True))


def test_windows(ids: list[str | None], texts: list[str | None], size: int) -> TestWindows:
    words = split_words(pa.array(texts, pa.string()), SYMBOLS, LOWER)
    count, hashes, row = words.count, words.hashes(), words.row()
    flat, place = joined(words)
    text = flat.tobytes()
    windows = {}
    for length in np.unique(np.minimum(count[count > 0], size)).tolist():
        at, h = words.windows(length, hashes)
        mine = count[row[at]] >= size if length == size else count[row[at]] == length
        order = np.argsort(h[mine], kind="stable")
        at, h = at[mine][order], h[mine][order]
        start, end = place[at], place[at + length] - 1
        # Windows with equal words count as the first of them; the same hash of other words is another window.
        same, seen = np.arange(len(h)), {}
        for k in (np.flatnonzero(h[1:] == h[:-1]) + 1).tolist():
            if k < 2 or h[k - 2] != h[k]:
                seen = {text[start[k - 1] : end[k - 1]]: k - 1}
            same[k] = seen.setdefault(text[start[k] : end[k]], k)
        order = np.argsort(same, kind="stable")
        one, first = np.unique(same[order], return_index=True)
        bits = np.zeros(1 << _SLOTS, bool)
        bits[h >> np.uint64(64 - _SLOTS)] = True
        windows[length] = Distinct(h[one], bits, start[one], end[one], np.append(first, len(h)), row[at[order]].astype(np.int32))
    return TestWindows(text, ids, windows)


def _hits(words: Words, tests: TestWindows) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words are hit, and the items found in each text."""
    hashes, row = words.hashes(), words.row()
    hit = np.zeros(len(words.start) + 1, np.int64)
    items: dict[int, set[int]] = {}
    for length, known in tests.windows.items():
        at, h = words.windows(length, hashes)
        near = np.flatnonzero(known.bits[h >> np.uint64(64 - _SLOTS)])
        low, high = np.searchsorted(known.hashes, h[near]), np.searchsorted(known.hashes, h[near], "right")
        some = low < high
        for i, a, b in zip(at[near[some]].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
            said = _joined(words, i, length)
            for k in range(a, b):
                if tests.text[known.start[k] : known.end[k]] == said:
                    hit[i] += 1
                    hit[i + length] -= 1
                    items.setdefault(int(row[i]), set()).update(known.items[known.first[k] : known.first[k + 1]].tolist())
    return np.cumsum(hit)[:-1] > 0, {r: {tests.ids[n] for n in found if tests.ids[n] is not None} for r, found in items.items()}


def _ranges(words: Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and end of each run of hit words, counted within the text."""
    row = words.row()
    edge = np.ones(len(hit) + 1, bool)
    edge[1:-1] = (hit[1:] != hit[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    start, end = start[hit[start]], end[hit[start]]
    base = words.first[row[start]]
    return row[start], start - base, end - base


def _lists(values: pa.Array, rows: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), values)


def _scanner(tests, text: str, keep: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            words = split_words(batch.column(batch.schema.get_field_index(text)), SYMBOLS, LOWER)
            hit, items = _hits(words, tests.value)
            rows, start, end = _ranges(words, hit)
            spans = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["start", "end"])
            listed = [sorted(items.get(r, ())) for r in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(words.count, pa.int64()), _lists(spans, rows, batch.num_rows), pa.array(listed, pa.list_(pa.string()))],
                names=[*keep, *(n for n, _ in _ARROW_HITS)])

    return scan


def _dropper(tests, text: str):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, SMALL_CHUNK):
            words = split_words(batch.column(batch.schema.get_field_index(text)), SYMBOLS, LOWER)
            hit, _ = _hits(words, tests.value)
            yield batch.filter(pa.array(~np.isin(np.arange(batch.num_rows), words.row()[hit])))

    return drop


def _marker(tests, text: str, spans: str):
    """Adds the slice's spans, pairs of words' numbers in one list, to those that are there."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            words = split_words(batch.column(batch.schema.get_field_index(text)), SYMBOLS, LOWER)
            hit, _ = _hits(words, tests.value)
            found: list[list[int]] = [list(x or ()) for x in batch.column(batch.schema.get_field_index(spans)).to_pylist()]
            for r, start, end in zip(*(x.tolist() for x in _ranges(words, hit)), strict=True):
                found[r] += [start, end]
            yield batch.set_column(batch.schema.get_field_index(spans), spans, pa.array(found, pa.list_(pa.int32())))

    return mark


def _cutter(text: str, spans: str):
    """Cuts the words of all spans out of the text they were found in."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            at = batch.schema.get_field_index(text)
            column = batch.column(at)
            words = split_words(column, SYMBOLS, LOWER)
            texts = column.to_pylist()
            for r, found in enumerate(batch.column(batch.schema.get_field_index(spans)).to_pylist()):
                if not found:
                    continue
                runs: list[list[int]] = []  # spans that touch are one
                for s, e in sorted(zip(found[::2], found[1::2], strict=True)):
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(e, runs[-1][1])
                    else:
                        runs.append([s, e])
                raw, base, out, last = texts[r].encode(), words.offsets[r], [], 0
                for s, e in runs:
                    out.append(raw[last : words.start[words.first[r] + s] - base])
                    last = words.end[words.first[r] + e - 1] - base
                texts[r] = b"".join([*out, raw[last:]]).decode()
            kept = [c for c in batch.schema.names if c != spans]
            yield pa.RecordBatch.from_arrays([pa.array(texts, column.type) if c == text else batch.column(batch.schema.get_field_index(c)) for c in kept], names=kept)

    return cut


def _slices(benchmark: DataFrame, item_id: str, text: str, size: int, max_bytes: int):
    """Broadcast values that hold all test items, each of a bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(total / max_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        rows = part.collect()
        yield spark.sparkContext.broadcast(test_windows([r.id for r in rows], [r.text for r in rows], size))


def scan(docs: DataFrame, benchmark: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", item_id: str = "item_id",
         size: int = SIZE, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The kept columns of every document with `n_words`, hit `spans` (in words, end exclusive)
    and the sorted ids of the `items` whose windows occur."""
    slices = list(_slices(benchmark, item_id, "text", size, max_bytes))
    names = beside(keep, HITS.names)
    kept = [F.col(c).alias(n) for c, n in zip(keep, names, strict=True)]
    said, = fresh(docs.select(*kept), "text")
    source, text, keep = docs.select(*kept, F.col(text).alias(said)), said, names
    schema = T.StructType([*(source.schema[c] for c in keep), *HITS])
    if len(slices) == 1:
        return source.mapInArrow(_scanner(slices[0], text, list(keep)), schema)
    # Equal rows give equal hits in every slice: merge by content, then restore their number.
    digest, copies = fresh(source, "digest", "copies")
    source = source.withColumn(digest, F.xxhash64(text))
    keys = [*keep, digest]
    schema = T.StructType([*(source.schema[c] for c in keys), *HITS])
    parts = None
    for one in slices:
        found = source.mapInArrow(_scanner(one, text, keys), schema)
        parts = found if parts is None else parts.unionByName(found)
    words = F.flatten(F.collect_list(F.flatten(F.transform("spans", lambda s: F.sequence(s.start, s.end - 1)))))
    runs = F.aggregate(
        F.array_sort(F.array_distinct(words)), F.array().cast(HITS["spans"].dataType),
        lambda got, w: F.when((F.size(got) > 0) & (F.element_at(got, -1).end == w), F.concat(F.slice(got, 1, F.size(got) - 1), F.array(F.struct(F.element_at(got, -1).start.alias("start"), (w + 1).alias("end")))))
        .otherwise(F.concat(got, F.array(F.struct(w.alias("start"), (w + 1).alias("end"))))))
    merged = parts.groupBy(*keys, "n_words").agg(
        runs.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count(F.lit(1)) / len(slices)).cast("int").alias(copies))
    return merged.withColumn(copies, F.explode(F.sequence(F.lit(1), copies))).select(*keep, *HITS.names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, drop: bool = True, text: str = "text", item_id: str = "item_id",
                  size: int = SIZE, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The documents without those that hold a test window (`drop`), or with the hit words cut out: spans of
    all slices are found in the whole text and cut once."""
    if drop:
        for one in _slices(benchmark, item_id, "text", size, max_bytes):
            docs = docs.mapInArrow(_dropper(one, text), docs.schema)
        return docs
    spans, = fresh(docs, "spans")
    marked = docs.withColumn(spans, F.array().cast("array<int>"))
    for one in _slices(benchmark, item_id, "text", size, max_bytes):
        marked = marked.mapInArrow(_marker(one, text, spans), marked.schema)
    return marked.mapInArrow(_cutter(text, spans), docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts and the digest of the listed items, from the result of `scan`."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
