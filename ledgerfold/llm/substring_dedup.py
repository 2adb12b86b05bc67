"""Substring dedup on super-k-mers.

A window is `size` consecutive words of one document. Its minimiser is the smallest hash of
its `gram`-word runs; consecutive windows with the same minimiser travel as one packed
string of words to the minimiser's bucket. There equal packed strings fold into their
earliest copy, windows are sorted by hash, and those with a repeated hash are compared word
for word. Each window's first occurrence (smallest document id, then earliest start) stays; a
word that any later occurrence covers is removed. Windows are judged on the input.

Defined cases: null text has no words; a document with fewer than `size` words keeps them;
a null id sorts last; rows that share an id but not the text are ordered by a hash of the
text; rows equal in both count as one document, so none removes words of the other; extra
columns do not matter.

Scale: a first scan counts windows by minimiser in a fixed table of cells. Minimisers of
cells that would overfill a bucket (a passage with very many different contexts) send
their windows singly, dealt by the window's own hash. Exact copies are folded before every
shuffle. Rows of the shuffles are compressed blocks for one bucket, so that the packed strings
cost little disk; a bucket with more windows than `bucket_windows` is worked off in several
passes over its compressed blocks. The driver gets the counts of the cells only."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerfold.llm.words import CHUNK_BYTES, Sums, Words, chunks, joined, mix, split_bytes, split_words

SIZE = 20
GRAM = 3
BUCKET_WINDOWS = 400_000
#: Text bytes whose super-k-mers a task gathers before it sends blocks.
FLUSH_BYTES = 12 << 20
CELL_BITS = 20
LAST = np.iinfo(np.int64).max


# -- windows and their minimisers ------------------------------------------------------------


@dataclass
class Runs:
    """Runs of windows with one minimiser: text, first window within it, number of windows."""

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    minimiser: np.ndarray
    at: np.ndarray  # first word in the batch


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[: len(x) - reach], x[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def super_kmers(words: Words, size: int, gram: int) -> Runs:
    hashes, count = words.hashes(), words.count
    _, grams = words.windows(gram, hashes)
    n_grams, n = np.maximum(count - gram + 1, 0), np.maximum(count - size + 1, 0)
    if not n.sum():
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64), none)
    least = _sliding_min(grams, size - gram + 1)
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    least = least[(np.cumsum(n_grams) - n_grams)[row] + start]
    edge = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])]))
    length = np.diff(np.append(edge, len(least)))
    return Runs(row[edge], start[edge], length, least[edge], words.first[row[edge]] + start[edge])


# -- blocks ----------------------------------------------------------------------------------


def _squeezed(raw: bytes, level: int = 6) -> bytes:
    return pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def _expanded(block: bytes, size: int) -> bytes:
    return pa.decompress(block, size, "zstd", asbytes=True)


def _pack(bucket: np.ndarray, columns: list[np.ndarray], strings: list[bytes] | None, windows: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """One row for each bucket: number of entries and windows, and the compressed columns and strings."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    out: tuple[list, ...] = ([], [], [], [], [])
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
        picked = order[a:b]
        raw = b"".join(c[picked].tobytes() for c in columns)
        if strings is not None:
            raw += b"\n".join([strings[i] for i in picked.tolist()])
        for values, x in zip(out, (int(bucket[picked[0]]), len(picked), int(windows[picked].sum()), len(raw), _squeezed(raw)), strict=True):
            values.append(x)
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.binary())], names=["bucket", "entries", "windows", "size", "block"])


BLOCKS = "bucket long, entries int, windows long, size int, block binary"


def _columns(entries: int, raw: memoryview | bytes, kinds: list[type]) -> tuple[list[np.ndarray], bytes]:
    at, out = 0, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, entries, at))
        at += entries * np.dtype(kind).itemsize
    return out, raw[at:]


def _groups(batches: Iterator[pa.RecordBatch], resolve: Callable) -> Iterator[pa.RecordBatch]:
    """Calls resolve with the blocks of each bucket; rows arrive sorted by bucket."""
    now, blocks = None, []
    for batch in batches:
        for bucket, entries, windows, size, block in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if bucket != now and blocks:
                yield from resolve(blocks)
                blocks = []
            now = bucket
            blocks.append((entries, windows, size, block))
    if blocks:
        yield from resolve(blocks)


def _by_bucket(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("bucket").sortWithinPartitions("bucket")


# -- stages ----------------------------------------------------------------------------------


def _texts(batches: Iterator[pa.RecordBatch], size: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, Words, Runs]]:
    for batch in chunks(batches):
        ids = batch.column(0)
        ids = (ids.fill_null(LAST) if ids.null_count else ids).to_numpy()
        words = split_words(batch.column(2))
        yield ids, batch.column(1).to_numpy(), words, super_kmers(words, size, gram)


def _counter(size: int, gram: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, total = np.zeros(1 << CELL_BITS, np.int64), 0
        for _, _, words, runs in _texts(batches, size, gram):
            _, one = np.unique(Sums(words.hashes()).hashed(runs.at, runs.at + runs.count + size - 1), return_index=True)
            total += int(runs.count.sum())
            np.add.at(cells, (runs.minimiser[one] >> np.uint64(64 - CELL_BITS)).astype(np.int64), runs.count[one])
        # A cell far above the mean over all tasks is above twice the mean in the tasks that make it so.
        full = np.flatnonzero(cells >= max(4, 2 * cells.mean()))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(full, -1)), pa.array(np.append(cells[full], total))], names=["cell", "windows"])

    return count


def _packer(size: int, gram: int, n_buckets: int, hot):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, digests, starts, counts, buckets, strings, held = [], [], [], [], [], [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if strings:
                doc, digest, start, count, bucket = (np.concatenate(x) for x in (ids, digests, starts, counts, buckets))
                order = np.lexsort((start, digest, doc)).tolist()
                first: dict[bytes, int] = {}
                for i in order:
                    first.setdefault(strings[i], i)
                keep = np.fromiter(first.values(), np.int64, len(first))
                yield from _pack(bucket[keep], [doc[keep], digest[keep], start[keep].astype(np.int32)], [strings[i] for i in keep.tolist()], count[keep], size)
            for x in (ids, digests, starts, counts, buckets, strings):
                x.clear()
            held = 0

        for doc, digest, words, runs in _texts(batches, size, gram):
            single = hot.value[(runs.minimiser >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
            spread = np.repeat(np.flatnonzero(single), runs.count[single])
            step = np.arange(len(spread)) - np.repeat(np.cumsum(runs.count[single]) - runs.count[single], runs.count[single])
            at = np.concatenate([runs.at[~single], runs.at[spread] + step])
            row = np.concatenate([runs.row[~single], runs.row[spread]])
            count = np.concatenate([runs.count[~single], np.ones(len(spread), np.int64)])
            key = np.concatenate([mix(runs.minimiser[~single]), Sums(words.hashes()).hashed(at[len(at) - len(spread) :], at[len(at) - len(spread) :] + size)])
            text, offsets = joined(words)
            raw = text.tobytes()
            strings += [raw[a:b] for a, b in zip(offsets[at].tolist(), (offsets[at + count + size - 1] - 1).tolist(), strict=True)]
            ids.append(doc[row])
            digests.append(digest[row])
            starts.append(np.concatenate([runs.start[~single], runs.start[spread] + step]))
            counts.append(count)
            buckets.append((key % np.uint64(n_buckets)).astype(np.int64))
            held += len(raw) + 20 * len(spread)
            if held >= FLUSH_BYTES:
                yield from sent()
        yield from sent()

    return pack


def _resolver(size: int, n_buckets: int, bucket_windows: int):
    def opened(block: tuple) -> tuple[np.ndarray, ...]:
        """Document, digest and start of every window of a block, its hash, and its bytes' place."""
        entries, _, length, packed = block
        (doc, digest, start), text = _columns(entries, _expanded(packed, length), [np.int64, np.int64, np.int32])
        buf = np.frombuffer(text, np.uint8)
        ends = np.append(np.flatnonzero(buf == 0x0A), len(buf))
        # Each line is a text of its own; line breaks are separators.
        words = split_bytes(np.concatenate([[0], ends[:-1], [len(buf)]]), buf)
        at, hashes = words.windows(size, words.hashes())
        row = words.row()[at]
        return doc[row], digest[row], start[row] + (at - words.first[row]), hashes, words.start[at], words.end[at + size - 1], text

    def resolve(blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
        passes = max(1, -(-sum(b[1] for b in blocks) // (4 * bucket_windows)))
        found: list[tuple[np.ndarray, ...]] = []
        for k in range(passes):
            cached = [opened(b) for b in blocks] if passes == 1 else None
            parts = []
            for i, block in enumerate(blocks):
                doc, digest, start, hashes, *_ = cached[i] if cached else opened(block)
                mine = hashes % np.uint64(passes) == k if passes > 1 else slice(None)
                parts.append((doc[mine], digest[mine], start[mine], hashes[mine]))
            doc, digest, start, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            same = hashes[order][1:] == hashes[order][:-1]
            again = np.zeros(len(hashes), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            first = ~again
            # Windows with a repeated hash: the earliest of those with the same words is the first.
            earliest: dict[bytes, tuple] = {}
            base = 0
            for i, block in enumerate(blocks):
                _, _, _, h, a, b, text = cached[i] if cached else opened(block)
                mine = np.flatnonzero(h % np.uint64(passes) == k) if passes > 1 else np.arange(len(h))
                picked = np.flatnonzero(again[base : base + len(mine)])
                where = mine[picked]
                for key, x, y in zip(zip(doc[base + picked].tolist(), digest[base + picked].tolist(), start[base + picked].tolist(), (base + picked).tolist(), strict=True), a[where].tolist(), b[where].tolist(), strict=True):
                    known = earliest.get(words := text[x:y])
                    if known is None or key < known:
                        earliest[words] = key
                base += len(mine)
            first[[key[3] for key in earliest.values()]] = True
            found.append((doc[first], digest[first], start[first]))
        doc, digest, start = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, digest, doc))
        doc, digest, start = doc[order], digest[order], start[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1]) | (start[1:] != start[:-1] + 1)
        at = np.flatnonzero(new)
        doc, digest, start, count = doc[at], digest[at], start[at], np.diff(np.append(at, len(start)))
        part = (mix(doc.astype(np.uint64) ^ mix(digest.astype(np.uint64))) % np.uint64(n_buckets)).astype(np.int64)
        yield from _pack(part, [doc, digest, start.astype(np.int32), (start + count).astype(np.int32)], None, count, size)

    return lambda batches: _groups(batches, resolve)


def _lister():
    def lists(blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
        parts = [_columns(n, _expanded(b, size), [np.int64, np.int64, np.int32, np.int32])[0] for n, _, size, b in blocks]
        doc, digest, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((start, digest, doc))
        doc, digest, start, end = doc[order], digest[order], start[order], end[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])])) if len(doc) else np.zeros(0, np.int64)
        offsets = pa.array(np.append(new, len(doc)), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(digest[new]), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (start, end))], names=["doc", "digest", "start", "end"])

    return lambda batches: _groups(batches, lists)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: they are shuffled once more, to meet the list of what stays."""
    for batch in chunks(batches):
        texts = [x or b"" for x in batch.column(2).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, texts), pa.int32()), pa.array((_squeezed(x, 3) for x in texts), pa.binary())], names=["doc", "digest", "size", "packed"])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of bounded numbers of text bytes, with the text in place of its compressed bytes."""
    for batch in batches:
        size = batch.column(1).to_numpy()
        cut = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // CHUNK_BYTES, prepend=-1))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            texts = [_expanded(x, n) for x, n in zip(part.column(2).to_pylist(), size[a:b].tolist(), strict=True)]
            yield part.set_column(2, "text", pa.array(texts, pa.binary()).cast(pa.string()))


def _remover(size: int, text: str, keep: list[str]):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _opened(batches):
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            words = split_words(get(text))
            starts, ends = get("start"), get("end")
            n_first = pc.fill_null(pc.list_value_length(starts), 0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), n_first)
            # +1 where a document's windows begin, -1 behind them; the reverse for first occurrences.
            later = np.zeros(len(words.start) + 1, np.int64)
            n = np.maximum(words.count - size + 1, 0)
            np.add.at(later, words.first[:-1][n > 0], 1)
            np.add.at(later, (words.first[:-1] + n)[n > 0], -1)
            np.add.at(later, words.first[row] + starts.flatten().to_numpy(), -1)
            np.add.at(later, words.first[row] + ends.flatten().to_numpy(), 1)
            later = np.concatenate([[0], np.cumsum(np.cumsum(later)[:-1] > 0)])
            at = np.arange(len(words.start))
            kept = later[at + 1] == later[np.maximum(at - size + 1, words.first[words.row()])]
            out, offsets = joined(words, kept)
            n_kept = np.concatenate([[0], np.cumsum(kept)])[words.first]
            edge = offsets[n_kept]
            raw = out.tobytes()
            texts = [raw[a : max(a, b - 1)] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(get(c) for c in keep), pa.array(words.count, pa.int64()), pa.array(words.count - np.diff(n_kept), pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*keep, "n_words", "n_removed", "kept_text"])

    return remove


def dedup_substrings(docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM,
                     bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """One row for each document: its id, `n_words`, `n_removed` and the `kept_text` (kept words joined by one space)."""
    spark = docs.sparkSession
    source = docs.select(F.col(id).cast("long").alias("doc"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    counted = source.mapInArrow(_counter(size, gram), "cell long, windows long").groupBy("cell").agg(F.sum("windows").alias("windows"))
    # The driver sees the total and the cells above their share: at most one in a few of a fixed number.
    total = counted.where("cell = -1").first()
    total = total.windows if total else 0
    limit = max(bucket_windows, 8 * total >> CELL_BITS)
    hot = np.zeros(1 << CELL_BITS, bool)
    hot[[r.cell for r in counted.where(f"cell >= 0 AND windows > {limit}").collect()]] = True
    n_buckets = max(1, -(-total // bucket_windows))
    blocks = source.mapInArrow(_packer(size, gram, n_buckets, spark.sparkContext.broadcast(hot)), BLOCKS)
    firsts = _by_bucket(blocks).mapInArrow(_resolver(size, n_buckets, bucket_windows), BLOCKS)
    ranges = _by_bucket(firsts).mapInArrow(_lister(), "doc long, digest long, start array<int>, end array<int>")
    texts = source.mapInArrow(_squeeze, "doc long, digest long, size int, packed binary")
    joined_docs = texts.join(ranges.select(F.col("doc").alias("doc_r"), F.col("digest").alias("digest_r"), "start", "end"),
                              (F.coalesce("doc", F.lit(int(LAST))) == F.col("doc_r")) & (F.col("digest") == F.col("digest_r")), "left")
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return joined_docs.select("doc", "size", "packed", "start", "end").mapInArrow(_remover(size, "text", ["doc"]), schema).withColumnRenamed("doc", id)


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
