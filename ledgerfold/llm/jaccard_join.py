"""Similarity join on word shingles: size-banded tiles with hashed bitmap signatures.

A document's set holds its distinct `k`-word shingles (A-Z lower-cased; with fewer words the
whole sequence). Two documents link when 100 * |A and B| >= percent * |A or B|.

Documents with equal sets form one class. A class puts its rarest-first prefix, of which two
linking classes must share a shingle, into tiles: a tile is one prefix shingle, or all those that the same
classes share, sorted by size bands. First each class is held against the smallest class of its tile and band (a star, so
a group of g costs g comparisons); links found join classes to components. Then tiles that still
hold several components are scanned by size. In the first rounds each class tries its few
closest partners of other components, which joins what belongs together; tiles where that left
partners over are scanned again, and the last round tries all. Bitmaps of one parity bit per hashed shingle bound the overlap from above
(bits that differ are shingles that differ); pairs that pass go to exact intersection. Pairs
inside a component need no look, as they cannot change it; no other pair is left out. Tiles carry bitmaps folded
to a fixed width; pairs that pass there are held against the whole ones before texts are fetched.

Defined cases: null or empty text has an empty set and links with nothing; equal rows are in
one class; a row without id belongs to its class, but texts are fetched by id only, so a
class of such rows alone links to no other.

Scale: postings are 8-byte shingle and class only. Shingles that occur far above the
average (counted in a fixed table of cells) come last in the prefix order, so that a
passage shared by many documents makes no huge tile. Texts are fetched for candidate
documents only, picked by a bitmap of fixed size before the shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerfold.llm.components import components
from ledgerfold.llm.store import fresh, stored
from ledgerfold.llm.words import LOWER, SMALL_CHUNK, SPACES, Sums, Words, chunks, mix, split_words

K = 5
PERCENT = 80
CELL_BITS = 22
#: Partners that a class tries in each round before the last one, which tries all that are left.
ROUNDS = (3, 3, None)
#: Bits of the filter that picks candidate documents before their texts are shuffled.
FILTER_BITS = 23
#: Bits of a bitmap that travel with every posting of an open tile; pairs that pass are held against their whole bitmaps.
TILE_BITS = 1024
SEEN = 1 << 20
#: Rows of a shingle that a task gathers to see whether another shingle has the same classes.
WHOLE = 1 << 20

CLASSES = T.StructType([T.StructField("doc", T.LongType()), T.StructField("n", T.LongType()), T.StructField("cls", T.LongType()),
                        T.StructField("bits", T.BinaryType()), T.StructField("prefix", T.ArrayType(T.LongType()))])


# -- sets ------------------------------------------------------------------------------------


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin (one more at the end)."""
    hashes, count = words.hashes(), words.count
    at, found = words.windows(k, hashes)
    short = np.flatnonzero((count > 0) & (count < k))
    row = np.concatenate([words.row()[at], short])
    found = np.concatenate([found, Sums(hashes).hashed(words.first[short], words.first[short + 1])])
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return found[new], np.searchsorted(row[new], np.arange(len(count) + 1))


def class_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One value for each set, whatever the order; 0 for empty sets."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes))])
    n = np.diff(first).astype(np.uint64)
    return np.where(n > 0, mix(total[first[1:]] - total[first[:-1]] + n * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1), np.uint64(0)).view(np.int64)


def bitmaps(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """One parity bit for each hash value; 64 bits at least, and as many as shingles, to the next power of 2."""
    n = np.diff(first)
    width = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    edge = np.concatenate([[0], np.cumsum(width)])
    row = np.repeat(np.arange(len(n)), n)
    place = edge[row] + (hashes & (width[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=edge[-1]) & 1).astype(np.uint8)
    raw = np.packbits(odd, bitorder="little").tobytes()
    return [raw[a // 8 : b // 8] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows of 64-bit words, halved until they have the size: parities of a narrower bitmap."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


# -- stages ----------------------------------------------------------------------------------


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple]:
    for batch in chunks(batches, size=SMALL_CHUNK):
        words = split_words(batch.column(1), SPACES, LOWER)
        hashes, first = shingle_sets(words, k)
        yield batch, hashes, first


def _counter(k: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = np.zeros(1 << CELL_BITS, np.int64), set()
        for _, hashes, first in _sets(batches, k):
            new = _unseen(class_hashes(hashes, first), seen)
            np.add.at(cells, (hashes[np.repeat(new, np.diff(first))] >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
        full = np.flatnonzero(cells >= max(4, 2 * cells.mean()))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(full, -1)), pa.array(np.append(cells[full], cells.sum()))], names=["cell", "n"])

    return count


def _unseen(classes: np.ndarray, seen: set[int]) -> np.ndarray:
    """Rows whose class this task has not met yet; a full memory starts anew, which repeats classes but loses none."""
    if len(seen) > SEEN:
        seen.clear()
    new = np.zeros(len(classes), bool)
    for i, c in enumerate(classes.tolist()):
        if c and c not in seen:
            seen.add(c)
            new[i] = True
    return new


def _classifier(k: int, percent: int, common):
    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, hashes, first in _sets(batches, k):
            classes, n = class_hashes(hashes, first), np.diff(first)
            new = _unseen(classes, seen)
            row = np.repeat(np.arange(len(n)), n)
            late = common.value[(hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
            ranked = hashes[np.lexsort((hashes, late, row))] if late.any() else hashes
            # A partner shares at least this many shingles, so one of the others and one more must be shared.
            length = np.where(new, n - (percent * n + 99) // 100 + 1, 0)
            picked = np.arange(len(row)) - first[row] < length[row]
            offsets = np.concatenate([[0], np.cumsum(length)])
            bits = bitmaps(hashes, first)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array(classes), pa.array([b if x else None for b, x in zip(bits, new.tolist(), strict=True)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=np.append(~new, False)), pa.array(ranked[picked].view(np.int64)))], names=CLASSES.names)

    return classify


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (shingle, band, cls) sorted by shingle: tiles (tile, band, cls) of shingles with several classes, a class once
    in each. Shingles of the same classes get the same number; one of more than WHOLE rows is not gathered and has its own."""
    held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)]  # the last shingle's rows, unless they are too many
    large: int | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        shingle, band, cls = (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True))
        # A shingle that is not gathered goes out at once, here too.
        over = int(np.searchsorted(shingle, large, "right")) if large is not None and shingle[0] == large else 0
        out = [(shingle[:over], band[:over], cls[:over])]
        last = max(over, int(np.searchsorted(shingle, shingle[-1])))
        out.append(_tiled(shingle[over:last], band[over:last], cls[over:last]))
        held = [shingle[last:], band[last:], cls[last:]]
        if over == len(shingle):
            pass
        elif len(held[0]) > WHOLE and (held[2] != held[2][0]).any():
            large = int(shingle[-1])
            out.append(tuple(held))
            held = [c[:0] for c in held]
        else:
            large = None
        yield _rows(out)
    yield _rows([_tiled(*held)])


def _rows(parts: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=["tile", "band", "cls"])


def _tiled(shingle: np.ndarray, band: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tile, band and cls of whole shingles, sorted: without those of one class, and once for all shingles of the same classes."""
    several = np.zeros(len(shingle), bool)
    several[1:] = shingle[1:] == shingle[:-1]
    several[:-1] |= several[1:]
    shingle, band, cls = shingle[several], band[several], cls[several]
    order = np.lexsort((cls, shingle))
    shingle, band, cls = shingle[order], band[order], cls[order]
    distinct = np.ones(len(cls), bool)
    distinct[1:] = (shingle[1:] != shingle[:-1]) | (cls[1:] != cls[:-1])
    shingle, band, cls = shingle[distinct], band[distinct], cls[distinct]
    first = np.append(np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1])[: len(shingle)]), len(shingle))
    size = np.diff(first)
    tile = class_hashes(cls.view(np.uint64), first)
    _, once = np.unique(tile, return_index=True)
    picked = np.zeros(len(size), bool)
    picked[once] = True
    kept = np.repeat(picked & (size > 1), size)
    return np.repeat(tile, size)[kept], band[kept], cls[kept]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of tiles sorted by tile, band and cls: their distinct rows (tile, cls, lead). The lead is the smallest class of tile and
    band, null where that is the class itself."""
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tile, band, cls = (c.to_numpy() for c in batch.columns)
        new = np.ones(len(cls), bool)
        new[1:] = (tile[1:] != tile[:-1]) | (band[1:] != band[:-1])
        distinct = new.copy()
        distinct[1:] |= cls[1:] != cls[:-1]
        lead = cls[np.maximum.accumulate(np.where(new, np.arange(len(cls)), 0))]
        if last is not None and (tile[0], band[0]) == last[:2]:
            stop = np.flatnonzero(new)[1] if new.sum() > 1 else len(cls)
            lead[:stop] = last[2]
            distinct[0] = cls[0] != last[3]
        last = (tile[-1], band[-1], lead[-1], cls[-1])
        tile, cls, lead = tile[distinct], cls[distinct], lead[distinct]
        yield pa.RecordBatch.from_arrays([pa.array(tile), pa.array(cls), pa.array(lead, mask=lead == cls)], names=["tile", "cls", "lead"])


def _passes(n_a: np.ndarray, n_b: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """|A or B| - |A and B| is `differ` at least, which leaves this much in common at most."""
    common = (n_a + n_b - differ) // 2
    return (100 * common >= percent * (n_a + n_b - common)) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


def _tiles(percent: int, limit: int | None):
    """Of rows (shingle, n, cls, component, bits) sorted by shingle and n: pairs of different components
    whose sizes and bitmaps let them link; of each row the `limit` closest ones. Tiles in which a row
    had more of them are named in column `more`, once for each batch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, done = None, {}, set()
        for batch in batches:
            out: set[tuple[int, int]] = set()
            more: set[int] = set()
            for shingle, n, cls, component, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shingle != now:
                    now, held = shingle, {}
                row = np.frombuffer(bits, np.uint64)[None, :]
                near: list[tuple[int, int]] = []
                # One block of rows for each bitmap width.
                for width, block in held.items():
                    size = block["n"][: block["used"]]
                    low = int(np.searchsorted(size, (percent * n + 99) // 100))
                    if low == block["used"]:
                        continue
                    part = slice(low, block["used"])
                    least = min(width, row.shape[1])
                    differ = np.bitwise_count(folded(block["bits"][part], least) ^ folded(row, least)).sum(1).astype(np.int64)
                    good = np.flatnonzero((block["component"][part] != component) & _passes(size[low:], np.int64(n), differ, percent))
                    if limit is not None and len(good) > limit:
                        more.add(shingle)
                        good = good[np.argsort(differ[good], kind="stable")[:limit]]
                    near += zip(differ[good].tolist(), block["cls"][part][good].tolist(), strict=True)
                if limit is not None and len(near) > limit:
                    more.add(shingle)
                    near = sorted(near)[:limit]
                out |= {(min(x, cls), max(x, cls)) for _, x in near}
                block = held.get(row.shape[1])
                if block is None:
                    block = held[row.shape[1]] = {"used": 0, "n": np.zeros(4, np.int64), "cls": np.zeros(4, np.int64), "component": np.zeros(4, np.int64), "bits": np.zeros((4, row.shape[1]), np.uint64)}
                if block["used"] == len(block["n"]):
                    for c in ("n", "cls", "component", "bits"):
                        block[c] = np.concatenate([block[c], np.zeros_like(block[c])])
                for c, value in (("n", n), ("cls", cls), ("component", component), ("bits", row[0])):
                    block[c][block["used"]] = value
                block["used"] += 1
            pairs = sorted(out - done)
            if len(done) > SEEN:
                done.clear()
            done.update(pairs)
            none = [None] * len(more)
            columns = ([x for x, _ in pairs] + none, [x for _, x in pairs] + none, [None] * len(pairs) + sorted(more))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "more"])

    return scan


def _bounder(percent: int):
    """Of pairs (a, n_a, bits_a, b, n_b, bits_b): those whose sizes and bitmaps let them link."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64)[None, :], np.frombuffer(y, np.uint64)[None, :]
                width = min(x.shape[1], y.shape[1])
                differ[i] = np.bitwise_count(folded(x, width) ^ folded(y, width)).sum()
            yield batch.select(["a", "b"]).filter(pa.array(_passes(batch.column(1).to_numpy(), batch.column(4).to_numpy(), differ, percent)))

    return bound


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cls, n, bits) with bitmaps folded to TILE_BITS."""
    for batch in batches:
        short = [folded(np.frombuffer(b, np.uint64)[None, :], TILE_BITS // 64)[0].tobytes() for b in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(short, pa.binary())], names=batch.schema.names)


def _chooser(bits):
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            place = (mix(ids.view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            yield batch.filter(pa.array((bits.value[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))

    return choose


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = (mix(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        cell, inverse = np.unique(place >> 6, return_inverse=True)
        value = np.zeros(len(cell), np.uint64)
        np.bitwise_or.at(value, inverse, np.uint64(1) << (place & 63).astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(value.view(np.int64))], names=["cell", "bits"])


def _verifier(k: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(chunks(batches, "text_a"), "text_b"):
            sets = []
            for side in ("a", "b"):
                hashes, first = shingle_sets(split_words(batch.column(batch.schema.get_field_index(f"text_{side}")), SPACES, LOWER), k)
                # Rows of the same id with another text are not meant.
                sets.append((hashes, first, class_hashes(hashes, first) == batch.column(batch.schema.get_field_index(side)).to_numpy()))
            (ha, fa, right_a), (hb, fb, right_b) = sets
            row = np.concatenate([np.repeat(np.arange(batch.num_rows), np.diff(f)) for f in (fa, fb)])
            both = np.concatenate([ha, hb])
            order = np.lexsort((both, row))
            twice = (both[order][1:] == both[order][:-1]) & (row[order][1:] == row[order][:-1])
            common = np.bincount(row[order][1:][twice], minlength=batch.num_rows)
            link = (100 * common >= percent * (np.diff(fa) + np.diff(fb) - common)) & right_a & right_b
            yield batch.select(["a", "b"]).filter(pa.array(link))

    return verify


def _linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs of classes that link, by exact intersection of their texts' sets."""
    spark = docs.sparkSession
    rep = reps.select(F.col("cls"), F.col("rep"))
    pairs = stored(pairs.join(rep.select(F.col("cls").alias("a"), F.col("rep").alias("doc_a")), "a").join(rep.select(F.col("cls").alias("b"), F.col("rep").alias("doc_b")), "b").where("doc_a IS NOT NULL AND doc_b IS NOT NULL"))
    ends = pairs.select(F.col("doc_a").alias("doc")).unionByName(pairs.select(F.col("doc_b").alias("doc")))
    cells = ends.mapInArrow(_cells, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[cells.column(0).to_numpy()] = cells.column(1).to_numpy()
    texts = docs.mapInArrow(_chooser(spark.sparkContext.broadcast(bits.view(np.uint8))), docs.schema)
    both = pairs.join(texts.select(F.col("doc").alias("doc_a"), F.col("text").alias("text_a")), "doc_a").join(texts.select(F.col("doc").alias("doc_b"), F.col("text").alias("text_b")), "doc_b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verifier(k, percent), "a long, b long")


def _open_tiles(tiles: DataFrame, known: DataFrame) -> DataFrame:
    """shingle, n, cls, component, bits of the tiles that hold several components."""
    placed = tiles.join(known.select("cls", "component"), "cls")
    mixed = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("shingle")
    return tiles.join(mixed, "shingle", "left_semi").join(known, "cls").select("shingle", "n", "cls", "component", "bits")


def similar_classes(docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = K, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc, n, cls) for each document, and (cls, component) for each class that links to another."""
    spark = docs.sparkSession
    source = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    counted = source.mapInArrow(_counter(k), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    total = counted.where("cell = -1").first()
    common = np.zeros(1 << CELL_BITS, bool)
    common[[r.cell for r in counted.where(f"cell >= 0 AND n > {max(32, 4 * (total.n if total else 0) >> CELL_BITS)}").collect()]] = True
    classes = stored(source.mapInArrow(_classifier(k, percent, spark.sparkContext.broadcast(common)), CLASSES))
    reps = stored(classes.where("n > 0").groupBy("cls").agg(F.min("doc").alias("rep"), F.max("n").alias("n"), F.max("bits").alias("bits")))
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int")
    postings = classes.where("prefix IS NOT NULL").select(F.explode("prefix").alias("shingle"), band.alias("band"), "cls")
    # Many shingles are shared by the same classes: those tiles are one.
    runs = postings.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(_runs, "tile long, band int, cls long")
    shared = stored(runs.repartition("tile").sortWithinPartitions("tile", "band", "cls").mapInArrow(_stars, "tile long, cls long, lead long"))
    stars = shared.where("lead IS NOT NULL").select(F.col("lead").alias("a"), F.col("cls").alias("b")).distinct()
    side = lambda x: reps.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    bounded = lambda pairs: stored(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "n_a", "bits_a", "b", "n_b", "bits_b").mapInArrow(_bounder(percent), "a long, b long"))
    tried = bounded(stars)
    links = stored(_linked(tried, reps, source, k, percent))
    short = stored(reps.select("cls", "n", "bits").mapInArrow(_shorten, "cls long, n long, bits binary"))
    joined = lambda: stored(components(links).select(F.col("vertex").alias("cls"), "component"))
    member, tiles = joined(), shared.select(F.col("tile").alias("shingle"), "cls")
    for limit in ROUNDS:
        known = short.join(member, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        rows = _open_tiles(tiles, known)
        found = stored(rows.repartition("shingle").sortWithinPartitions("shingle", "n", "cls").mapInArrow(_tiles(percent, limit), "a long, b long, more long"))
        new = stored(found.where("more IS NULL").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
        # What later rounds still have to look at: tiles with more partners than were tried.
        tiles = tiles.join(found.where("more IS NOT NULL").select(F.col("more").alias("shingle")).distinct(), "shingle", "left_semi")
        tried = tried.unionByName(new)
        more = stored(_linked(bounded(new), reps, source, k, percent))
        if not more.isEmpty():
            links = links.unionByName(more)
            member = joined()
        if found.where("more IS NOT NULL").isEmpty():
            break
    return classes.select("doc", "n", "cls"), member


def similar_documents(docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = K, percent: int = PERCENT) -> DataFrame:
    """id, `n_shingles`, `component_id` (smallest id reachable by links) for each document."""
    classes, linked = similar_classes(docs, id=id, text=text, k=k, percent=percent)
    member = classes.where("n > 0").groupBy("cls").agg(F.min("doc").alias("low")).join(linked, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    by_class = member.join(lowest, "component").select("cls", "component_id")
    out = classes.join(by_class, "cls", "left").withColumn("component_id", F.coalesce("component_id", "doc"))
    return out.select(F.col("doc").alias(id), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = K, percent: int = PERCENT) -> DataFrame:
    """One document of each component, of the smallest id, and all that have no words.

    Ids that occur once decide by themselves. Rows whose id is null or repeated are told apart by their class: a text that
    is unlike anything stays, whatever other rows its id has, and of several rows with a component's smallest id one stays. A null
    id counts as larger than all others."""
    classes, linked = similar_classes(docs, id=id, text=text, k=k, percent=percent)
    member = classes.where("n > 0").groupBy("cls").agg(F.min("doc").alias("low")).join(linked, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    lowest = member.groupBy("component").agg(F.min("low").alias("least"))
    placed = stored(member.join(lowest, "component").select(F.col("cls").alias("of_class"), "component", "least"))
    odd = stored(classes.groupBy(F.col("doc").alias("odd")).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1 OR odd IS NULL").select("odd"))
    gone = classes.where("n > 0").join(placed, F.col("cls") == F.col("of_class")).where("least < doc").select(F.col("doc").alias("gone")).distinct()
    number = F.col(f"`{id}`").cast("long")
    if odd.isEmpty():
        return docs.join(gone, number == F.col("gone"), "left_anti")
    once = docs.join(odd, number.eqNullSafe(F.col("odd")), "left_anti").join(gone, number == F.col("gone"), "left_anti")
    mine, = fresh(docs, "cls")
    schema = T.StructType([*docs.schema, T.StructField(mine, T.LongType())])

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            words = split_words(batch.column(batch.schema.get_field_index(text)), SPACES, LOWER)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(class_hashes(*shingle_sets(words, k)))], names=schema.names)

    several = stored(docs.join(odd, number.eqNullSafe(F.col("odd")), "left_semi").mapInArrow(classed, schema))
    silent = several.where(F.col(mine) == 0).drop(mine)
    spoken = several.join(placed, F.col(mine) == F.col("of_class")).where(number.eqNullSafe(F.col("least")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = spoken.groupBy("component").agg(F.min_by(row, F.struct(F.col(f"`{text}`"), F.col(mine))).alias("row")).select("row.*")
    return once.unionByName(silent).unionByName(one)
