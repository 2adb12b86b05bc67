"""Source divergence audit: how far the term shares of the sources of a language lie apart.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A language keeps the
terms that stand in `MIN_DOCS` of its documents or more, V of them. In a group (language and source, or the
language as a whole) with N occurrences of kept terms, a term with `count` of them has the share
p = 1 + floor(10^9 (count + 5) / (N + 5 V)). A pair of sources differs by the sum of |p - q| over all
kept terms; a source's own terms are those with a larger share than in its language.

Method: the counts of a language's sources by terms are cut into tiles of about `TILE` terms and
blocks of about `BLOCK` sources, each stored as a k^2-tree (k = 2): for every level a bitmap that
holds four bits for each non-empty quadrant above. Two blocks' trees are walked jointly, all pairs of
sources at once, level by level: a quadrant empty on both sides is left at once, since each of its
terms adds the same |p(0) - q(0)|, which is priced once for each pair from the number of terms met in
neither; the other quadrants are followed down to their leaves, where counts are compared.

Defined cases: null text, language and source are empty texts. A group without terms
takes part with counts of 0; where a language keeps no term, its pairs differ by 0 and there are no terms. Rows
that repeat count each time. Equal values rank by the UTF-8 order of the item. Other columns are not read. Shares are exact while a group has
less than 9 * 10^15 occurrences; beyond that the job fails.

Scale: each task counts its texts and hands on one row for each (language, source, term) and
flush; a common term or a hot source is thus reduced before the shuffle, and terms are dealt by hash. Nothing is
broadcast by hint or collected. The comparison of a tile holds TILE terms by two blocks of sources at
most (hashes deal them, so about), whatever the number of either; a row goes to as many tasks as
its language has blocks. The output has a row for each ordered pair of sources, as it must."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerfold.llm.store import stored
from ledgerfold.llm.words import LOWER, chunks, split_words

MIN_DOCS = 30
TOP_TERMS = 50
ADDED = 5
#: 10^9 as steps of a long division, so that no product leaves 64 bits.
STEPS, BASE = 3, 1000
TILE, BLOCK = 1024, 32
#: Rows of partial counts that a task holds, and pairs of quadrants that a walk holds at once.
HELD_ROWS, WALK = 400_000, 1 << 20

LETTERS = np.ones(256, bool)
LETTERS[0x80:] = False
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
PARTIAL = "lang string, source string, term string, n long, docs long"


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each (lang, source, term) of one batch; every group has a row without a term as well."""
    words = split_words(batch.column(2), LETTERS, LOWER)
    size = words.end - words.start
    first = np.concatenate([[0], np.cumsum(size)])
    letters = words.buf[np.arange(first[-1]) + np.repeat(words.start - first[:-1], size)]
    terms = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(first), pa.py_buffer(letters)).dictionary_encode()
    named = [batch.column(i).fill_null("").dictionary_encode() for i in (0, 1)]
    lang, source = (x.indices.to_numpy().astype(np.int64) for x in named)
    group, n_sources = lang * len(named[1].dictionary) + source, len(named[1].dictionary)
    v = max(1, len(terms.dictionary))
    in_doc, n = np.unique(words.row() * v + terms.indices.to_numpy(), return_counts=True)
    key = group[in_doc // v] * v + in_doc % v
    order = np.argsort(key, kind="stable")
    cell, at = np.unique(key[order], return_index=True)
    docs = np.diff(np.append(at, len(order)))
    n = np.add.reduceat(n[order], at) if len(at) else n
    alone = np.unique(group)
    groups = np.concatenate([cell // v, alone])
    said = pa.chunked_array([terms.dictionary.take(pa.array(cell % v)).cast(pa.string()), pa.nulls(len(alone), pa.string())])
    zero = np.zeros(len(alone), np.int64)
    return pa.table({"lang": named[0].dictionary.take(pa.array(groups // n_sources)), "source": named[1].dictionary.take(pa.array(groups % n_sources)),
                     "term": said, "n": np.concatenate([n, zero]), "docs": np.concatenate([docs, zero])})


def term_counts(docs: DataFrame, *, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): one row for each group and term, and one with a null term for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        fresh = 0

        def fold() -> pa.Table:
            all_ = pa.concat_tables(held)
            return all_.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["lang", "source", "term", "n", "docs"])

        for batch in chunks(batches, "text"):
            held.append(_counted(batch))
            fresh += held[-1].num_rows
            if fresh >= HELD_ROWS:
                held = [fold()]
                fresh = 0
                if held[0].num_rows >= HELD_ROWS:
                    yield from held[0].to_batches()
                    held = []
        if held:
            yield from fold().to_batches()

    parts = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")).mapInArrow(run, PARTIAL)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (N + 5 V)), by long division."""
    whole, rest, quotient = total + ADDED * kept, count + ADDED, F.lit(0).cast("long")
    for _ in range(STEPS):
        rest = rest * BASE
        quotient, rest = quotient * BASE + _whole(rest, whole), rest % whole
    return quotient + 1


def _whole(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    rest, quotient = count + ADDED, np.zeros_like(count)
    for _ in range(STEPS):
        rest = rest * BASE
        quotient = quotient * BASE + rest // whole
        rest %= whole
    return quotient + 1


class Tree:
    """k^2-tree of the non-zero cells of a square of 2**height rows and columns: `bits[l]` has four
    bits (row half, column half) for each quadrant of level l that is not empty, `values` the cells in leaf order."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, height: int):
        self.height = height
        path = np.zeros(len(row), np.int64)
        for l in range(height - 1, -1, -1):  # two bits a level, the highest first
            path = path << 2 | (row >> l & 1) << 1 | (column >> l & 1)
        order = np.argsort(path)
        path, self.values = path[order], value[order]
        self.bits, self.rank = [], []
        parents = np.zeros(min(1, len(path)), np.int64)
        for l in range(height - 1, -1, -1):
            nodes = np.unique(path >> (2 * l))
            bits = np.zeros(4 * len(parents), bool)
            bits[4 * np.searchsorted(parents, nodes >> 2) + (nodes & 3)] = True
            self.bits.append(bits)
            self.rank.append(np.cumsum(bits) - 1)
            parents = nodes

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The nodes of a level's quadrants, -1 for the empty ones (and below those)."""
        if not len(self.bits[level]):
            return np.full(len(node), -1)
        at = 4 * np.maximum(node, 0) + quadrant
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)


_HALVES = np.array([(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)])


def joint_leaves(a: Tree, b: Tree, rows_a: int, rows_b: int, upper: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(row of a, row of b, count in a, count in b) of all cells of one column that are non-zero in either row,
    in arrays of bounded size; with `upper` only pairs whose first row is the smaller one."""
    zero = np.zeros(1, np.int64)
    root_a, root_b = (zero if len(t.values) else zero - 1 for t in (a, b))
    walk = [(0, root_a, root_b, zero, zero)] if len(a.values) or len(b.values) else []
    while walk:
        level, na, nb, ra, rb = walk.pop()
        if level == a.height:
            ca, cb = (np.where(n >= 0, t.values[np.maximum(n, 0)] if len(t.values) else 0, 0) for n, t in ((na, a), (nb, b)))
            yield ra, rb, ca, cb
            continue
        if len(na) > WALK // 8:
            half = len(na) // 2
            walk += [(level, *(x[:half] for x in (na, nb, ra, rb))), (level, *(x[half:] for x in (na, nb, ra, rb)))]
            continue
        k = np.arange(8)
        ha, hb, hc = (np.tile(_HALVES[k, i], len(na)) for i in range(3))
        na, nb, ra, rb = (np.repeat(x, 8) for x in (na, nb, ra, rb))
        na, nb = a.child(level, na, 2 * ha + hc), b.child(level, nb, 2 * hb + hc)
        ra, rb = 2 * ra + ha, 2 * rb + hb
        below = a.height - level - 1
        keep = ((na >= 0) | (nb >= 0)) & (ra << below < rows_a) & (rb << below < rows_b)
        if upper:
            keep &= (ra < rb) if not below else (ra <= rb)
        if keep.any():
            walk.append((level + 1, na[keep], nb[keep], ra[keep], rb[keep]))


def _compared(tile: pa.Table) -> pa.Table:
    """Of one tile and two blocks of sources: for each pair the difference over terms met in either, and their number."""
    term = tile["term"].combine_chunks().dictionary_encode()
    said = term.is_valid().to_numpy(zero_copy_only=False)
    column = term.indices.fill_null(0).to_numpy().astype(np.int64)
    block = tile["block"].to_numpy()
    low, high = tile["low"][0].as_py(), tile["high"][0].as_py()
    height = max(1, int(len(term.dictionary) - 1).bit_length())
    sides = []
    for side in dict.fromkeys((low, high)):
        mine = np.flatnonzero(block == side)
        source = tile["source"].combine_chunks().take(pa.array(mine)).dictionary_encode()
        by_name = sorted(range(len(source.dictionary)), key=lambda k: source.dictionary[k].as_py().encode())
        row = np.argsort(by_name)[source.indices.to_numpy()].astype(np.int64) if by_name else np.zeros(0, np.int64)
        whole = np.ones(len(by_name), np.int64)
        whole[row] = tile["whole"].to_numpy()[mine]
        cell = said[mine]
        sides.append((row[cell], column[mine][cell], tile["n"].to_numpy()[mine][cell], [source.dictionary[k].as_py() for k in by_name], whole))
    height = max([height, *(int(len(s[3]) - 1).bit_length() for s in sides if s[3])])
    trees = [Tree(*s[:3], height) for s in sides]
    a, b = (sides * 2)[0], (sides * 2)[1]
    total, met = (np.zeros((len(a[3]), len(b[3])), np.int64) for _ in range(2))
    for ra, rb, ca, cb in joint_leaves(trees[0], trees[-1], len(a[3]), len(b[3]), low == high):
        np.add.at(total, (ra, rb), np.abs(_shares(ca, a[4][ra]) - _shares(cb, b[4][rb])))
        np.add.at(met, (ra, rb), 1)
    i, j = np.nonzero(met)
    return pa.table({"lang": pa.array([tile["lang"][0].as_py()] * len(i), pa.string()), "x": pa.array([a[3][k] for k in i], pa.string()), "y": pa.array([b[3][k] for k in j], pa.string()),
                     "total": pa.array(total[i, j]), "met": pa.array(met[i, j])})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, *, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` has the other sources of the language, part
    `term` the source's own terms."""
    counts = stored(term_counts(docs, lang=lang, source=source, text=text))
    said = counts.where("term IS NOT NULL")
    kept = stored(said.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs"))
    cells = stored(said.drop("docs").join(kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    groups = counts.where("term IS NULL").select("lang", "source")
    n_sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    group_n = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    sized = stored(groups.join(n_sources, "lang").join(langs, "lang", "left").join(group_n, ["lang", "source"], "left").na.fill(0, ["v", "lang_n", "group_n"]))

    terms = cells.join(sized, ["lang", "source"])
    terms = terms.withColumn("value", _share(F.col("n"), F.col("group_n"), F.col("v")) - _share(F.col("total"), F.col("lang_n"), F.col("v")))
    own = terms.where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)

    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_sources") / BLOCK))
    tiles = F.ceil(F.col("v") / TILE)
    of_source = [(F.col("group_n") + ADDED * F.col("v")).alias("whole"), F.pmod(F.xxhash64("source"), blocks).alias("block"), blocks.alias("blocks")]
    present = cells.join(sized, ["lang", "source"]).select("lang", "source", "term", "n", F.pmod(F.xxhash64("term"), tiles).alias("tile"), *of_source)
    # every source has a row without a term in every tile, as those without its terms differ from the others too
    named = sized.where("v > 0").select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("tile"), *of_source)
    dealt = present.unionByName(named)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("lang", "source", "term", "n", "whole", "tile", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    compared = dealt.groupBy("lang", "tile", "low", "high").applyInArrow(_compared, "lang string, x string, y string, total long, met long")
    summed = compared.groupBy("lang", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.sum("total").alias("total"), F.sum("met").alias("met"))

    none = F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("group_n"), F.col("v"))).otherwise(0)
    ends = sized.select("lang", "source", "v", none.alias("none"))
    x = ends.select("lang", F.col("source").alias("x"), "v", F.col("none").alias("none_x"))
    y = ends.select("lang", F.col("source").alias("y"), F.col("none").alias("none_y"))
    pairs = x.join(y, "lang").where("x < y").join(summed, ["lang", "x", "y"], "left").na.fill(0, ["total", "met"])
    pairs = pairs.withColumn("value", F.col("total") + (F.col("v") - F.col("met")) * F.abs(F.col("none_x") - F.col("none_y")))
    both = F.explode(F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item"))))
    pairs = stored(pairs.select("lang", both.alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value"))
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(own)
