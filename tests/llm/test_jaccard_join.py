import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from ledgerfold.llm import jaccard_join
from ledgerfold.llm.jaccard_join import _open_tiles, keep_one, similar_documents
from tests.llm.cases import documents, odd_rows, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1) if w else 0))


def brute(rows):
    """Groups of rows; a class without any id links to no other class."""
    sets = [shingles(t) for _, t in rows]
    named = {s for (i, _), s in zip(rows, sets, strict=True) if i is not None}
    group = list(range(len(rows)))
    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and (sets[a] == sets[b] or {sets[a], sets[b]} <= named) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    ids = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            ids[root(x)] = min(i, ids.get(root(x), i))
    return sorted(((i, len(s), ids.get(root(x)) if s else i) for x, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def near_copies(seed):
    """Chains and stars of edited copies, so that links meet the limit from both sides."""
    rng = random.Random(seed)
    rows = odd_rows(seed)
    for family in range(6):
        words = sentence(rng, rng.choice([12, 40, 150])).split(" ")
        for copy in range(12):
            rows.append((100 + 20 * family + copy, " ".join(words)))
            for _ in range(rng.choice([0, 1, 1, 2])):
                words[rng.randrange(len(words))] = sentence(rng, 1)
    return rows


@pytest.mark.parametrize("whole", [3, 1 << 20])
def test_shingles_of_the_same_classes_make_one_tile(monkeypatch, whole):
    monkeypatch.setattr(jaccard_join, "WHOLE", whole)
    rng = random.Random(4)
    groups = [[11, 12], [11, 12, 13, 15, 16], [14], [12, 13], [17, 17], []]
    rows = sorted((s, c % 2, c) for s in range(-40, 40) for c in groups[s % len(groups)] * rng.choice([1, 2]))
    for size in (1, 3, 10, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[a : a + size], strict=True), (pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["shingle", "band", "cls"])
                   for a in range(0, len(rows), size)]
        tiles = sorted(tuple(r.values()) for out in jaccard_join._runs(iter(batches)) for r in out.to_pylist())
        kept = [r for out in jaccard_join._stars(iter([pa.RecordBatch.from_pylist([dict(zip(("tile", "band", "cls"), r, strict=True)) for r in tiles[a : a + size]]) for a in range(0, len(tiles), size)])) for r in out.to_pylist()]
        held = defaultdict(list)
        for r in kept:
            held[r["tile"]].append((r["cls"], r["lead"]))
        got = sorted(sorted(x) for x in held.values())
        large = [(11, None), (12, None), (13, 11), (15, 11), (16, 12)]
        assert {repr(x) for x in got} == {repr([(11, None), (12, None)]), repr(large), repr([(12, None), (13, None)])}
        if whole > 3:
            assert len(got) == 3 and (size < 1000 or len(tiles) <= 14)
    assert list(jaccard_join._runs(iter([])))[0].num_rows == 0 and not list(jaccard_join._stars(iter([])))


def test_tiles_of_one_component_are_not_scanned(spark):
    tiles = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 12), (3, 12), (3, 13), (3, 10), (4, 13)], "shingle long, cls long")
    known = spark.createDataFrame([(10, 5, b"a", 10), (11, 5, b"b", 10), (12, 6, b"c", 12), (13, 6, b"d", 12)], "cls long, n long, bits binary, component long")
    got = sorted((r.shingle, r.n, r.cls, r.component, bytes(r.bits)) for r in _open_tiles(tiles, known).collect())
    assert got == [(2, 5, 10, 10, b"a"), (2, 6, 12, 12, b"c"), (3, 5, 10, 10, b"a"), (3, 6, 12, 12, b"c"), (3, 6, 13, 12, b"d")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, seed):
    rows = near_copies(seed)
    got = similar_documents(documents(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_one_stays_of_each_group(spark):
    rows = [(i, t) for i, t in near_copies(3) if i is not None]
    want = sorted(repr(i) for i, _, c in brute(rows) if i == c)
    docs = documents(spark, rows)
    left = keep_one(docs)
    assert left.columns == docs.columns and sorted(repr(r.doc_id) for r in left.collect()) == want


def test_rows_of_repeated_and_null_ids_are_told_apart_by_text(spark):
    rng = random.Random(9)
    a, b, c, d, e = (sentence(rng, 30) for _ in range(5))
    rows = [(1, a), (1, a), (2, a), (2, b), (None, a), (None, a), (None, c), (None, c), (3, d), (3, d + " x"), (4, None), (4, ""), (None, None), (5, b), (6, e)]
    left = keep_one(documents(spark, rows))
    assert left.columns == documents(spark, []).columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    assert [x for x in got if x[1] not in (d, d + " x")] == sorted([(1, a), (2, b), (None, c), (4, None), (4, ""), (None, None), (6, e)], key=repr)
    assert len([x for x in got if x[1] in (d, d + " x")]) == 1
    assert sorted((r.doc_id, r.text) for r in keep_one(documents(spark, [(1, a), (2, a), (3, b)])).collect()) == [(1, a), (3, b)]


def test_empty_table(spark):
    assert similar_documents(documents(spark, [])).collect() == []
    assert similar_documents(documents(spark, [(1, None), (2, "")])).count() == 2
