import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import decontaminate as module
from ledgerfold.llm.decontaminate import decontaminate, digest, scan
from ledgerfold.llm.words import LOWER, SYMBOLS, Words, split_words
from tests.llm.cases import documents, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id string, text string, doc_id int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def items(rows):
    long = next(t for i, t in rows if i == 10).split(" ")
    return [("b", " ".join(long[40:70]).upper()), ("a", "ONE, two!three"), ("c", ""), ("d", None), (None, "ünï"), ("a", "one two three"), ("e", " ".join(long[40:49]) + " never")]


def brute(rows, tests):
    windows = {}
    for i, t in tests:
        w = WORD.findall(lower(t))
        for j in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[j : j + 10]), set()).update([i] if i is not None else [])
    out = []
    for i, t in rows:
        w, hit, ids = WORD.findall(lower(t)), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    ids |= windows[tuple(w[j : j + n])]
        out.append((i, len(w), sorted(hit), sorted(ids)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_bytes", [1 << 20, 150])
def test_hits_against_brute_force(spark, max_bytes):
    rows = odd_rows()
    tests = items(rows)
    found = scan(documents(spark, rows), spark.createDataFrame([(i, t, 0) for i, t in tests], ITEMS), max_bytes=max_bytes)
    got = [(r.doc_id, r.n_words, [p for s in r.spans for p in range(s.start, s.end)], r["items"]) for r in found.collect()]
    want = brute(rows, tests)
    assert sorted(got, key=repr) == want
    assert sum(r.contaminated for r in digest(found).collect()) == sum(bool(h) for _, _, h, _ in want)


def test_documents_or_spans_go(spark):
    rows = [(1, "Keep this. Secret TEST words of an item are here, and more."), (2, "clean"), (3, None), (4, "secret test words")]
    tests = spark.createDataFrame([("x", "secret test words", 0)], ITEMS)
    docs = documents(spark, rows)
    left = decontaminate(docs, tests)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontaminate(docs, tests, drop=False).collect()}
    assert cut == {1: "Keep this.  of an item are here, and more.", 2: "clean", 3: None, 4: ""}


def test_spans_of_several_slices_are_cut_once(spark):
    words = [f"w{i}" for i in range(40)]
    tests = spark.createDataFrame([("a", " ".join(words[5:17]), 0), ("b", " ".join(words[12:25]), 0), ("c", " ".join(words[25:36]), 0)], ITEMS)
    docs = documents(spark, [(1, " ".join(words)), (2, ", ".join(words[3:20])), (3, "clean")])
    want = {1: " ".join(words[:5]) + "  " + " ".join(words[36:]), 2: "w3, w4, , w17, w18, w19", 3: "clean"}
    for max_bytes in (1 << 20, 150, 20):
        cut = decontaminate(docs, tests, drop=False, max_bytes=max_bytes)
        assert cut.columns == docs.columns and {r.doc_id: r.text for r in cut.collect()} == want


def test_empty_tables(spark):
    docs, none = documents(spark, [(1, "a b")]), spark.createDataFrame([], ITEMS)
    assert [tuple(r) for r in scan(docs, none).collect()] == [(1, 2, [], [])]
    assert scan(documents(spark, []), none).collect() == [] and decontaminate(docs, none).count() == 1


def test_windows_whose_hashes_meet_are_told_apart_by_their_words(monkeypatch):
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    tests = [(f"i{k}", say(rng.choice([2, 3, 12, 14]))) for k in range(40)]
    rows = [(k, say(60)) for k in range(20)] + [(99, tests[3][1])]
    whole = Words.windows

    def few(self, length, hashes):
        at, h = whole(self, length, hashes)
        return at, h % np.uint64(5)

    monkeypatch.setattr(Words, "windows", few)
    known = module.test_windows([i for i, _ in tests], [t for _, t in tests], 10)
    words = split_words(pa.array([t for _, t in rows]), SYMBOLS, LOWER)
    hit, items = module._hits(words, known)
    want = brute(rows, tests)
    row = words.row()
    got = [(i, len(t.split(" ")), (np.flatnonzero(hit & (row == k)) - words.first[k]).tolist(), sorted(items.get(k, ()))) for k, (i, t) in enumerate(rows)]
    assert sorted(got, key=repr) == want and any(h for _, _, h, _ in want)
    assert len(known.windows[2].hashes) == len({t for _, t in tests if len(t) == 3})


@pytest.mark.parametrize("max_bytes", [1 << 20, 150])
def test_kept_columns_with_names_of_the_result(spark, max_bytes):
    rows = odd_rows()
    docs = documents(spark, rows).withColumn("items", F.col("doc_id")).withColumn("ITEMS_", F.lit(1))
    tests = spark.createDataFrame([(i, t, 0) for i, t in items(rows)], ITEMS)
    found = scan(docs, tests, keep=("doc_id", "n_words", "items", "text"), max_bytes=max_bytes)
    assert found.columns == ["doc_id", "n_words_", "items_", "text", "n_words", "spans", "items"]
    assert sorted(((r.doc_id, r["items"]) for r in found.collect()), key=repr) == sorted(((i, got) for i, _, _, got in brute(rows, items(rows))), key=repr)
