import math
import random

import numpy as np
import pytest

from ledgerfold.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>, label int, q int, score long, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, None) for i, v in rows], SCHEMA).repartition(4)


def rows(seed, n=900, width=16, copies=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(5)]
    out = [(i, [float(np.float32(x + rng.gauss(0, 0.05))) for x in rng.choice(centres)]) for i in range(n)]
    return out + [(n + k, out[7][1]) for k in range(copies)] + [(-100, out[3][1]), (-300, None), (-400, [None] * width), (-500, [float("nan")] * width), (None, out[5][1]), (200, out[200 % n][1]), (200, out[9][1])]


def brute(table_rows, k=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in table_rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, x) in enumerate(kept):
        if i is None or i % 100:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y)), j is None, j or 0) for b, (j, y) in enumerate(kept) if a != b)[:k]
        out += [(i, r, None if null else j, -s) for r, (s, null, j) in enumerate(scores, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("case", [rows(1), rows(2, 1500, 64, copies=300), rows(3, 12, 4), [(0, [0.5] * 4)], [(0, [0.5] * 4), (0, [0.5] * 4), (100, [1.0, 2.0]), (1, [])],
                                  [(i, [0.25, 0.5]) for i in range(400)]])
def test_hits_against_all_pairs(spark, case):
    df = table(spark, case)
    got = topk_search.search(df, topk_search.hundredth(df))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(case)


def test_small_blocks_and_slices_give_the_same(spark, monkeypatch):
    case = rows(4, 1200, 16)
    monkeypatch.setattr(topk_search, "SLICE_NUMBERS", 16 * 5)
    monkeypatch.setattr(topk_search, "SAMPLE_ROWS", 4)
    df = table(spark, case)
    assert sorted(map(tuple, topk_search.search(df, topk_search.hundredth(df)).collect()), key=repr) == brute(case)


def test_bounds_drop_candidates_and_lose_none():
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, (3000, 64)) // (1 + np.arange(64))
    q = topk_search.Queries(np.arange(40), np.zeros(40, bool), x[:40], np.full(40, topk_search.LEAST))
    exact = q.x @ x.T
    q.least[:] = np.sort(exact, axis=1)[:, -10]
    cuts = q.cuts()
    bits = topk_search.limb_bits(8)
    vertical = [(bits, topk_search.limbs(np.ascontiguousarray(x.T[c]), bits)) for c in cuts]
    a, c, score = topk_search._survivors(q, slice(0, 40), q.least, cuts, topk_search._left(q.x, cuts), x, vertical, topk_search._left(x, cuts), 11)
    want = {(i, j, exact[i, j]) for i, j in zip(*np.nonzero(exact >= q.least[:, None]))}
    assert set(zip(a.tolist(), c.tolist(), score.tolist())) == want
    after = [(q.least[:, None] - exact_part <= topk_search._gain(topk_search._left(q.x, cuts)[:, k][:, None], topk_search._left(x, cuts)[:, k][None, :])).mean()
             for k, exact_part in enumerate(np.cumsum([q.x[:, c] @ x[:, c].T for c in cuts], axis=0))]
    assert after == sorted(after, reverse=True) and after[1] < 0.5 and after[3] < 0.05


def test_search_without_own_row(spark):
    df = table(spark, rows(6, 300, 8))
    asked = df.where("vec_id in (1, 2)")
    got = topk_search.search(df.where("vec_id > 2"), asked, 3, skip_own=False)
    assert got.groupBy("query_id").count().orderBy("query_id").collect() == [(1, 3), (2, 3)]


def test_empty_tables(spark):
    for case in ([], [(1, [0.5])], [(0, None), (1, [0.5])]):
        df = table(spark, case)
        assert topk_search.search(df, topk_search.hundredth(df)).collect() == []
