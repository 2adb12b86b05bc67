import hashlib
import math
import random

import numpy as np
import pytest

from ledgerfold.llm import vector_codes
from ledgerfold.llm.int_vectors import dot, limb_bits, limbs, padded, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, code string, id long, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", None, 1) for i, v, l in rows], SCHEMA).repartition(3)


def rows(seed=1, n=700, width=8, ids=None):
    rng = random.Random(seed)
    out = [(rng.randrange(ids) if ids else i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(width)], rng.choice([1, 1, 1, 2, None])) for i in range(n)]
    return out + [(-5, None, 1), (-4, [1.0, None] * (width // 2), 1), (-3, [float("nan")] * width, 2), (-2, [float("inf")] + [0.0] * (width - 1), 2), out[0], out[1], (10**6, [], 1), (10**6 + 1, [0.5] * 3, 1)]


def brute(table_rows, rounds=4, parts=4, entries=256):
    """Plain Python integers, one row at a time."""
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in table_rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = next((len(v) for _, v, _ in kept if v and len(v) % parts == 0), 0)
    kept = [r for r in kept if len(r[1]) == width and width]
    cut = width // parts
    split = lambda v: [v[p * cut : (p + 1) * cut] for p in range(parts)]
    books = [[split(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        met = [[[] for _ in book] for book in books]
        for _, v, _ in kept:
            for p, x in enumerate(split(v)):
                met[p][nearest(p, x)[0]].append(x)
        books = [[[sum(c) // len(c) for c in zip(*xs)] if xs else old for xs, old in zip(met[p], books[p])] for p in range(parts)]
    coded = [(i, [nearest(p, x) for p, x in enumerate(split(v))], l) for i, v, l in kept]
    total = {}
    for _, c, l in coded:
        total[l] = total.get(l, 0) + sum(d for _, d in c)
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for e, _ in c), sum(d for _, d in c), total[l], sha) for i, c, l in coded), key=repr)


@pytest.mark.parametrize("case", [rows(), rows(2, 90), rows(3, 400, 4, ids=40), [(None, [0.5] * 4, None), (None, [0.25] * 4, None), (1, [0.1] * 4, 3)], rows(4, 300, 8, ids=5)])
def test_codes_against_plain_integers(spark, case):
    df = table(spark, case)
    got = vector_codes.digest(df, vector_codes.train(df))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(case)


def test_large_numbers_take_several_limbs(spark):
    rng = random.Random(5)
    case = [(i, [float(np.float32(rng.uniform(-2e5, 2e5))) for _ in range(8)], 1) for i in range(300)]
    df = table(spark, case)
    assert sorted(map(tuple, vector_codes.digest(df, vector_codes.train(df)).collect()), key=repr) == brute(case)
    too_large = table(spark, [(1, [1e30] * 4, 1)])
    with pytest.raises(Exception, match="too large"):
        vector_codes.train(too_large)


def test_empty_tables(spark):
    for case in ([], [(1, None, 1)], [(1, [], 1)]):
        df = table(spark, case)
        got = vector_codes.digest(df, vector_codes.train(df))
        assert got.collect() == [] and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(0)
    for depth, top in ((1, 2**30), (16, 2**28), (64, 2**28), (1000, 2**26), (3, 5)):
        a, b = rng.integers(-top, top + 1, (7, depth)), rng.integers(-top, top + 1, (depth, 5))
        a[0] = top
        b[:, 0] = -top
        bits = limb_bits(depth)
        want = (a.astype(object) @ b.astype(object)).tolist()
        assert dot(limbs(a, bits), limbs(b, bits), bits).tolist() == want
        assert all(np.abs(x).max() <= 2 ** (bits - 1) for x in limbs(a, bits)) and depth * 4 ** (bits - 1) <= 2**53
        if top > 2**25:
            assert len(limbs(a, bits)) > 1


def test_padding():
    import pyarrow as pa

    places, size, values = vectors(pa.array([[1.0, -0.0001], None, [], [0.5, None], [2.0, 3.0, 4.0]], pa.list_(pa.float32())))
    assert places.tolist() == [0, 2, 4] and size.tolist() == [2, 0, 3] and values.tolist() == [1024, -1, 2048, 3072, 4096]
    assert padded(size, values, 2).tolist() == [[1024, -1], [0, 0], [2048, 3072]]
