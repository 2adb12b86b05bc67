import mmap
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerfold.llm import ordinal_quality as oq
from tests.llm.cases import documents, odd_rows, sentence

SF = "/root/testdata/sf0.1"


def test_held_out_ratings(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0
    model = oq.train(docs, oq.ratings(labels.where(~held)))
    assert model.value[1].tolist() == sorted(model.value[1])
    graded = oq.grade(docs.join(labels.where(held), "doc_id"), model, keep=("doc_id", "quality", "toxic"))
    rate = {(r.quality, r.toxic): r.rate for r in graded.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rate[1, 0] > 0.99 and rate[0, 0] < 0.1 and rate[1, 1] < 0.65
    assert graded.where("expected_grade < 0 OR expected_grade > 2 OR tail_probability > expected_grade + 1e-9").count() == 0


def test_slopes_are_those_of_the_likelihood():
    """One step from 0 goes against the numeric slope of the likelihood."""
    rng = np.random.default_rng(0)
    first, index, value = np.arange(0, 61, 3), rng.integers(0, 8, 60).astype(np.int32), np.ones(60, np.float32)
    grade = rng.integers(0, 3, 20)
    weights, thresholds = oq.fit(first, index, value, grade, 3, epochs=200, batch=20, l1=0.0, l2=0.0, rate=0.3)

    def loss(w, t):
        score = np.bincount(np.repeat(np.arange(20), 3), w[index] * value, 20)
        edge = np.concatenate([[-np.inf], t, [np.inf]])
        return -np.log(oq._sigmoid(score - edge[grade]) - oq._sigmoid(score - edge[grade + 1])).sum()

    at = loss(weights, thresholds)
    assert at < loss(np.zeros_like(weights), thresholds)
    for i in range(8):
        for step in (0.05, -0.05):
            moved = weights.copy()
            moved[i] += step
            assert loss(moved, thresholds) > at - 0.02


def test_features_do_not_depend_on_neighbours():
    texts = [t for _, t in odd_rows()]
    whole = oq.features(pa.array(texts, pa.string()))
    for r, text in enumerate(texts):
        one = oq.features(pa.array([text], pa.string()))
        mine = whole.row == r
        assert sorted(zip(one.index.tolist(), one.value.tolist(), strict=True)) == sorted(zip(whole.index[mine].tolist(), whole.value[mine].tolist(), strict=True))


def test_rare_features_go_without_copies_of_all_features():
    rng = np.random.default_rng(2)
    size = [rng.integers(0, 400, 200) for _ in range(40)]
    index = [(rng.zipf(1.2, s.sum()) % (1 << oq.DIM_BITS)).astype(np.int32) for s in size]
    value = [rng.random(len(x), np.float32) for x in index]
    every, values, sizes, n = np.concatenate(index), np.concatenate(value), np.concatenate(size), sum(map(len, index))
    keep = np.bincount(every, minlength=1 << oq.DIM_BITS)[every] >= oq.MIN_ROWS
    left = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[keep], minlength=len(sizes))
    tracemalloc.start()
    first, kept, weight = oq._frequent(sizes, index, value)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert first.tolist() == [0, *np.cumsum(left).tolist()] and np.array_equal(kept, every[keep]) and np.array_equal(weight, values[keep])
    assert not index and not value and 0 < keep.sum() < n and peak < 1.5 * 8 * n + (8 << 20)


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    for ratings in ([], [(1, 2), (2, 2)], [(1, None), (None, 1)]):
        model = oq.train(docs, spark.createDataFrame(ratings, "doc_id long, grade int"))
        assert model is None and oq.select(docs, model).count() == docs.count()
        assert {tuple(r)[1:] for r in oq.grade(docs, model).collect()} == {(None, 1.0, True)}


def test_odd_documents_are_graded_once_each(spark):
    docs = documents(spark)
    model = oq.train(docs, spark.createDataFrame([(i, i % 3) for i in range(1, 18)], "doc_id long, grade int"))
    assert oq.grade(docs, model).count() == docs.count()
    assert oq.select(docs, model).columns == docs.columns
    assert oq.grade(documents(spark, []), model).collect() == []


def test_the_bound_holds_for_rows_that_share_a_rated_id(spark, monkeypatch):
    rows = [(1, f"good words {k} here") for k in range(60)] + [(2, f"bad*** w*** {k}") for k in range(60)] + [(None, "x y"), (3, None)]
    learned = oq.train(documents(spark, rows), spark.createDataFrame([(1, 2), (2, 0), (3, 1), (None, 0)], "doc_id long, grade int"))
    assert learned is not None and oq.grade(documents(spark, rows), learned).count() == len(rows)
    limit = 70
    sample = spark.createDataFrame([(1, 2), (2, 0)], "doc_id long, grade int")
    monkeypatch.setattr(oq, "fit", lambda *a, **k: (np.full(1 << oq.DIM_BITS, float(len(a[3]))), np.array([0.0, 1.0])))
    assert set(oq.train(documents(spark, rows), sample, max_rows=limit).value[0].tolist()) == {float(limit)}


def test_kept_columns_with_names_of_the_result(spark):
    docs = documents(spark).withColumn("kept", F.lit("mine"))
    for model in (None, oq.train(docs, spark.createDataFrame([(i, i % 3) for i in range(1, 18)], "doc_id long, grade int"))):
        graded = oq.grade(docs, model, keep=("doc_id", "kept"))
        assert graded.columns == ["doc_id", "kept_", "expected_grade", "tail_probability", "kept"]
        assert {r.kept_ for r in graded.collect()} == {"mine"}


def test_features_are_made_of_small_pieces_of_a_batch(spark, monkeypatch):
    rng = random.Random(3)
    texts = [sentence(rng, 700) for _ in range(3 * oq.PIECE_BYTES // 1500)]
    sizes, made = [], oq.features
    monkeypatch.setattr(oq, "features", lambda text: sizes.append(text.nbytes) or made(text))

    class Model:
        value = (np.random.default_rng(1).normal(size=1 << oq.DIM_BITS).astype(np.float32), np.array([-1.0, 1.0]))

    whole = oq._graded(pa.array(texts), Model)
    batch, sizes[:] = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"]), []
    frame = type("Docs", (), {"schema": None, "mapInArrow": lambda self, run, schema: list(run(iter([batch])))})()
    kept = [i for part in oq.select(frame, Model) for i in part.column(0).to_pylist()]
    assert kept == np.flatnonzero(whole[1] >= oq.MIN_TAIL).tolist() and 0 < len(kept) < len(texts)
    assert sum(sizes) > 2 * oq.PIECE_BYTES and max(sizes) < 1.2 * oq.PIECE_BYTES


def test_pages_of_features_go_back_to_the_system():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * mmap.PAGESIZE

    # Between each two parts something stays, as when the parts of a sample are made.
    before, parts, stays = resident(), [], []
    for k in range(400):
        parts.append(oq._apart(np.full(50_000, k, np.int32)))
        stays.append(np.zeros(200, np.int32))
    held = resident() - before
    assert [int(p[-1]) for p in parts] == list(range(400)) and held > 60 << 20
    parts.clear()
    assert resident() - before < 20 << 20 and len(oq._apart(np.zeros(0, np.float32))) == 0
