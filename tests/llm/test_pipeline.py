"""Stages on one table with a known case for each of them."""

import random

import corpus_pipeline
from ledgerfold.llm.store import stored
from tests.llm.cases import sentence

SF = "/root/testdata/sf0.001"


def test_every_stage_takes_effect(spark, tmp_path):
    rng = random.Random(11)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    long = [sentence(rng, 80) + "." for _ in range(8)]
    edited = long[3].split(" ")
    edited[40] = "other"
    bad = " ".join(w + "***" for w in sentence(rng, 80).split(" "))
    passage = sentence(rng, 12)
    rows = [(1, long[0]), (2, long[1] + "\n" + long[0]), (3, long[3]), (4, " ".join(edited)), (5, long[4] + " " + passage), (6, long[5]), (7, bad), (8, None), (9, ""), (10, long[6].upper()), (10, long[7])]
    for k in range(30):
        rows += [(100 + k, sentence(rng, 60) + "."), (200 + k, " ".join(w + "***" for w in sentence(rng, 60).split(" ")))]
    table = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "extra") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, digest string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("b", passage)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(100 + k, 1, 0) for k in range(30)] + [(200 + k, 0, 0) for k in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert docs.columns == table.columns[:5]
    now, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, str(tmp_path)))
        left[name] = now
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == table.columns
    graded, lined, joined, clean, encoded = left.values()
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert {1, 2, 3, 4, 5, 6, 10} <= ids(graded) and 7 not in ids(graded) and not ids(graded) & set(range(200, 230))
    assert {r.doc_id: (r.text, r.n_chars) for r in lined.where("doc_id <= 2").collect()} == {1: (long[0], len(long[0])), 2: (long[1], len(long[1]))}
    assert {3, 5, 6, 10} <= ids(joined) and 4 not in ids(joined)
    assert 5 not in ids(clean) and {1, 2, 3, 6, 10} <= ids(clean) == ids(encoded)
    assert encoded.where("NOT decodes").count() == 0
    assert sorted(map(repr, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(repr, encoded.collect()))


def test_pipeline_over_the_smallest_tables(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.where("decodes").count() == got.count() > 0
