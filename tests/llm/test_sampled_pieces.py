import itertools
import math
import random
import tracemalloc
from collections import Counter
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from ledgerfold.llm import sampled_pieces as sampled
from tests.llm.cases import documents, odd_rows, sentence


@pytest.fixture(scope="module")
def pieces():
    return sampled.load_pieces()


def segmentations(pieces, raw):
    """All ways to cut the bytes into pieces, with the logarithm of their weight."""
    if not raw:
        return [((), 0.0)]
    out = []
    for _, numbers, _ in pieces.tables.values():
        for i in numbers.tolist():
            if raw.startswith(own := pieces.flat[pieces.offsets[i] : pieces.offsets[i + 1]].tobytes()):
                out += [((i, *rest), pieces.weight[i] + w) for rest, w in segmentations(pieces, raw[len(own) :])]
    return out


@pytest.mark.parametrize("text", ["then", "it is", "it is up"])  # one run, and several
def test_samples_have_the_chances_of_drawing_without_replacement(pieces, text):
    runs = [segmentations(pieces, b" " + run.encode()) for run in text.split(" ")]
    every = [(sum((p for p, _ in parts), ()), sum(w for _, w in parts)) for parts in itertools.product(*runs)]
    total = sum(math.exp(w) for _, w in every)
    chance = {s: math.exp(w) / total for s, w in every}
    n = 6000
    row, sample, log, value, inclusion, ids, first = sampled.sample_batch(pa.array([text] * n), np.arange(n) * 977 + 5, pieces, 3)
    drawn = [tuple(ids[a:b].tolist()) for a, b in pairwise(first.tolist())]
    assert len(row) == 3 * n and all(len(set(drawn[3 * k : 3 * k + 3])) == 3 for k in range(n))
    assert np.allclose(log, [math.log(chance[s]) for s in drawn]) and all(value[i] >= value[i + 1] for i in range(3 * n - 1) if row[i] == row[i + 1])
    once, twice = Counter(drawn[0::3]), Counter(drawn[1::3])
    second = Counter()
    for a, p in chance.items():
        for b, q in chance.items():
            if a != b:
                second[b] += p * q / (1 - p)
    assert max(abs(once[s] / n - chance[s]) for s in chance) < 0.02 and max(abs(twice[s] / n - second[s]) for s in chance) < 0.02
    # Chances over inclusion chances add up to 1 on the average.
    assert abs(np.bincount(row, np.exp(log - inclusion), n).mean() - 1) < 0.02


def test_texts_with_few_segmentations_give_all_of_them(pieces):
    every = {s for s, _ in segmentations(pieces, b" it")}
    row, _, log, _, inclusion, ids, first = sampled.sample_batch(pa.array(["it"]), np.array([3]), pieces, 50)
    drawn = [tuple(ids[a:b].tolist()) for a, b in pairwise(first.tolist())]
    assert set(drawn) == every and len(drawn) == len(every) and abs(np.exp(log).sum() - 1) < 1e-9 and not inclusion.any()


def test_pieces_give_back_every_text(spark, pieces):
    model = sentencepiece.SentencePieceProcessor(model_file=sampled.MODEL)
    rows = [*odd_rows(), (70, "  two  blanks "), (71, "\tx\x00\x7f\r;\r"), (72, "日本語のテキスト"), (73, "é́ﬁ½퟿"), (74, " ")]
    docs = documents(spark, rows)
    encoded = sampled.encode(docs, pieces)
    got = sampled.decode(encoded, pieces).collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t or "")
    for r in got:
        assert r.decodes and r.decoded in texts[r.doc_id] and r.n_tokens == len(r.ids)
    for r in got:
        if "\x00" not in r.decoded:
            assert model.decode(r.ids) == r.decoded
    for i, t in rows:
        if not t:
            assert sum(r.doc_id == i for r in got) == 1
    assert sorted(map(repr, encoded.collect())) == sorted(map(repr, sampled.encode(docs.repartition(7), pieces).collect()))


def test_empty_tables_and_null_pieces(spark, pieces):
    assert sampled.encode(documents(spark, []), pieces).collect() == []
    null = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in sampled.decode(null, pieces).collect()} == {1: None, 2: ""}


def test_the_search_does_not_depend_on_windows_or_other_rows(pieces, monkeypatch):
    texts = pa.array([t for _, t in odd_rows(4)])
    keys = np.arange(len(texts)) * 31 + 7
    whole = sampled.sample_batch(texts, keys, pieces, 4)
    monkeypatch.setattr(sampled, "WINDOW", 2)
    parts = [sampled.sample_batch(texts.slice(k, 1), keys[k : k + 1], pieces, 4) for k in range(len(texts))]
    assert whole[5].tolist() == np.concatenate([p[5] for p in parts]).tolist()
    for column in (2, 3, 4):
        assert np.allclose(whole[column], np.concatenate([p[column] for p in parts]))


def test_a_process_holds_small_tables_and_little_work(pieces):
    held = [pieces.flat, pieces.offsets, pieces.weight, pieces.reach, *pieces.short.values(), *(x for own in pieces.tables.values() for x in own)]
    assert sum(x.nbytes for x in held) < 8e6
    rng = random.Random(2)
    texts = pa.array([sentence(rng, 300) for _ in range(400)])
    batch = next(sampled.chunks(iter([pa.record_batch({"text": texts})]), "text", sampled.CHUNK))
    assert 0 < batch.num_rows < 400
    tracemalloc.start()
    try:
        sampled.sample_batch(batch.column(0), np.arange(batch.num_rows), pieces, 3)
        assert tracemalloc.get_traced_memory()[1] < 48e6
    finally:
        tracemalloc.stop()
