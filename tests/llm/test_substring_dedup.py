import re

import pytest

from ledgerfold.llm.substring_dedup import dedup_substrings
from tests.llm.cases import documents, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size, digests):
    """Documents are (id, text); null ids come last, equal ids are ordered by the text's hash."""
    order = lambda i, t: (i is None, i or 0, digests[t])
    first, words = {}, {}
    for i, t in rows:
        w = words[i, t] = WORD.findall(t or "")
        for j in range(len(w) - size + 1):
            key = (*order(i, t), j)
            first[tuple(w[j : j + size])] = min(key, first.get(tuple(w[j : j + size]), key))
    out = []
    for i, t in rows:
        w, gone = words[i, t], set()
        for j in range(len(w) - size + 1):
            if first[tuple(w[j : j + size])] != (*order(i, t), j):
                gone.update(range(j, j + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("size", "bucket"), [(20, 400_000), (20, 50), (5, 300)])
def test_windows_against_brute_force(spark, size, bucket):
    from pyspark.sql import functions as F

    rows = odd_rows()
    docs = documents(spark, rows)
    digests = {r.text: r.d for r in docs.select("text", F.xxhash64("text").alias("d")).collect()}
    got = dedup_substrings(docs, size=size, bucket_windows=bucket)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, size, digests)


def test_empty_table(spark):
    assert dedup_substrings(documents(spark, [])).collect() == []
