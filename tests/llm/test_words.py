import re

import numpy as np
import pyarrow as pa

from ledgerfold.llm.words import LOWER, SYMBOLS, chunks, joined, split_words
from tests.llm.cases import odd_rows

TEXTS = [t for _, t in odd_rows()] + ["a", " b", "c ", "\x00d\x7f"]


def cut(words, row):
    return [words.buf[s:e].tobytes().decode() for s, e in zip(words.start[words.first[row] : words.first[row + 1]], words.end[words.first[row] : words.first[row + 1]], strict=True)]


def test_words_are_those_of_the_patterns():
    column = pa.array([None, *TEXTS, "last"]).slice(1, len(TEXTS))
    plain, folded = split_words(column), split_words(column, SYMBOLS, LOWER)
    for row, text in enumerate(TEXTS):
        text = text or ""
        assert cut(plain, row) == re.findall(r"[^\x20\x09-\x0D]+", text)
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        assert cut(folded, row) == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_equal_runs_have_equal_hashes_and_others_do_not():
    words = split_words(pa.array(["a b c a b", "b c a", "ab c", ""]))
    hashes = words.hashes()
    assert hashes[0] == hashes[3] != hashes[1] and len(set(hashes.tolist())) == 4
    at, windows = words.windows(2, hashes)
    assert at.tolist() == [0, 1, 2, 3, 5, 6, 8]
    assert windows[0] == windows[3] and windows[1] == windows[4] and windows[2] == windows[5] and len(set(windows.tolist())) == 4


def test_joined_words_and_chunks():
    out, offsets = joined(split_words(pa.array(["a  bc", None, "d"])), np.array([True, False, True]))
    assert out.tobytes() == b"a d " and offsets.tolist() == [0, 2, 4]
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 10, None, "y" * 100, "z", ""]})
    parts = list(chunks([batch], "text", 12))
    assert [p.num_rows for p in parts] == [2, 1, 2] and sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
    assert list(chunks([batch.slice(0, 0)], "text")) == []
