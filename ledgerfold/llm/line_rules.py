"""Quality rules, line first: failing lines go, then documents that lost too much text go.

Lines are split at \\n; a line fails if any of these holds:
  - punctuation: it has `min_line_words` words or more and no closing mark at its end;
  - symbols: more than a quarter of its words hold one of `#*$%&|<>`;
  - navigation: cut at `|` and `>` it has `nav_parts` parts or more, of `nav_words` words at most on the average;
  - boilerplate: it matches one of the `boilerplate` patterns, whatever the case of ASCII letters;
  - repetition: it equals an earlier line of the same text.
Lines without a word never fail. A document is kept if the base rules hold (`min_words`
words, not more than `max_repeat_percent` of them in repeated three-word windows) and its
remaining lines hold `min_left_percent` of its word characters at least.

Words are runs of anything but ASCII blanks. A window of three words is repeated if the same
three words occur twice or more in the text; windows may overlap.

Defined cases: null and empty text have no words and so fail the base rules; one row goes
out for each row that comes in, repeated rows included; other columns are not read.

Scale: one pass without a shuffle; texts are worked on in chunks of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerfold.llm.store import beside
from ledgerfold.llm.words import BYTE_VALUE, Sums, Words, chunks, split_bytes, split_words

BREAK = 0x0A
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BARS = np.zeros(256, bool)
BARS[list(b"|>")] = True
CLOSING = np.zeros(256, bool)
CLOSING[list(b".!?:;\"')")] = True
CLOSING[0x80:] = True


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_left_percent: int = 50
    min_line_words: int = 4
    nav_parts: int = 4
    nav_words: float = 3.0
    boilerplate: tuple[str, ...] = (
        r"\ball rights reserved\b", r"\bclick here\b", r"\b(accept|uses?|use of) (all )?cookies\b", r"\benable javascript\b",
        r"\bprivacy policy\b", r"\bsubscribe to (our|the) newsletter\b", r"\bterms of (use|service)\b")


MEASURES = T.StructType([
    *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines")),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("kept_text", T.StringType())])


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def _per(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.diff(_running(values)[first])


def _repeated(hashes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a hash occurs again in its group: anywhere, and earlier."""
    order = np.lexsort((np.arange(len(hashes)), hashes, group))
    same = (hashes[order][1:] == hashes[order][:-1]) & (group[order][1:] == group[order][:-1])
    anywhere, earlier = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    earlier[order[1:][same]] = True
    anywhere[order[:-1][same]] = True
    return anywhere | earlier, earlier


def _repeat_words(words: Words) -> np.ndarray:
    at, hashes = words.windows(3, words.hashes())
    again, _ = _repeated(hashes, words.row()[at])
    covered = np.zeros(len(words.start), bool)
    for k in range(3):
        covered[at[again] + k] = True
    return _per(words.first, covered)


def _line_edges(offsets: np.ndarray, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each line without its break, and each text's first line. An empty line
    at the very end of a text is left out."""
    breaks = np.flatnonzero(buf == BREAK) + 1
    edges = np.unique(np.concatenate([offsets, breaks]))
    begin, end = edges[:-1], edges[1:].copy()
    if len(end):
        end -= buf[end - 1] == BREAK
    return begin, end, np.searchsorted(edges, offsets)


def _boilerplate(column: pa.Array, begin: np.ndarray, text_of: np.ndarray, patterns: re.Pattern) -> np.ndarray:
    """Lines with a match. Texts are joined by a break, so that no match crosses two of them."""
    raw = b"\n".join(x or b"" for x in column.cast(pa.binary()).to_pylist())
    place = begin + text_of
    found = [m.start() for m in patterns.finditer(raw)]
    return np.unique(np.searchsorted(place, found, "right") - 1) if found else np.zeros(0, np.int64)


def measure(column: pa.Array, rules: Rules) -> list[pa.Array]:
    words = split_words(column)
    begin, end, first_line = _line_edges(words.offsets, words.buf)
    text_of = np.repeat(np.arange(len(column)), np.diff(first_line))
    lines = split_bytes(np.append(begin, words.offsets[-1]), words.buf)
    chars = np.diff(_running((words.buf & 0xC0) != 0x80)[np.stack([words.start, words.end])], axis=0)[0]
    symbols, bars = _running(SYMBOLS[words.buf]), _running(BARS[words.buf])
    n_words, word_chars = words.count, _per(words.first, chars)
    line_words, line_chars, spoken = lines.count, _per(lines.first, chars), lines.count > 0

    _, repeat = _repeated(Sums(BYTE_VALUE[words.buf]).hashed(begin, end), text_of)
    repeat &= spoken
    closed = np.zeros(len(begin), bool)
    closed[spoken] = CLOSING[words.buf[words.end[lines.first[1:][spoken] - 1] - 1]]
    marked = _per(lines.first, symbols[words.end] > symbols[words.start])
    parts = bars[end] - bars[begin] + 1
    bad = repeat | ((line_words >= rules.min_line_words) & ~closed) | (4 * marked > line_words)
    bad |= (parts >= rules.nav_parts) & (line_words <= rules.nav_words * parts)
    if rules.boilerplate:
        bad[_boilerplate(column, begin, text_of, re.compile("|".join(rules.boilerplate).encode(), re.IGNORECASE))] = True
    bad &= spoken

    n_repeat = _repeat_words(words)
    failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    kept = ~failed & (100 * _per(first_line, np.where(bad, 0, line_chars)) >= rules.min_left_percent * word_chars)
    n_bad = _per(first_line, bad)
    texts = column.to_pylist()
    raw = words.buf.tobytes()
    for r in np.flatnonzero(n_bad).tolist():
        texts[r] = b"\n".join(raw[begin[i] : end[i]] for i in range(first_line[r], first_line[r + 1]) if not bad[i]).decode()
    counts = [n_words, word_chars, symbols[words.offsets[1:]] - symbols[words.offsets[:-1]], _per(first_line, repeat), n_repeat, n_bad]
    return [*(pa.array(x, pa.int64()) for x in counts), pa.array(failed), pa.array(kept), pa.array(texts, pa.string())]


def apply_rules(docs: DataFrame, rules: Rules = Rules(), *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns of every document with its counts, verdict and `kept_text` (null text stays null). A kept column that is
    named like one of these gets an underscore behind its name."""
    names = beside(keep, MEASURES.names)
    schema = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for c, n in zip(keep, names, strict=True)), *MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            yield pa.RecordBatch.from_arrays([*(get[c] for c in keep), *measure(get[text], rules)], names=schema.names)

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def digest(measured: DataFrame) -> DataFrame:
    return measured.select("doc_id", *MEASURES.names[:5], "base_failed", "kept", "n_bad_lines", F.sha2("kept_text", 256).alias("kept_text_sha256"))
