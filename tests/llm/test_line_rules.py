import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerfold.llm.line_rules import Rules, apply_rules
from tests.llm.cases import documents, odd_rows, sentence
import random

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows():
    rng = random.Random(3)
    clean = "\n".join(sentence(rng, 20) + "." for _ in range(5))
    return [*odd_rows(), (50, clean), (51, clean + "\nHome | News | Sport | About | Contact\nAll Rights Reserved 2020.\n\n" + clean.split("\n")[0]),
            (52, "\n".join(" ".join(w + "***" for w in sentence(rng, 20).split(" ")) for _ in range(5))), (53, "\n".join(sentence(rng, 20) for _ in range(5))),
            (54, clean + "\n" + sentence(rng, 30) + "\nprivacy"), (55, "policy " + clean)]


def brute(text, rules):
    w = WORD.findall(text or "")
    lines = (text or "").split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered.update((i, i + 1, i + 2))
    seen, duplicates, bad, left, kept = set(), 0, 0, 0, []
    for line in lines:
        said = WORD.findall(line)
        again = bool(said) and line in seen
        seen.add(line)
        duplicates += again
        parts = len(re.findall("[|>]", line)) + 1
        fails = bool(said) and (again or (len(said) >= rules.min_line_words and not re.search(r"[.!?:;\"')\u0080-\U0010ffff]$", said[-1]))
                                or 4 * sum(bool(re.search("[#*$%&|<>]", x)) for x in said) > len(said) or (parts >= rules.nav_parts and len(said) <= rules.nav_words * parts)
                                or any(re.search(p, line, re.I | re.A) for p in rules.boilerplate))
        bad += fails
        if not fails:
            left += sum(map(len, said))
            kept.append(line)
    failed = len(w) < rules.min_words or 100 * len(covered) > rules.max_repeat_percent * len(w)
    chars = sum(map(len, w))
    return (len(w), chars, len(re.findall("[#*$%&|<>]", text or "")), duplicates, len(covered), bad, failed,
            not failed and 100 * left >= rules.min_left_percent * chars, "\n".join(kept) if bad else text)


def test_measures_and_verdicts_against_brute_force(spark):
    table = rows()
    got = apply_rules(documents(spark, table))
    want = sorted(((i, *brute(t, Rules())) for i, t in table), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    verdict = {r[0]: r[8] for r in want}
    assert [verdict[i] for i in (50, 51, 52, 53, 54, 55)] == [True, True, False, False, True, True]


def test_empty_table(spark):
    assert apply_rules(documents(spark, [])).collect() == []


def test_kept_columns_with_names_of_the_result(spark):
    docs = documents(spark).withColumn("kept", F.lit("mine"))
    out = apply_rules(docs, keep=("doc_id", "n_words", "kept"))
    assert out.columns[:3] == ["doc_id", "n_words_", "kept_"] and len(set(out.columns)) == len(out.columns)
    assert {r.kept_ for r in out.collect()} == {"mine"}
