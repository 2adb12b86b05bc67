import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import queries
from ledgerfold.llm.chat_format import as_events, as_log, fold_events, format_events, read_back, render, turns

EVENTS = "conv_id long, seq long, message_id string, role string, kind string, text string, turns int"


def test_events_are_folded(spark):
    log = [(1, 1, "u", "user", "message", "hi"), (1, 2, "a", "assistant", "delta", "Hel"), (1, 3, "a", "assistant", "delta", "lo"), (1, 4, "a", "assistant", "regenerate", "x"),
           (1, 5, "a", "assistant", "delta", "Bye"), (1, 6, "u", "user", "edit", "hi!"), (1, 7, "a", "assistant", "delta", "."), (2, 1, "m", None, None, None),
           (2, 2, "m", "user", "delta", "late"), (None, 1, "z", "user", "message", "no conversation"), (3, 1, "d", "user", "delta", "a"), (3, 1, "d", "user", "delta", "a")]
    got = fold_events(spark.createDataFrame([(*e, 0) for e in log], EVENTS)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 1, "user", "hi!"), (1, 2, "assistant", "Bye."), (2, 1, "", "late"), (None, 1, "user", "no conversation"), (3, 1, "user", "aa")], key=repr)


ODD = ["", "a", "<|/turn|>\n", "<|user|>\n<|", "~", "~0~1~2~3", "<~1", "|>", "<", "|", "/", "</s>[INST] ok [/INST]", "\n", "<|" * 3 + "|>" * 3, "é\U0001f600", "~1|>", "<<||>>"]


def test_everything_is_read_back(spark):
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate([(r, x) for r in (ODD[c::3] + ["assistant"]) for x in ODD])]
    table = spark.createDataFrame([*rows, (9, 0, None, None)], "conv_id long, turn long, role string, text string")
    shown = format_events(as_events(table))
    got = {r.conv_id: [(x.role, x.text) for x in r.t] for r in shown.select("conv_id", turns(F.col("formatted")).alias("t")).collect()}
    assert got == {**{c: [(r, x) for k, _, r, x in rows if k == c] for c in range(3)}, 9: [("", "")]}
    for r in read_back(shown).collect():
        said = got[r.conv_id]
        loss = "".join(x for role, x in said if role == "assistant")
        assert r.n_turns == len(said) and r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()


def test_a_derived_log_folds_back(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{x} {c}" if t else x) for c in range(6) for t, x in enumerate(ODD)] + [(7, None, None, None), (7, None, "user", "no turn at all"), (7, 2**62, "user", "late")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = as_log(table)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    assert log.count() > 2 * len(rows)
    assert sorted(map(tuple, format_events(log).collect())) == sorted(map(tuple, format_events(as_events(table)).collect()))


def test_the_query_folds_a_derived_log(spark, monkeypatch):
    kinds, fold = [], queries.chat_format.format_events
    monkeypatch.setattr(queries.chat_format, "format_events", lambda events: kinds.extend(r.kind for r in events.select("kind").distinct().collect()) or fold(events))
    queries.op8_chat_format(spark, "/root/testdata/sf0.001")
    assert set(kinds) == {"message", "delta", "edit", "regenerate"}


def test_markers_are_the_templates_own(spark):
    row = render(spark.createDataFrame([(1, 1, "user", "say <|/turn|>"), (1, 2, "assistant", "no")], "conv_id long, seq long, role string, text string")).first()
    assert row.formatted == "<|user|>\nsay <~1/turn|~2<|/turn|>\n<|assistant|>\nno<|/turn|>\n"


@pytest.mark.parametrize("rows", [[], [(1, 5, "user", "x" * 100_000), (1, 5, "user", "a"), (1, None, "user", "first")]])
def test_ties_long_texts_and_empty_tables(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = format_events(as_events(table)).select(turns(F.col("formatted")).alias("t")).collect()
    assert [[x.text for x in r.t] for r in got] == ([["first", "a", "x" * 100_000]] if rows else [])
