"""Chat formatting from event logs, in DataFrame functions only.

An event has a conversation, a sequence number, the message it is about, a role, a kind and
a text. Kinds: `message` sets the text, `delta` appends to it, `edit` replaces it, and
`regenerate` throws it away, so that later deltas build it anew. Events are folded by
message (the texts since the last `message`, `edit` or `regenerate`, in sequence), messages
are put in the order of their first event, and each conversation is rendered:

    <|role|>
    text<|/turn|>

Control strings inside roles and texts are escaped (`~` becomes `~0`, `<|` `<~1`, `|>` `|~2`, and
`/` in roles `~3`), so that a marker in the output is always one of the template, and `turns` reads
everything back. Texts of `loss_roles` are under the loss mask.

Defined cases: null text is empty; a null role is an empty role; null kinds count as `message`; events without
conversation form one conversation with null id; events with equal sequence are ordered by
role, then text; repeated events count each time; a message whose only events are deltas
starts empty; an empty table gives no rows.

Scale: both steps are aggregations by key, the first by message, so that a long stream
of deltas meets its like before the conversation is put together. One conversation is one
output row and is put together by one task; no other state is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|/turn|>\n"
#: In this order; undone in the order 1, 2, 3, 0.
ESCAPES = (("~", "~0"), ("<|", "<~1"), ("|>", "|~2"))


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("/"), F.lit("~3"))


def unescape(text: Column) -> Column:
    for safe, plain in (("~1", "|"), ("~2", ">"), ("~3", "/"), ("~0", "~")):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, seq, role, text of final messages, from conv_id, seq, message_id, role, kind, text."""
    kind = F.coalesce("kind", F.lit("message"))
    plain = events.select("conv_id", "message_id", F.struct(
        "seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), kind.alias("kind")).alias("event"))
    grouped = plain.groupBy("conv_id", "message_id").agg(F.array_sort(F.collect_list("event")).alias("events"))
    # The part from the last event that sets or drops the text.
    last = F.aggregate(F.sequence(F.lit(1), F.size("events")), F.lit(1), lambda at, i: F.when(F.element_at("events", i).kind != "delta", i).otherwise(at))
    live = F.slice("events", last, F.size("events"))
    texts = F.transform(live, lambda e: F.when(e.kind == "regenerate", F.lit("")).otherwise(e.text))
    return grouped.select("conv_id", F.element_at("events", 1).seq.alias("seq"), F.element_at("events", 1).role.alias("role"), F.array_join(texts, "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id and the `formatted` text, from conv_id, seq, role, text."""
    turn = F.concat(F.lit(OPEN), escape_role(F.coalesce("role", F.lit(""))), F.lit(CLOSE), escape(F.coalesce("text", F.lit(""))), F.lit(END))
    order = F.struct("seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), turn.alias("turn"))
    return messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(order)).alias("turns")).select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t.turn), "").alias("formatted"))


def format_events(events: DataFrame) -> DataFrame:
    return render(fold_events(events))


def turns(formatted: Column) -> Column:
    """Roles and texts of a formatted conversation, read back from its markers."""
    parts = F.filter(F.split(formatted, r"<\|/turn\|>\n"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, 3, F.length(p)), CLOSE, 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, CLOSE) + 3, F.length(p))).alias("text")))


def read_back(formatted: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Counts and digests of what the formatted text holds."""
    found = formatted.select("conv_id", "formatted", turns(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t.role.isin(*loss_roles)), lambda t: t.text), "")
    return found.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))


def as_events(conversations: DataFrame) -> DataFrame:
    """A table of whole messages as a log: every row sets the text of a message of its own."""
    return conversations.select("conv_id", F.col("turn").alias("seq"), F.monotonically_increasing_id().alias("message_id"), "role", F.lit("message").alias("kind"), "text")


def as_log(conversations: DataFrame) -> DataFrame:
    """A table of whole messages as a log of streamed ones, which folds back to the same texts.

    By a hash of the row, its text is one message, comes in deltas, after a draft that is thrown away, as an edit of a draft,
    or as an edit after all of that. Events of a message follow each other at its turn."""
    text = F.coalesce("text", F.lit(""))
    event = lambda kind, said: F.struct(F.lit(kind).alias("kind"), said.alias("text"))
    third = F.ceil(F.length(text) / 3).cast("int")
    deltas = [event("delta", F.substring(text, i * third + 1, third)) for i in range(3)]
    draft = F.concat(F.lit("draft "), F.reverse(F.substring(text, 1, 20)))
    dropped = [event("delta", draft), event("regenerate", draft), *deltas]
    logs = [[event("message", F.col("text"))], deltas, dropped, [event("message", draft), event("edit", text)], [*dropped, event("edit", text)]]
    which = F.pmod(F.xxhash64("conv_id", "turn", "role", "text"), F.lit(len(logs)))
    events = F.array(*logs[-1])
    for k, log in enumerate(logs[:-1]):
        events = F.when(which == k, F.array(*log)).otherwise(events)
    each = conversations.select("conv_id", "turn", F.monotonically_increasing_id().alias("message_id"), "role", events.alias("events"))
    each = each.select("conv_id", "turn", "message_id", "role", F.posexplode("events").alias("step", "event"))
    return each.select("conv_id", F.struct("turn", "step").alias("seq"), "message_id", "role", "event.kind", "event.text")
