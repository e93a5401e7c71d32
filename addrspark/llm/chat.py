"""Rebuild conversations from event logs and render them.

A log has one row per event: ``conv_id``, ``seq`` (order of the events of a
conversation), ``kind``, ``turn`` (the message it is about), ``role`` and ``text``.

========== ==================================================================
start      begins message ``turn`` of ``role``, without text; a message may begin again
delta      appends ``text`` to the message
edit       replaces the message's text by ``text``
regenerate empties the message, and drops the later turns that began before it
========== ==================================================================

The log is partitioned by conversation, sorted by ``seq`` and folded into the final
messages; these are rendered by one template:

    ### role\\n text </turn>\\n      (without the spaces)

In roles and texts ``\\`` is written as ``\\b``, ``#`` as ``\\h``, ``<`` as ``\\l``, and in
roles a line end as ``\\e``. So no text holds a control string, the rendered text can
be cut at ``</turn>`` without a parser, and every text comes back as it was. The loss mask is a list of spans
(start from 0, length, in code points): the written text of each assistant message.

Everything is built of DataFrame functions. One conversation is one row, so it is
gathered in one task as any row is; conversations are spread by their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from addrspark.llm.tables import table, text_or_empty

OPEN, CLOSE = "### ", "</turn>\n"
_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
_ROLE_ESCAPES = (*_ESCAPES, ("\n", "\\e"))


def _replaced(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column, role: bool = False) -> Column:
    return _replaced(text, _ROLE_ESCAPES if role else _ESCAPES)


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``: a backslash always begins an escape, so its own comes last."""
    return _replaced(text, [(new, old) for old, new in reversed(_ROLE_ESCAPES)])


def folded(events: DataFrame) -> DataFrame:
    """The final messages of each conversation: conv_id and ``messages``, an array of (turn, role, text).

    Defined cases: events with the same ``seq`` come in the order of turn, kind
    (start, edit, regenerate, delta), role and text; null texts are empty, null roles are the empty role; a
    message without a start event has the empty role; null turns are the first turn;
    a null conv_id is a conversation; unknown kinds change nothing; an empty log gives an empty result.
    Other columns are not read.
    """
    rank = F.when(F.col("kind") == "start", 0).when(F.col("kind") == "edit", 1).when(F.col("kind") == "regenerate", 2).when(F.col("kind") == "delta", 3)
    log = events.where(rank.isNotNull()).select(
        "conv_id", "turn", F.struct("seq", rank.alias("rank"), F.coalesce("role", F.lit("")).alias("role"), text_or_empty().alias("text")).alias("e"))
    # Of each message: its events in order, when it last began, and when it was last regenerated.
    message = log.groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list("e")).alias("log"),
        F.max(F.when(F.col("e.rank") == 0, F.col("e.seq"))).alias("began"), F.max(F.when(F.col("e.rank") == 2, F.col("e.seq"))).alias("emptied"))
    last = F.coalesce(F.array_max(F.transform("log", lambda e, i: F.when(e["rank"] < 3, i))), F.lit(0))
    live = F.expr("slice(log, _last + 1, size(log))")
    text = F.array_join(F.transform(F.filter(live, lambda e: e["rank"].isin(1, 3)), lambda e: e["text"]), "")
    role = F.coalesce(F.try_element_at(F.transform(F.filter("log", lambda e: e["rank"] == 0), lambda e: e["role"]), F.lit(-1)), F.lit(""))
    message = message.withColumn("_last", last).select(
        "conv_id", F.struct("turn", role.alias("role"), text.alias("text"), "began", "emptied").alias("m"))
    # A turn is dropped if an earlier turn was emptied after it began. Sorted by turn, that is a running maximum.
    earlier = Window.partitionBy("conv_id").orderBy(F.col("m.turn").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    message = message.withColumn("_cut", F.max("m.emptied").over(earlier))
    message = message.where(F.col("_cut").isNull() | F.col("m.began").isNull() | (F.col("m.began") > F.col("_cut")))
    kept = message.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("m.turn", "m.role", "m.text"))).alias("messages"))
    return kept


def rendered(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, ``formatted`` and ``loss``, the spans of the written texts of ``loss_role``."""
    written = F.transform("messages", lambda m: F.struct(
        F.concat(F.lit(OPEN), escaped(m["role"], role=True), F.lit("\n")).alias("head"), escaped(m["text"]).alias("body"),
        (m["role"] == loss_role).alias("masked")))
    rows = conversations.select("conv_id", written.alias("parts"))
    sizes = F.transform("parts", lambda p: F.struct(
        F.char_length(p["head"]).alias("head"), F.char_length(p["body"]).alias("body"), p["masked"].alias("masked")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc, p):
        begin = acc["at"] + p["head"]
        span = F.struct(begin.alias("start"), p["body"].cast("long").alias("length"))
        return F.struct(
            (begin + p["body"] + len(CLOSE)).alias("at"),
            F.when(p["masked"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return rows.withColumn("_sizes", sizes).select(
        "conv_id", formatted.alias("formatted"), F.aggregate("_sizes", zero, step, lambda acc: acc["spans"]).alias("loss"))


def parsed(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, loss, and ``turns``: the (role, text) read back from the formatted text."""
    pieces = F.expr("slice(split(formatted, '</turn>\\n', -1), 1, size(split(formatted, '</turn>\\n', -1)) - 1)")
    turns = F.transform(pieces, lambda p: F.struct(
        unescaped(F.substring_index(F.substring(p, len(OPEN) + 1, 1 << 30), "\n", 1)).alias("role"),
        unescaped(F.substring(p, F.locate("\n", p) + 1, F.lit(1 << 30))).alias("text")))
    return formatted.withColumn("turns", turns)


def loss_text(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the mask."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def events_of(conversations: DataFrame) -> DataFrame:
    """A log of the rows of ``conversations`` (conv_id, turn, role, text), as it would be streamed.

    Each row begins a message and sends its text in two deltas. Assistant messages begin with a draft, the first
    half of the text, that is then regenerated. Rows with the same turn become messages of their own, in order of
    role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        "conv_id", F.row_number().over(order).cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), text_or_empty().alias("text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    first, second = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.char_length("text"))

    def event(i: int, kind: str, text: Column) -> Column:
        return F.struct((F.col("turn") * 8 + i).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    nothing = F.lit("")
    plain = [event(0, "start", nothing), event(3, "delta", first), event(4, "delta", second)]
    drafted = [event(0, "start", nothing), event(1, "delta", first), event(2, "regenerate", nothing), *plain[1:]]
    events = F.when(F.col("role") == "assistant", F.array(*drafted)).otherwise(F.array(*plain))
    return rows.select("conv_id", "turn", "role", F.explode(events).alias("e")).select("conv_id", "turn", "role", "e.*")


def op10(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    tricky = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    back = parsed(rendered(folded(events_of(rows))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(turns, "UTF-8"), 256).alias("turns_sha256"),
        loss_text(F.col("formatted"), F.col("loss")).alias("_loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return back.select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


OP10_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
written AS (
    SELECT *, length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l'))
        + length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), chr(10), '\e')) + 13 AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""
