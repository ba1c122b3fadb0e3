"""Chat formatting with Spark expressions only.

A conversation becomes one string. Its turns are collected, sorted as
structs, adjacent turns of one role are merged by an array aggregation, and
the parts are concatenated. Every step is a built-in expression.

Template, for each merged turn::

    <|turn|>ROLE<|text|>TEXT<|sep|>TEXT<|end|>

``<|sep|>`` stands between the texts of merged turns, so the merge can be
undone. Control strings inside roles and texts get a backslash after their
first character, and backslashes are doubled, so no control string of a text
survives in the output and unescaping gives back the text.

Defined results: a null text is empty, a null role is the empty role, a null
conversation id is a conversation of its own; turns with equal numbers are
ordered by role and then text, repeated rows stay repeated turns; a
conversation with empty texts only keeps its marks; an empty table gives no
rows. Further columns of the table are not carried. A conversation is one
output value, so it must fit into one row (2 GB); nothing else bounds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN, TEXT, SEP, END = "<|turn|>", "<|text|>", "<|sep|>", "<|end|>"

#: Beginnings of control strings of common chat templates.
CONTROL = r"(<)(\||/?s>|</?SYS>>)"
CONTROL_SQUARE = r"(\[)(/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(
        F.regexp_replace(doubled, CONTROL, r"$1\\$2"), CONTROL_SQUARE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """Rows ``(key, formatted, loss_mask)``; the mask lists (start, length) in code points.

    The mask covers the escaped texts of ``loss_role``, one range each, and
    no mark of the template.
    """
    one = F.struct(F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"),
                   F.coalesce(F.col(text), F.lit("")).alias("x"))
    rows = turns.select(F.col(key).alias("key"), one.alias("one"))
    sorted_turns = rows.groupBy("key").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    escaped = sorted_turns.select("key", F.transform("turns", lambda t: F.struct(
        t["r"].alias("role"), F.array(escape(t["x"])).alias("texts"))).alias("turns"))

    # Starts of runs of one role; each run takes the texts up to the next start.
    starts = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (i == 1) | (F.element_at("turns", i)["role"]
                              != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]))
    runs = escaped.withColumn("starts", starts)

    def merged(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get("starts", k + 1), F.size("turns") + 1)
        texts = F.aggregate(
            F.slice("turns", start, stop - start), F.array().cast("array<string>"),
            lambda acc, t: F.concat(acc, t["texts"]))
        return F.struct(F.element_at("turns", start)["role"].alias("role"), texts.alias("texts"))

    segments = runs.select("key", F.transform("starts", merged).alias("segments"))

    def rendered(s: Column) -> Column:
        return F.concat(F.lit(TURN), escape(s["role"]), F.lit(TEXT),
                        F.array_join(s["texts"], SEP), F.lit(END))

    sized = segments.select(
        "key", "segments", F.transform("segments", rendered).alias("parts"))

    # One pass over the segments carries the position; ranges are kept for the loss role.
    zero = F.struct(F.lit(0).cast("long").alias("at"),
                    F.array().cast("array<struct<start:bigint,length:bigint>>").alias("mask"))

    def ranges(at: Column, s: Column) -> Column:
        head = at + F.length(F.lit(TURN)) + F.length(escape(s["role"])) + F.length(F.lit(TEXT))
        lengths = F.transform(s["texts"], lambda x: F.length(x).cast("long"))
        return F.transform(lengths, lambda n, i: F.struct(
            (head + F.aggregate(F.slice(lengths, 1, i), F.lit(0).cast("long"),
                                lambda a, b: a + b + F.lit(len(SEP)))).alias("start"),
            n.alias("length")))

    def step(acc: Column, p: Column) -> Column:
        s = p["segments"]
        return F.struct(
            (acc["at"] + F.length(p["parts"])).alias("at"),
            F.when(s["role"] == loss_role, F.concat(acc["mask"], ranges(acc["at"], s)))
            .otherwise(acc["mask"]).alias("mask"))

    mask = F.aggregate(F.arrays_zip("segments", "parts"), zero, step)["mask"]
    return sized.select(F.col("key").alias(key), F.array_join("parts", "").alias("formatted"),
                        mask.alias("loss_mask"))


def parse_chats(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, text>>``, merges undone."""
    parts = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")

    def turns(p: Column) -> Column:
        fields = F.split(p, r"<\|turn\|>|<\|text\|>")
        role = unescape(F.get(fields, F.lit(1)))
        return F.transform(F.split(F.get(fields, F.lit(2)), r"<\|sep\|>"),
                           lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(parts, turns))


def masked_text(formatted: Column, mask: Column) -> Column:
    """The text under the mask, unescaped, nothing between its ranges."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(
        formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), "")
