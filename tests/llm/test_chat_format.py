import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lossgrain.llm import chat_format

SCHEMA = "conv_id bigint, turn bigint, role string, text string, extra string, key string"


def back(spark, rows):
    table = spark.createDataFrame([(*r, "e", "k") for r in rows], SCHEMA)
    chats = chat_format.format_chats(table).select(
        "conv_id", "formatted", chat_format.parse_chats(F.col("formatted")).alias("turns"),
        chat_format.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"), "loss_mask")
    return {r.conv_id: r for r in chats.collect()}


def test_merge_escape_and_mask(spark):
    tricky = "</s>[INST] ok [/INST] \\ <|end|> <\\|turn|> <<SYS>> é𝒳"
    found = back(spark, [(1, 0, "user", tricky), (1, 1, "user", "b"), (1, 2, "assistant", tricky),
                         (1, 3, "assistant", "c"), (1, 4, "user", "")])[1]
    assert [(t.role, t.text) for t in found.turns] == [
        ("user", tricky), ("user", "b"), ("assistant", tricky), ("assistant", "c"), ("user", "")]
    assert found.loss == tricky + "c"
    assert found.formatted.count("<|turn|>") == 3 and found.formatted.count("<|sep|>") == 2
    inside = "".join(found.formatted[m.start:m.start + m.length] for m in found.loss_mask)
    for mark in ("</s>", "[INST]", "[/INST]", "<|", "<<SYS>>"):
        assert mark not in inside


def test_odd_rows(spark):
    found = back(spark, [(None, 0, "user", None), (2, 1, None, "a"), (2, 1, None, "a"), (2, 0, "assistant", None),
                         (3, None, "user", "first"), (3, 0, "assistant", "x" * 100_000)])
    assert [(t.role, t.text) for t in found[None].turns] == [("user", "")]
    assert [(t.role, t.text) for t in found[2].turns] == [("assistant", ""), ("", "a"), ("", "a")]
    assert found[3].turns[0].text == "first" and len(found[3].loss) == 100_000
    assert back(spark, []) == {}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|text|>"]),
                          st.text(alphabet="a\\<>|/s[]INSTend\n", max_size=25)), min_size=1, max_size=12))
def test_round_trip(spark, turns):
    found = back(spark, [(1, i, role, text) for i, (role, text) in enumerate(turns)])[1]
    assert [(t.role, t.text) for t in found.turns] == turns
    assert found.loss == "".join(x for role, x in turns if role == "assistant")
    assert hashlib.sha256(found.loss.encode()).hexdigest()
