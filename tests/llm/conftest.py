import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(r, n, size=(2, 9)):
    return " ".join("".join(r.choice("abcdefghijklmnoprstuvwz") for _ in range(r.randint(*size))) for _ in range(n))


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src", None if text is None else len(text))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and blank texts, a very long text, ties, repeated rows, clashing names."""
    r = random.Random(11)
    long_text = words(r, 30_000)
    rows = [
        row(1, words(r, 80)), row(2, None), row(3, ""), row(4, " \n\t "), row(None, "lost id " + words(r, 60)),
        row(None, None, None), row(5, long_text), row(6, words(r, 70), None), row(7, "x"), row(7, "x"),
        row(8, "y" * 70_000), row(9, "é ß 你好 𝒳 " * 40, "zz"), row(10, "#*$%&|<>" * 30),
        row(11, "dup line\n" * 60), row(12, words(r, 90)), row(12, words(r, 90)), row(13, "\x02\x03\x00 nul \x1c  end"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    extra = {c: "extra" for c in ("k", "raw", "bit", "seed", "at", "doc", "kept", "shard", "size", "row_key",
                                  "n_words", "digest", "rank", "item_id", "c0", "sid", "link")}
    from pyspark.sql import functions as F
    return docs.withColumns({c: F.lit(v) for c, v in extra.items()})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
