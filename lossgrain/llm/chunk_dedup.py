"""Substring deduplication by content-defined chunking with a gear rolling hash.

A cut falls where the high bits of the rolling hash are zero, so it depends
on the preceding 32 bytes only and an insertion moves no later cut; where no
such place comes within ``most`` bytes, the cut falls at the smallest hash of
that stretch. Chunks are told by a 128-bit digest. Of the occurrences of a
chunk the first one in the smallest document stays; adjacent repeated chunks
are joined to runs. Both ends of a run are then compared with the text around
the first occurrence, character by character, to the true ends of the equal
stretch, and only the exact run is measured.

Defined results: null and empty texts have no chunks; rows with a null id
are not compared; rows are told by id and text, so two texts under one id are
two documents, and rows that repeat both are one; very long texts are chunked
whole; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lossgrain.llm.common import attach, fresh, pin

CHUNK_SCHEMA = ("doc_id bigint, text_key bigint, start int, chars int, word_at int, words int, "
                "digest_a bigint, digest_b bigint")
NEAR_SCHEMA = "doc_id bigint, text_key bigint, code bigint, near string"
SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint8)


def gear_table() -> np.ndarray:
    """256 random 32-bit numbers, by rule: digests of the byte values."""
    return np.array([int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=4).digest(), "little")
                     for i in range(256)], np.uint32)


def cut_points(data: np.ndarray, gear: np.ndarray, bits: int, least: int, most: int) -> list[int]:
    """Ends of the chunks of ``data``, never inside a character."""
    n = len(data)
    rolling = gear[data]
    for k in (1, 2, 4, 8, 16):  # doubling: the sum over 32 bytes of gear << age
        if k < n:
            older = rolling[:-k] << np.uint32(k)
            rolling = rolling.copy()
            rolling[k:] += older
    opens = np.empty(n, bool)  # a character may end here
    opens[-1] = True
    np.not_equal(data[1:] & 0xC0, 0x80, out=opens[:-1])
    wanted = np.flatnonzero((rolling >> np.uint32(32 - bits) == 0) & opens) + 1
    rolling = np.where(opens, rolling, np.uint32(0xFFFFFFFF))
    ends, last = [], 0
    for at in [*wanted.tolist(), n]:
        while at - last > most:
            forced = last + most - int(np.argmin(rolling[last + least - 1:last + most][::-1]))
            ends.append(forced)
            last = forced
        if at - last >= least or (at == n and at > last):
            ends.append(at)
            last = at
    return ends


def text_key(text: str = "text"):
    """What tells the texts of one id apart."""
    return F.xxhash64(F.col(text).cast("string"))


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 5,
           least: int = 16, most: int = 80) -> DataFrame:
    """One row per chunk: place in code points, words begun before and inside, digest."""
    names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")]
    gear = gear_table()

    def cut(batches):
        for batch in batches:
            out: list[list] = [[] for _ in names[:-2]]
            digests: list[bytes] = []
            for one, key, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = words.as_buffer()
                if raw is None or not raw.size or one is None:
                    continue
                data = np.frombuffer(raw, np.uint8)
                ends = np.array(cut_points(data, gear, bits, least, most))
                begins = np.concatenate([[0], ends[:-1]])
                space = np.isin(data, SPACES)
                opened = ~space
                opened[1:] &= space[:-1]
                view = memoryview(raw)
                digests += [hashlib.blake2b(view[a:b], digest_size=16).digest()
                            for a, b in zip(begins.tolist(), ends.tolist())]
                chars = np.cumsum((data & 0xC0) != 0x80)[ends - 1]
                begun = np.cumsum(opened)[ends - 1]
                columns = ([one] * len(ends), [key] * len(ends), (chars - np.diff(chars, prepend=0)).tolist(),
                           np.diff(chars, prepend=0).tolist(), (begun - np.diff(begun, prepend=0)).tolist(),
                           np.diff(begun, prepend=0).tolist())
                for into, values in zip(out, columns):
                    into += values
                if len(digests) > 100_000:
                    yield batch_of(out, digests)
                    out, digests = [[] for _ in names[:-2]], []
            if digests:
                yield batch_of(out, digests)

    def batch_of(columns, digests):
        pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        kinds = [pa.int64()] * 2 + [pa.int32()] * 4
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)] + [
            pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], names)

    return docs.select(F.col(doc_id).cast("bigint"), text_key(text), F.col(text).cast("string")).mapInArrow(
        cut, CHUNK_SCHEMA)


def occurrences(parts: DataFrame) -> DataFrame:
    """The chunks of a stored table that are there twice, with the place of the first one."""
    digest = ["digest_a", "digest_b"]
    # Place and word of a first occurrence as one struct, so that the chunks meet once to be counted and told.
    shared = pin(parts.groupBy(*digest).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_key", "start", "word_at")).alias("f")).where(
            "n > 1").select(*digest, "n", F.col("f.doc_id").alias("first_doc_id"), F.col("f.text_key").alias("first_key"),
                            F.col("f.start").alias("first_start"), F.col("f.word_at").alias("first_word")))
    return attach(parts, shared, digest, "n", "inner").drop("n", *digest).withColumn(
        "stays", F.expr("doc_id = first_doc_id and text_key = first_key and start = first_start"))


def joined(parts: DataFrame, *kept) -> DataFrame:
    """Parts (``doc_id, text_key, stays, start, stop, word_at, word_end``) that touch or overlap as one row."""
    order = Window.partitionBy("doc_id", "text_key", "stays").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    return parts.withColumn("opened", opened).withColumn(
        "run", F.sum("opened").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        "doc_id", "text_key", "stays", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("word_at").alias("word_at"),
        F.max("word_end").alias("word_end"), F.min("first_doc_id").alias("first_doc_id"), *kept)


def _near(docs: DataFrame, places: DataFrame, width: int) -> DataFrame:
    """The ``width`` characters behind each place (code 2 * place), or before it, read backwards (odd code)."""

    def sliced(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for one, key, codes, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for code in codes:
                    at = code >> 1
                    near = text[max(at - width, 0):at][::-1] if code & 1 else text[at:at + width]
                    for into, value in zip(out, (one, key, code, near)):
                        into.append(value)
                if len(out[0]) > 20_000:
                    yield batch_of(out)
                    out = [[], [], [], []]
            yield batch_of(out)

    def batch_of(out):
        return pa.record_batch([pa.array(c, k) for c, k in zip(out, [pa.int64()] * 3 + [pa.string()])],
                               ["doc_id", "text_key", "code", "near"])

    asked = pin(places.groupBy("doc_id", "text_key").agg(F.collect_set("code").alias("codes")))
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return texts.join(asked, ["doc_id", "text_key"]).select("doc_id", "text_key", "codes", "text").mapInArrow(
        sliced, NEAR_SCHEMA).dropDuplicates(["doc_id", "text_key", "code"])


def _equal_stretch(a: str, b: str) -> int:
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


@F.pandas_udf(StructType([StructField("reach", IntegerType()), StructField("begun", IntegerType())]))
def _reach(mine: pd.Series, other: pd.Series) -> pd.DataFrame:
    reach = [_equal_stretch(a, b) for a, b in zip(mine, other)]
    return pd.DataFrame({"reach": reach, "begun": [len(a[:k].split()) for a, k in zip(mine, reach)]})


def equal_ends(docs: DataFrame, edges: DataFrame, width: int = 256) -> DataFrame:
    """What lies beyond the ends of runs and is equal there and around the first occurrence.

    ``edges`` has ``doc_id, text_key, code, word`` and the same four of the
    first occurrence. ``width`` characters are compared, and four times as
    many in each further round for those ends that are equal to the last one.
    """
    mine, other = ["doc_id", "text_key", "code"], ["first_doc_id", "first_key", "first_code"]
    out = None
    edges = pin(edges)
    while not edges.isEmpty():
        counts = edges.groupBy(*other).agg(F.count(F.lit(1)).alias("n"))
        near = pin(_near(docs, edges.select(*mine).unionByName(
            edges.select(*[F.col(o).alias(m) for o, m in zip(other, mine)])), width))
        rows = pin(edges.join(near, mine))
        firsts = pin(near.toDF(*other, "first_near").join(counts, other))
        found = pin(attach(rows, firsts, other, "n").withColumn("r", _reach("near", "first_near")).select(
            *mine, "word", *other, "first_word", "r.reach", "r.begun").where("reach > 0"))
        backwards = F.col("code") % 2 == 1
        for code, word, names, stays in (("code", "word", mine, False), ("first_code", "first_word", other, True)):
            at = F.shiftright(code, 1).cast("int")
            piece = found.select(
                F.col(names[0]).alias("doc_id"), F.col(names[1]).alias("text_key"), F.lit(stays).alias("stays"),
                F.when(backwards, at - F.col("reach")).otherwise(at).alias("start"),
                F.when(backwards, at).otherwise(at + F.col("reach")).alias("stop"),
                F.when(backwards, F.col(word) - F.col("begun")).otherwise(F.col(word)).alias("word_at"),
                F.when(backwards, F.col(word)).otherwise(F.col(word) + F.col("begun")).alias("word_end"),
                "first_doc_id")
            out = piece if out is None else out.unionByName(piece)
        sign = F.when(backwards, -1).otherwise(1)
        edges = pin(found.where(F.col("reach") == width).select(
            "doc_id", "text_key", (F.col("code") + 2 * sign * width).alias("code"),
            (F.col("word") + sign * F.col("begun")).alias("word"), "first_doc_id", "first_key",
            (F.col("first_code") + 2 * sign * width).alias("first_code"),
            (F.col("first_word") + sign * F.col("begun")).alias("first_word")))
        width *= 4
    return out


def repeats(docs: DataFrame, least_words: int = 50, least_chars: int = 400, doc_id: str = "doc_id",
            text: str = "text", **options) -> DataFrame:
    """Repeated runs: ``doc_id, text_key, start, stop, n_words, n_chunks, first_doc_id, stays``.

    ``stays`` marks the runs that are the first occurrences; the other runs
    are what deduplication removes. Runs that have neither ``least_words``
    words nor ``least_chars`` characters (for scripts without white space)
    are left alone: a line that many texts share is no passage. A word that
    an end cuts counts where two parts of a run meet inside it, so
    ``n_words`` can be a few words too high.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_key(text).alias("text_key"),
                       F.col(text).cast("string").alias("text"))
    found = occurrences(pin(chunks(rows, **options))).withColumns({
        "stop": F.col("start") + F.col("chars"), "word_end": F.col("word_at") + F.col("words")})
    place = ["first_doc_id", "first_key"]
    runs = pin(joined(
        found, F.count_distinct("start").alias("n_chunks"),
        F.min_by(F.struct(*place, F.col("first_start").alias("at"), F.col("first_word").alias("word")),
                 "start").alias("head"),
        F.max_by(F.struct(*place, (F.col("first_start") + F.col("chars")).alias("at"),
                          (F.col("first_word") + F.col("words")).alias("word")), "start").alias("tail")))

    def edge(end: str, at: str, word: str, odd: int) -> DataFrame:
        def code(c):
            return F.col(c).cast("bigint") * 2 + odd
        return runs.where("not stays").select(
            "doc_id", "text_key", code(at).alias("code"), F.col(word).alias("word"),
            *[F.col(f"{end}.{p}").alias(p) for p in place], code(f"{end}.at").alias("first_code"),
            F.col(f"{end}.word").alias("first_word"))

    beyond = equal_ends(rows, edge("head", "start", "word_at", 1).unionByName(edge("tail", "stop", "word_end", 0)))
    columns = ["doc_id", "text_key", "stays", "start", "stop", "word_at", "word_end", "first_doc_id", "n_chunks"]
    parts = runs.select(*columns)
    if beyond is not None:
        parts = parts.unionByName(beyond.withColumn("n_chunks", F.lit(0).cast("bigint")).select(*columns))
    n_words = F.col("word_end") - F.col("word_at")
    return joined(parts, F.sum("n_chunks").alias("n_chunks")).withColumn("n_words", n_words).where(
        (n_words >= least_words) | (F.col("stop") - F.col("start") >= least_chars)).select(
        "doc_id", "text_key", "start", "stop", "n_words", "n_chunks", "first_doc_id", "stays")


def without_repeats(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``docs`` whose texts lack the runs of :func:`repeats` that do not stay."""
    key, one, cuts = fresh(docs, "cut_key", "cut_doc", "cuts")
    spans = found.where(~F.col("stays")).groupBy(F.col("doc_id").alias(one), F.col("text_key").alias(key)).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias(cuts))
    keyed = docs.withColumns({one: F.col(doc_id).cast("bigint"), key: text_key(text)})
    whole = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))
    kept = F.aggregate(
        cuts, whole,
        lambda acc, c: F.struct(c["stop"].alias("at"), F.concat(acc["kept"], F.substring(
            F.col(text), acc["at"] + 1, c["start"] - acc["at"])).alias("kept")),
        lambda acc: F.concat(acc["kept"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return keyed.join(spans, [one, key], "left").withColumn(
        text, F.when(F.col(cuts).isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)
