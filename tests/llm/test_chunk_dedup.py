import random

import numpy as np
from pyspark.sql import functions as F

from lossgrain.llm import chunk_dedup
from tests_llm_words import words


def test_rolling_hash_matches_the_loop():
    gear = chunk_dedup.gear_table()
    data = np.frombuffer("é".encode() * 50 + words(random.Random(1), 200).encode(), np.uint8)
    ends, rolling, last = [], 0, 0
    for i, byte in enumerate(data.tolist()):
        rolling = ((rolling << 1) + int(gear[byte])) & 0xFFFFFFFF
        opens = i + 1 == len(data) or data[i + 1] & 0xC0 != 0x80
        if rolling >> 27 == 0 and opens and i + 1 - last >= 16:
            ends.append(i + 1)
            last = i + 1
    if last < len(data):
        ends.append(len(data))
    assert chunk_dedup.cut_points(data, gear, 5, 16, 10**9) == ends
    assert max(np.diff([0, *chunk_dedup.cut_points(data, gear, 5, 16, 64)])) <= 64


def test_insertion_moves_only_near_cuts():
    text = words(random.Random(2), 2000)
    gear = chunk_dedup.gear_table()
    parts = []
    for t in (text, text[:300] + "inserted " + text[300:]):
        raw = t.encode()
        ends = chunk_dedup.cut_points(np.frombuffer(raw, np.uint8), gear, 5, 16, 512)
        parts.append({raw[a:b] for a, b in zip([0, *ends], ends)})
    assert len(parts[0] - parts[1]) <= 4


def test_shared_passages_are_found_and_removed(spark):
    r = random.Random(3)
    passage = words(r, 60)
    rows = [(i, f"{words(r, 40)} {passage} {words(r, 30)}") for i in (5, 3, 9)] + [
        (i, words(r, 150)) for i in range(20, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = chunk_dedup.repeats(docs).collect()
    assert {(x.doc_id, x.first_doc_id, x.stays) for x in found} == {(3, 3, True), (5, 3, False), (9, 3, False)}
    text = dict(rows)
    for x in found:
        assert passage in text[x.doc_id][x.start:x.stop] and x.stop - x.start <= len(passage) + 4
    left = {x.doc_id: x.text for x in chunk_dedup.without_repeats(docs, chunk_dedup.repeats(docs)).collect()}
    assert left[3] == text[3] and left[25] == text[25]
    for x in found:
        if not x.stays:
            assert left[x.doc_id] == text[x.doc_id][:x.start] + text[x.doc_id][x.stop:]


def test_hot_chunk_and_odd_rows(spark, odd_docs, no_docs):
    same = words(random.Random(4), 70)
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(same).alias("text"))
    found = chunk_dedup.repeats(hot)
    assert found.where("stays").select("doc_id").distinct().collect() == [(0,)]
    assert found.where("not stays").select("doc_id").distinct().count() == 2999
    ids = {x.doc_id for x in chunk_dedup.repeats(odd_docs).collect()}
    assert not ids & {2, 3, 4, None, 1, 5}  # 8, 9 and 11 repeat themselves
    assert chunk_dedup.repeats(no_docs).count() == 0
    out = chunk_dedup.without_repeats(odd_docs, chunk_dedup.repeats(odd_docs))
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()


def test_every_passage_is_found_to_its_ends(spark):
    """Equal stretches by comparison of the texts around the planted place, for passages of 51 words."""
    r = random.Random(5)
    planted, rows = {}, []
    for k in range(150):
        passage = words(r, 51)
        for i in (k, 1000 + k):
            before, after = words(r, r.randint(0, 30)), words(r, r.randint(0, 30))
            rows.append((i, f"{before} {passage} {after}"))
            planted[i] = (len(before) + 1, len(before) + 1 + len(passage))
    text = dict(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {(x.doc_id, x.stays): x for x in chunk_dedup.repeats(docs).collect()}
    missed = 0
    for k in range(150):
        (a, b), (c, d) = planted[1000 + k], planted[k]
        while a and c and text[1000 + k][a - 1] == text[k][c - 1]:
            a, c = a - 1, c - 1
        while b < len(text[1000 + k]) and d < len(text[k]) and text[1000 + k][b] == text[k][d]:
            b, d = b + 1, d + 1
        if (1000 + k, False) not in found:
            missed += 1
            continue
        copy, first = found[1000 + k, False], found[k, True]
        assert (copy.start, copy.stop) == (a, b) and (first.start, first.stop) == (c, d)
        assert 51 <= copy.n_words <= 55 and copy.first_doc_id == k
    assert missed <= 1  # a stretch without two common cuts has no seed


def test_long_equal_ends_take_further_rounds(spark):
    """Equal text without chunks in common: the ends are compared beyond the first width."""
    rows = [(1, "ab" * 3000 + "c"), (2, "x" + "ab" * 3000 + "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("text_key", chunk_dedup.text_key())
    key = {x.doc_id: x.text_key for x in docs.collect()}
    edges = spark.createDataFrame([(2, key[2], 2 * 3001, 0, 1, key[1], 2 * 3000, 0), (2, key[2], 2 * 3001 + 1, 0, 1, key[1], 2 * 3000 + 1, 0)],
                                  "doc_id bigint, text_key bigint, code bigint, word int, first_doc_id bigint, "
                                  "first_key bigint, first_code bigint, first_word int")
    out = chunk_dedup.equal_ends(docs, edges).collect()
    mine = [x for x in out if not x.stays]
    assert (min(x.start for x in mine), max(x.stop for x in mine)) == (1, 6001)
    assert len(mine) > 4 and {x.doc_id for x in out if x.stays} == {1}


def test_texts_under_one_id_are_told_apart(spark):
    r = random.Random(6)
    passage, other = words(r, 80), words(r, 300)
    rows = [(1, passage), (2, f"{words(r, 20)} {passage}"), (2, other)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = chunk_dedup.without_repeats(docs, chunk_dedup.repeats(docs)).collect()
    assert other in {x.text for x in left} and rows[1][1] not in {x.text for x in left}


def test_only_repeated_chunks_come_out_of_the_join(spark):
    """No plan keeps the chunks that are there once, and the first occurrences are those of a loop."""
    r = random.Random(21)
    schema = chunk_dedup.CHUNK_SCHEMA
    rows = [(r.randint(0, 40), r.randint(0, 2), i, 45, i, 8, r.randint(0, 300), 7) for i in range(600)]
    rows += [(i % 50, 5, 1000 + i, 45, i, 8, -1, -1) for i in range(3000)]
    parts = chunk_dedup.pin(spark.createDataFrame(rows, schema).repartition(3))
    out = chunk_dedup.occurrences(parts)
    assert "LeftOuter" not in out._jdf.queryExecution().executedPlan().toString()
    by_digest = {}
    for x in rows:
        by_digest.setdefault(x[6:], []).append(x)
    wanted = sorted((*x[:6], *min(same)[:3], min(same)[4], x[:3] == min(same)[:3])
                    for same in by_digest.values() if len(same) > 1 for x in same)
    assert sorted(map(tuple, out.select(
        "doc_id", "text_key", "start", "chars", "word_at", "words", "first_doc_id", "first_key", "first_start",
        "first_word", "stays").collect())) == wanted
