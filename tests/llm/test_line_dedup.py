import collections
import random

import numpy as np
import pytest

from lossgrain.llm import line_dedup

SCHEMA = "doc_id bigint, text string, token string, n_lines string, data string, c0 string"
BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def by_hand(rows, least_docs, least_chars, keep_first):
    """Rows ``(doc_id, text)`` to the expected texts, by one dictionary."""
    docs = collections.defaultdict(set)
    for i, (_, text) in enumerate(rows):
        for line in (text or "").split("\n") if text is not None else ():
            if len(key_of(line)) >= least_chars:
                docs[key_of(line)].add(i)
    often = {k: v for k, v in docs.items() if len(v) >= least_docs}
    out = []
    for i, (_, text) in enumerate(rows):
        if text is None:
            out.append(None)
            continue
        kept, seen = [], set()
        for line in text.split("\n"):
            k = key_of(line)
            if k in often:
                first = min(often[k], key=lambda j: (rows[j][0] is None, rows[j][0] or 0))
                if not keep_first or first != i or k in seen:
                    continue
                seen.add(k)
            kept.append(line)
        out.append("\n".join(kept))
    return out


def fixture(r):
    common = ["All rights reserved.", "  all RIGHTS reserved.\r", "Ünï 你好", "x", "{", "-" * 5000, "É", "é"]
    rows = [(i, "\n".join(r.choice(common) if r.random() < 0.4 else f"line {r.randrange(400)}" for _ in range(r.randrange(1, 12))))
            for i in range(150)]
    rows += [(900, None), (901, ""), (902, "\n\n \n"), (None, "x\nlost\nx"), (903, "long " * 100_000), (904, "a\n" * 20_000),
             (905, " x\n x\nx\x1c"), (906, "line 1\x0b\nLINE 1\nline 1")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", "n", "d", "c") for i, t in rows], SCHEMA).repartition(7)


@pytest.mark.parametrize("least_docs,least_chars,keep_first,known_rows", [
    (2, 1, False, 10**6), (2, 1, True, 10**6), (3, 2, True, 0), (10, 1, False, 0), (10, 5, False, 10**6)])
def test_equals_a_dictionary(spark, least_docs, least_chars, keep_first, known_rows):
    rows = fixture(random.Random(least_docs * 7 + least_chars))
    out = line_dedup.drop_repeated(frame(spark, rows), least_docs, least_chars, keep_first, known_rows=known_rows)
    assert out.columns[:6] == ["doc_id", "text", "token", "n_lines", "data", "c0"]
    got = sorted(((r[0], r[1], r[6], r[7]) for r in out.collect()), key=lambda r: (r[0] is None, r[0]))
    wanted = by_hand(rows, least_docs, least_chars, keep_first)
    expected = sorted(
        ((i, w, len((t or "").split("\n")), 0 if t is None else len(t.split("\n")) - kept)
         for (i, t), w in zip(rows, wanted)
         for kept in [0 if w is None else len(w.split("\n")) if w or gone_none(t, w) else 0]),
        key=lambda r: (r[0] is None, r[0]))
    assert got == expected


def gone_none(text, kept):
    """Whether an empty result is one empty line that stays, not no line."""
    return any(key_of(line) == "" for line in text.split("\n"))


def test_full_filters_change_nothing(spark):
    rows = fixture(random.Random(5))
    small = line_dedup.drop_repeated(frame(spark, rows), 2, filter_bits=1 << 16)
    large = line_dedup.drop_repeated(frame(spark, rows), 2)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (1, "a\nc"), (2, "c\nd")]
    out = line_dedup.drop_repeated(frame(spark, rows), 2, keep_first=False)
    assert sorted(r.text for r in out.collect()) == ["", "", "", "d"]
    first = line_dedup.drop_repeated(frame(spark, [(2, "q\nz"), (1, "q\ny"), (1, "w")]), 2)
    assert sorted(r.text for r in first.collect()) == ["q\ny", "w", "z"]


def test_empty_table(spark):
    assert line_dedup.drop_repeated(frame(spark, []), 2).collect() == []


def test_filters_miss_no_repeat():
    """Parts marked apart and merged hold every key of two parts or of two batches."""
    r = random.Random(3)
    bits, parts = 16, []
    for _ in range(5):
        once, twice = np.zeros(1 << 13, np.uint8), np.zeros(1 << 13, np.uint8)
        own = [b"key %d" % r.randrange(3000) for _ in range(500)]
        for i in (0, 200):
            line_dedup.fold(once, twice, line_dedup.hashes_of(own[i:i + 250]), bits)
        parts.append((own, (once, twice)))
    merged = parts[0][1]
    for _, p in parts[1:]:
        merged = line_dedup.merge(merged, p)
    count = collections.Counter(k for own, _ in parts for i in (0, 200) for k in own[i:i + 250])
    again = [k for k, n in count.items() if n > 1]
    alone = [k for k, n in count.items() if n == 1]
    assert line_dedup.holds(merged[1], line_dedup.places(line_dedup.hashes_of(again), bits)).all()
    assert line_dedup.holds(merged[1], line_dedup.places(line_dedup.hashes_of(alone), bits)).mean() < 0.05
