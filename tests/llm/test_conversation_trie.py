import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lossgrain.llm import conversation_trie as ct

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, path string, n string"


def shared(conv):
    return zlib.crc32(str(conv).encode()) % 6


def order(row):
    role, text = row[2] or "", row[3] or ""
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    return row[1] is not None, row[1] or 0, digest


def by_hand(rows):
    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {c: tuple(own.get(c - c % 100, [])[:shared(c)] + own[c][shared(c):]) for c in own}
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) if below else 1
        saved[p] = sum(saved[q] for q in below) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == p).encode()).hexdigest())
        for p, m in members.items()) if members else []


def found(spark, rows):
    chats = spark.createDataFrame([(*r, "c", "p", "n") for r in rows], SCHEMA).repartition(5)
    rebuilt = ct.with_shared_start(ct.numbered_turns(chats), F.col("conv") - F.pmod("conv", F.lit(100)),
                                   F.crc32(F.col("conv").cast("string").cast("binary")) % 6)
    return sorted(map(tuple, ct.prefix_nodes(ct.paths(rebuilt)).collect()), key=lambda r: (r[0], r[1], r[2] or -1, r[7]))


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[2] or -1, r[7]))


def test_random_conversations(spark):
    r = random.Random(1)
    rows = []
    for c in [*range(0, 260), 300, 301, 302, 555, 556]:
        for t in range(r.choice([1, 2, 3, 6, 7, 9])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", r.choice(["a", "bb", "ccc 你"]) * (1 if t < 6 else 2)))
    assert found(spark, rows) == ordered(by_hand(rows))


def test_odd_rows(spark):
    long = "y" * 100_000
    rows = [
        (100, 0, "user", "hi"), (100, 1, "assistant", "hello"), (100, 2, None, None), (100, None, "system", "first"),
        (101, 0, "user", "hi"), (101, 0, "user", "hi"), (101, 0, "assistant", "tie"), (102, 5, None, "x"), (102, 5, "", "x"),
        (103, 0, "user", long), (103, 1, "user", long), (104, 0, "user", ""), (250, 0, "u", "t"), (251, 0, "u", "t"),
        (None, 0, "user", "lost"), (-3, 0, "user", "below"), (-100, 0, "user", "host"), (7, None, None, None)]
    rows += [(107, t, "user", f"turn {t}") for t in range(70)] + [(c, 0, "user", "same") for c in range(1000, 1090)]
    assert found(spark, rows) == ordered(by_hand(rows))


def test_no_conversations(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("shape", ["nested", "comb", "copies"])
def test_shapes_of_tries(spark, shape):
    """Chains of prefixes, one branch at each depth, and one conversation many times."""
    if shape == "nested":
        texts = {c: [f"t{d}" for d in range(c % 40 + 1)] for c in range(80)}
    elif shape == "comb":
        texts = {c: [f"t{d}" for d in range(c)] + [f"own {c}"] * 3 for c in range(40)}
    else:
        texts = {c: ["a", "b", "c"] for c in range(9000)}
    built = spark.createDataFrame(
        [(c, d, hashlib.sha256(x.encode()).hexdigest(), len(x)) for c, xs in texts.items() for d, x in enumerate(xs)],
        "conv bigint, pos int, turn_digest string, chars bigint")
    rows = ct.prefix_nodes(ct.paths(built)).collect()
    members = {}
    for c, xs in texts.items():
        for d in range(len(xs) + 1):
            members.setdefault(tuple(xs[:d]), []).append(c)
    assert sorted((r.conv_id, r.depth, r.n_convs) for r in rows) == sorted((min(m), len(p), len(m)) for p, m in members.items())
    assert max(r.n_convs for r in rows) == len(texts)
    ends = {hashlib.sha256(",".join(str(c) for c in m if len(texts[c]) == len(p)).encode()).hexdigest() for p, m in members.items()}
    assert {r.ends_sha256 for r in rows} == ends


def test_two_fattest(spark):
    pairs = [(a, b) for b in range(1, 40) for a in range(b)]
    df = spark.createDataFrame(pairs, "a int, b int").select("a", "b", ct.two_fattest(F.col("a"), F.col("b")).alias("f"))
    trailing = lambda x: x & -x
    for r in df.collect():
        assert r.f == max(range(r.a + 1, r.b + 1), key=trailing)
