import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lossgrain.llm import merkle_manifest as mm

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, digest string, n string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """Root and the siblings of each leaf, level by level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for p, i in zip(paths, at):
            p.append((i % 2, nodes[i ^ 1]) if i ^ 1 < len(nodes) else None)
        at = [i // 2 for i in at]
        nodes = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def by_hand(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, h(*map(field, r[:5]))))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    roots = {t: tree([x[2] for x in sorted(trees[t])]) for t in names}
    root, above = tree([roots[t][0] for t in names])
    out = []
    for t, up in zip(names, above):
        for leaf, path in zip(sorted(trees[t]), roots[t][1]):
            out.append((leaf[1] if leaf[0] else None, leaf[2], roots[t][0], h(*[s[1] for s in path + up if s])))
    return root, out


def table(spark, rows):
    return spark.createDataFrame([(*r, "t", "d", "n") for r in rows], SCHEMA).repartition(5)


def sample(r, n):
    langs = ["en"] * 6 + ["de", "zz é", "", None]
    rows = [(i, "s", r.choice(langs), i * 3, f"text {i}") for i in range(n)]
    return rows + [(None, None, None, None, None), (None, "s", "en", 1, ""), (3, "s", "en", 1, "twice"), (3, "s", "en", 1, "twice"),
                   (-5, "s", "one", None, "é" * 50_000)]


@pytest.mark.parametrize("n,levels", [(1, 12), (13, 1), (100, 2), (333, 3)])
def test_equals_a_tree_by_hand(spark, n, levels):
    rows = sample(random.Random(n), n)
    manifest = mm.of_table(table(spark, rows), levels=levels)
    root, wanted = by_hand(rows)
    assert manifest.root == root
    got = mm.proofs(manifest).select("id", "digest", "subroot", mm.proof_digest(F.col("proof")), mm.fold(F.col("digest"), F.col("proof")))
    found = [tuple(r) for r in got.collect()]
    assert {r[4] for r in found} == {root}
    assert sorted((r[:4] for r in found), key=str) == sorted(wanted, key=str)


def test_some_rows_share_a_multiproof(spark):
    rows = sample(random.Random(2), 200)
    manifest = mm.of_table(table(spark, rows), levels=3)
    some = manifest.leaves.where(F.col("id").isin(1, 2, 50, 77, 199, -5))
    got = mm.proofs(manifest, some).select("id", "digest", "proof", mm.fold(F.col("digest"), F.col("proof")).alias("root")).collect()
    assert len(got) == 6 and {r.root for r in got} == {manifest.root}
    changed = mm.proofs(manifest, some).select(mm.fold(mm.leaf_of(F.lit("other")), F.col("proof")).alias("root"))
    assert manifest.root not in {r.root for r in changed.collect()}


@pytest.mark.parametrize("n", [1, 2, 7, 16, 29])
def test_missing_nodes_are_the_smallest_set(n):
    r = random.Random(n)
    leaves = [h(str(i)) for i in range(n)]
    nodes, level = {(0, i): d for i, d in enumerate(leaves)}, 0
    here = leaves
    while len(here) > 1:
        here, level = mm.parents(here), level + 1
        nodes |= {(level, i): d for i, d in enumerate(here)}
    for _ in range(20):
        known = sorted(r.sample(range(n), r.randint(1, n)))
        asked = mm.missing_nodes(known, n)
        assert len(set(asked)) == len(asked)
        # None can be derived: below no node asked for lies a known leaf.
        for lv, i in asked:
            assert not any(k >> lv == i for k in known)
            assert any(k >> lv == i ^ 1 for k in known)
        steps = mm.expand({k: leaves[k] for k in known}, {a: nodes[a] for a in asked}, n)
        _, paths = tree(leaves)
        for k in known:
            assert steps[k] == ["" if s is None else ("L" if s[0] else "R") + s[1] for s in paths[k]]


def test_one_row_and_no_rows(spark):
    one = mm.of_table(table(spark, [(1, "s", "en", 4, "text")]))
    row = mm.proofs(one).first()
    assert row.digest == row.subroot == one.root and row.proof == []
    none = mm.of_table(table(spark, []))
    assert none.root is None and mm.proofs(none).collect() == []
