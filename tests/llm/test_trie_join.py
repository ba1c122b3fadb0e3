import random
import re

from hypothesis import given, settings, strategies as st
import numpy as np

from lossgrain.llm import components, trie_join
from tests_llm_words import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n=4, percent=85):
    sets = []
    for _, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def family(r, base, copies, edits):
    out = []
    for _ in range(copies):
        w = base.split()
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = words(r, 1)
        out.append(" ".join(w))
    return out


def corpus(r):
    texts = [words(r, r.randint(1, 120)) for _ in range(60)]
    license_line = words(r, 30)
    texts += [f"{words(r, 60)} {license_line}" for _ in range(25)]
    for size, copies, edits in ((100, 40, 6), (60, 25, 3), (8, 10, 1), (300, 15, 15)):
        texts += family(r, words(r, size), copies, edits)
    texts += ["A b  C d", "a B\tc d", "one two", "ONE two", "one", "", " \n", None, texts[0], texts[0].upper()]
    r.shuffle(texts)
    return [(10 * i + 3, t) for i, t in enumerate(texts)]


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    return {x.k: (x.n_shingles, x.keeper) for x in trie_join.groups(docs, **options).collect()}


def test_against_brute_force(spark):
    rows = corpus(random.Random(21))
    assert found(spark, rows) == brute(rows)


def test_split_clusters_and_other_parameters(spark):
    rows = corpus(random.Random(22))
    assert found(spark, rows, block_sets=4) == brute(rows)
    assert found(spark, rows, words=5, percent=80, slot_bits=3) == brute(rows, 5, 80)


def test_first_of_groups(spark, odd_docs, no_docs):
    kept = trie_join.first_of_groups(odd_docs, words=5, percent=80)
    assert kept.columns == odd_docs.columns
    ids = sorted(-1 if x.doc_id is None else x.doc_id for x in kept.select("doc_id").collect())
    # 7 is there twice with one text, 12 with two texts; both null ids stay, and 3 and 4 are without shingles.
    assert ids.count(7) == 1 and ids.count(12) == 2 and ids.count(-1) == 2 and {1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13} <= set(ids)
    assert trie_join.first_of_groups(no_docs).count() == 0
    assert trie_join.groups(odd_docs).count() == odd_docs.count()


def test_rows_of_one_id_are_told_by_their_texts(spark):
    r = random.Random(31)
    one, two, three, four = (words(r, 60) for _ in range(4))
    rows = [(5, one), (5, two), (6, three), (7, f"{one} more"), (7, four), (8, two), (5, one)]
    docs = spark.createDataFrame([(i, t, "kept") for i, t in rows], "doc_id bigint, text string, note string")
    kept = [(x.doc_id, x.text) for x in trie_join.first_of_groups(docs, words=5, percent=80).collect()]
    assert (6, three) in kept and (7, four) in kept and len(kept) == 4
    assert sum(t in (one, f"{one} more") for _, t in kept) == 1 and sum(t == two for _, t in kept) == 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 14), min_size=1, max_size=12), min_size=1, max_size=14),
       st.sampled_from([50, 80, 85, 100]))
def test_tree_links(sets, percent):
    members = [np.array(sorted(s), np.uint64) for s in sets]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert trie_join.link_sets(members, percent) == [find(i) for i in range(len(sets))]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 400), (400, 500), (7, 7)]
    found = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 400: 400, 500: 400}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 40), min_size=1, max_size=30), min_size=1, max_size=12),
       st.sampled_from([8, 64, 1024]))
def test_bitmaps_exclude_no_similar_pair(sets, least):
    trie_join.LEAST_BITS = max(least, 64)
    ordered = sorted((np.array(sorted(s), np.uint64) * np.uint64(97) for s in sets), key=len)
    roots = trie_join.may_link(np.array([len(s) for s in ordered]),
                               [trie_join.folded(s) for s in ordered], 85)
    trie_join.LEAST_BITS = 1024
    links = trie_join.link_sets(ordered, 85)
    for i in range(len(ordered)):
        for j in range(i):
            assert links[i] != links[j] or roots[i] == roots[j]
