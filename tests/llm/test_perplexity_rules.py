import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lossgrain.llm import perplexity_rules as rules
from lossgrain.llm.queries import op1_perplexity_rules
from tests_llm_words import words


def brute_model(texts, order):
    """Probability of each character by modified Kneser-Ney, from dictionaries."""
    b, e = rules.BEGIN, rules.END
    raw = Counter()
    for t in texts:
        for w in t.split():
            s = b + w + e
            for i in range(1, len(s)):
                raw[s[max(0, i + 1 - order):i + 1]] += 1
    kinds = {g[i:] for g in raw for i in range(len(g))}
    count = {}
    for g in kinds:
        full = len(g) == order or g[0] == b
        count[g] = raw[g] if full else len({k for k in kinds if len(k) == len(g) + 1 and k[1:] == g})
    count.pop(b, None)
    level = defaultdict(dict)
    for g, n in count.items():
        level[len(g)][g] = n
    discounts = {}
    for k, table in level.items():
        c = Counter(table.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] + 2 * c[2] else 0.0
        discounts[k] = [0.0] + [min(max(j - (j + 1) * y * c[j + 1] / c[j], 0), j) if c[j] else 0.5 * j for j in (1, 2, 3)]
    below = defaultdict(list)
    for g, n in count.items():
        below[g[:-1]].append((len(g), n))

    def p(context, x):
        k = len(context) + 1
        lower = p(context[1:], x) if context else 1 / (len(level[1]) + 1)
        seen = [n for size, n in below[context] if size == k]
        if not seen:
            return lower
        d = discounts[k]
        own = count.get(context + x, 0)
        return (max(own - d[min(own, 3)], 0) + sum(d[min(n, 3)] for n in seen) * lower) / sum(seen)

    return p


def brute_log_perplexity(text, p, order):
    total, n = 0.0, 0
    for w in text.split():
        s = rules.BEGIN + w + rules.END
        for i in range(1, len(s)):
            total -= math.log(p(s[max(0, i + 1 - order):i], s[i]))
            n += 1
    return total / n


def test_model_and_scores_match_brute_force(spark):
    r = random.Random(8)
    vocabulary = words(r, 60).split()
    texts = [" ".join(r.choices(vocabulary, k=60)) for _ in range(12)] + [words(r, 55)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id int, text string, lang string")
    found = {x.doc_id: x.log_perplexity for x in rules.judge(docs.repartition(4)).collect()}
    p = brute_model(texts, 4)
    symbols = sorted({c for t in texts for c in t if c != " "}) + [rules.END]
    assert abs(sum(p("ab", x) for x in symbols) - 1) < 0.05
    for i, t in enumerate(texts):
        assert abs(found[i] - brute_log_perplexity(t, p, 4)) < 1e-9


def test_base_counts_match_plain_python(spark, odd_docs):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    r = random.Random(9)
    rows = [(i, " ".join(r.choices("a b cc d#".split(), k=n)) + "\n\n x\n x \n x") for i, n in enumerate([0, 1, 3, 60, 200])]
    docs = odd_docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([(100 + i, t, "q") for i, t in rows], "doc_id bigint, text string, lang string"))
    expected = []
    for x in docs.collect():
        text = x.text or ""
        w = word.findall(text)
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {i + j for i, g in enumerate(zip(w, w[1:], w[2:])) if windows[g] > 1 for j in range(3)}
        lines, seen, repeated = text.split("\n"), set(), 0
        for line in lines:
            if word.search(line):
                repeated += line in seen
                seen.add(line)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        expected.append((x.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeated,
                         len(covered), failed))
    found = [tuple(x) for x in rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()]
    key = lambda t: tuple(-1 if v is None else v for v in t)
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_bands_reject_both_sides_and_keep_clean_rows(spark):
    r = random.Random(10)
    vocabulary = [words(r, 1) for _ in range(300)]
    rows = [(i, " ".join(r.choices(vocabulary, k=300)), "en") for i in range(300)]
    rows.append((900, " ".join("".join(chr(r.randint(0x4E00, 0x9000)) for _ in range(6)) for _ in range(300)), "en"))
    rows.append((1000, " ".join("a" * k for k in range(1, 200)), "en"))
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn("kept", F.lit("x"))
    verdict = {x.doc_id: x.kept for x in rules.judge(docs).collect()}
    assert all(verdict[i] for i in range(300)) and not verdict[900] and not verdict[1000]
    kept = rules.keep(docs)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {d for d, k in verdict.items() if k}


def test_copies_do_not_narrow_the_band(spark):
    r = random.Random(12)
    vocabulary = [words(r, 1) for _ in range(300)]
    rows = [(i, " ".join(r.choices(vocabulary, k=120)), "en") for i in range(150)]
    rows += [(1000 + i, rows[0][1], "en") for i in range(600)]
    found = rules.judge(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert found.where("not kept").count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    kept = rules.keep(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {x.doc_id for x in kept.collect()} >= {1, 6, 12}
    assert rules.judge(no_docs).count() == 0 and rules.keep(no_docs).count() == 0


def test_slots_bound_the_model(spark):
    docs = spark.createDataFrame([(1, words(random.Random(1), 400), "en")], "doc_id int, text string, lang string")
    model = rules.fit(docs, slot_bits=4)
    assert all(len(keys) <= 16 for keys, _ in model["grams"])
    assert all(np.all(keys[1:] > keys[:-1]) for keys, _ in model["grams"])


def test_labels_calibrate_the_bands(spark, tmp_path):
    r = random.Random(14)
    vocabulary = [words(r, 1) for _ in range(400)]
    draw = lambda: r.choices(vocabulary, k=120)
    rows, labels = [], []
    for i in range(300):
        kind = ("clean", "clean", "clean", "bars", "glued")[i % 5]
        text = {"clean": " ".join, "bars": " | ".join,
                "glued": lambda w: " ".join(x + r.choice(("***", "$$$", "&&&")) for x in w)}[kind](draw())
        rows.append((i, text, "en", kind))
        if i < 200:
            labels.append((i, int(kind == "clean")))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    clean = {i for i, _, _, kind in rows if kind == "clean"}
    found = op1_perplexity_rules(spark, str(tmp_path)).where("kept").collect()
    assert {x.doc_id for x in found} == clean
    stage = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert stage.columns == docs.columns and {x.doc_id for x in stage.collect()} == clean


def test_small_languages_are_not_judged_by_others(spark):
    r = random.Random(16)
    vocabulary = [words(r, 1) for _ in range(300)]
    rows = [(i, " ".join(r.choices(vocabulary, k=120)), "en") for i in range(150)]
    for first, count, lang in ((1000, 50, "zh"), (2000, 3, None)):
        rows += [(first + i, " ".join("".join(chr(r.randint(0x4E00, 0x5E00)) for _ in range(4)) for _ in range(120)), lang)
                 for i in range(count)]
    rows.append((3000, " ".join("a" * k for k in range(1, 200)), "zh"))
    found = rules.judge(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert [x.doc_id for x in found.where("not kept").collect()] == [3000]


def test_remembered_words_are_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the word{i}", "en") for i in range(1200)], "doc_id int, text string, lang string")
    model, asked = rules.fit(docs), []
    plain = rules.Scorer.__call__

    def spy(scorer, fresh_words, *rest):
        asked.extend(fresh_words)
        return plain(scorer, fresh_words, *rest)

    def here(rows, scored, schema):
        list(scored(rows.toArrow().combine_chunks().to_batches()))
        return spark.createDataFrame([], schema)

    monkeypatch.setattr(rules.Scorer, "__call__", spy)
    monkeypatch.setattr(type(docs), "mapInArrow", here)
    rules.score(docs, model, remembered=100)
    assert asked.count(b"the") == 3 and len(asked) == 1203


def test_grams_forgotten_change_no_score(spark):
    r = random.Random(8)
    own = ["".join(r.choice("abcdeé你") for _ in range(r.randint(1, 9))).encode() for _ in range(600)]
    docs = spark.createDataFrame([(i, b" ".join(own[i:i + 40]).decode(), "en") for i in range(0, 600, 20)],
                                 "doc_id int, text string, lang string")
    model = rules.fit(docs)
    langs = np.full(len(own), rules.lang_hash("en"), np.uint64)
    whole, sizes = rules.word_scores(own, langs, model)
    scorer, parts = rules.Scorer([model, model], held=50), []
    for i in range(0, 600, 7):
        (one, two), n = scorer(own[i:i + 7], langs[i:i + 7])
        assert np.array_equal(one, two) and np.array_equal(n, sizes[i:i + 7])
        parts.append(one)
    assert np.array_equal(np.concatenate(parts), whole)


def test_longest_grams_are_those_of_a_loop():
    r = random.Random(9)
    own = list({"".join(r.choice("ab\u0301你𝒳") for _ in range(r.randint(1, 9))).encode() for _ in range(300)}) + [b"\xff\xfe", b"a"]
    counts = np.array([r.randint(1, 9) for _ in own])
    wanted = {}
    for word, n in zip(own, counts):
        text = f"{rules.BEGIN}{rules._plain(word)}{rules.END}"
        for i in range(1, len(text)):
            gram = text[max(0, i - 3):i + 1]
            wanted[gram] = wanted.get(gram, 0) + n
    grams, n = rules.longest_grams(own, counts, 4)
    assert len(set(grams)) == len(grams) and dict(zip(grams, n)) == wanted


def test_grams_beyond_the_bound_are_scored_exactly(spark, odd_docs):
    r = random.Random(18)
    vocabulary = words(r, 80).split()
    rows = [(i, " ".join(r.choices(vocabulary, k=60)), "en" if i % 3 else None) for i in range(20)]
    rows += [(100 + i, rows[0][1], rows[0][2]) for i in range(5)]
    docs = odd_docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    model, reference = rules.fit(docs), rules.fit(docs.where("doc_id < 10"))
    small = [rules.fit(x, slot_bits=4) for x in (docs, docs.where("doc_id < 10"))]
    assert small[0]["partial"]["grams"] and not model["partial"]["grams"]

    def scores(*models):
        found = rules.score(docs, models[0], reference=models[1]).drop("text").collect()
        return sorted((tuple(x) for x in found), key=lambda x: (str(x[0]), str(x[1]), x[2], x[3]))

    whole, bounded = scores(model, reference), scores(*small)
    assert [x[:-2] for x in whole] == [x[:-2] for x in bounded]
    for a, b in zip(whole, bounded):
        assert all((x is None and y is None) or abs(x - y) < 1e-9 for x, y in zip(a[-2:], b[-2:]))
    own = docs.where("lang = 'en' and (doc_id < 20 or doc_id >= 100) and length(text) between 200 and 2000 and doc_id > 13")
    p = brute_model([x.text for x in own.collect()], 4)
    found = rules.judge(own, slot_bits=4).select("doc_id", "log_perplexity").collect()
    assert len(found) > 3
    assert all(abs(x.log_perplexity - brute_log_perplexity(dict(r[:2] for r in rows)[x.doc_id], p, 4)) < 1e-9 for x in found)


def test_every_label_counts_in_the_limits(spark):
    r = random.Random(19)
    rows = [(i, "en" if i % 7 else "de", i * 7919, i % 2 == 1, 60 + i, False, r.choice((1.5, 2.0)) + r.random(), 1) for i in range(900)]
    rows += [(900 + i, "en", 1_000_000 + i, i % 2 == 1, 90, False, 4 + 3 * r.random() - (i % 9 == 0) * 2, 0) for i in range(40)]
    narrow = spark.createDataFrame([(a, b, c, f, x, n) for a, b, c, _, n, f, x, _ in rows],
                                   "doc_id bigint, lang string, digest bigint, base_failed boolean, "
                                   "reference_log_perplexity double, n_words bigint").repartition(3)
    labels = spark.createDataFrame([(x[0], x[-1]) for x in rows], "doc_id bigint, quality int")
    found = rules.calibrate(narrow, labels)
    for lang in ("en", "de"):
        own = [x for x in rows if x[1] == lang]
        held = np.array([x[6] for x in own if x[-1] == 1 and x[2] % 2])
        middle = np.median(held)
        away = lambda x: (x[6] - middle) / math.sqrt(1 + rules.SHORT_WORDS / x[4])
        wanted = [middle]
        for side in (-1, 1):
            clean = sorted(max(side * away(x), 0) for x in own if x[-1] == 1)
            inner = sorted(max(side * away(x), 0) for x in own if x[-1] == 1 and x[2] % 2)
            junk = sorted(side * away(x) for x in own if x[-1] == 0 and side * away(x) > 0)
            if not junk:
                wanted.append(max(8 * 1.4826 * np.median(abs(held - middle)), np.quantile(clean, 0.995, method="higher")))
                continue
            places = sorted({0.0, *inner, *junk})
            cost = [sum(h > p for h in inner) / len(inner) + sum(j <= p for j in junk) / len(junk) for p in places]
            at = cost.index(min(cost))
            wanted.append((places[at] + places[at + 1]) / 2 if at + 1 < len(places) else places[at])
        assert np.allclose(found[lang], wanted, rtol=1e-12)


def test_only_texts_in_shared_slots_are_shuffled_to_their_labels(spark):
    rows = spark.createDataFrame([(i % 900 if i % 50 else None, f"text {i}") for i in range(1000)], "k bigint, text string").repartition(3)
    ids = spark.createDataFrame([(i,) for i in range(0, 2000, 3)], "k bigint")
    wanted = F.col("text") != "text 6"
    plain = sorted(tuple(x) for x in rows.where(wanted).join(ids, "k", "left_semi").collect())
    for slots, apart in ((1 << 26, True), (1 << 15, None), (256, False), (1, False)):
        alone, mixed = rules.with_ids(rows, ids, wanted, slots=slots)
        assert sorted(tuple(x) for x in alone.unionByName(mixed).collect()) == plain
        assert apart is None or (mixed.count() == 0) == apart
    assert [x.count() for x in rules.with_ids(rows, ids.where("k < 0"), wanted)] == [0, 0]
