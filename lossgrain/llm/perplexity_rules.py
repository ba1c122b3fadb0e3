"""Quality rules by n-gram perplexity.

The model predicts a word's characters from the characters before them
(grams of up to ``order`` characters, word begin and end marked), per
language. Spark counts the grams of all documents. Modified Kneser-Ney
discounts and back-off weights are computed from these counts and kept in
sorted arrays of 64-bit gram hashes, which tasks search by bisection. The
number of grams a model keeps is bounded by ``order * 2**slot_bits``, which
is the proven bound of what is broadcast: grams of an order that fall into
one of 2**slot_bits slots keep the most frequent one.

A document's log-perplexity must lie between a lower and an upper band of its
language: median minus ``below`` and plus ``above`` robust standard
deviations over the distinct texts that pass the base rules, and at least
``least_width`` away from the median. The mean of a short text scatters more,
so for n words both distances are multiplied by sqrt(1 + short_words / n).
A band is wider by three standard errors of its median and of its deviation,
so few texts give a wide band of their own; a language with fewer than
``least_texts`` keeps the verdict of the base rules. No language is compared
with another's median.

These bands know nothing of quality and are wide, and the model has seen the
junk too. With ``labels`` (id and quality 0 or 1) there is a second model, the
reference, of texts labelled 1, in which what clean text never holds (a symbol
behind each word, bars between words) is unlikely. Its bands are calibrated
per language: the limit above (below) the median is the one with the smallest
sum of two shares, clean rows beyond it and junk rows within it. One half of
the clean texts fits the reference, the other half places the limits. All
labels count; languages with fewer than ``least_labelled`` clean texts to place limits have no such band. A document
must lie in both bands of its language.

Defined results: a null text has no words and fails the base rules like any
text under 50 words; a null language is the language ''; empty texts have no
perplexity; very long texts are scored whole; repeated rows are counted and
scored like others; empty tables give no rows; further columns are kept by
:func:`keep`, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType)

from lossgrain.llm.common import attach, fresh, hand_back, pin
from lossgrain.operators.order_stats import quantiles, with_running_counts

BEGIN, END = "\x02", "\x03"
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"  # fixed values of the base rules
SHORT_WORDS = 200.0  # words at which the scatter of a mean doubles the variance
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

SCORES = StructType([StructField(c, t) for c, t in (
    ("n_words", LongType()), ("word_chars", LongType()), ("n_symbols", LongType()),
    ("n_dup_lines", LongType()), ("n_repeat_words", LongType()), ("base_failed", BooleanType()),
    ("log_perplexity", DoubleType()))])
REFERENCE = StructType([StructField("reference_log_perplexity", DoubleType())])
#: Predicted characters, digest of the text, language, and the words whose grams a task does not hold.
OPEN = StructType([
    StructField("open_chars", LongType()), StructField("open_a", LongType()), StructField("open_b", LongType()),
    StructField("open_lang", StringType()), StructField("open_words", ArrayType(StructType([
        StructField("word", StringType()), StructField("n", LongType())])))])
OPEN_TYPES = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))]


def _plain(word: bytes) -> str:
    return word.decode("utf-8", "replace").replace(BEGIN, " ").replace(END, " ")


def _marked(words: list[bytes]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """Words between their marks end to end, their code points, sizes, and each character's place in its word."""
    texts = [f"{BEGIN}{_plain(w)}{END}" for w in words]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    return joined, codes, sizes, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def longest_grams(words: list[bytes], counts: np.ndarray, order: int) -> tuple[list[str], np.ndarray]:
    """The longest gram ending at each character but the first of the words, and how often each is there."""
    joined, codes, sizes, depth = _marked(words)
    at = np.flatnonzero(depth > 0)
    length = np.minimum(depth[at] + 1, order)
    keys = np.stack(gram_keys(codes, np.zeros(len(codes), np.uint64), order))[length - 1, at]
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    n = np.bincount(which, np.repeat(counts, sizes)[at], len(first)).astype(np.int64)
    ends = at[first] + 1
    return [joined[e - k:e] for e, k in zip(ends.tolist(), length[first].tolist())], n


def gram_counts(docs: DataFrame, order: int, held: int = 50_000) -> DataFrame:
    """``lang, gram, n`` of ``docs(lang, raw)``: the longest gram ending at each character.

    A task counts words before it counts grams, and holds at most about
    ``held`` distinct words.
    """

    def counted(batches):
        words: dict[str, Counter] = defaultdict(Counter)

        def flush():
            langs, grams, counts = [], [], []
            for lang, found in words.items():
                own, n = longest_grams(list(found), np.fromiter(found.values(), np.int64, len(found)), order)
                langs += [lang] * len(own)
                grams += own
                counts += n.tolist()
            words.clear()
            return pa.record_batch([pa.array(langs, pa.string()), pa.array(grams, pa.string()),
                                    pa.array(counts, pa.int64())], ["lang", "gram", "n"])

        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if raw.is_valid:
                    words[lang].update(raw.as_buffer().to_pybytes().split())
                    if sum(map(len, words.values())) > held:
                        yield flush()
        yield flush()
        hand_back()  # the worker stays for the next stage

    return docs.mapInArrow(counted, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def adjusted_counts(counts: DataFrame, order: int) -> DataFrame:
    """Counts of full-length and word-begin grams; of the others the number of different left neighbours."""
    length = F.length("gram")
    suffixes = counts.select(
        "lang", "n", "gram", F.explode(F.sequence(F.lit(1), length)).alias("at"))
    kinds = suffixes.groupBy("lang", F.expr("substring(gram, at)").alias("gram")).agg(
        F.sum(F.when(F.col("at") == 1, F.col("n")).otherwise(0)).alias("n"))
    full = (length == order) | F.col("gram").startswith(BEGIN)
    left = kinds.where(length > 1).groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(
        F.count(F.lit(1)).alias("n"))
    return kinds.where(full).unionByName(left.where(~full))


def gram_keys(codes: np.ndarray, langs: np.ndarray, lengths: int) -> list[np.ndarray]:
    """For each order up to ``lengths``: hash of the gram that ends at each position."""
    n, total, power, out = len(codes), np.zeros(len(codes), np.uint64), 1, []
    symbols = codes.astype(np.uint64) + np.uint64(1)
    for k in range(1, lengths + 1):
        if k <= n:
            total[k - 1:] += symbols[:n - k + 1] * np.uint64(power)
        power = power * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
        mixed = (total ^ langs) * MULTIPLIER + np.uint64(k)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        out.append(mixed ^ (mixed >> np.uint64(32)))
    return out


def lang_hash(lang: str) -> int:
    total = 1469598103934665603
    for byte in lang.encode():
        total = ((total ^ byte) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return total


def smoothed(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Modified Kneser-Ney from adjusted counts: ``lang, size, gram, n, value`` of grams and of contexts.

    The value of a gram is its discounted share of its context, that of a
    context (``size`` is one more than its length) the weight of the lower
    order.
    """
    by = ["lang", "size"]
    counts = pin(counts.where(F.col("gram") != BEGIN).withColumn("size", F.length("gram")))  # never predicted
    few = counts.groupBy(*by).agg(*[F.count(F.when(F.col("n") == j, 1)).alias(f"c{j}") for j in range(1, 5)])
    share = F.coalesce(F.try_divide(F.col("c1"), F.col("c1") + 2 * F.col("c2")), F.lit(0.0))
    discounts = few.select(*by, *[
        F.when(F.col(f"c{j}") == 0, 0.5 * j).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(float(j)), j - (
            j + 1) * share * F.try_divide(F.col(f"c{j + 1}"), F.col(f"c{j}"))))).alias(f"d{j}") for j in (1, 2, 3)])
    # One row per language and length.
    rows = counts.join(F.broadcast(discounts), by).select(
        *by, "gram", "n", F.expr("substring(gram, 1, size - 1)").alias("context"),
        F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")).alias("d"))
    contexts = pin(rows.groupBy(*by, F.col("context").alias("gram")).agg(
        F.sum("n").alias("n"), F.sum("d").alias("d")).select(*by, "gram", "n", (F.col("d") / F.col("n")).alias("value")))
    totals = contexts.select(*by, F.col("gram").alias("context"), F.col("n").alias("total"))
    grams = pin(rows.join(totals, [*by, "context"]).select(
        *by, "gram", "n", ((F.col("n") - F.col("d")) / F.col("total")).alias("value")))
    return grams, contexts


def held(table: DataFrame, slot_bits: int) -> tuple[pa.Table, list[int]]:
    """The rows tasks hold, and the sizes of which they do not hold all."""
    sizes = {r["size"]: r["count"] for r in table.groupBy("size").count().collect()}
    large = sorted(k for k, n in sizes.items() if n > 1 << slot_bits)
    rows = table.where(~F.col("size").isin(large)).select("size", "n", "lang", "gram", "value")
    if large:
        slot = F.pmod(F.xxhash64("lang", "gram"), F.lit(1 << slot_bits))
        rows = rows.unionByName(table.where(F.col("size").isin(large)).groupBy("size", slot.alias("slot")).agg(
            F.max(F.struct("n", "lang", "gram", "value")).alias("top")).select("size", "top.*"))
    return rows.select("size", "lang", "gram", "value").toArrow(), large


def _arrays(table: pa.Table, order: int, shorter: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per size the sorted hashes, and their values, of texts that are ``shorter`` by that many characters."""
    out = []
    for k in range(1, order + 1):
        own = table.filter(pc.equal(table.column("size"), k))
        langs = own.column("lang").combine_chunks().dictionary_encode()
        names = np.array([lang_hash(x) for x in langs.dictionary.to_pylist()], np.uint64)
        keys, length = names[langs.indices.to_numpy()] if len(own) else np.zeros(0, np.uint64), k - shorter
        if length and len(own):
            codes = np.frombuffer("".join(own.column("gram").to_pylist()).encode("utf-32-le"), np.uint32)
            keys = gram_keys(codes, np.repeat(keys, length), length)[-1][length - 1::length]
        order_of = np.argsort(keys)
        out.append((keys[order_of], own.column("value").to_numpy()[order_of]))
    return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = 4,
        slot_bits: int = 20) -> dict:
    """The model of all documents. The driver receives at most ``2 * order * 2**slot_bits`` grams and contexts.

    ``partial`` has the sizes of which tasks do not hold all, ``tables`` the
    whole tables of grams and contexts.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                       F.encode(F.col(text), "UTF-8").alias("raw"))
    grams, contexts = smoothed(adjusted_counts(pin(gram_counts(rows, order)), order))
    symbols = grams.where("size = 1").select("gram").distinct().count()
    model = {"order": order, "floor": 1.0 / (max(symbols, 1) + 1), "partial": {}, "tables": (grams, contexts)}
    for name, table, shorter in (("grams", grams, 0), ("contexts", contexts, 1)):
        rows, model["partial"][name] = held(table, slot_bits)
        model[name] = _arrays(rows, order, shorter)
    return model


def exact_logs(grams: DataFrame, model: dict) -> DataFrame:
    """``lang, gram, x``: natural-log probability of the last character of each of the different grams, by joins."""
    def look(rows: DataFrame, table: DataFrame, text: str, into: str, default: float) -> DataFrame:
        keys = ["lang", "size", text]
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("uses"))
        known = pin(table.select("lang", "size", F.col("gram").alias(text), F.col("value").alias(into)).join(counts, keys))
        return attach(rows, known, keys, "uses").drop("uses").fillna(default, [into])

    size = F.length("gram")
    rows = pin(grams.withColumn("size", F.explode(F.sequence(F.lit(1), size))).withColumn(
        "part", F.expr("substring(gram, length(gram) - size + 1, size)")).withColumn(
        "context", F.expr("substring(part, 1, size - 1)")))
    rows = pin(look(rows, model["tables"][0], "part", "seen", 0.0))
    rows = look(rows, model["tables"][1], "context", "weight", 1.0)
    steps = F.sort_array(F.collect_list(F.struct("size", "seen", "weight")))
    p = F.aggregate("steps", F.lit(model["floor"]), lambda p, s: s["seen"] + s["weight"] * p)
    return rows.groupBy("lang", "gram").agg(steps.alias("steps")).select("lang", "gram", p.alias("p")).select(
        "lang", "gram", F.when(F.col("p") > 0, F.log("p")).otherwise(float("-inf")).alias("x"))


def exact_word_logs(words: DataFrame, models: list[dict]) -> DataFrame:
    """``words`` (different ``lang, word``, and more) with ``x0, x1, ...``: the log probabilities by the models."""
    order = models[0]["order"]

    def ends(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = f"{BEGIN}{word}{END}"
                for gram, n in Counter(text[max(0, i - order):i] for i in range(2, len(text) + 1)).items():
                    for into, value in zip(out, (lang, word, gram, n)):
                        into.append(value)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, [pa.string()] * 3 + [pa.int64()])],
                                  ["lang", "word", "gram", "n"])

    parts = pin(words.select("lang", "word").mapInArrow(ends, "lang string, word string, gram string, n bigint"))
    grams = pin(parts.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("uses")))
    names = [f"x{i}" for i in range(len(models))]
    logs = grams
    for name, model in zip(names, models):
        logs = logs.join(exact_logs(grams.select("lang", "gram"), model).withColumnRenamed("x", name), ["lang", "gram"])
    sums = attach(parts, pin(logs), ["lang", "gram"], "uses").groupBy("lang", "word").agg(
        *[F.sum(F.col("n") * F.col(x)).alias(x) for x in names])
    return words.join(sums, ["lang", "word"])


def indexed(model: dict) -> dict:
    """The model with, for each sorted array, the place where every group of leading hash bits begins.

    Hashes are even, so a group has about one entry, and a lookup is a step or
    two instead of a bisection.
    """
    def begins(known: np.ndarray) -> tuple[np.uint64, np.ndarray]:
        shift = np.uint64(64 - max(len(known).bit_length(), 1))
        top = np.arange((1 << (64 - int(shift))) + 1, dtype=np.uint64)
        return shift, np.searchsorted(known >> shift, top)

    return model | {"begins": {name: [begins(known) for known, _ in model[name]] for name in ("grams", "contexts")}}


def _log_p(model: dict, keys: list[np.ndarray], lang_of: np.ndarray, depth: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural-log probability of the characters ``at``, from the grams that end there.

    NaN where a gram or context is not found and not all of its size are held.
    """
    def look(name: str, k: int, wanted: np.ndarray, default: float) -> np.ndarray:
        known, values = model[name][k]
        shift, begins = model["begins"][name][k]
        top = (wanted >> shift).astype(np.int64)
        out, place, end = np.full(len(wanted), default), begins[top], begins[top + 1]
        open_ = np.flatnonzero(place < end)
        while len(open_):
            here = place[open_]
            hit = known[here] == wanted[open_]
            out[open_[hit]] = values[here[hit]]
            open_ = open_[~hit]
            place[open_] += 1
            open_ = open_[place[open_] < end[open_]]
        return out

    p = np.full(len(at), model["floor"])
    for k in range(1, model["order"] + 1):
        here = np.flatnonzero(depth[at] >= k - 1)
        where = at[here]
        seen = look("grams", k - 1, keys[k - 1][where], np.nan if k in model["partial"]["grams"] else 0.0)
        context = keys[k - 2][where - 1] if k > 1 else lang_of[where]
        p[here] = seen + look("contexts", k - 1, context, np.nan if k in model["partial"]["contexts"] else 1.0) * p[here]
    return np.log(p)


class Scorer:
    """Scores words in one or several models of one order.

    What a character adds depends on the longest gram that ends there, so it
    is worked out once per gram and then remembered, up to ``held`` grams.
    """

    def __init__(self, models: list[dict], held: int = 2_000_000):
        self.models, self.held = [indexed(m) for m in models], held
        self.forget()

    def forget(self) -> None:
        self.grams = np.zeros(0, np.uint64)
        self.logs = [np.zeros(0) for _ in self.models]

    def __call__(self, words: list[bytes], langs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Per model the natural-log probability of each word, and its number of predicted characters."""
        order = self.models[0]["order"]
        _, codes, sizes, depth = _marked(words)
        lang_of = np.repeat(langs, sizes)
        keys = gram_keys(codes, lang_of, order)
        at = np.flatnonzero(depth > 0)
        longest = np.stack(keys)[np.minimum(depth[at] + 1, order) - 1, at]
        self._learn(longest, at, keys, lang_of, depth)
        place, starts, out = np.searchsorted(self.grams, longest), np.cumsum(sizes) - sizes, []
        for logs in self.logs:
            added = np.zeros(len(codes))
            added[at] = logs[place]
            out.append(np.add.reduceat(added, starts) if len(codes) else np.zeros(0))
        return out, sizes - 1

    def _learn(self, longest, at, keys, lang_of, depth) -> None:
        if len(self.grams) > self.held:
            self.forget()
        place = np.minimum(np.searchsorted(self.grams, longest), max(len(self.grams) - 1, 0))
        unknown = self.grams[place] != longest if len(self.grams) else np.ones(len(longest), bool)
        if not unknown.any():
            return
        fresh_grams, first = np.unique(longest[unknown], return_index=True)
        where = at[unknown][first]
        grams = np.concatenate([self.grams, fresh_grams])
        sorted_ = np.argsort(grams)
        self.grams = grams[sorted_]
        self.logs = [np.concatenate([logs, _log_p(m, keys, lang_of, depth, where)])[sorted_]
                     for logs, m in zip(self.logs, self.models)]


def word_scores(words: list[bytes], langs: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Natural-log probability and number of predicted characters of each word."""
    (logs,), sizes = Scorer([model])(words, langs)
    return logs, sizes


def base_counts(raw: bytes, words: list[bytes], ids: np.ndarray, kinds: int) -> tuple[int, int, int, int]:
    chars = len(raw.decode("utf-8", "replace")) - (len(raw) - len(raw.translate(None, SPACES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if len(ids) > 3:
        key = (ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(key), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        covered = np.zeros(len(ids), bool)
        covered[:-2] |= again
        covered[1:-1] |= again
        covered[2:] |= again
        repeated = int(covered.sum())
    return chars, symbols, len(lines) - len(set(lines)), repeated


def score(docs: DataFrame, model: dict, lang: str = "lang", text: str = "text",
          remembered: int = 100_000, reference: dict | None = None, carried: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``carried``, with those of ``SCORES`` appended; scored words are remembered in a task.

    With a ``reference`` model its log-perplexity is appended too. If tasks
    hold only a part of a model, the rows are stored and the words left open
    are scored by joins.
    """
    models = [model] if reference is None else [model, reference]
    partial = any(k for m in models for k in m["partial"].values())
    added_fields = SCORES.fields + REFERENCE.fields * (len(models) - 1)
    shared = docs.sparkSession.sparkContext.broadcast(
        [{k: v for k, v in m.items() if k != "tables"} for m in models])
    l_col, r_col = fresh(docs, "score_lang", "score_raw")
    rows = docs.withColumns({l_col: F.coalesce(F.col(lang).cast("string"), F.lit("")),
                             r_col: F.encode(F.col(text), "UTF-8")})
    if carried is not None:
        docs, rows = docs.select(*carried), rows.select(*carried, l_col, r_col)
    width = len(docs.columns)
    names = [f"c{i}" for i in range(width)]
    schema = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema)] + added_fields)
    if partial:
        schema = StructType(schema.fields + OPEN.fields)

    def scored(batches):
        scorer, number = Scorer(shared.value), {}
        logs, sizes = [np.zeros(0)] * len(scorer.models), np.zeros(0, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                langs = part.column(width).to_pylist()
                raws = [None if not x.is_valid else x.as_buffer().to_pybytes() for x in part.column(width + 1)]
                texts = [[] if x is None else x.split() for x in raws]
                if len(sizes) > remembered:
                    number, logs, sizes = {}, [np.zeros(0)] * len(scorer.models), np.zeros(0, np.int64)
                fresh_words, fresh_langs = [], []
                memory = {}
                ids_of = []
                for code, words in zip(langs, texts):
                    own = number.get(code)
                    if own is None:
                        own = number[code] = {}
                    for w in set(words).difference(own):
                        own[w] = len(sizes) + len(fresh_words)
                        fresh_words.append(w)
                        fresh_langs.append(lang_hash(code) if code not in memory else memory[code])
                        memory[code] = fresh_langs[-1]
                    ids_of.append(np.array([own[w] for w in words], np.int64))
                if fresh_words:
                    hashes = np.array(fresh_langs, np.uint64)
                    found, predicted = scorer(fresh_words, hashes)
                    logs = [np.concatenate([x, a]) for x, a in zip(logs, found)]
                    sizes = np.concatenate([sizes, predicted])
                out = []
                for code, raw, words, ids in zip(langs, raws, texts, ids_of):
                    chars, symbols, lines, repeated = base_counts(raw or b"", words, ids, len(sizes))
                    n = len(words)
                    failed = n < 50 or 100 * repeated > 50 * n
                    row = (n, chars, symbols, lines, repeated, failed)
                    if not partial:
                        out.append((*row, *(float(-x[ids].sum() / sizes[ids].sum()) if n else None for x in logs)))
                        continue
                    predicted = int(sizes[ids].sum())
                    left = np.flatnonzero(np.isnan(sum((x[ids] for x in logs), np.zeros(n))))
                    told = np.delete(ids, left)
                    digest = np.frombuffer(hashlib.blake2b(
                        raw or b"", digest_size=16, key=code.encode()[:64]).digest(), np.int64).tolist()
                    out.append((
                        *row, *(float(-x[told].sum() / predicted) if n else None for x in logs), predicted,
                        *(digest if len(left) else (None, None)), code,
                        list(Counter(_plain(words[i]) for i in left.tolist()).items())))
                added = [pa.array(c, k) for c, k in zip(
                    zip(*out), [pa.int64()] * 5 + [pa.bool_()] + [pa.float64()] * len(logs) + OPEN_TYPES)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(width)] + added, schema.names)
        del scorer, number, logs, sizes
        hand_back()

    out = rows.mapInArrow(scored, schema)
    if partial:
        out = with_open_words(pin(out), models, [f.name for f in added_fields[len(SCORES.fields) - 1:]])
    return out.toDF(*docs.columns, *fresh(docs, *[f.name for f in added_fields]))


def with_open_words(scored: DataFrame, models: list[dict], columns: list[str]) -> DataFrame:
    """Adds to the log-perplexities of a stored table what the words left open add; drops the columns of ``OPEN``."""
    key, word = ["open_a", "open_b"], ["lang", "word"]
    texts = scored.where(F.col("open_a").isNotNull()).groupBy(*key).agg(
        F.first("open_lang").alias("lang"), F.first("open_words").alias("words"), F.first("open_chars").alias("chars"),
        F.count(F.lit(1)).alias("copies"))
    rows = pin(texts.select(*key, "lang", "chars", "copies", F.inline("words")))
    words = pin(rows.groupBy(*word).agg(F.count(F.lit(1)).alias("uses")))
    logs = pin(exact_word_logs(words, models))
    names = [f"x{i}" for i in range(len(models))]
    sums = pin(attach(rows, logs, word, "uses").groupBy(*key).agg(
        F.first("copies").alias("copies"),
        *[(-F.sum(F.col("n") * F.col(x)) / F.first("chars")).alias(x) for x in names]))
    return attach(scored, sums, key, "copies").withColumns({
        c: F.col(c) + F.coalesce(F.col(x), F.lit(0.0)) for c, x in zip(columns, names)}).drop(
        *names, "copies", *OPEN.fieldNames())


def _middles(texts: DataFrame) -> list:
    """``lang, n, m, d`` of ``texts(lang, x)``: median, and median distance from it. Languages are few."""
    middle = quantiles(texts, "x", [0.5], ["lang"], few_groups=True).select("lang", "n", F.col("q")[0].alias("m"))
    away = texts.join(F.broadcast(middle), "lang").withColumn("away", F.abs(F.col("x") - F.col("m")))
    spread = quantiles(away, "away", [0.5], ["lang"], few_groups=True).select("lang", F.col("q")[0].alias("d"))
    return middle.join(spread, "lang").collect()


def bands(scored: DataFrame, below: float = 8.0, above: float = 8.0, least_width: float = 0.4,
          least_texts: int = 10) -> dict:
    """(Median, distance below, distance above) by language.

    ``scored`` has ``lang, digest, base_failed, log_perplexity``. Medians are
    exact and over all distinct texts.
    """
    texts = pin(scored.where(~F.col("base_failed") & F.col("log_perplexity").isNotNull()).groupBy(
        "lang", "digest").agg(F.first("log_perplexity").alias("x")))
    found = [r for r in _middles(texts) if r.n >= least_texts]

    def band(r) -> tuple[float, float, float]:
        scale, error = 1.4826 * r.d, 3 / math.sqrt(r.n)
        # Standard errors in deviations over the root of n: 1.2533 of the median, 1.17 of a robust deviation.
        return (r.m, *(max(k * scale * (1 + 1.17 * error), least_width) + 1.2533 * error * scale
                       for k in (below, above)))

    return {r.lang: band(r) for r in found}


def reference_model(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", lang: str = "lang",
                    text: str = "text", quality: str = "quality", slot_bits: int = 20) -> dict | None:
    """The model of one half of all texts labelled clean, by their digest."""
    rows = docs.select(
        F.col(doc_id).alias("k"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.col(text).alias("text"))
    known = _known(labels, doc_id, quality)
    kind = rows.select("k").union(known.select("k")).schema["k"].dataType
    alone, mixed = with_ids(
        rows.withColumn("k", F.col("k").cast(kind)), known.where("good = 1").select(F.col("k").cast(kind)),
        F.col("text").isNotNull() & _in_fit(text_digest("text")))
    reference = fit(alone.unionByName(mixed), slot_bits=slot_bits)
    return reference if len(reference["grams"][0][0]) else None


def with_ids(rows: DataFrame, ids: DataFrame, wanted, slots: int = 1 << 26) -> tuple[DataFrame, DataFrame]:
    """The ``wanted`` ones of ``rows`` whose ``k`` is among the different ``ids``, in two parts; only the second is shuffled.

    Two bitmaps of hash slots, of ``slots`` bits each, are what is broadcast:
    slots of the ids, and slots of other ids of ``rows``. A row whose slot
    is in the first only needs no join; rows whose slot is in both are joined.
    """
    slot, size = F.pmod(F.xxhash64("k"), F.lit(slots)), 1 << 15  # bits of a bitmap of Spark
    bucket, at = F.floor(slot / size).cast("int"), F.pmod(slot, F.lit(size))

    def bitmaps(keys: DataFrame, name: str) -> DataFrame:
        return keys.select(bucket.alias("bucket"), at.alias("at")).repartition("bucket").groupBy("bucket").agg(
            F.bitmap_construct_agg("at").alias(name))

    def bit(name: str):
        byte = F.conv(F.hex(F.substring(name, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2)) == 1, F.lit(False))

    ids = pin(ids)
    others = rows.select("k").where(F.col("k").isNotNull()).distinct().join(ids, "k", "left_anti")
    maps = pin(bitmaps(ids, "own").join(bitmaps(others, "foreign"), "bucket", "left"))
    near = rows.where(wanted & F.col("k").isNotNull()).withColumn("bucket", bucket).join(
        F.broadcast(maps), "bucket").where(bit("own")).select(*rows.columns, bit("foreign").alias("is_mixed"))
    # Stored, as Spark would move the join with the ids below the one with the bitmaps, and shuffle all rows.
    mixed = pin(near.where("is_mixed").drop("is_mixed"))
    return near.where(~F.col("is_mixed")).drop("is_mixed"), mixed.join(ids, "k", "left_semi")


def _known(labels: DataFrame, doc_id: str, quality: str) -> DataFrame:
    return labels.where(F.col(quality).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("k")).agg(F.min(quality).alias("good"))


def text_digest(text: str):
    return F.xxhash64(F.col(text), F.length(text))


def _in_fit(digest):
    return F.pmod(digest, F.lit(2)) == 0


def calibrate(narrow: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality",
              least_labelled: int = 20, below: float = 8.0, above: float = 8.0) -> dict:
    """(Median, distance below, distance above) by language, from the scores of all labelled texts.

    Shares on both sides of every possible limit come from running counts;
    the driver receives one row per language and side.
    """
    good = F.col("good") == 1
    found = narrow.where(~F.col("base_failed")).join(
        _known(labels, doc_id, quality), narrow["doc_id"] == F.col("k")).withColumn(
        "fitted", good & _in_fit(F.col("digest"))).groupBy("lang", "digest", "fitted").agg(
        F.min("good").alias("good"), F.first("reference_log_perplexity").alias("x"), F.first("n_words").alias("n"))
    found = pin(found)
    middles = {r.lang: (r.m, 1.4826 * r.d) for r in _middles(found.where(good & ~F.col("fitted")))
               if r.n >= least_labelled}
    if not middles:
        return {}
    m = _by_lang({k: v[:1] for k, v in middles.items()}, F.col("lang"))
    away = (F.col("x") - F.get(m, F.lit(0))) / F.sqrt(1 + SHORT_WORDS / F.greatest(F.col("n"), F.lit(1)))
    v = F.col("side") * F.col("away")
    rows = found.where(F.col("lang").isin(list(middles))).withColumn("away", away).withColumn(
        "side", F.explode(F.array(F.lit(-1), F.lit(1)))).where(good | (v > 0)).select(
        "lang", "side", F.greatest(v, F.lit(0.0)).alias("v"), good.cast("long").alias("clean"),
        (good & ~F.col("fitted")).cast("long").alias("held"), (~good).cast("long").alias("junk"))
    kinds = ["clean", "held", "junk"]
    zero = found.sparkSession.createDataFrame(
        [(k, side, 0.0, 0, 0, 0) for k in middles for side in (-1, 1)], rows.schema)
    counts = rows.unionByName(zero).groupBy("lang", "side", "v").agg(*[F.sum(c).alias(c) for c in kinds])
    places = pin(with_running_counts(counts, "v", ["lang", "side"], kinds))
    by = ["lang", "side"]
    cost = ((F.col("total_held") - F.col("before_held") - F.col("held")) / F.greatest(F.col("total_held"), F.lit(1))
            + (F.col("before_junk") + F.col("junk")) / F.greatest(F.col("total_junk"), F.lit(1)))
    rank = F.ceil(0.995 * (F.col("total_clean") - 1))
    seen = F.col("before_clean") + F.col("clean")
    wanted = (F.col("held") > 0) | (F.col("junk") > 0) | (F.col("v") == 0)
    best = places.groupBy(*by).agg(
        F.min(F.when(wanted, F.struct(cost.alias("cost"), F.col("v").alias("v"))))["v"].alias("best"),
        F.max("total_junk").alias("junk_rows"), F.min(F.when((seen > rank) & (F.col("clean") > 0), F.col("v"))).alias("high"))
    # One row per language and side.
    sides = places.where(wanted).select(*by, "v").join(F.broadcast(best), by).groupBy(
        *by, "best", "junk_rows", "high").agg(F.min(F.when(F.col("v") > F.col("best"), F.col("v"))).alias("next")).collect()
    out = {k: [m, None, None] for k, (m, _) in middles.items()}
    for r in sides:
        deviations = (below if r.side < 0 else above) * middles[r.lang][1]
        out[r.lang][1 if r.side < 0 else 2] = (
            max(deviations, r.high or 0.0) if not r.junk_rows else r.best if r.next is None else (r.best + r.next) / 2)
    return {k: tuple(v) for k, v in out.items()}


def _inside(x: str, n_words: str, limit, short_words: float):
    away = (F.col(x) - F.get(limit, F.lit(0))) / F.sqrt(1 + short_words / F.greatest(F.col(n_words), F.lit(1)))
    return (-away <= F.get(limit, F.lit(1))) & (away <= F.get(limit, F.lit(2)))


def _by_lang(own: dict, code):
    return F.try_element_at(F.create_map(*[c for k, v in sorted(own.items()) for c in (
        F.lit(k), F.array(*[F.lit(x) for x in v]))]), code)


def verdict(scored: DataFrame, limits: dict, lang: str, n_words: str = "n_words",
            base_failed: str = "base_failed", log_perplexity: str = "log_perplexity",
            short_words: float = SHORT_WORDS, calibrated: dict | None = None,
            reference: str = "reference_log_perplexity"):
    """Column: whether the base rules and the bands of the row's language keep it."""
    code = F.coalesce(F.col(lang).cast("string"), F.lit(""))
    kept = ~F.col(base_failed)
    for table, x in ((limits, log_perplexity), (calibrated, reference)):
        if table:  # a language without a band is not judged by it
            kept = kept & F.coalesce(_inside(x, n_words, _by_lang(table, code), short_words), F.lit(True))
    return kept


def narrow_scores(docs: DataFrame, model: dict, doc_id: str, lang: str, text: str,
                  reference: dict | None = None) -> DataFrame:
    """Scores of all documents without their texts, stored."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                       text_digest(text).alias("digest"), F.col(text).alias("text"))
    return pin(score(rows, model, reference=reference, carried=["doc_id", "lang", "digest"]))


def judge(docs: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text",
          labels: DataFrame | None = None, slot_bits: int = 20, **limits) -> DataFrame:
    """One row per document: base counts, log-perplexity and verdict ``kept``."""
    reference = None if labels is None else reference_model(docs, labels, doc_id, lang, text, slot_bits=slot_bits)
    narrow = narrow_scores(docs, fit(docs, lang, text, slot_bits=slot_bits), doc_id, lang, text, reference)
    calibrated = calibrate(narrow, labels, doc_id) if reference else {}
    return narrow.withColumn("kept", verdict(narrow, bands(narrow, **limits), "lang", calibrated=calibrated))


def keep(docs: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text",
         labels: DataFrame | None = None, slot_bits: int = 20, **limits) -> DataFrame:
    """The rows of ``docs`` that are kept. The scored rows are stored with their texts, so each is scored once."""
    reference = None if labels is None else reference_model(docs, labels, doc_id, lang, text, slot_bits=slot_bits)
    scored = pin(score(docs, fit(docs, lang, text, slot_bits=slot_bits), lang, text, reference=reference))
    added = scored.columns[len(docs.columns):]
    names = [f.name for f in SCORES.fields + (REFERENCE.fields if reference else [])]
    narrow = pin(scored.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        text_digest(text).alias("digest"), *[F.col(a).alias(n) for a, n in zip(added, names)]))
    calibrated = calibrate(narrow, labels, doc_id) if reference else {}
    return scored.where(verdict(
        scored, bands(narrow, **limits), lang, added[0], added[5], added[6], calibrated=calibrated, reference=added[-1],
    )).select(*docs.columns)
