"""Secrets by a linear-chain conditional random field.

Rules find the plain forms (the base spans). The field tags all tokens of a
text as begin, inside or outside of a secret by their shape, the words around
them and features of the whole text, and Viterbi decoding picks the best
tags. Base spans always stay; a tagged span is added where it overlaps none
of them, as ``access`` or ``hex`` if it looks like one, else as ``assign``.

The weights are fitted by conditional likelihood on stretches of a hash
sample of the documents, labelled by the rules (at most ``bound`` around
suspicious places, and as many from any place), and on stretches written by
rule (other key words, other forms, and long tokens that are no secrets).

Every token of the text is scored, in blocks that end on token borders. Most
are outside on any best path: changing their tag to outside (and an inside
behind it to begin) gains whatever the tags around them are. Those cut the
text into runs, and only the runs are decoded, which gives the tags of the
best path through the whole text.

Defined results: null and empty texts have no spans; a very long text is
read whole, in linear time; of tag paths that score alike the one with the
first tag in the order of ``TAGS`` is taken; repeated rows give repeated
results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from functools import lru_cache
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lossgrain.llm.common import disjoint

KINDS = ("assign", "access", "hex")
TAGS = ("O", "B", "I")
OUT, BEGIN, INSIDE = range(3)
AROUND = 80  # characters of context on either side of a suspicious token
BLOCK = 16_384  # characters whose tokens are scored at once

# The base patterns.
_ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+|[^\sA-Za-z0-9]")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]")
_RUN_END = re.compile(r"[A-Za-z0-9+/_.=-]*+")
_DIGIT, _NUMBER = re.compile("[0-9]"), re.compile(r"[0-9.,-]+")
_HEX_ONLY, _NO_LETTERS = re.compile(r"[0-9a-f]+"), re.compile(r"[^a-z]+")
#: A long unbroken token with a digit, or a word that names a secret before a sign and a value.
_SUSPICIOUS = re.compile(
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}"
    r"|(?ai:pass(?:word|wd|phrase)?|secret|token|key|credential|bearer|auth)[\w\"' ]{0,12}[:=]")


#: What every match of ``_ASSIGN`` contains, in lower case.
_KEYS = ("pass", "secret", "token", "key")


def has_trigger(text: str) -> bool:
    """False only if no base pattern can match."""
    low = text.lower()
    return any(k in low for k in _KEYS) or any(len(w) >= 32 for w in low.split()) or "akia" in low


def base_spans(text: str) -> list[tuple[int, int, str]]:
    if not has_trigger(text):
        return []
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def stretches(text: str) -> list[tuple[int, int]]:
    """Merged surroundings of the suspicious places, ending on token borders."""
    near: list[list[int]] = []
    for m in _SUSPICIOUS.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if near and a <= near[-1][1]:
            near[-1][1] = max(near[-1][1], b)
        else:
            near.append([a, b])
    out: list[tuple[int, int]] = []
    for a, b in near:
        low = out[-1][1] if out else 0
        if b <= low:
            continue
        if _RUN.match(text, a):
            while a > low and _RUN.match(text, a - 1):  # the token begins further left
                a -= 1
        if _RUN.match(text, b - 1):
            b = _RUN_END.match(text, b).end()
        if out and a <= low:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


@lru_cache(maxsize=4096)
def _bits(counts: tuple[int, ...]) -> float:
    n = sum(counts)
    return -sum(c / n * math.log2(c / n) for c in counts)


def file_features(text: str) -> list[str]:
    """Features of the whole text, shared by its tokens."""
    n = max(len(text), 1)
    signs = sum(map(text.count, "{};=()<>")) / n
    digits = sum(map(text.count, "0123456789")) / n
    return [f"file-signs={min(int(signs * 100), 5)}", f"file-digits={min(int(digits * 50), 5)}"]


@lru_cache(maxsize=4096)
def _shape(part: str) -> list[str]:
    n = len(part)
    lower, upper = part.lower() != part, part.upper() != part
    digit = _DIGIT.search(part) is not None
    changes = sum((a.isdigit() != b.isdigit()) for a, b in zip(part, part[1:])) if digit else 0
    kind = ("hex" if n >= 8 and digit and _HEX_ONLY.fullmatch(part) else
            "akia" if part.startswith("AKIA") else "number" if _NUMBER.fullmatch(part) else
            "sign" if n == 1 and not part.isalnum() else "other")
    return [f"length={min(n, 40) // 4}", f"kind={kind}", f"case={lower}{upper}{digit}",
            f"bits={int(_bits(tuple(sorted(map(part.count, set(part))))) * 2)}", f"changes={min(changes, 10)}",
            f"path={part.count('/') + part.count('.') > 1}", f"head={part[:4].lower() if n >= 16 else ''}"]


@lru_cache(maxsize=4096)
def _low(word: str) -> str:
    return "#" if _DIGIT.search(word) else _NO_LETTERS.sub("", word.lower())[:12]


def token_rows(words: list[str], first: int, last: int, whole: list[str]) -> list[list[str]]:
    """Feature names of the tokens ``first`` to ``last`` of a stretch."""
    rows = []
    for t in range(first, last):
        w = words[t]
        shape = _shape(w)
        near = [f"{d:+d}={(_low(words[t + d]) or words[t + d][:2]) if 0 <= t + d < len(words) else '|'}"
                for d in (-3, -2, -1, 1)]
        rows.append(["bias", *shape, *near, f"{shape[1]},{shape[0]}", f"key={_low(w)}", *whole,
                     f"{shape[0]},{shape[3]},{near[2]}"])
    return rows


def features(text: str, start: int, end: int, whole: list[str]):
    """Tokens of a stretch and the feature names of each."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
    return tokens, token_rows([text[a:b] for a, b in tokens], 0, len(tokens), whole)


class Chain:
    """Weights of the chain: features by tag, and tag pairs."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.emit = np.zeros((0, 3))
        self.pairs = np.zeros((3, 3))
        self.pairs[OUT, INSIDE] = -1e9  # inside follows begin or inside only

    def numbers(self, rows, grow: bool):
        if grow:
            return [[self.index.setdefault(f, len(self.index)) for f in r] for r in rows]
        return [[self.index[f] for f in r if f in self.index] for r in rows]

    def scores(self, numbers) -> np.ndarray:
        return np.array([self.emit[r].sum(axis=0) for r in numbers]).reshape(-1, 3)

    def viterbi(self, numbers) -> list[int]:
        return self.best_tags([self.scores(numbers)])

    def best_tags(self, blocks) -> list[int]:
        """Tags of the best path through the scores of all tokens, which come in blocks."""
        pairs = self.pairs.tolist()
        through = [[(a, pairs[a][y]) for a in range(3)] for y in range(3)]
        best, back = None, bytearray()  # one pointer per token and tag
        for block in blocks:
            for emit in block.tolist():
                if best is None:
                    best = [emit[0], emit[1], emit[2] - 1e9]
                    back += b"\0\0\0"
                    continue
                now = []
                for y in range(3):
                    top, source = -math.inf, 0
                    for a, weight in through[y]:
                        if best[a] + weight > top:
                            top, source = best[a] + weight, a
                    now.append(top + emit[y])
                    back.append(source)
                best = now
        if best is None:
            return []
        tags = bytearray([best.index(max(best))])
        for t in range(len(back) // 3 - 1, 0, -1):
            tags.append(back[3 * t + tags[-1]])
        return list(reversed(tags))

    def gradient(self, numbers, gold, into_emit, into_pairs) -> None:
        emit = self.scores(numbers)
        n = len(emit)
        forward, backward = np.zeros((n, 3)), np.zeros((n, 3))
        forward[0] = emit[0] + np.array([0.0, 0.0, -1e9])
        for t in range(1, n):
            forward[t] = np.logaddexp.reduce(forward[t - 1][:, None] + self.pairs, axis=0) + emit[t]
        for t in range(n - 2, -1, -1):
            backward[t] = np.logaddexp.reduce(self.pairs + (emit[t + 1] + backward[t + 1])[None, :], axis=1)
        total = np.logaddexp.reduce(forward[-1])
        each = np.exp(forward + backward - total)
        for t in range(n):
            change = -each[t]
            change[gold[t]] += 1
            into_emit[numbers[t]] += change
            if t:
                both = forward[t - 1][:, None] + self.pairs + (emit[t] + backward[t])[None, :] - total
                into_pairs -= np.exp(both)
                into_pairs[gold[t - 1], gold[t]] += 1


def tags_of(tokens, spans) -> list[int]:
    """Tags of the tokens under value spans."""
    out = []
    for a, b in tokens:
        hit = next((s for s in spans if s[0] < b and a < s[1]), None)
        out.append(OUT if hit is None else BEGIN if a <= hit[0] else INSIDE)
    return out


def value_spans(text: str) -> list[tuple[int, int]]:
    """What the rules call secret, without the key word before it."""
    spans = [(m.start(1), m.end(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    spans += [(a, b) for a, b, k in base_spans(text) if k != "assign"]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def written_stretches(count: int, seed: int = 5) -> list[tuple[str, list]]:
    """Texts written by rule: secrets in forms the rules miss and in plain ones, and long tokens that are none."""
    r, out = random.Random(seed), []
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def word(low=2, high=9):
        return "".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(low, high)))

    for i in range(count):
        lead, tail = " ".join(word() for _ in range(r.randint(0, 4))), " ".join(word() for _ in range(r.randint(0, 4)))
        secret = "".join(r.choice(mixed) for _ in range(r.randint(20, 44)))
        if i % 3 == 0:
            key = r.choice(["client_secret", "auth", "credential", "private_key", "passphrase", "access_key", "bearer", "signing_key"])
            part, at = f"{key}{r.choice([' = ', ': ', '=', ' := ', ' is '])}{r.choice(['', chr(34)])}", None
            at = len(part)
            part += secret
            span = [(at, at + len(secret))]
        elif i % 3 == 1:
            head = r.choice(["token = \"", "AKIA", "Authorization: Bearer ", "ghp_", "sk-", "xoxb-"])
            if head == "AKIA":
                part = head + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))
                span = [(0, len(part))]
            elif head in ("ghp_", "sk-", "xoxb-"):
                part = head + secret
                span = [(0, len(part))]
            else:
                value = r.choice([secret, "".join(r.choice("0123456789abcdef") for _ in range(40))])
                part, span = head + value, [(len(head), len(head) + len(value))]
        else:
            part = r.choice([
                word(16, 34), f"https://{word()}.example.org/{word()}/{r.randint(100, 99999)}",
                "".join(str(r.randint(0, 9)) for _ in range(r.randint(16, 20))), f"{word()}-{word()}-{r.randint(1, 2030)}-{word()}",
                f"/{word()}/{word()}/{word()}{r.randint(1, 99)}.{word(2, 3)}", f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}T10:{r.randint(10, 59)}:00",
                f"{word()}={r.randint(1, 9999)}", f"key: {word()}", f"token {word()} = {word(3, 7)}", f"{word()}_{word()}_{r.randint(1, 9)}_{word()}",
                f"+1 ({r.randint(100, 999)}) {r.randint(100, 999)}-{r.randint(1000, 9999)}", f"{word(6, 12)}.{r.randint(10, 99)}@{word()}{r.randint(1, 9)}.example.com"])
            span = []
        head = f"{lead} " if lead else ""
        out.append((f"{head}{part} {tail}", [(a + len(head), b + len(head)) for a, b in span]))
    return out


def fit_chain(samples: list[tuple[str, list]], rounds: int = 10, rate: float = 0.3) -> Chain:
    chain, cases = Chain(), []
    for text, spans in samples:
        whole = file_features(text)
        tokens, rows = features(text, 0, len(text), whole)
        if tokens and len(tokens) <= 400:
            cases.append((chain.numbers(rows, True), tags_of(tokens, spans)))
    chain.emit = np.zeros((len(chain.index), 3))
    squares_e, squares_p = np.full(chain.emit.shape, 1e-6), np.full((3, 3), 1e-6)
    order = random.Random(1)
    for _ in range(rounds):
        order.shuffle(cases)
        for first in range(0, len(cases), 16):
            ge, gp = -1e-3 * chain.emit, np.zeros((3, 3))
            for numbers, gold in cases[first:first + 16]:
                chain.gradient(numbers, gold, ge, gp)
            gp[OUT, INSIDE] = 0.0
            squares_e += ge * ge
            squares_p += gp * gp
            chain.emit += rate * ge / np.sqrt(squares_e)
            chain.pairs += rate * gp / np.sqrt(squares_p)
    return chain


class _Words(dict):
    """Word to its row in the arrays of a reader."""

    def __init__(self, add):
        self.add = add

    def __missing__(self, word):
        row = self[word] = len(self)
        self.add(row, word)
        return row


class Reader:
    """Scores all tokens of texts by a chain.

    What a word adds by itself is worked out once and remembered, up to
    ``held`` words or ``20 * held`` characters of them, and those of a block.
    """

    def __init__(self, chain: Chain, held: int = 200_000):
        self.chain, self.held = chain, held
        weights = np.vstack([chain.emit, np.zeros((1, 3))])  # the last row: a feature without a weight
        beside, both = {}, {}
        for name, at in chain.index.items():
            if name[:3] in ("-3=", "-2=", "-1=", "+1="):
                beside[name[:3], name[3:]] = at
            elif m := re.fullmatch(r"(length=\d+,bits=\d+),-1=(.*)", name, re.DOTALL):
                both[m.groups()] = at
        self.sides = {v: i for i, v in enumerate(sorted({v for _, v in [*beside, *both]} | {"|"}))}
        self.forms = {v: i for i, v in enumerate(sorted({f for f, _ in both}))}
        sides, forms, none = len(self.sides) + 1, len(self.forms) + 1, len(weights) - 1  # the last of each: unknown
        self.beside = {d: weights[[beside.get((d, v), none) for v in self.sides] + [none]]
                       for d in ("-3=", "-2=", "-1=", "+1=")}
        self.both = np.full((forms, sides), none)
        for (form, side), at in both.items():
            self.both[self.forms[form], self.sides[side]] = at
        self.weights, room = weights, held + BLOCK
        self.own, self.side, self.form = np.zeros((room, 3)), np.zeros(room, np.int32), np.zeros(room, np.int32)
        self.words, self.chars, self.shapes = _Words(self._add), 0, {}
        pairs = chain.pairs
        self.alone, self.cut = [], []
        for y, before in ((BEGIN, (OUT, BEGIN, INSIDE)), (INSIDE, (BEGIN, INSIDE))):
            left = min([0.0, *(pairs[a, OUT] - pairs[a, y] for a in before)])
            self.alone.append(left + min([0.0, *(pairs[OUT, c] - pairs[y, c] for c in (OUT, BEGIN))]))
            self.cut.append(left + pairs[OUT, BEGIN] - pairs[y, INSIDE] + min(0.0, *(pairs[BEGIN] - pairs[INSIDE])))

    def _weight(self, names: list[str]) -> np.ndarray:
        return self.weights[[self.chain.index.get(f, -1) for f in names]].sum(axis=0)

    def _add(self, row: int, word: str) -> None:
        shape, low = _shape(word), _low(word)
        names = tuple(shape)
        if (known := self.shapes.get(names)) is None:
            known = self._weight(["bias", *shape, f"{shape[1]},{shape[0]}"])
            if len(self.shapes) < self.held:
                self.shapes[names] = known
        self.own[row] = known + self.weights[self.chain.index.get(f"key={low}", -1)]
        self.side[row] = self.sides.get(low or word[:2], len(self.sides))
        self.form[row] = self.forms.get(f"{shape[0]},{shape[3]}", len(self.forms))
        self.chars += len(word)

    def blocks(self, text: str):
        """``start, end, scores`` of blocks that have all tokens of the text."""
        whole, bar = self._weight(file_features(text)), self.sides["|"]
        before, held, at = np.full(3, bar, np.int32), None, 0
        while at < len(text):
            start, at = at, min(at + BLOCK, len(text))
            if _RUN.match(text, at - 1):
                at = _RUN_END.match(text, at).end()
            words = _TOKEN.findall(text, start, at)
            if not words:
                continue
            if len(self.words) > self.held or self.chars > 20 * self.held:
                self.words.clear()
                self.chars = 0
            n = len(words)
            rows = np.fromiter(map(self.words.__getitem__, words), np.int64, n)
            side = np.concatenate([before, self.side[rows]])
            scores = self.own[rows] + whole
            for d, first in (("-3=", 0), ("-2=", 1), ("-1=", 2)):
                scores += self.beside[d].take(side[first:first + n], axis=0)
            scores += self.weights.take(self.both[self.form[rows], side[2:2 + n]], axis=0)
            scores[:-1] += self.beside["+1="].take(side[4:], axis=0)
            if held:
                held[2][-1] += self.beside["+1="][side[3]]
                yield held
            held, before = (start, at, scores), side[-3:]
        if held:
            held[2][-1] += self.beside["+1="][bar]
            yield held

    def outside(self, scores: np.ndarray, after: np.ndarray | None) -> np.ndarray:
        """Which tokens are outside on every best path; ``after`` has the scores of the next token."""
        begin_or_inside = scores[:, BEGIN] - scores[:, INSIDE]
        following = np.append(begin_or_inside[1:], np.inf if after is None else after[BEGIN] - after[INSIDE])
        out = np.ones(len(scores), bool)
        for y, alone, cut in zip((BEGIN, INSIDE), self.alone, self.cut):
            out &= np.minimum(alone, cut + following) - (scores[:, y] - scores[:, OUT]) > 1e-6
        return out

    def runs(self, text: str):
        """Tokens that may not be outside, with the one before and after: lists of ``block, first, last``."""
        blocks, run, previous = self.blocks(text), [], None
        block = next(blocks, None)
        while block:
            following = next(blocks, None)
            out = self.outside(block[2], following[2][0] if following else None)
            n = len(out)
            if run and out[0]:
                yield [*run, (block, 0, 1)]
                run = []
            elif previous and not run and not out[0]:
                run = [(previous, len(previous[2]) - 1, len(previous[2]))]
            borders = np.flatnonzero(np.diff(np.concatenate([[True], out, [True]]))).tolist()
            for first, last in zip(borders[::2], borders[1::2]):
                run.append((block, max(first - 1, 0), min(last + 1, n)))
                if last < n or not following:
                    yield run
                    run = []
            block, previous = following, block


def find(text: str, chain: Chain, reader: Reader | None = None) -> tuple[list, list]:
    """Base spans, and all spans: (start, end, kind) by start and kind."""
    base, added = base_spans(text), []
    starts, ends = disjoint(base)
    at, tokens = None, []
    for run in (reader or Reader(chain)).runs(text):
        tags = chain.best_tags(scores[first:last] for (_, _, scores), first, last in run)
        if BEGIN not in tags:
            continue
        places = []
        for (start, end, _), first, last in run:
            if start != at:
                at, tokens = start, [m.span() for m in _TOKEN.finditer(text, start, end)]
            places += tokens[first:last]
        t = 0
        while t < len(tags):
            if tags[t] != BEGIN:
                t += 1
                continue
            a, b = places[t]
            t += 1
            while t < len(tags) and tags[t] == INSIDE:
                b = places[t][1]
                t += 1
            after = bisect_left(starts, b)  # the first base span from b on
            if b - a >= 8 and not (after and ends[after - 1] > a):
                part = text[a:b]
                kind = ("access" if part.startswith("AKIA") else
                        "hex" if re.fullmatch(r"[0-9a-fA-F]{16,}", part) else "assign")
                added.append((a, b, kind))
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def any_stretch(text: str) -> tuple[int, int]:
    """A stretch of about ``2 * AROUND`` characters, ending on token borders, at a place told by the text's hash."""
    a = crc32(text.encode("utf-8", "replace")) % max(len(text) - 2 * AROUND + 1, 1)
    b = min(a + 2 * AROUND, len(text))
    if a and _RUN.match(text, a - 1):
        a = _RUN_END.match(text, a).end()
    return a, _RUN_END.match(text, max(a, b)).end() if _RUN.match(text, b - 1) else max(a, b)


def sample_stretches(docs: DataFrame, doc_id: str, text: str, bound: int) -> list[tuple[str, list]]:
    """At most ``bound`` suspicious stretches and ``bound`` others, from about 20 x ``bound`` documents chosen by hash."""
    total = docs.count()
    share = min(1.0, 20.0 * bound / max(total, 1))
    chosen = docs.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).select(
        F.col(text).cast("string").alias("text"))

    def parts(batches):
        for batch in batches:
            out = [(near, one[a:b]) for one in batch.column(0).to_pylist() if one
                   for near, places in ((True, stretches(one)), (False, [any_stretch(one)]))
                   for a, b in places if 0 < b - a <= 2000]
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), [pa.bool_(), pa.string()])], ["near", "part"])

    found = chosen.mapInArrow(parts, "near boolean, part string").distinct()
    return [(r.part, value_spans(r.part)) for near in (True, False) for r in found.where(F.col("near") == near).orderBy(
        F.xxhash64("part"), "part").limit(bound).collect()]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bound: int = 400) -> Chain:
    return fit_chain(sample_stretches(docs, doc_id, text, bound) + written_stretches(600))


def joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def detect(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, spans``: both as kind:start:end, comma-joined, in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def searched(batches):
        model = shared.value
        reader = Reader(model)
        for batch in batches:
            base, spans = [], []
            for value in batch.column(1):
                pair = find(value.as_py() or "", model, reader)
                base.append(joined(pair[0]))
                spans.append(joined(pair[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "base", "spans"])

    schema = StructType([StructField("doc_id", docs.schema[doc_id].dataType),
                         StructField("base", StringType()), StructField("spans", StringType())])
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(searched, schema)
