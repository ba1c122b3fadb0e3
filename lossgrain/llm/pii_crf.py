"""Personal data by a semi-Markov conditional random field.

Rules find the plain forms (the base spans). The field finds what rules
miss: addresses with written-out marks, numbers with other separators. It
scores whole candidate segments of a stretch of text (digit count, check
sum, octets, separators, shape, neighbours), adds weights for neighbouring
types, and chooses boundaries and types together by dynamic programming over
segments of at most ``LONGEST`` tokens and, without an address mark,
``MOST_DIGITS`` digits. Base spans always stay; a segment of the field is
added where it overlaps none of them. The part before the mark of an address
has at most 64 characters, the limit of mail addresses; the base has no such
bound. Segments are made end by end and dropped once scored, so a long
stretch takes a few bytes a token.

The weights are fitted by conditional likelihood on at most ``stretches``
stretches of a hash sample of the documents, labelled by the rules, on
variants of these with replaced marks, and on stretches written by rule.

Defined results: null and empty texts have no spans; a very long text is
read whole, in linear time; of segmentations that score alike the one found
first (shorter last segment, then label in the order of ``LABELS``) is taken;
repeated rows give repeated results; an empty table gives no rows and is
fitted on the written stretches; further columns are kept by :func:`redact`
and ignored otherwise.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lossgrain.llm.common import disjoint, fresh, hand_back

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
LONGEST = 24  # tokens in a segment
MOST_DIGITS = 24  # in a segment without an address mark; no kind has more than 20

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_STRETCH = re.compile(
    r"[\w.%+-]{1,64}(?: ?[\[({] ?(?:at|AT) ?[\])}] ?|@)\w[\w-]*(?:(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?)[\w-]+)*"
    r"|[+(]?[0-9](?:[ ().\[\]_/:-]{0,4}[0-9])+")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end(), "email"
            last = domain.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the rules, leftmost and without overlap per kind, by start and kind."""
    found = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = _digits(m.group()) if m.end() - m.start() <= 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def stretches(text: str):
    """(start, end) of parts that may hold an entity: marked addresses, runs with seven digits or four groups."""
    for m in _STRETCH.finditer(text):
        part = m.group()
        if part[0].isalpha() or "@" in part or "at" in part.lower():
            yield m.start(), m.end()
        elif len(_digits(part)) >= 7 or len(re.findall("[0-9]+", part)) >= 4:
            yield m.start(), m.end()


_AT = re.compile(r"[\[({] ?at ?[\])}]", re.I)
_ENDING = re.compile(r"(?:[.]|dot ?[])}]) ?[a-z]{2,12}$")


def token_places(text: str, start: int, end: int) -> np.ndarray:
    """Start and end of each token of a stretch."""
    flat = (x for m in _TOKEN.finditer(text, start, end) for x in m.span())
    return np.fromiter(flat, np.int64).reshape(-1, 2)


def segments(text: str, start: int, end: int, places: np.ndarray) -> Iterator[tuple[int, int, tuple]]:
    """Candidates (first token, last token + 1, features without type) by end; only the last tokens are held."""
    left = re.findall(r"[^\W\d_]+", text[max(0, start - 24):start])
    left = left[-1].lower() if left else ""
    before, after = text[start - 1:start], text[end:end + 1]
    marks = [m.start() for m in _AT.finditer(text, start, end)]
    n = len(places)
    held: list[tuple] = []  # (index, start, text, kind) of up to LONGEST tokens, and the two before them
    addressed = bool(marks) or text.find("@", start, end) >= 0
    for j in range(1, n + 1):
        a, b = int(places[j - 1, 0]), int(places[j - 1, 1])
        word = text[a:b]
        kind = "d" if "0" <= word[0] <= "9" else "a" if word.isalpha() else word
        held.append((j - 1, a, word, kind))
        if len(held) > LONGEST + 2:
            del held[0]
        if not word[-1].isalnum():
            continue
        ending = _ENDING.search(text, max(start, b - 24), b) if kind == "a" else None
        ends_at = ending.start() if ending else -1
        next_ = text[b:b + 1] if b < end else after
        follows = "w" if next_.isalnum() else next_
        number_after = j + 1 < n and "0" <= text[int(places[j + 1, 0])] <= "9"
        digits, groups, shape, marked = 0, 0, "", False
        for back in range(1, min(j, LONGEST) + 1):
            i, a, word, kind = held[-back]
            if kind == "d":
                digits += len(word)
                groups += 1
            elif "@" in word:
                marked = True
            shape = kind + shape
            at = bisect_left(marks, a)
            written = at < len(marks) and marks[at] < b
            if digits > MOST_DIGITS and not addressed:
                break
            head = word[0]
            if not (head.isalnum() or head in "+(") or not (4 <= digits <= MOST_DIGITS or marked or written):
                continue
            octets = luhned = False
            if groups == 4 and not marked and not written:
                octets = all(len(w) <= 3 and int(w) <= 255 for _, _, w, k in held[-back:] if k == "d")
            if 14 <= digits <= 19:
                luhned = luhn("".join(w for _, _, w, k in held[-back:] if k == "d"))
            prev = text[a - 1:a] if a > start else before
            number_before = back + 1 < len(held) and held[-back - 2][3] == "d"
            yield i, j, (
                "bias", f"digits={min(digits, 20)}", f"groups={min(groups, 8)}", f"shape={shape[:40]}",
                f"whole={i == 0 and j == n}", f"plus={head == '+'}", f"luhn={luhned}", f"octets={octets}",
                f"mark={'@' if marked else 'at' if written else '-'}", f"domain={ends_at >= a}",
                f"prev={'w' if prev.isalnum() else prev}", f"next={follows}", f"word={left}",
                f"numbers={number_before}{number_after}")


def lattice(text: str, start: int, end: int):
    """Tokens of a stretch and all its candidates."""
    places = token_places(text, start, end)
    return [tuple(p) for p in places.tolist()], list(segments(text, start, end, places))


class Field:
    """Weights of the semi-Markov field; label 0 is outside and spans one token."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weights = np.zeros(0)

    def compile(self, tokens, edges, grow: bool):
        """Rows (from, to, label, feature numbers) sorted by end."""
        n = len(tokens)
        rows = [(t, t + 1, 0, ["out"]) for t in range(n)]
        rows += [(i, j, y, f) for i, j, f in edges for y in range(1, len(LABELS))]
        out = []
        for i, j, y, features in sorted(rows, key=lambda r: (r[1], r[0], r[2])):
            numbers = []
            for f in features:
                name = f"{LABELS[y]}|{f}"
                if grow:
                    numbers.append(self.index.setdefault(name, len(self.index)))
                elif name in self.index:
                    numbers.append(self.index[name])
            out.append((i, j, y, numbers))
        return n, out

    def grow_weights(self):
        pairs = len(LABELS) ** 2
        wanted = len(self.index) + pairs
        grown = np.zeros(wanted)
        self.weights = grown

    def transition(self, a: int, b: int) -> int:
        return len(self.index) + a * len(LABELS) + b

    def decode(self, n, rows):
        """Best segmentation: list of (first token, last token + 1, label > 0)."""
        w = self.weights
        return self._best(n, ((i, j, ((y, sum(w[x] for x in numbers)),)) for i, j, y, numbers in rows))

    def decode_segments(self, n: int, found: Iterable[tuple[int, int, tuple]]):
        """:meth:`decode` of candidates that come by end, none of them held."""
        w, index = self.weights, self.index

        @lru_cache(maxsize=50_000)
        def scores(features: tuple) -> tuple:
            return tuple((y, sum(w[index[name]] for name in (f"{LABELS[y]}|{f}" for f in features) if name in index))
                         for y in range(1, len(LABELS)))

        outside = ((0, float(w[index["O|out"]]) if "O|out" in index else 0.0),)

        def steps():
            done = 0
            for i, j, features in found:
                while done < j:  # the outside step to every end comes first
                    yield done, done + 1, outside
                    done += 1
                yield i, j, scores(features)
            for t in range(done, n):
                yield t, t + 1, outside

        return self._best(n, steps())

    def _best(self, n: int, steps) -> list[tuple[int, int, int]]:
        """Best path through steps (from, to, (label, score) pairs) that come by end.

        Held are the scores at the last ``LONGEST`` ends, and one pointer (tokens
        back, label before) per end and label.
        """
        k = len(LABELS)
        pairs = self.weights[len(self.index):].reshape(k, k).T.tolist()
        lost = -math.inf
        ring = LONGEST + 1
        best = [[lost] * k for _ in range(ring)]
        best[0][0] = 0.0
        # For each of the last ends and next label: the best score so far with the pair's weight, and its label.
        leave: list[list] = [[]] * ring
        size, before = np.zeros((n + 1) * k, np.int8), np.zeros((n + 1) * k, np.int8)
        at = 0
        for i, j, labels in steps:
            while at < j:  # all steps to `at` have come
                row = best[at % ring]
                leave[at % ring] = [max((row[a] + pairs[y][a], -a) for a in range(k)) for y in range(k)]
                at += 1
                best[at % ring] = [lost] * k
            row, into = leave[i % ring], best[j % ring]
            for y, score in labels:
                total = row[y][0] + score
                if total > into[y]:
                    into[y] = total
                    size[j * k + y], before[j * k + y] = j - i, -row[y][1]
        if not n:
            return []
        last = best[n % ring]
        at, y, out = n, last.index(max(last)), []
        while at > 0:
            i = at - int(size[at * k + y])
            if y:
                out.append((i, at, y))
            at, y = i, int(before[at * k + y])
        return out[::-1]

    def gradient(self, n, rows, gold: set, into: np.ndarray) -> float:
        """Adds gold minus expected counts; returns the log-likelihood."""
        w, k = self.weights, len(LABELS)
        pairs = w[len(self.index):].reshape(k, k)
        scores = [sum(w[x] for x in r[3]) for r in rows]
        forward = np.full((n + 1, k), -np.inf)
        forward[0, 0] = 0.0
        for (i, j, y, _), s in zip(rows, scores):
            forward[j, y] = np.logaddexp(forward[j, y], np.logaddexp.reduce(forward[i] + pairs[:, y]) + s)
        total = np.logaddexp.reduce(forward[n])
        backward = np.full((n + 1, k), -np.inf)
        backward[n] = 0.0
        likelihood, last = -total, 0
        for (i, j, y, numbers), s in sorted(zip(rows, scores), key=lambda r: -r[0][0]):
            through = pairs[:, y] + s + backward[j, y]
            backward[i] = np.logaddexp(backward[i], through)
        for (i, j, y, numbers), s in zip(rows, scores):
            each = np.exp(forward[i] + pairs[:, y] + s + backward[j, y] - total)
            expected = each.sum()
            for x in numbers:
                into[x] -= expected
            for a in range(k):
                into[self.transition(a, y)] -= each[a]
            if (i, j, y) in gold:
                for x in numbers:
                    into[x] += 1
                into[self.transition(last, y)] += 1
                likelihood += s + pairs[last, y]
                last = y
        return likelihood


def gold_path(tokens, spans) -> set | None:
    """Rows of the labelled segmentation, or None where a span cuts a token."""
    starts = {a: t for t, (a, _) in enumerate(tokens)}
    ends = {b: t + 1 for t, (_, b) in enumerate(tokens)}
    path, covered = set(), set()
    for a, b, kind in spans:
        if a not in starts or b not in ends or ends[b] - starts[a] > LONGEST or covered & set(range(starts[a], ends[b])):
            return None
        path.add((starts[a], ends[b], LABELS.index(kind)))
        covered |= set(range(starts[a], ends[b]))
    return path | {(t, t + 1, 0) for t in range(len(tokens)) if t not in covered}


def written_stretches(count: int, seed: int = 7) -> list[tuple[str, list]]:
    """Texts written by rule, with their spans: plain forms, other marks, and numbers that are none."""
    r, out = random.Random(seed), []

    def word():
        return "".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(3, 9)))

    def card(good):
        digits = [r.randint(0, 9) for _ in range(15)]
        last = next(d for d in range(10) if luhn("".join(map(str, digits)) + str(d)) == good)
        return "".join(map(str, digits)) + str(last)

    for i in range(count):
        kind = ("email", "ip", "card", "phone", None)[i % 5]
        if i % 10 == 9:  # a table of numbers
            digits, sep = r.randint(2, 5), r.choice([" ", "  ", ".", "-", "/"])
            part = sep.join(str(r.randint(10 ** (digits - 1), 10 ** digits - 1)) for _ in range(r.randint(8, 20)))
            out.append((f"{word()} {part} {word()}", []))
            continue
        if kind == "email":
            at = r.choice(["@", " [at] ", "(at)", " (at) ", "[at]", "{at}"])
            dot = "." if at == "@" else r.choice([".", " [dot] ", "(dot)", " (dot) "])
            part = f"{word()}{r.choice(['', '.' + word(), str(r.randint(1, 99))])}{at}{word()}{dot}{r.choice(['com', 'org', 'net'])}"
        elif kind == "ip":
            part = r.choice([".", "[.]", "(.)", "[.]"]).join(str(r.randint(0, 255)) for _ in range(4))
        elif kind == "card":
            c, sep = card(True), r.choice(["", " ", "-", ".", "_", "/"])
            part = sep.join(c[x:x + 4] for x in range(0, 16, 4))
        elif kind == "phone":
            a, b, c = r.randint(200, 999), r.randint(200, 999), r.randint(1000, 9999)
            part = r.choice([f"+{r.randint(1, 99)} ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"({a}) {b}-{c}",
                             f"+1.{a}.{b}.{c}", f"1 ({a}) {b}-{c}", f"+1/{a}/{b}/{c}"])
        else:
            part = r.choice([card(False), card(False), str(r.randint(10**6, 10**12)), f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
                             f"{r.randint(256, 999)}.{r.randint(256, 999)}.{r.randint(0, 99)}.{r.randint(0, 9)}",
                             f"{r.randint(1000, 9999)} {r.randint(1000, 9999)}", f"{r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 9)}-{r.randint(1000, 9999)}",
                             f"{r.randint(10, 99)}:{r.randint(10, 59)}:{r.randint(10, 59)}"])
        head = f"{word()} {word()} "
        out.append((f"{head}{part} {word()}", [(len(head), len(head) + len(part), kind)] if kind else []))
    return out


def fit_field(samples: list[tuple[str, list]], rounds: int = 12, rate: float = 0.5) -> Field:
    """Conditional likelihood by adaptive gradient steps, a weak pull towards zero."""
    field, cases = Field(), []
    for text, spans in samples:
        for start, end in stretches(text):
            inside = [s for s in spans if start <= s[0] and s[1] <= end]
            tokens, edges = lattice(text, start, end)
            gold = gold_path(tokens, inside)
            if gold is not None and len(tokens) <= 200:
                n, rows = field.compile(tokens, edges, True)
                if gold <= {r[:3] for r in rows}:
                    cases.append((n, rows, gold))
    field.grow_weights()
    squares = np.full(len(field.weights), 1e-6)
    order = random.Random(1)
    for _ in range(rounds):
        order.shuffle(cases)
        for first in range(0, len(cases), 16):
            g = -1e-3 * field.weights
            for n, rows, gold in cases[first:first + 16]:
                field.gradient(n, rows, gold, g)
            squares += g * g
            field.weights += rate * g / np.sqrt(squares)
    return field


def find(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and all spans: (start, end, kind) by start and kind."""
    base, added = base_spans(text), []
    starts, ends = disjoint(base)
    for start, end in stretches(text):
        places = token_places(text, start, end)
        for i, j, y in field.decode_segments(len(places), segments(text, start, end, places)):
            a, b = int(places[i, 0]), int(places[j - 1, 1])
            after = bisect_left(starts, b)  # the first base span from b on
            if not (after and ends[after - 1] > a):
                added.append((a, b, LABELS[y]))
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def has_trigger(text: str) -> bool:
    return re.search(r"[0-9@]|[\[({] ?(?:at|AT) ?[\])}]", text) is not None


def sample_stretches(docs: DataFrame, doc_id: str, text: str, bound: int) -> list[tuple[str, list]]:
    """At most ``bound`` parts with stretches from about 20 x ``bound`` documents chosen by hash."""
    total = docs.count()
    share = min(1.0, 20.0 * bound / max(total, 1))
    key = F.xxhash64(doc_id)
    chosen = docs.where(F.pmod(key, F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).select(
        F.col(text).cast("string").alias("text"))

    def parts(batches):
        for batch in batches:
            out = []
            for one in batch.column(0).to_pylist():
                last = 0
                for start, end in stretches(one or ""):
                    if start >= last and end - start <= 200:
                        out.append(one[max(0, start - 40):end + 40])
                        last = end + 40
            if out:
                yield pa.record_batch([pa.array(out, pa.string())], ["part"])

    found = chosen.mapInArrow(parts, "part string").distinct().orderBy(F.xxhash64("part"), "part").limit(bound)
    return [(r.part, base_spans(r.part)) for r in found.collect()]


def varied(samples: list[tuple[str, list]], seed: int = 3) -> list[tuple[str, list]]:
    """Copies of labelled parts with one span whose marks are replaced."""
    r, out = random.Random(seed), []
    for text, spans in samples:
        if len(spans) != 1:
            continue
        (a, b, kind), = spans
        part = text[a:b]
        if kind == "email":
            local, _, domain = part.partition("@")
            changed = f"{local}{r.choice([' [at] ', '(at)', ' (at) '])}{domain.replace('.', r.choice(['.', ' [dot] ', '(dot)']))}"
        elif kind == "ip":
            changed = part.replace(".", r.choice(["[.]", "(.)"]))
        elif kind == "card":
            d = _digits(part)
            changed = r.choice(".-_ ").join(d[i:i + 4] for i in range(0, len(d), 4))
        else:
            changed = part.replace(" ", r.choice([".", " ", "/"]))
        out.append((text[:a] + changed + text[b:], [(a, a + len(changed), kind)]))
    return out


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bound: int = 400) -> Field:
    sample = sample_stretches(docs, doc_id, text, bound)
    return fit_field(sample + varied(sample) + written_stretches(300))


def joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


FOUND = StructType([StructField("base", StringType()), StructField("spans", StringType())])


def detect(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, spans``: both as kind:start:end, comma-joined, in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def searched(batches):
        model = shared.value
        for batch in batches:
            base, spans = [], []
            for value in batch.column(1):
                one = value.as_py() or ""
                pair = find(one, model) if has_trigger(one) else ([], [])
                base.append(joined(pair[0]))
                spans.append(joined(pair[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "base", "spans"])

    schema = StructType([StructField("doc_id", docs.schema[doc_id].dataType), *FOUND.fields])
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(searched, schema)


def redact(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    place = docs.columns.index(text)
    names = [f"c{i}" for i in range(len(docs.columns))]
    schema = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema)])

    def cleaned(one: str, model: Field) -> str:
        out, at = [], 0
        for a, b, kind in find(one, model)[1]:
            if a >= at:
                out += [one[at:a], f"<{kind.upper()}>"]
            at = max(at, b)
        return "".join(out) + one[at:] if out else one

    def replaced(batches):
        model = shared.value
        for batch in batches:
            values = [v if v is None or not has_trigger(v) else cleaned(v, model)
                      for v in (x.as_py() for x in batch.column(place))]
            columns = [batch.column(i) for i in range(batch.num_columns)]
            columns[place] = pa.array(values, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names)
        hand_back()

    return docs.mapInArrow(replaced, schema).toDF(*docs.columns)


def digest_of(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
