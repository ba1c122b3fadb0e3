import hashlib
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lossgrain.llm import pii_crf, queries, secret_crf

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
                    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def digits(text):
    return "".join(c for c in text if c in "0123456789")


def plain_pii(text):
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        d = digits(m.group())
        odd = sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2]) + sum(int(c) for c in d[::-2])
        if 14 <= len(d) <= 19 and odd % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], pii_crf.KINDS.index(s[2])))


def plain_secrets(text):
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 32]
    return sorted(out, key=lambda s: (s[0], secret_crf.KINDS.index(s[2])))


PIECES = ["@", "a.b", "x@y.z", "@@", "a@b@c.d.", "1.2.3.4", ".5.6", "256.1.1.1", "4111 1111-1111 1111", "4", "+1 (974) 555-3436",
          "+", "12345678901234", " ", "-", "é@é.é", "0000.1.1.1", "  ", "\n", "token", "Secret", "api_key", "APIKEY", "=", ": ", '"',
          "'", "AKIA", "ABCDEFGH1234", "deadbeef", "0123456789abcdef", "passwd=", "ſecret=abcdefgh1", "K", "value_1.2/3", "_"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert pii_crf.base_spans(text) == plain_pii(text)
    assert secret_crf.base_spans(text) == plain_secrets(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1 " * 100_000, "@" * 100_000, "token " * 50_000, "f" * 300_000,
                 "a@" * 50_000, "key" + " " * 200_000 + "=", "1-" * 100_000):
        pii_crf.base_spans(text)
        secret_crf.base_spans(text)


def test_personal_field_on_held_out_stretches():
    field = pii_crf.fit_field(pii_crf.written_stretches(300))
    cases = pii_crf.written_stretches(300, seed=71)
    right = sum(pii_crf.find(text, field)[1] == spans for text, spans in cases)
    assert right >= 0.97 * len(cases)
    base_only = sum(pii_crf.base_spans(text) == spans for text, spans in cases)
    assert right > base_only + 60
    assert pii_crf.find("words only, year 2024 and 3.14", field) == ([], [])


def test_secret_field_on_held_out_stretches():
    chain = secret_crf.fit_chain(secret_crf.written_stretches(600))
    right, cases = 0, secret_crf.written_stretches(300, seed=72)
    for text, spans in cases:
        found = secret_crf.find(text, chain)[1]
        right += bool(spans) == bool(found) and all(any(a <= s and e <= b for a, b, _ in found) for s, e in spans)
    assert right >= 0.95 * len(cases)


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np
    chain = secret_crf.Chain()
    random = np.random.default_rng(4)
    chain.index = {str(i): i for i in range(6)}
    chain.emit, chain.pairs = random.normal(size=(6, 3)), random.normal(size=(3, 3))
    chain.pairs[0, 2] = -1e9
    numbers = [[0, 3], [1], [2, 5], [4], [5, 0]]
    emit = chain.scores(numbers)

    def value(tags):
        return (sum(emit[t, y] for t, y in enumerate(tags)) - 1e9 * (tags[0] == 2)
                + sum(chain.pairs[a, b] for a, b in zip(tags, tags[1:])))

    best = max(itertools.product(range(3), repeat=5), key=value)
    assert tuple(chain.viterbi(numbers)) == best


def test_segment_decoding_is_the_best_segmentation():
    field = pii_crf.fit_field(pii_crf.written_stretches(60))
    text = "call 1 (974) 555-3436 or 12.34.56.78 now"
    for start, end in pii_crf.stretches(text):
        n, rows = field.compile(*pii_crf.lattice(text, start, end), False)
        pairs = field.weights[len(field.index):].reshape(5, 5)

        def best(at, last):
            if at == n:
                return 0.0
            return max(sum(field.weights[x] for x in r[3]) + pairs[last, r[2]] + best(r[1], r[2])
                       for r in rows if r[0] == at)

        found = field.decode(n, rows)
        covered = {t for i, j, _ in found for t in range(i, j)}
        path = sorted([*found, *[(t, t + 1, 0) for t in range(n) if t not in covered]])
        total, last = 0.0, 0
        scores = {r[:3]: sum(field.weights[x] for x in r[3]) for r in rows}
        for step in path:
            total += scores[step] + pairs[last, step[2]]
            last = step[2]
        assert abs(total - best(0, 0)) < 1e-9


def test_tables(spark, odd_docs, no_docs, tmp_path):
    mail = spark.createDataFrame([(50, "é mail a.b@c.de token = \"0123456789abcdef0123456789abcdef\"", "en", "s", 1)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = odd_docs.select(*mail.columns).unionByName(mail)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op4_pii_crf(spark, str(tmp_path)).collect()}
    assert found[50].n_email == 1 and found[50].spans == "email:7:15"
    assert found[50].base_sha256 == hashlib.sha256(b"email:7:15").hexdigest()
    assert found[2].spans == "" and found[1].spans == "" and found[5].spans == ""
    secrets = {r.doc_id: r for r in queries.op5_secret_crf(spark, str(tmp_path)).collect()}
    assert (secrets[50].n_assign, secrets[50].n_access, secrets[50].n_hex) == (1, 0, 1)
    assert secrets[50].spans == "assign:16:57,hex:25:57" and secrets[8].spans == ""
    field = pii_crf.fit(docs)
    clean = pii_crf.redact(docs.withColumn("base", F.lit("b")), field)
    assert {r.doc_id: r.text for r in clean.collect()}[50].startswith("é mail <EMAIL> token")
    assert clean.columns == [*docs.columns, "base"] and clean.count() == docs.count()
    assert pii_crf.detect(no_docs, pii_crf.fit(no_docs)).count() == 0
    assert secret_crf.detect(no_docs, secret_crf.fit(no_docs)).count() == 0


def test_decoding_without_the_lattice_gives_the_same_segments():
    field = pii_crf.fit_field(pii_crf.written_stretches(60))
    texts = [t for t, _ in pii_crf.written_stretches(80, seed=9)] + ["+1 (974) 555-3436 12.34.56.78 4111-1111.1111_1111 " * 5]
    for text in texts:
        for start, end in pii_crf.stretches(text):
            tokens, edges = pii_crf.lattice(text, start, end)
            places = pii_crf.token_places(text, start, end)
            streamed = field.decode_segments(len(places), pii_crf.segments(text, start, end, places))
            assert streamed == field.decode(*field.compile(tokens, edges, False))


def megabytes_and_seconds(call):
    import time
    import tracemalloc
    started = time.time()
    tracemalloc.start()
    out = call()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak / 2**20, time.time() - started


def test_number_tables_are_no_personal_data_and_take_little_memory():
    import random
    r = random.Random(3)
    field = pii_crf.fit_field(pii_crf.written_stretches(300))
    small, large = (" ".join(str(r.randint(100, 999)) for _ in range(n)) for n in (4000, 12_000))
    assert pii_crf.find(small, field) == ([], [])
    (base, found), peak, seconds = megabytes_and_seconds(lambda: pii_crf.find(large, field))
    assert (base, found) == ([], []) and peak < 30 and seconds < 60
    # An entity between two tables is found as well as alone.
    mixed = f"{small} x bob [at] mail [dot] org y {small}"
    assert [mixed[a:b] for a, b, _ in pii_crf.find(mixed, field)[1]] == ["bob [at] mail [dot] org"]


def test_secrets_in_long_texts_without_white_space():
    import random
    r = random.Random(3)
    chain = secret_crf.fit_chain(secret_crf.written_stretches(600))
    han = [chr(0x4E00 + i) for i in range(3000)]

    def value():
        return "".join(r.choice("ABCDEFabcdef0123456789xyzXYZ") for _ in range(30))

    wanted = [value() for _ in range(120)]
    text = "".join("".join(r.choice(han) for _ in range(200)) + "passphrase:" + v for v in wanted)
    (base, found), peak, seconds = megabytes_and_seconds(lambda: secret_crf.find(text, chain))
    assert base == [] and peak < 60 and seconds < 60  # the rules do not know this key word
    assert [v for v in wanted if not any(v in text[a:b] for a, b, _ in found)] == []
    # Every token of a stretch is decoded once, and stretches end on token borders.
    for odd in (text, "a." * 200_000 + "key=" + value() * 3, value() * 5000, ("key" + "\u00e9") * 50_000):
        last = 0
        for a, b in secret_crf.stretches(odd):
            assert last <= a < b
            last = b
            for at in {a, b} - {0, len(odd)}:
                assert not (secret_crf._RUN.match(odd, at - 1) and secret_crf._RUN.match(odd, at))


def test_a_secret_with_a_long_head_before_its_first_digit():
    assert secret_crf.stretches("x " + "a" * 900 + "1 y") == [(0, 905)]


def test_secrets_without_a_suspicious_place_are_found():
    chain = secret_crf.fit_chain(secret_crf.written_stretches(600))
    value = "ZkQ7xW2pL9.bT4vR8nJ1.cY6mH3sD5"
    for text in (f"client_secret is {value} here", f"word ghp_{value}", "plain words " * 3000 + f"signing_key is {value}"):
        assert secret_crf.stretches(text) == [] and secret_crf.base_spans(text) == []
        assert [text[a:b] for a, b, _ in secret_crf.find(text, chain)[1]] in ([value], [f"ghp_{value}"])


def test_all_tokens_get_the_tags_of_the_best_path(monkeypatch):
    import random
    r = random.Random(5)
    chain = secret_crf.fit_chain(secret_crf.written_stretches(150), rounds=2)
    texts = [" ".join(t for t, _ in secret_crf.written_stretches(6, seed=i)) for i in range(40)]
    texts += ["".join(r.choice(PIECES) for _ in range(r.randint(0, 60))) for _ in range(200)] + [" " * 900 + "a" * 900 + "\n= x"]
    for block, held in ((secret_crf.BLOCK, 200_000), (7, 3), (50, 40)):
        monkeypatch.setattr(secret_crf, "BLOCK", block)
        reader = secret_crf.Reader(chain, held=held)
        for text in texts:
            tokens, rows = secret_crf.features(text, 0, len(text), secret_crf.file_features(text))
            wanted = [(p, y) for p, y in zip(tokens, chain.viterbi(chain.numbers(rows, False))) if y]
            found = []
            for run in reader.runs(text):
                places = [m.span() for (a, b, _), first, last in run
                          for m in list(secret_crf._TOKEN.finditer(text, a, b))[first:last]]
                tags = chain.best_tags(scores[first:last] for (_, _, scores), first, last in run)
                found += [(p, y) for p, y in zip(places, tags) if y]
            assert found == wanted
