"""Line deduplication behind two Bloom filters, for lines seen once and seen twice.

Every task marks the keys of its own lines in one filter and, on meeting a key
again, in a second one; filters of different tasks are merged by *or*, and what
two tasks both hold as seen goes to the second filter. A key of two documents
is always in the second filter, so only keys found there are shuffled, by
their SHA-256, to count their documents exactly and to choose the first one.
A false hit costs a shuffled digest, never a line.

The filters have 8 to 16 bits a line up to ``filter_bits`` (64 MB). Beyond
that they fill up and more digests are shuffled; the result stays exact.
Repeated keys are broadcast up to ``known_rows`` of them; beyond, every text
gets its own repeated keys by a join on its digest.

Defined results: a null text has one empty line and stays null; an empty key
(fewer than ``least_chars`` code points) is never repeated; every row is a
document, rows that repeat an id too; of rows equal in id and text that own a
first occurrence, each keeps it; long texts are split whole; an empty table
gives an empty table; further columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lossgrain.llm.common import attach, fresh, pin

BLANKS = b" \t\n\x0b\x0c\r"
FILTER_BITS = 1 << 29
KNOWN_ROWS = 500_000
SEGMENTS = 256
#: Odd multipliers, one for each bit of a key: the golden ratio's fraction and two like it.
SPREAD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]
#: Hashes a task holds before it marks them.
HELD = 1 << 20


def line_keys(data: bytes) -> list[bytes]:
    """Of each line its key: blanks stripped at both ends, A-Z lower-cased."""
    return [line.strip(BLANKS).lower() for line in data.split(b"\n")]


def long_enough(key: bytes, least_chars: int) -> bool:
    return len(key) >= least_chars and (least_chars < 2 or len(key.decode(errors="replace")) >= least_chars)


def hashes_of(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each hash in a filter of ``2 ** bits`` bits."""
    return np.stack([(hashes * np.uint64(m)) >> np.uint64(64 - bits) for m in SPREAD]).astype(np.int64)


def holds(filter_: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return ((filter_[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1).all(axis=0)


def mark(filter_: np.ndarray, spots: np.ndarray) -> None:
    np.bitwise_or.at(filter_, (spots >> 3).ravel(), (1 << (spots & 7)).astype(np.uint8).ravel())


def fold(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray, bits: int) -> None:
    distinct, counts = np.unique(hashes, return_counts=True)
    spots = places(distinct, bits)
    again = holds(once, spots) | (counts > 1)
    mark(once, spots)
    mark(twice, spots[:, again])


def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] | b[0], a[1] | b[1] | (a[0] & b[0])


def _binary(text: str) -> Column:
    return F.col(text).cast("binary")


def twice_filter(docs: DataFrame, text: str = "text", least_chars: int = 1,
                 filter_bits: int = FILTER_BITS) -> tuple[list[bytes], int]:
    """Compressed segments of the filter of keys seen twice, and the number of bits as a power of two."""
    n_lines = docs.agg(F.sum(
        F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    bits = min(max(16, int(8 * n_lines).bit_length()), filter_bits.bit_length() - 1)
    size = 1 << (bits - 3)

    def build(batches):
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        held: list[bytes] = []
        for batch in batches:
            for data in batch.column(0):
                if (data := data.as_py()) is not None:
                    held += {k for k in line_keys(data) if long_enough(k, least_chars)}
                if len(held) >= HELD:
                    fold(once, twice, hashes_of(held), bits)
                    held = []
        fold(once, twice, hashes_of(held), bits)
        parts = once.reshape(SEGMENTS, -1), twice.reshape(SEGMENTS, -1)
        filled = np.flatnonzero(parts[0].any(axis=1))
        for at in np.array_split(filled, max(1, len(filled) // 16)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)),
                 *[pa.array([zlib.compress(p[i].tobytes(), 1) for i in at], pa.binary()) for p in parts]],
                ["segment", "once", "twice"])

    def whole(data: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(data), np.uint8)

    def add_up(batches):
        segment, both = None, None
        for batch in batches:
            for s, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if s != segment and both is not None:
                    yield pa.RecordBatch.from_pylist([{"segment": segment, "twice": zlib.compress(both[1].tobytes())}], out)
                one = whole(once), whole(twice)
                segment, both = s, one if s != segment else merge(both, one)
        if both is not None:
            yield pa.RecordBatch.from_pylist([{"segment": segment, "twice": zlib.compress(both[1].tobytes())}], out)

    out = pa.schema([("segment", pa.int32()), ("twice", pa.binary())])
    made = docs.select(_binary(text)).mapInArrow(build, "segment int, once binary, twice binary")
    # Rows of a segment stream through one task in order; two filters of a segment are held at once.
    merged = made.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        add_up, "segment int, twice binary")
    found = {r.segment: bytes(r.twice) for r in merged.collect()}  # at most filter_bits / 8 bytes
    empty = zlib.compress(bytes(size // SEGMENTS))
    return [found.get(s, empty) for s in range(SEGMENTS)], bits


def suspects(docs: DataFrame, text: str = "text", least_chars: int = 1, filter_bits: int = FILTER_BITS,
             carry: tuple[str, ...] = ()) -> DataFrame:
    """``line`` (SHA-256) once for each document and key that may be repeated, beside the columns ``carry``."""
    segments, bits = twice_filter(docs, text, least_chars, filter_bits)
    shared = docs.sparkSession.sparkContext.broadcast(segments)

    def find(batches):
        twice = np.frombuffer(b"".join(zlib.decompress(s) for s in shared.value), np.uint8)
        for batch in batches:
            keys, rows = [], []
            for i, data in enumerate(batch.column(0)):
                if (data := data.as_py()) is not None:
                    own = {k for k in line_keys(data) if long_enough(k, least_chars)}
                    keys += own
                    rows += [i] * len(own)
            at = np.flatnonzero(holds(twice, places(hashes_of(keys), bits)))
            lines = pa.array([hashlib.sha256(keys[i]).digest() for i in at], pa.binary())
            taken = pa.array(np.asarray(rows, np.int64)[at])
            yield pa.RecordBatch.from_arrays(
                [lines, *[batch.column(1 + i).take(taken) for i in range(len(carry))]], ["line", *carry])

    kinds = [docs.schema[c] for c in carry]
    schema = T.StructType([T.StructField("line", T.BinaryType()), *[T.StructField(f.name, f.dataType) for f in kinds]])
    return docs.select(_binary(text).alias(fresh(docs, "data")[0]), *carry).mapInArrow(find, schema)


def drop_repeated(docs: DataFrame, least_docs: int = 2, least_chars: int = 1, keep_first: bool = True,
                  doc_id: str = "doc_id", text: str = "text", n_lines: str = "n_lines", n_dropped: str = "n_dropped",
                  filter_bits: int = FILTER_BITS, known_rows: int = KNOWN_ROWS) -> DataFrame:
    """``docs`` without the lines whose key is in at least ``least_docs`` of them.

    With ``keep_first`` the first line of such a key stays in the document
    with the smallest id (null ids last; of equal ids the smallest digest).
    Adds the number of lines before dropping and of those dropped.
    """
    token, = fresh(docs, "token")
    whose = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit(":"),
                     F.coalesce(F.sha2(_binary(text), 256), F.lit("-")))
    with_token = docs.withColumn(token, F.unhex(F.sha2(whose, 256)))
    rows, carry = (with_token, (doc_id, token)) if keep_first else (docs, ())
    found = suspects(rows, text, least_chars, filter_bits, carry)
    n = F.count(F.lit(1)).alias("n_docs")
    if keep_first:
        first = F.min(F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"), F.col(token).alias("owner")))
        known = found.groupBy("line").agg(n, first.alias("first")).select("line", "n_docs", "first.owner")
    else:
        known = found.groupBy("line").agg(n).withColumn("owner", F.lit(None).cast("binary"))
    known = pin(known.where(F.col("n_docs") >= least_docs))
    if known.count() <= known_rows:
        listed = {bytes(r.line): r.owner and bytes(r.owner) for r in known.select("line", "owner").collect()}
        shared = docs.sparkSession.sparkContext.broadcast(listed)
        return _strip(with_token if keep_first else docs, token, None, shared, docs, text, n_lines, n_dropped)
    # Too many to broadcast: each text meets its own repeated keys by its digest.
    own = pin(suspects(with_token, text, least_chars, filter_bits, (token,)).distinct())
    asked = pin(own.groupBy("line").agg(F.count(F.lit(1)).alias("n_asked")).join(known, "line"))
    lists = attach(own, asked, "line", "n_asked").where(F.col("n_docs").isNotNull()).groupBy(token).agg(
        F.collect_list(F.struct("line", "owner")).alias("repeated"))
    repeated, = fresh(with_token, "repeated")
    joined = with_token.join(lists.withColumnRenamed("repeated", repeated), token, "left")
    return _strip(joined, token, repeated, None, docs, text, n_lines, n_dropped)


def _strip(rows: DataFrame, token: str, repeated: str | None, shared, docs: DataFrame, text: str,
           n_lines: str, n_dropped: str) -> DataFrame:
    names = docs.columns
    at = names.index(text)
    has_token = token in rows.columns

    def strip(batches):
        for batch in batches:
            tokens = batch.column(len(names)).to_pylist() if has_token else [None] * batch.num_rows
            lists = batch.column(len(names) + 1) if repeated else None
            texts, before, gone = [], [], []
            for i, data in enumerate(batch.column(at)):
                data = data.as_py()
                if data is None:
                    texts.append(None)
                    before.append(1)
                    gone.append(0)
                    continue
                known = shared.value if lists is None else {
                    x["line"]: x["owner"] for x in lists[i].as_py() or ()}
                lines, seen, kept = data.split(b"\n"), set(), []
                for line, key in zip(lines, line_keys(data)):
                    digest = hashlib.sha256(key).digest() if known else b""
                    if digest in known:
                        if known[digest] is None or known[digest] != tokens[i] or digest in seen:
                            continue
                        seen.add(digest)
                    kept.append(line)
                texts.append(b"\n".join(kept))
                before.append(len(lines))
                gone.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.binary()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                [f"c{i}" for i in range(len(names) + 2)])

    # Columns go by place: names may repeat those used here.
    fields = [T.StructField(f"c{i}", T.BinaryType() if f.name == text else f.dataType) for i, f in enumerate(docs.schema)]
    fields += [T.StructField(f"c{len(names) + i}", T.LongType()) for i in range(2)]
    extra = [*([token] if has_token else []), *([repeated] if repeated else [])]
    passed = rows.select(*[(_binary(c) if c == text else F.col(f"`{c}`")) for c in names], *extra)
    out = passed.mapInArrow(strip, T.StructType(fields)).toDF(*names, *fresh(docs, n_lines, n_dropped))
    return out.withColumn(text, F.col(text).cast("string"))
