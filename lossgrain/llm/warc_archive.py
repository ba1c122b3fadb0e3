"""Dictionary-compressed WARC archives.

A Zstandard dictionary is trained on a bounded sample of the records. Every
archive file starts with a skippable frame that holds it; each record
follows as a frame of its own, so a record can be read without the others.

The files are written by Spark's text writer, so any file system Spark
reaches will do: a line is a record's frame plus the eight header bytes of a
one-byte skippable frame, and the line end is that frame's content. To a
Zstandard reader the file is a plain sequence of frames.

Defined results: a null payload is empty, a null address becomes the
record's own identifier; payloads below ``least_bytes`` are always full
responses; rows with the smallest page id of a payload are all responses
(a row repeated whole is archived twice); rows without page id are responses
and never referred to; an empty table gives an archive without records.
Further columns are not archived.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrain.llm.common import attach, pin, scratch_path

DICTIONARY_FRAME = 0x184D2A5D  # fixed value: skippable frame of an archive's dictionary
LINE_FRAME = 0x184D2A50  # fixed value: skippable frame that readers pass over
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


def _record(page_id, url, payload: bytes, size: int, digest: str, refers_to, date: str) -> bytes:
    own = f"urn:page:{page_id}"
    target = own if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    kind = "response" if refers_to is None else "revisit"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    head = (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{own}>\r\nWARC-Date: {date}\r\n"
            f"WARC-Target-URI: {target}\r\nWARC-Payload-Digest: sha256:{digest}\r\n")
    if refers_to is not None:
        head += f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:{refers_to}>\r\n"
    head += (f"Content-Type: application/http; msgtype=response\r\n"
             f"Content-Length: {len(block)}\r\n\r\n")
    return head.encode() + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, records: int = 512, longest: int = 65536,
                     size: int = 65536, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """Dictionary from at most ``records`` records of at most ``longest`` bytes, chosen by hash."""
    total = pages.count()
    share = min(1.0, 2.0 * records / max(total, 1))
    key = F.xxhash64("page_id", "url")
    rows = (pages.where(F.pmod(key, F.lit(1 << 20)) <= F.lit(int(share * (1 << 20))))
            .where(F.length("payload") <= longest).orderBy(key, F.sha2("payload", 256))
            .limit(records).select("page_id", "url", "payload").collect())
    samples = [_record(r.page_id, r.url, bytes(r.payload), len(r.payload),
                       hashlib.sha256(bytes(r.payload)).hexdigest(), None, date) for r in rows]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too equal records: they are the dictionary themselves
        return b"".join(samples)[-size:]


def mark_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the rows whose payload another row archives."""
    facts = pin(pages.select("page_id", F.sha2("payload", 256).alias("digest"),
                             F.length("payload").alias("size")))
    firsts = pin(facts.where(F.col("size") >= least_bytes).groupBy("digest")
                 .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1"))
    known = attach(facts, firsts, "digest", "n")
    return (known.where("refers_to <> page_id").where(F.col("size") >= least_bytes)
            .select("page_id", "digest", "refers_to").distinct())


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
                   payload: str = "html", least_bytes: int = 100, archive_bytes: int = 64 << 20,
                   date: str = "1970-01-01T00:00:00Z", level: int = 6) -> None:
    """Write one archive per ``archive_bytes`` of payload below ``path``."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b"")).alias("payload"))
    total = rows.agg(F.coalesce(F.sum(F.length("payload")), F.lit(0))).first()[0]
    spark = pages.sparkSession
    files = max(int(total // archive_bytes) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dictionary = train_dictionary(rows, date=date)
    keyed = (rows.withColumn("digest", F.sha2("payload", 256))
             .repartition(files, "page_id", "digest"))
    full = keyed.join(mark_revisits(rows, least_bytes), ["page_id", "digest"], "left").select(
        "page_id", "url", "digest", "refers_to", F.length("payload").alias("size"),
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"))

    def compressed(batches):
        trained = zstandard.ZstdCompressionDict(dictionary)
        packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True)
        end = struct.pack("<II", LINE_FRAME, 1)
        first = True
        for batch in batches:
            out = []
            if first:
                out.append(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary + end)
                first = False
            columns = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                one, address, digest, refers, size, body = (c[i].as_py() for c in columns)
                out.append(packer.compress(
                    _record(one, address, body or b"", size, digest, refers, date)) + end)
                if len(out) >= 500:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["line"])
                    out = []
            if out:
                yield pa.record_batch([pa.array(out, pa.binary())], ["line"])

    # The cast relabels the bytes; the writer copies them as they are and ends each with \n.
    full.mapInArrow(compressed, "line binary").select(F.col("line").cast("string")).write.option(
        "lineSep", "\n").text(path)


def _frames(data: memoryview):
    """The decompressed records of one archive."""
    at, dictionary = 0, None
    while at < len(data):
        magic, = struct.unpack_from("<I", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            size, = struct.unpack_from("<I", data, at + 4)
            if magic == DICTIONARY_FRAME:
                dictionary = zstandard.ZstdCompressionDict(bytes(data[at + 8:at + 8 + size]))
            at += 8 + size
            continue
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        parts = []
        while not reader.eof:
            piece = data[at:at + 65536]
            if not piece:
                raise ValueError("archive ends inside a record")
            parts.append(reader.decompress(piece))
            at += len(piece) - len(reader.unused_data)
        yield b"".join(parts)


READ_SCHEMA = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, "
               "record_type string, refers_to bigint, payload binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``; a payload that differs from its digest is an error."""

    def number(text):
        found = text.strip("<>").rpartition(":")[2]
        return None if found == "None" else int(found)

    def parsed(batches):
        names = [f.split()[0] for f in READ_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows):
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for content in batch.column(0):
                rows = []
                for record in _frames(memoryview(content.as_buffer())):
                    head, _, block = record.partition(b"\r\n\r\n")
                    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                    block = block[:int(fields["Content-Length"])]
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = fields["WARC-Payload-Digest"].partition(":")[2]
                    kind, refers = fields["WARC-Type"], None
                    if kind == "revisit":
                        refers, payload = number(fields["WARC-Refers-To"]), None
                    elif hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                    rows.append((number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], size,
                                 digest, kind, refers, payload))
                    if len(rows) >= 200:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select("content").mapInArrow(parsed, READ_SCHEMA))


def archive_path(spark: SparkSession) -> str:
    return scratch_path(spark, "archives")
