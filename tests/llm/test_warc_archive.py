import glob
import hashlib
import struct

import zstandard

from lossgrain.llm import warc_archive

SCHEMA = "page_id bigint, url string, html string, digest string, size string"


def archived(spark, rows):
    pages = spark.createDataFrame([(*r, "d", "s") for r in rows], SCHEMA)
    path = warc_archive.archive_path(spark)
    warc_archive.write_archives(pages, path)
    return path, warc_archive.read_archives(spark, path).collect()


def test_round_trip_and_revisits(spark):
    same = "é" * 60
    rows = [(3, "http://a", same), (1, "http://b\r\nX: y", same), (2, None, "short"), (4, "http://c", "short"),
            (5, "u", None), (6, "u", ""), (7, "u", same), (7, "u", same), (None, "u", same), (8, "u", "z\n" * 100_000),
            (9, "u", "\r\n\r\nContent-Length: 3\r\n\r\n" * 9)]
    path, found = archived(spark, rows)
    text = {r[0]: (r[2] or "").encode() for r in rows}
    assert len(found) == len(rows)
    for r in found:
        body = text[r.page_id]
        assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha256(body).hexdigest()
        if r.page_id in (3, 7):
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", 1, None)
        else:
            assert (r.record_type, r.refers_to) == ("response", None) and bytes(r.payload) == body


def test_files_are_plain_zstandard(spark):
    path, found = archived(spark, [(i, "u", f"<p>page {i} of many pages</p>" * 20) for i in range(200)])
    seen = 0
    for name in glob.glob(f"{path.removeprefix('file:')}/part-*"):
        data = open(name, "rb").read()
        if not data:
            continue
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc_archive.DICTIONARY_FRAME
        dictionary = zstandard.ZstdCompressionDict(data[8:8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data, read_across_frames=True)
        seen += reader.read().count(b"WARC-Type: response")
    assert seen == 200 == len(found)


def test_empty_table(spark):
    assert archived(spark, [])[1] == []
