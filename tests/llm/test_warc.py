from __future__ import annotations

import base64
import hashlib
import random
import struct

import pytest
import zstandard

from chatlake.llm import warc as W

SCHEMA = "page_id long, url string, html string, row string, key string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "extra", "extra", "extra") for r in rows], SCHEMA)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least):
    out = []
    for i, _, h in rows:
        first = min(j for j, _, g in rows if (g or "") == (h or ""))
        revisit = len((h or "").encode()) >= least and i != first
        out.append((i, len((h or "").encode()), digest(h), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out)


ROWS = [
    (1, "http://a/1", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (3, "http://a/\r\nX-Bad: 1", "<p>é \U0001f600</p>"),
    (4, "http://a/4", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "big " * 60_000),
    (7, "http://a/7", "big " * 60_000),
    (8, "http://a/8", "\r\n\r\nWARC/1.1\r\n\r\n"),
]


@pytest.mark.parametrize("least", [0, 100])
def test_roundtrip_matches_brute_force(spark, least):
    out = W.roundtrip(pages(spark, ROWS), least).collect()
    got = sorted((int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in out)
    assert got == brute(ROWS, least)


def test_repeated_rows_null_ids_and_hot_payload(spark):
    rows = [(None, "u", "x"), (9, "u", "x"), (9, "u", "x")] + [(100 + i, "u", "hot") for i in range(1500)]
    out = W.roundtrip(pages(spark, rows)).collect()
    assert len(out) == len(rows)
    assert sum(r.record_type == "response" for r in out) == 2
    assert all(r.refers_to == "100" for r in out if r.payload_digest == digest("hot") and r.record_type == "revisit")
    assert all(r.refers_to == "9" for r in out if r.payload_digest == digest("x") and r.record_type == "revisit")


def test_empty_table(spark):
    assert W.roundtrip(pages(spark, [])).count() == 0


def some_records(n=300):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abc def ghi jkl".split()) for _ in range(rng.randrange(300))) for _ in range(n)]
    return texts, [W.record(str(i), i, f"http://h/{i}", t.encode(), None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("n", [1, 3, 300])
def test_archive_has_a_leading_dictionary_and_one_frame_per_record(n):
    texts, records = some_records(n)
    data = W.archive(records)
    assert struct.unpack_from("<I", data)[0] == W.SKIPPABLE
    entries = list(W.read_archive(data))
    assert [e["payload"].decode() for e in entries] == texts and [e["page_id"] for e in entries] == [str(i) for i in range(n)]


def test_compressed_dictionary_and_archive_without_one():
    texts, records = some_records()
    known = W.dictionary(records)
    frames = zstandard.ZstdCompressor(dict_data=known)
    body = zstandard.ZstdCompressor().compress(known.as_bytes())
    data = struct.pack("<II", W.SKIPPABLE, len(body)) + body + b"".join(map(frames.compress, records))
    assert [e["payload"].decode() for e in W.read_archive(data)] == texts
    plain = b"".join(map(zstandard.ZstdCompressor().compress, records))
    assert [e["payload"].decode() for e in W.read_archive(plain)] == texts


def test_faults_are_reported_and_do_not_end_the_archive():
    _, records = some_records(5)
    bad = [
        records[0],
        records[1].replace(b"WARC/1.1", b"JUNK/1.1"),
        records[2].replace(b"Content-Length: ", b"Content-Length: 1", 1),
        records[3].replace(b"WARC-Type: response\r\n", b"", 1),
        records[4][:-1],
        records[0].replace(b"sha1:", b"sha1:A", 1),
        records[4],
    ]
    entries = list(W.read_archive(W.archive(bad)))
    assert [bool(e.get("error")) for e in entries] == [False, True, True, True, True, True, False]
    whole = W.archive(records)
    assert "cut" in list(W.read_archive(whole[:-3]))[-1]["error"]
    assert list(W.read_archive(whole[:20]))[0]["error"]
    assert list(W.read_archive(b"no archive at all"))[0]["error"]


def test_record_header_survives_odd_urls():
    parsed = W.parse_record(W.record(None, 1, "http://a/\r\nWARC-Type: x", b"p", None))
    assert parsed["page_id"] is None and parsed["record_type"] == "response" and "%0D%0A" in parsed["url"]
