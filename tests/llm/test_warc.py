import base64
import gzip
import hashlib
import io

import pytest

from tidemark.llm import warc

PAGES = [
    (1, "http://a.example/ü x\r\nInjected: 1", "<p>one</p>"), (2, "http://b.example/", "<p>one</p>"), (9, None, "<p>one</p>"), (3, "u", "é" * 5000), (4, "u", None), (5, "u", ""), (6, "u", "alone\r\n\r\nWARC/1.1\r\n"),
    (7, "u", "twice"), (7, "u", "twice"), (None, "u", "null id"), (10, "u", "null id"), (None, "u", "no id at all"), (11, "u", "x" * 300_001),
]


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def slow(rows, least=0):
    out = []
    for i, _, t in rows:
        size = len((t or "").encode())
        equal = [j for j, _, u in rows if (u or "") == (t or "") and j is not None]
        top = max(equal) if equal and size >= least else i
        revisit = top is not None and top != i and size >= least
        out.append((i, size, b32(t), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("chunk", "least"), [(1 << 20, 0), (7, 0), (1000, 6)])
def test_round_trip(spark, tmp_path, chunk, least):
    pages = spark.createDataFrame([(*r, 1) for r in PAGES], "page_id int, url string, html string, record_id int").repartition(3)
    archives = warc.write(warc.planned(pages, least=least), f"file://{tmp_path}/w", chunk=chunk)
    chunks = warc.read_chunks(spark, archives, chunk=chunk)
    got = sorted((tuple(r) for r in warc.summaries(chunks).collect()), key=str)
    assert got == slow(PAGES, least)
    rows = chunks.collect()
    assert all(len(r.data) <= chunk for r in rows)
    for i, _, t in PAGES:
        own = sorted((r for r in rows if r.record_id == i and r.record_type == "response" and (i is not None or r.payload_digest == b32(t))), key=lambda r: r.chunk_no)
        if own and i != 7:
            body = b"".join(r.data for r in own)
            assert body == (t or "").encode() and [r.chunk_no for r in own] == list(range(len(own)))
            seen = b""
            for r in own:  # digests are carried along
                seen += r.data
                assert (r.bytes_so_far, r.sha1_so_far) == (len(seen), base64.b32encode(hashlib.sha1(seen).digest()).decode())
            assert own[-1].last and own[-1].payload_digest == own[-1].sha1_so_far


def test_members_and_headers(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string").coalesce(1)
    (archive,) = warc.write(warc.planned(pages).coalesce(1), f"file://{tmp_path}/w")
    text = gzip.open(archive.removeprefix("file://")).read().decode()
    assert text.count("WARC/1.1\r\n") == 3 and text.count("<p>one</p>") == 1 and "\r\nInjected" not in text
    assert text.count("WARC-Type: revisit") == 2 and text.count("WARC-Refers-To: <urn:page:9>") == 2


def test_damage_is_found():
    good = warc._opening({"payload_bytes": 4, "refers_to": None, "record_id": 1, "url": "u", "sha1": hashlib.sha1(b"body").hexdigest()}, warc.DATE)
    assert len(list(warc.records_of(io.BytesIO(gzip.compress(good + b"body" + warc.END))))) == 1
    with pytest.raises(ValueError, match="digest"):
        list(warc.records_of(io.BytesIO(gzip.compress(good + b"bodY" + warc.END))))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.records_of(io.BytesIO(gzip.compress(good + b"bo"))))


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write(warc.planned(none), f"file://{tmp_path}/none") == []
    assert warc.summaries(warc.read_chunks(spark, [])).count() == 0
