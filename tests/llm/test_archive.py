import gzip
import hashlib

import pytest

from graphfeed.lineage import scratch_path
from graphfeed.llm import archive as A

V1 = (b"filedesc://x.arc 0.0.0.0 20010203040506 text/plain 72\n1 0 Someone\n"
      b"URL IP-address Archive-date Content-type Archive-length\n\n   \n"[:0])


def arc(version, records):
    block = f"{version} 0 Someone\n{A.FIELDS[version]}\n".encode()
    mid = b"" if version == 1 else b" 200 - - 0 -"
    out = b"filedesc://x 0.0.0.0 20010203040506 text/plain" + mid + b" %d\n" % len(block) + block + b"\n"
    for url, mime, body in records:
        out += url + b" 1.2.3.4 20010203040506 " + mime + mid + b" %d\n" % len(body) + body + b"\n"
    return out


BODY = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"
RECORDS = [(b"http://a/", b"text/html", BODY + b"x"), (b"dns:a", b"text/dns", b"20010203 a"),
           (b"http://b/", b"text/html", BODY + b"WARC/1.1\r\n\nhttp://c/ 1 2 3 4\n\r\n\r\n"),
           (b"http://c/", b"text/html", b""), (b"http://d/", b"text/html", bytes(range(256)))]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_walk_by_declared_lengths(version, pack):
    got = list(A.arc_records(pack(arc(version, RECORDS))))
    assert [(f["URL"].encode(), b) for _, f, b in got] == [(u, b) for u, _, b in RECORDS]
    for at, fields, _ in got:
        assert arc(version, RECORDS)[at:].startswith(fields["URL"].encode())
        assert ("Checksum" in fields) == (version == 2)


@pytest.mark.parametrize("broken", [arc(1, RECORDS)[:-4], b"http://a 1 2 3 5\nhello\n",
                                    arc(1, RECORDS) + b"only three fields 0\n"])
def test_broken_files_are_errors(broken):
    with pytest.raises(ValueError):
        list(A.arc_records(broken))


def test_records_round_trip():
    made = [A.warc_record("x", at, f, b, None) for at, f, b in A.arc_records(arc(1, RECORDS))]
    got = list(A.warc_records(b"".join(m + b"\r\n\r\n" for m in made)))
    assert [b for _, b in got] == [b for _, _, b in RECORDS]
    assert [h["WARC-Type"] for h, _ in got] == ["response", "resource", "response", "resource", "resource"]
    assert got[0][0]["WARC-Date"] == "2001-02-03T04:05:06Z"
    assert len({h["WARC-Record-ID"] for h, _ in got}) == len(RECORDS)


def brute(pages):
    first = {}
    for key, _, body in pages:
        data = (body or "").encode()
        if len(data) >= 1000 and key is not None:
            first[data] = max(first.get(data, key), key)
    out = []
    for key, _, body in pages:
        data = (body or "").encode()
        again = len(data) >= 1000 and key is not None and first[data] != key
        out.append((key, len(data), hashlib.sha1(data).hexdigest(),
                    "revisit" if again else "response", first[data] if again else None))
    return sorted(map(str, out))


def test_pages_through_archives(spark):
    pages = [(1, "http://a b\nc", "é" * 600), (2, None, "é" * 600), (3, "u", "x" * 999), (4, "u", "x" * 999),
             (5, "u", None), (6, "", ""), (7, "u", "\r\n\r\n" * 400), (8, "u", "y" * 3_000_000), (9, "u", "é" * 600),
             (10, "u", "WARC/1.1\r\n" * 200), (11, "u", "WARC/1.1\r\n" * 200)]
    df = spark.createDataFrame([(*p, "clash", "k") for p in pages],
                               "page_id long, url string, html string, content string, key string").repartition(3)
    got = A.archived(df).select("key", "payload_bytes", "payload_digest", "record_type", "refers_key", "intact")
    rows = got.collect()
    assert all(r.intact for r in rows) and sorted(str(tuple(r)[:5]) for r in rows) == brute(pages)


def test_repeated_rows_null_keys_and_empty(spark):
    body = "z" * 2000
    df = spark.createDataFrame([(1, "u", body)] * 3 + [(None, "u", body)], "page_id long, url string, html string")
    rows = A.archived(df).collect()
    assert sorted(r.record_type for r in rows) == ["response"] + ["revisit"] * 3
    assert {r.refers_key for r in rows if r.record_type == "revisit"} == {1}
    assert A.archived(df.limit(0)).count() == 0


def test_other_archives(spark):
    path = scratch_path(spark, "old-arc")
    spark.range(1).selectExpr("'' as value").write.text(path)  # an empty file beside is no archive
    assert list(A.warc_records(b"")) == []
