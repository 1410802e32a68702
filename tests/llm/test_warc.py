import base64
import gzip
import hashlib
import os

import pytest

from geotrace.llm import warc


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


ROWS = [(1, "http://a/1", "<p>same</p>"), (5, "http://a/5", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"), (2, None, None), (9, "http://b/\r\nX: y", ""),
        (4, "http://c", "é漢\r\n\r\n" * 3000), (6, "http://d", "<p>own</p>"), (6, "http://d", "<p>own</p>"), (None, "http://e", "alone")]


def test_round_trip_of_equal_null_and_repeated_payloads(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)
    got = sorted(((r.page_id is None, r.page_id or 0), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect())
    owner = {}
    for i, _, h in ROWS:
        owner[h or ""] = max(owner.get(h or "", -1), i or -1)
    want = sorted(((i is None, i or 0), len((h or "").encode()), sha((h or "").encode()), "response" if owner[h or ""] == (i or -1) else "revisit",
                   None if owner[h or ""] == (i or -1) else owner[h or ""]) for i, _, h in ROWS)
    assert got == want


def test_small_payloads_are_never_revisits(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    got = {(r.page_id, r.record_type) for r in warc.round_trip(df, min_bytes=12).collect()}
    assert all(kind == "response" for _, kind in got)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_payloads_predicates_and_uncommitted_files(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    warc.archive(df, path)
    (tmp_path / "w/part-lost.warc.gz").write_bytes(b"a task that never committed")
    rows = warc.read(spark, path).collect()
    assert len(rows) == len(ROWS)
    assert {r.payload.decode() for r in rows if r.record_type == "response"} == {h or "" for _, _, h in ROWS}
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    some = warc.read(spark, path).where("record_type = 'revisit' AND target_uri LIKE 'http://a%'")
    assert some.count() == 2 and "PushedFilters: []" not in some._jdf.queryExecution().executedPlan().toString()
    assert warc.read(spark, path, record_types="revisit", pushdown="false").count() == sum(r.record_type == "revisit" for r in rows)
    warc.archive(df, path)  # appended archives are read too
    assert warc.read(spark, path).count() == 2 * len(ROWS)


def view(tmp_path, data):
    import pyarrow.fs
    (tmp_path / "x").write_bytes(data)
    return warc._View(pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / "x")), len(data))


def test_unwanted_members_are_skipped_by_length_without_inflating(tmp_path):
    rows = [{"record_type": "response", "record_id": f"urn:page:{i}", "warc_date": "d", "payload": os.urandom(200_000)} for i in range(4)]
    data = b"".join(warc.member(warc.record(r)) for r in rows)
    broken = bytearray(data)
    size = len(warc.member(warc.record(rows[0])))
    broken[100_000:150_000] = bytes(50_000)  # inside the first payload, which nobody wants
    got = list(warc.records(view(tmp_path, bytes(broken)), 0, len(broken), lambda h: h["warc-record-id"] != "<urn:page:0>", True))
    assert [h["warc-record-id"] for h, _ in got] == [f"<urn:page:{i}>" for i in (1, 2, 3)]
    assert all(b.endswith(r["payload"]) for (_, b), r in zip(got, rows[1:], strict=True))
    second = size + len(warc.member(warc.record(rows[1])))  # members of random bytes differ in length
    own = [h["warc-record-id"] for h, _ in warc.records(view(tmp_path, data), size, second, lambda h: True, False)]
    assert own == ["<urn:page:1>"]  # a split's own records


@pytest.mark.parametrize("kind", ["plain", "gzip"])
def test_archives_of_other_writers(tmp_path, spark, kind):
    rows = [{"record_type": t, "record_id": f"urn:x:{i}", "warc_date": "d", "payload": b"p" * i * 3000} for i, t in enumerate(["warcinfo", "response", "response"])]
    parts = [warc.record(r) for r in rows]
    data = b"".join(parts) if kind == "plain" else b"".join(map(gzip.compress, parts))
    (tmp_path / ("a.warc" if kind == "plain" else "a.warc.gz")).write_bytes(data)
    got = warc.read(spark, str(tmp_path)).where("record_type = 'response'").collect()
    assert [(r.record_id, len(r.payload), r.payload_length) for r in got] == [("urn:x:1", 3000, 3000), ("urn:x:2", 6000, 6000)]


def test_a_wrong_digest_is_found(spark, tmp_path):
    row = {"record_type": "response", "record_id": "urn:page:1", "warc_date": "d", "payload": b"abc", "payload_digest": sha(b"abd")}
    (tmp_path / "a.warc.gz").write_bytes(warc.member(warc.record(row)))
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, str(tmp_path), verify="true").collect()


@pytest.mark.parametrize("kind", ["plain", "gzip"])
@pytest.mark.parametrize("said", [True, False])
def test_payload_length_behind_a_long_http_header(tmp_path, spark, kind, said):
    http = b"HTTP/1.1 200 OK\r\nSet-Cookie: " + b"x" * 30_000 + (b"\r\nContent-Length: 5" if said else b"") + b"\r\n\r\n"
    head = (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nWARC-Date: d\r\nContent-Type: application/http; msgtype=response\r\n"
            b"Content-Length: " + str(len(http) + 5).encode() + b"\r\n\r\n")
    data = head + http + b"hello\r\n\r\n"
    (tmp_path / ("a.warc" if kind == "plain" else "a.warc.gz")).write_bytes(data if kind == "plain" else gzip.compress(data))
    for payload in ("true", "false"):
        got = warc.read(spark, str(tmp_path), payload=payload).collect()
        assert [(r.payload_length, r.payload) for r in got] == [(5, b"hello" if payload == "true" else None)]
