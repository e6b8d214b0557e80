"""Operator 9: exact round trip, revisits, nulls, ties and repeated rows."""

import hashlib

from relaysql.llm import warc_archive as w
from relaysql.session import shared_path

BIG = "<html>" + "é" * 200


def archive(spark, rows, schema="page_id bigint, url string, html string, payload string, headers int"):
    path = shared_path(spark, "test-warc")
    return w.write_archive(spark.createDataFrame(rows, schema), path)


def test_records_come_back_byte_for_byte(spark):
    rows = [(3, "http://a/1", BIG, "clash", 1), (1, "http://a/2", BIG, "x", 1), (2, None, "short", None, None),
            (5, "http://a/\r\nInjected: 1", "short", None, None), (4, "http://a/4", None, None, None),
            (9, "http://a/9", "", None, None), (7, "u", "line\r\n\r\nline" * 50, None, None)]
    path = archive(spark, rows)
    got = {r.page_id: r for r in w.restore(spark, path).collect()}
    assert len(got) == len(rows)
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        assert bytes(got[page_id].payload) == payload
        record = bytes(got[page_id].record)
        head, body = record.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n")
        assert hashlib.sha256(payload).hexdigest().encode() in head
        assert body == (payload if got[page_id].record_type == "response" else b"") + b"\r\n\r\n"
        assert b"\nInjected" not in head
    by = {r.page_id: r for r in w.verified(spark, path).collect()}
    assert (by[1].record_type, by[1].refers_to) == ("response", None)
    assert (by[3].record_type, by[3].refers_to) == ("revisit", 1)
    assert {by[k].record_type for k in (2, 5, 4, 9, 7)} == {"response"}
    assert by[4].payload_bytes == 0


def test_payload_is_stored_once(spark):
    path = archive(spark, [(i, "u", BIG, None, None) for i in range(50)] + [(0, "u", BIG, None, None)])
    assert spark.read.parquet(f"{path}/payloads").count() == 1
    types = [(r.page_id, r.record_type) for r in w.verified(spark, path).collect()]
    assert len(types) == 51
    assert sorted(p for p, t in types if t == "response") == [0, 0]     # both rows of the smallest id


def test_null_ids_and_empty_table(spark):
    path = archive(spark, [(None, "u", BIG, None, None), (8, "u", BIG, None, None), (None, "u", "only" * 50, None, None)])
    got = sorted((r.page_id or -1, r.record_type, r.refers_to or -1) for r in w.verified(spark, path).collect())
    assert got == [(-1, "response", -1), (-1, "revisit", 8), (8, "response", -1)]
    assert w.verified(spark, archive(spark, [])).count() == 0


def test_line_breaks_of_all_kinds_in_urls(spark):
    breaks = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"
    rows = [(i, f"http://a/{c}X-Page: 77{c}WARC-Type: revisit{c}text", BIG + str(i), None, None) for i, c in enumerate(breaks)]
    rows.append((50, "http://a/\u2028X-Page: 77 and text", BIG, None, None))
    path = archive(spark, rows)
    got = {r.page_id: r for r in w.read_archive(spark, path).collect()}
    assert set(got) == {r[0] for r in rows} and {r.record_type for r in got.values()} == {"response"}
    assert got[8].url == "http://a/%E2%80%A8X-Page: 77%E2%80%A8WARC-Type: revisit%E2%80%A8text"
    assert all(len(r.headers.split("\r\n")) == len(r.headers.splitlines()) + 1 for r in got.values())
