import gzip
import io

import pytest

from clipmart.llm import warc

ROWS = [(5, "http://a.org/x y", "<p>same</p>"), (3, "http://b.org/", "<p>same</p>"), (9, None, None), (1, "u", ""),
        (7, "http://c.org/é", "ünï\r\n\r\nx"), (None, "http://d.org", "<p>same</p>"), (3, "http://b.org/", "<p>same</p>"),
        (2**62 + 5, "x", "big" * 100_000), (-4, "x", "neg"), (None, "n", "neg")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in ROWS],
                                 "page_id long, url string, html string, file string, key long")


def by_definition(rows):
    out, first = [], {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for k, _, h in order:
        b = (h or "").encode()
        kind, to = ("revisit", first[b]) if b in first else ("response", None)
        first.setdefault(b, k)
        out.append((k is None, k or 0, len(b), warc.sha1(b), kind, to))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["key"] is None, r["key"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("records", [warc.FILE_RECORDS, 1])
def test_round_trip(pages, monkeypatch, records):
    monkeypatch.setattr(warc, "FILE_RECORDS", records)
    assert rows_of(warc.archived(pages)) == by_definition(ROWS)
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert rows_of(warc.archived(pages)) == by_definition(ROWS)


def test_small_payloads_stay(pages):
    out = warc.archived(pages, at_least=5).collect()
    assert all(r["record_type"] == "response" for r in out if r["payload_bytes"] < 5)


def test_empty(pages):
    assert warc.archived(pages.limit(0)).collect() == []


def arc(version, *records):
    return warc.arc_start(version, "f.arc") + b"".join(records)


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions(version):
    body = b"HTTP/1.0 200 OK\r\nX-Page-Id: 8\r\nContent-Length: 3\r\n\r\nabc"
    line = warc.arc_line(version, "http://x/a b", "19991231235959", "text/html", len(body))
    data = arc(version, line, body, b"\n", line, body, b"\n")
    got = list(warc.arc_records(io.BytesIO(data), "f.arc"))
    assert [n for n, *_ in got] == [0, 1, 2]
    assert got[0][1] == {"URL": "filedesc://f.arc", "Version": str(version)}
    assert got[1][2] == body and got[1][1]["Archive-date"] == "19991231235959" and got[1][1]["URL"] == "http://x/a b"
    record = gzip.decompress(warc.converted("f.arc", 1, got[1][1], body, None))
    fields, block = next(warc.warc_records(io.BytesIO(record), "f"))
    assert fields["warc-type"] == "response" and fields["warc-date"] == "1999-12-31T23:59:59Z" and block == body
    assert warc.key_of(fields["warc-record-id"]) == 8
    assert fields["warc-payload-digest"] == "sha1:VGMT4NSHA2AWVOR6EVYXQUGCNSONBWE5"


def test_damaged():
    line = warc.arc_line(1, "u", "19991231235959", "text/html", 100)
    with pytest.raises(ValueError, match="cut off"):
        list(warc.arc_records(io.BytesIO(arc(1, line, b"short")), "f"))
    with pytest.raises(ValueError, match="header line"):
        list(warc.arc_records(io.BytesIO(arc(1, b"nonsense\n")), "f"))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.warc_records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"), "f"))


def test_identifiers():
    import uuid

    seen = set()
    for k in (0, 1, -1, 2**63 - 1, -2**63, 123456789):
        for n in (1, 2):
            urn = warc.record_id(k, "f", n)
            u = uuid.UUID(urn)
            assert (u.version, u.variant, warc.key_of(urn)) == (8, uuid.RFC_4122, k)
            seen.add(urn)
    assert len(seen) == 12 and warc.key_of(warc.record_id(None, "f", 1)) is None
    assert warc.iso_date("199912") == "1999-12-01T00:00:00Z"
