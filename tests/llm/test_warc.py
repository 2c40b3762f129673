import hashlib
import tempfile

from dcflow.llm import warc as W


def test_round_trip_and_revisits(spark):
    big, other = "é<p>" * 400, "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (None, None, big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""),
            (7, "u", other), (8, "u", other), (8, "u", other), (9, "u", "x" * 999), (10, "u", "x" * 999), (11, "u", "y" * 1000), (12, "u", "y" * 1000),
            (13, "u", "z" * 300000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, type string").repartition(2)
    path = tempfile.mkdtemp(prefix="dcflow-test-warc-") + "/out"
    got = W.deduplicate(spark, pages, path).collect()
    seen = sorted(((r["page_id"], r["payload_bytes"], r["digest"], r["type"], r["refers_to"]) for r in got), key=str)
    first = {big: 2, other: 8, "y" * 1000: 12}
    want = []
    for k, (i, _, html) in enumerate(rows):
        raw = (html or "").encode()
        again = html in first and (i != first[html] or k == 9)
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    assert seen == sorted(want, key=str)
    full = W.read_archive(spark, path, payloads=True).collect()
    assert len({r["record_id"] for r in full}) == len(rows)
    kept = [h.encode() for h in first] + [(h or "").encode() for *_, h in rows if h not in first]
    assert sorted(bytes(r["payload"]) for r in full if r["type"] == "response") == sorted(kept)
    assert {r["uri"] for r in full if r["page_id"] == 2} == {"http://a/2%0D%0AX:%20y"}
    assert W.deduplicate(spark, pages.limit(0)).count() == 0


def test_archives_are_read_piece_by_piece():
    import gzip

    import pytest

    from dcflow.llm.warc import inflate, parse_records

    def record(payload: bytes) -> bytes:
        body = b"HTTP/1.1 200 OK\r\n\r\n" + payload
        return b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)

    payloads = [b"", b"\r\n\r\n", b"x" * 5000, "é€".encode() * 700]
    whole = b"".join(map(record, payloads))
    for step in (1, 7, 64, 1 << 20):
        files = gzip.compress(whole), gzip.compress(record(payloads[0])) + gzip.compress(b"".join(map(record, payloads[1:])))
        for data in files:
            assert [p for _, _, p in parse_records(inflate(data, step))] == payloads
    assert list(parse_records([])) == []
    with pytest.raises(ValueError):
        list(parse_records([whole[:-10]]))
    with pytest.raises(ValueError):
        list(inflate(gzip.compress(whole)[:-20]))
