"""Archives written and read back, against the pages themselves; odd inputs."""

import hashlib

import pyarrow.parquet as pq
import pytest
from fitloom.llm import warc
from fitloom.llm.queries import op6_warc
from fitloom.session import scratch_path


def plain(pages):
    first = {}
    for i, html in pages:
        body = (html or "").encode()
        if i is not None and len(body) >= 100:
            first[body] = min(first.get(body, i), i)
    out = []
    for i, html in pages:
        body = (html or "").encode()
        again = i is not None and first.get(body, i) < i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    assert all(r.intact for r in rows)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_query_equals_the_plain_rule(spark, folder):
    table = pq.read_table(f"{folder}/pages.parquet").to_pydict()
    assert found(op6_warc(spark, folder)) == plain(list(zip(table["page_id"], table["html"], strict=True)))


def test_odd_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n" * 3
    long = "é€😀 " * 300_000
    rows = [(5, "http://a b\r\nX: y", trap), (2, None, trap), (9, "u", trap), (1, "u", "short"), (3, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", long), (8, "u", long)]
    rows += [(8, "u", long), (None, "u", trap), (None, None, None), (10, "u", "\r\n\r\n" * 60), (11, "u", "\r\n\r\n" * 60)]
    df = spark.createDataFrame([(i, u, h, "x", 3) for i, u, h in rows], "page_id long, url string, html string, digest string, bytes int")
    assert found(warc.archived(df)) == plain([(i, h) for i, _, h in rows])
    assert warc.archived(df.where("false")).collect() == []


def test_captures_are_nested_and_carry_payloads(spark):
    df = spark.createDataFrame([(1, "http://x/1", "y" * 200), (2, "http://x/2", "y" * 200)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df, path)
    records = warc.read_records(spark, path)
    assert records.count() == 6
    captures = {r.response.uri: r for r in warc.with_payloads(warc.assemble(records), records).collect()}
    one, two = captures["http://x/1"], captures["http://x/2"]
    assert bytes(one.payload).decode() == "y" * 200 and two.payload is None and two.response.type == "revisit"
    assert one.request.uri == "http://x/1" and one.metadata.fields["pageId"] == "1" and two.metadata.fields["refersToPage"] == "1"


def test_lone_records_keep_a_capture(spark):
    rows = [("a", "a", "response", 3), ("r", "a", "request", 0), ("m", "z", "metadata", 0)]
    df = spark.createDataFrame([(i, c, t, "u", "d", None, n, "h", {"k": "v"}, None) for i, c, t, n in rows], warc._READ)
    got = {r.capture_id: r for r in warc.assemble(df).collect()}
    assert got["a"].response.payload_bytes == 3 and got["a"].request is not None and got["a"].metadata is None
    assert got["z"].response is None and got["z"].metadata.fields == {"k": "v"}


def test_broken_archives_raise():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    assert [b for _, b in warc.parse(record * 2)] == [b"abcde"] * 2
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse(record[:-6]))
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse(record + b"junk"))
