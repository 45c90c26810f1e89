import hashlib

import pytest

from docpipe.llm import warc
from docpipe.llm.files import open_file

BIG, OTHER = "<p>é</p>" * 200, "<b>x</b>" * 300
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (5, "http://ä/ü?q=1 2\r\nX: y", BIG),
        (3, None, "small"), (4, "http://a/4", "small"), (6, "u", None), (7, "u", ""),
        (None, "http://n", BIG), (8, "http://a/8", OTHER), (8, "http://a/8", OTHER)]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(ROWS, "page_id bigint, url string, html string")
    return df.selectExpr("*", "'x' AS record_type", "1 AS _digest", "2 AS payload_bytes").repartition(3)


@pytest.fixture(scope="module")
def archived(spark, pages):
    return warc.write_archives(warc.resolve(pages))


def test_round_trip(spark, archived):
    rows = warc.read_archives(spark, archived).collect()
    texts = {(r.page_id, r.url): r.html for r in rows if r.record_type == "response"}
    expected = {(i, u): (h or "") for i, u, h in ROWS if (i, h) not in ((1, BIG), (2, BIG))}
    assert texts == expected
    revisits = [r for r in rows if r.record_type == "revisit"]
    assert {r.page_id for r in revisits} == {1, 2} and all(r.html is None for r in revisits)


def test_revisits_are_resolved(spark, archived):
    records = warc.read_archives(spark, archived, bodies=False)
    found = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest)
             for r in warc.resolved_records(records).collect()}
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    size = len(BIG.encode())
    assert found == {
        (1, "revisit", 5, size, sha(BIG)), (2, "revisit", 5, size, sha(BIG)),
        (5, "response", None, size, sha(BIG)), (None, "response", None, size, sha(BIG)),
        (3, "response", None, 5, sha("small")), (4, "response", None, 5, sha("small")),
        (6, "response", None, 0, sha("")), (7, "response", None, 0, sha("")),
        (8, "response", None, len(OTHER), sha(OTHER)),
    }
    assert warc.resolved_records(records).count() == len(ROWS)


def test_records_are_members_with_fresh_headers(archived):
    uri = archived.where("records > 0").head().uri
    with open_file(uri) as stream:
        raw = next(warc.members(stream))
    head, _, block = raw.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")
    length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
    assert len(block) == length + 4


def test_a_damaged_payload_is_noticed(archived, spark):
    row = next(r for r in warc.read_archives(spark, archived).collect() if r.page_id == 3)
    raw = warc.encoded_record(type("Row", (), row.asDict() | {"payload_bytes": 5, "refers_to": None}))
    assert warc.decoded_record(raw)[7] == "small"
    with pytest.raises(ValueError, match="damaged"):
        warc.decoded_record(raw.replace(b"small", b"smaLl"))


def test_empty(spark, pages):
    records = warc.read_archives(spark, warc.write_archives(warc.resolve(pages.limit(0))))
    assert warc.resolved_records(records).collect() == []


def test_ids_beyond_the_exact_doubles_and_a_long_payload(spark):
    long = "<p>" + "x y " * 1_500_000 + "</p>"
    rows = [(2**53 + 1, "u", BIG), (2**53 + 3, "u", BIG), (None, "u", "z"), (7, "v", long), (8, "w", long)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    records = warc.read_archives(spark, warc.write_archives(warc.resolve(df)))
    found = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.resolved_records(records).collect()}
    size = len(BIG.encode())
    assert found == {
        (2**53 + 1, "revisit", 2**53 + 3, size), (2**53 + 3, "response", None, size), (None, "response", None, 1),
        (7, "revisit", 8, len(long)), (8, "response", None, len(long)),
    }
    assert {r.html for r in records.where("page_id = 8").collect()} == {long}
