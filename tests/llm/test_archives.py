"""WARC archives: round trips, revisits and damage."""

import gzip
import hashlib
from base64 import b32encode
from glob import glob

import pytest

from tallymart.llm.warc import archive_digests, parsed, read_archives, write_archives


def digest(html):
    return b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


PAGES = [
    (5, "http://a", "same"),
    (3, "http://b", "same"),
    (3, "http://b", "same"),
    (3, "http://c", "same"),
    (None, "http://d", "same"),
    (9, None, None),
    (8, "http://e/\r\nWARC-Type: metadata", ""),
    (7, "http://f", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n\0"),
    (4, "http://g", "x" * 300_000),
    (6, "http://g", "x" * 300_000),
    (1, "http://h", "single"),
]


@pytest.fixture(scope="module")
def pages(spark):
    made = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return made.repartition(3).selectExpr("*", "1 AS digest", "2 AS payload", "3 AS bytes", "'n' AS number")


def plain(rows, least):
    """The contract, row by row: (page_id, bytes, digest, type, refers_to)."""
    out, first = [], {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    for page_id, _, html in order:
        size, name = len((html or "").encode()), digest(html)
        if size >= least and name in first:
            out.append((page_id, size, name, "revisit", first[name]))
        else:
            first.setdefault(name, page_id)
            out.append((page_id, size, name, "response", None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1, 5])
def test_digests_of_the_archives(pages, least):
    assert sorted(map(tuple, archive_digests(pages, least).collect()), key=str) == plain(PAGES, least)


def test_revisits_refer_to_the_response_that_holds_the_payload(spark, pages, tmp_path):
    rows = read_archives(spark, write_archives(pages, str(tmp_path / "w"))).collect()
    assert len({r.record_id for r in rows}) == len(rows) == len(PAGES)
    held = {r.record_id: r for r in rows if r.record_type == "response"}
    for row in rows:
        own = row if row.record_type == "response" else held[row.refers_to_record]
        assert digest(bytes(own.payload).decode()) == row.payload_digest and own.page_id == (row.refers_to or own.page_id)
        assert (row.payload is None) == (row.record_type == "revisit")
    payloads = sorted(bytes(r.payload).decode() for r in held.values())
    assert payloads == sorted({html or "" for _, _, html in PAGES})
    assert {r.url for r in rows} >= {None, "http://e/%0D%0AWARC-Type: metadata"}


def test_archives_are_plain_warc(spark, pages, tmp_path):
    folder = write_archives(pages, str(tmp_path / "w"))
    seen = 0
    for path in glob(f"{folder}/*/*.gz"):
        data = gzip.open(path).read()
        assert data == b"" or (data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n"))
        for fields, block in parsed(open(path, "rb").read()):
            seen += 1
            assert {"WARC-Record-ID", "WARC-Date", "WARC-Payload-Digest", "Content-Type"} <= fields.keys()
            assert block.startswith(b"HTTP/1.1 200 OK\r\n")
            assert fields["WARC-Type"] == "response" or block.endswith(b"\r\n\r\n")
    assert seen == len(PAGES)


def test_damage_is_found(spark, pages, tmp_path):
    folder = write_archives(pages, str(tmp_path / "w"))
    for path in glob(f"{folder}/responses/*.gz"):
        data = gzip.open(path).read()
        with gzip.open(path, "wb") as into:
            into.write(data.replace(b"single", b"sample"))
    for path in glob(f"{folder}/responses/.*.crc"):
        open(path, "wb").close()
    with pytest.raises(Exception, match="damaged|hecksum"):
        read_archives(spark, folder).collect()


def test_no_pages(spark, pages, tmp_path):
    assert archive_digests(pages.limit(0)).count() == 0


def test_a_payload_on_a_third_of_the_rows(spark):
    rows = spark.range(3000).selectExpr(
        "id AS page_id", "concat('http://', id % 7) AS url", "if(id % 3 = 1, 'hot', concat('own ', id)) AS html"
    )
    found = archive_digests(rows).collect()
    hot = [r for r in found if r.payload_digest == digest("hot")]
    assert len(found) == 3000 and len(hot) == 1000
    assert sorted((r.record_type, r.refers_to) for r in hot if r.page_id == 1) == [("response", None)]
    assert {(r.record_type, r.refers_to) for r in hot if r.page_id != 1} == {("revisit", 1)}
    assert {r.record_type for r in found if r.payload_digest != digest("hot")} == {"response"}
