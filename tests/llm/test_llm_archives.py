from __future__ import annotations

import gzip
import hashlib
import json
import zlib

import pytest

from quillvault.llm.warc import (
    archived,
    inflated,
    normalise,
    parse,
    read_records,
    record,
    records,
    write_archives,
)

SCHEMA = "page_id bigint, url string, html string, digest string, refers_to bigint"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def expected(rows):
    first = {}
    for page, html in rows:
        if len((html or "").encode()) >= 100 and page is not None:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, html in rows:
        to = first.get(html)
        revisit = to is not None and page != to
        out.append((page, len((html or "").encode()), sha(html), "revisit" if revisit else "response",
                    to if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (4, "<p>é</p>" * 30), (2, "<p>é</p>" * 30), (9, "<p>é</p>" * 30), (1, None), (3, ""), (5, "tiny"), (6, "tiny"),
    (7, "x" * 100), (8, "x" * 100), (8, "x" * 100), (10, "y" * 99), (11, "y" * 99), (None, "x" * 100), (None, "z" * 200),
    (None, "z" * 200), (12, "Content-Length: 5\r\n\r\nWARC/1.1\r\n\r\n" * 20), (13, "long " * 300000),
]


def test_round_trip(spark, rows_of):
    urls = [None, "http://a/\r\nX-Page-Id: 9", "http://b/%0A?q=é"]
    pages = spark.createDataFrame(
        [(p, urls[i % 3], h, "theirs", 5) for i, (p, h) in enumerate(ROWS)], SCHEMA
    )
    got = archived(spark, pages)
    kept = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows_of(kept) == expected(ROWS)
    texts = {(r.page_id, r.payload) for r in got.collect() if r.record_type == "response"}
    assert (12, ROWS[15][1]) in texts and (1, "") in texts
    assert sorted(map(repr, (r.url for r in got.collect()))) == sorted(repr(urls[i % 3]) for i in range(len(ROWS)))


def test_empty(spark):
    assert archived(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_normalised_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", "page " * (i * 50), "", 0) for i in range(40)], SCHEMA)
    raw = write_archives(pages.coalesce(1), str(tmp_path / "raw"))
    sources = [r.archive for r in raw.collect()]
    for source in sources:
        body = open(source, "rb").read()
        stream = zlib.decompressobj(31)
        stream.decompress(body)
        assert stream.eof and not stream.unused_data  # one member for the whole file
    index = normalise(raw, str(tmp_path / "members"), keep_source=True)
    rows = index.collect()
    assert len(rows) == 40
    for r in rows:
        with open(r.archive, "rb") as file:
            file.seek(r.offset)
            fields, _ = parse(gzip.decompress(file.read(r.length)))
        assert int(fields["x-page-id"]) == r.page_id and fields["warc-type"] == r.record_type
    for archive in {r.archive for r in rows}:
        listed = [json.loads(x) for x in open(f"{archive}.index")]
        mine = sorted((r.offset, r.length) for r in rows if r.archive == archive)
        assert sorted((o, n) for o, n, *_ in listed) == mine
        assert b"".join(records(inflated(iter([open(archive, "rb").read()])))).count(b"WARC/1.1") == len(mine)
    # A second attempt, even after the sources are gone, gives the same index.
    again = normalise(raw, str(tmp_path / "members"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))
    third = normalise(raw, str(tmp_path / "members"))
    assert read_records(third, str(tmp_path / "members")).count() == 40


def test_streams_in_small_pieces():
    data = [record(i, "u", b"x" * (i * 37), None) for i in range(30)]
    whole = gzip.compress(b"".join(data[:20])) + gzip.compress(b"".join(data[20:]))
    for size in (1, 7, 1000):
        pieces = (whole[i : i + size] for i in range(0, len(whole), size))
        assert list(records(inflated(pieces))) == data
    with pytest.raises(ValueError):
        list(records(iter([data[3][:-10]])))


def test_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "payload " * 50, "", 0)], SCHEMA)
    index = normalise(write_archives(pages, str(tmp_path / "raw")), str(tmp_path / "m"))
    r = index.first()
    body = gzip.decompress(open(r.archive, "rb").read()).replace(b"payload", b"PAYLOAD", 1)
    member = gzip.compress(body)
    with open(r.archive, "wb") as file:
        file.write(member)
    damaged = spark.createDataFrame([(r.archive, 0, len(member), 1, "response")], index.schema)
    with pytest.raises(Exception, match="does not match its digest"):
        read_records(damaged, str(tmp_path / "m")).collect()
