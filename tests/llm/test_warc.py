import gzip
import hashlib
import io
import random
from collections import Counter

import pytest
from pyarrow import fs

from meldstone.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest int"


def expected(pages):
    newest = {}
    for page_id, _, html, _ in pages:
        raw = (html or "").encode()
        if len(raw) >= warc.REVISIT_BYTES and page_id is not None:
            newest[raw] = max(newest.get(raw, page_id), page_id)
    rows = []
    for page_id, _, html, _ in pages:
        raw = (html or "").encode()
        refers = newest.get(raw)
        revisit = refers is not None and refers != page_id
        rows.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", refers if revisit else None))
    return Counter(rows)


def test_round_trip_with_copies_nulls_and_odd_urls(spark):
    rng = random.Random(8)
    copy, small = "copié " * 400, "x" * 999
    pages = [(i, f"http://h/{i}", copy, 1) for i in range(60)] + [(i, None, small, 1) for i in range(60, 90)]
    pages += [(2**60 + 1, "http://h/a b\r\nWARC-Type: warcinfo", "WARC/1.1\r\n\r\n" * 300, None), (None, None, None, None)]
    pages += [(None, "u", copy, 1), (100, "u", "", 1), (100, "u", "", 1), (101, "ü", "y" * 1000, 1), (101, "ü", "y" * 1000, 1)]
    pages += [(200 + i, "u", "".join(chr(rng.randrange(32, 1500)) for _ in range(rng.randrange(60_000))), 1) for i in range(40)]
    frame = spark.createDataFrame(pages, SCHEMA).repartition(5)
    assert Counter(map(tuple, warc.archive_report(frame).collect())) == expected(pages)


def test_empty_table(spark):
    assert warc.archive_report(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("split", [1, 7, 50, 333, 4096, 10**9])
def test_any_ranges_own_each_record_once(tmp_path, split):
    rng = random.Random(split)
    contents = []
    for i in range(25):
        noise = bytes(rng.randrange(256) for _ in range(rng.randrange(700)))
        # Stored blocks keep the magic of an inner member visible in the archive.
        inner = warc.gzip_member(b"not a record") + warc.MAGIC + noise
        contents.append(warc.record_bytes(i, "u", inner, hashlib.sha1(inner).hexdigest(), len(inner), "response", None))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(warc.gzip_member(c) for c in contents))
    size = path.stat().st_size
    found = []
    with fs.LocalFileSystem().open_input_file(str(path)) as handle:
        for start in range(0, size, split):
            found += [c for _, c in warc.members(warc._Bytes(handle), start, start + split, "a")]
    assert found == contents


def test_reader_splits_archives(spark, tmp_path):
    pages = spark.range(400).selectExpr("id page_id", "'u' url", "repeat(md5(cast(id as string)), 200) html", "1 digest")
    folder = str(tmp_path / "warc")
    assert warc.write_archives(pages.coalesce(1), folder) == 400
    rows = warc.read_archives(spark, folder, split_bytes=3000)
    assert rows.count() == 400 and rows.rdd.getNumPartitions() > 1
    payloads = {r["record_id"]: bytes(r["payload"]).decode() for r in rows.collect()}
    assert payloads["urn:page:17"] == hashlib.md5(b"17").hexdigest() * 200


def test_damage_is_reported(tmp_path):
    content = warc.record_bytes(1, "u", b"z" * 50_000, "00" * 20, 50_000, "response", None)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(warc.gzip_member(content)[:-20])
    with fs.LocalFileSystem().open_input_file(str(path)) as handle, pytest.raises(ValueError, match="damaged"):
        list(warc.members(warc._Bytes(handle), 0, 10**6, "a"))


def some_records(rng, count, largest=3000):
    contents = []
    for i in range(count):
        payload = bytes(rng.randrange(256) for _ in range(rng.randrange(largest))) + b"\r\n\r\nWARC/1.1\r\n"
        contents.append(warc.record_bytes(i, "u", payload, hashlib.sha1(payload).hexdigest(), len(payload), "response", None))
    return contents


@pytest.mark.parametrize("per_member", [2, 7, 100])
def test_members_of_several_records(tmp_path, rng, monkeypatch, per_member):
    monkeypatch.setattr(warc, "READ_BYTES", 1500)
    contents = some_records(rng, 40)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(warc.gzip_member(b"".join(contents[k : k + per_member])) for k in range(0, 40, per_member)))
    size, found = path.stat().st_size, []
    with fs.LocalFileSystem().open_input_file(str(path)) as handle:
        for start in range(0, size, 5000):
            found += [c for _, c in warc.members(warc._Bytes(handle), start, start + 5000, "a")]
    assert found == contents


def test_foreign_archive_in_one_member_is_read_whole(spark, tmp_path, rng):
    contents = some_records(rng, 200)
    (tmp_path / "warc").mkdir()
    (tmp_path / "warc" / "foreign.warc.gz").write_bytes(gzip.compress(b"".join(contents)))
    rows = warc.read_archives(spark, str(tmp_path / "warc"), split_bytes=20_000).collect()
    assert sorted(bytes(r["payload"]) for r in rows) == sorted(warc.parse_record(c)["payload"] for c in contents)


def test_long_gzip_header(tmp_path, rng):
    contents, packed = some_records(rng, 3), io.BytesIO()
    for content in contents:
        with gzip.GzipFile(filename="n" * 5000, mode="wb", fileobj=packed) as out:
            out.write(content)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(packed.getvalue())
    with fs.LocalFileSystem().open_input_file(str(path)) as handle:
        assert [c for _, c in warc.members(warc._Bytes(handle), 0, 10**6, "a")] == contents


@pytest.mark.parametrize("tail", [b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort", b"WARC/1.1\r\nno end", b"else", b"WARC/1.1\r\nA: b\r\n\r\n"])
def test_rests_that_are_no_record_are_reported(tmp_path, rng, tail):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(warc.gzip_member(some_records(rng, 1)[0] + tail))
    with fs.LocalFileSystem().open_input_file(str(path)) as handle, pytest.raises(ValueError, match="damaged"):
        list(warc.members(warc._Bytes(handle), 0, 10**6, "a"))


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"], None) for r in pages.collect()]
    assert Counter(map(tuple, warc.archive_report(pages).collect())) == expected(rows)
