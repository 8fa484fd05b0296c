"""WARC archives: one gzip member per record, written and read by Spark tasks.

Writing: each task writes one archive under a temporary name and moves it in place when it
is whole, so a repeated task replaces an archive by an equal one. Of records with equal
payloads of ``REVISIT_BYTES`` or more, the one with the largest id is a ``response`` and
the others are ``revisit`` records that refer to it. Payloads are exchanged once, by
digest; that exchange feeds an outer join, whose hot digests adaptive execution splits.

Reading: archives are cut into byte ranges of ``SPLIT_BYTES``. A task looks for the gzip
magic in its range, takes a candidate as a member if its first bytes inflate to a WARC
version line, however long the gzip header before them is, and owns the members that start
inside the range; the last one may end beyond it. After a member the next one starts at
once, so its bytes are not searched. Foreign archives may hold several records in a member:
all are read, with the member's offset. Memory holds one record, what is inflated at a time
and one read-ahead block.

Archives are opened through the file system of their URI, so the folder can be any that
both Spark and pyarrow reach.

Defined results: a NULL payload is empty; a NULL URL leaves its header out; a NULL id is
the smallest and is read back as NULL; of repeated ids at the top of a group all are
responses; an empty table gives no archive and reads back empty; other columns are not
read. Digests are SHA-1 of the full payload, in headers as Base32, in results as hex. A
member whose body is damaged, or does not consist of whole records, raises an error that
names archive and offset.
"""

from __future__ import annotations

import base64
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldstone.llm.common import share_package
from meldstone.sources.storage import scratch_path

REVISIT_BYTES = 1000
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
#: Ranges are dealt over as many tasks at most; each task reads its ranges one by one.
MOST_TASKS = 50_000

#: Fixed values of the format.
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
ID_PREFIX = "urn:page:"

_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; Spark writes file:/x where others expect file:///x."""
    return fs.FileSystem.from_uri(re.sub(r"^([a-z0-9]+):/(?!/)", r"\1:///", uri))


# Writing


def record_types(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Pages with payload, digest, record_type and refers_to."""
    content = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), content.alias("payload"))
    rows = rows.select(
        "*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    large = F.col("payload_bytes") >= REVISIT_BYTES
    groups = (
        rows.where(large)
        .groupBy(F.concat_ws(":", "digest", "payload_bytes").alias("_group"))
        .agg(F.max("page_id").alias("_newest"))
    )
    # Small records meet no group; their own key spreads them evenly.
    group = F.when(large, F.concat_ws(":", "digest", "payload_bytes")).otherwise(
        F.concat_ws(":", F.lit("small"), "page_id", F.xxhash64("url", "digest"))
    )
    joined = rows.withColumn("_group", group).join(groups, "_group", "left")
    older = F.col("_newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_newest"))
    return joined.select(
        "page_id",
        "url",
        F.when(~older, F.col("payload")).alias("payload"),
        "digest",
        "payload_bytes",
        F.when(older, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(older, F.col("_newest")).alias("refers_to"),
    )


def record_bytes(page_id, url, payload, digest: str, payload_bytes: int, record_type: str, refers_to) -> bytes:
    """One record before compression."""
    http = (
        "HTTP/1.1 200 OK\r\n"
        "Content-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {payload_bytes}\r\n\r\n"
    ).encode()
    block = http + (payload or b"" if record_type == "response" else b"")
    headers = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if record_type == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>")]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode("utf-8", "surrogatepass") + b"\r\n"
    return head + block + b"\r\n\r\n"


def gzip_member(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


RECORD_COLUMNS = ["page_id", "url", "payload", "digest", "payload_bytes", "record_type", "refers_to"]


def write_archives(pages: DataFrame, folder: str, **columns: str) -> int:
    """Write a record per row to archives in ``folder``; return the number of records."""
    share_package(pages.sparkSession)
    system, path = _open(folder)
    system.create_dir(path, recursive=True)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _open(folder)
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        waiting, count, out = f"{path}/_{uuid.uuid4().hex}.tmp", 0, None
        for batch in batches:
            batch = batch[RECORD_COLUMNS].astype(object)
            batch = batch.where(batch.notna(), None)
            for row in batch.itertuples(index=False, name=None):
                if out is None:
                    out = system.open_output_stream(waiting, compression=None)
                out.write(gzip_member(record_bytes(*row)))
                count += 1
        if out is not None:
            out.close()
            system.move(waiting, f"{path}/{name}")
            yield pd.DataFrame({"archive": [name], "records": [count]})

    # 64-bit ids with NULLs would reach pandas as floats; as text they stay exact.
    rows = record_types(pages, **columns).select(
        F.col("page_id").cast("string"), *RECORD_COLUMNS[1:-1], F.col("refers_to").cast("string")
    )
    written = rows.sortWithinPartitions("page_id", "url", "digest").mapInPandas(write, "archive string, records long")
    return written.agg(F.sum("records")).first()[0] or 0


# Reading


class _Bytes:
    """Sequential reads from any offset of a file, a block ahead."""

    def __init__(self, handle):
        self.handle, self.size = handle, handle.size()
        self.start, self.block = 0, b""

    def at(self, offset: int, least: int = 1) -> bytes:
        """What is known from ``offset`` on: ``least`` bytes or more, fewer at the end."""
        known = offset - self.start
        if known < 0 or known + least > len(self.block):
            length = min(max(READ_BYTES, least), self.size - offset)
            self.start, self.block, known = offset, self.handle.read_at(length, offset) if length > 0 else b"", 0
        return self.block[known:] if known else self.block


def starts_member(source: _Bytes, offset: int) -> bool:
    """Whether a gzip member that holds a WARC record begins at ``offset``."""
    head = source.at(offset, 18)
    if not head.startswith(MAGIC) or len(head) < 18 or head[3] & 0xE0:
        return False
    unpacker, at, content = zlib.decompressobj(31), offset, b""
    try:
        # A gzip header may be long: what is read grows until it ends.
        while len(content) < 7 and not unpacker.eof:
            block = source.at(at)[:1024]
            if not block:
                return False
            content += unpacker.decompress(block, 7 - len(content))
            at += len(block)
    except zlib.error:
        return False
    return content.startswith(b"WARC/1.")


class _Member:
    """The records of the member at ``offset``, inflated one by one; ``at`` ends behind it."""

    def __init__(self, source: _Bytes, offset: int, archive: str):
        self.source, self.offset, self.archive = source, offset, archive
        self.unpacker, self.at, self.held = zlib.decompressobj(31), offset, bytearray()

    def damaged(self, damage: object) -> ValueError:
        return ValueError(f"damaged record in {self.archive} at {self.offset}: {damage}")

    def fill(self, least: int) -> None:
        """Hold ``least`` bytes of content, fewer only at the member's end."""
        try:
            while len(self.held) < least and not self.unpacker.eof:
                block = self.unpacker.unconsumed_tail
                if not block:
                    block = self.source.at(self.at)
                    if not block:
                        raise zlib.error("the archive ends inside a member")
                    self.at += len(block)
                self.held += self.unpacker.decompress(block, READ_BYTES)
                if self.unpacker.eof:
                    self.at -= len(self.unpacker.unused_data)
        except zlib.error as damage:
            raise self.damaged(damage) from damage

    def head_end(self) -> int:
        """Where the headers of the next record end."""
        searched = 0
        while (end := self.held.find(b"\r\n\r\n", max(0, searched - 3))) < 0:
            searched = len(self.held)
            self.fill(searched + 1)
            if len(self.held) == searched:
                raise self.damaged("headers without an end")
        return end

    def records(self) -> Iterator[bytes]:
        self.fill(1)
        while self.held:
            if not self.held.startswith(b"WARC/1."[: len(self.held)]):
                raise self.damaged("no version line")
            end = self.head_end()
            length = _LENGTH.search(self.held, 0, end)
            if length is None:
                raise self.damaged("no length")
            total = end + 4 + int(length[1])
            self.fill(total + 4)
            if len(self.held) < total:
                raise self.damaged("content is shorter than its length")
            # The empty lines behind the content belong to it.
            while self.held[total : total + 1] in (b"\r", b"\n"):
                total += 1
                self.fill(total + 1)
            yield bytes(self.held[:total])
            del self.held[:total]
            self.fill(1)


def members(source: _Bytes, start: int, end: int, archive: str) -> Iterator[tuple[int, bytes]]:
    """Offset of the member and content of every record whose member starts in [start, end)."""
    at, end = start, min(end, source.size)
    while at < end:
        if starts_member(source, at):
            member = _Member(source, at, archive)
            for content in member.records():
                yield at, content
            at = member.at
            continue
        block = source.at(at, 1024)
        found = block.find(MAGIC, 1)
        # Without a hit, the last bytes could begin a magic that the next block ends.
        at += found if found > 0 else max(1, len(block) - len(MAGIC) + 1)


def parse_record(content: bytes) -> dict:
    """Headers and payload of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length: *(\d+)", http)
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    return {
        "warc_type": headers.get("warc-type"),
        "record_id": headers.get("warc-record-id", "").strip("<>"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
        "declared_digest": base64.b32decode(digest).hex() if digest else None,
        "declared_bytes": int(length[1]) if length else len(payload),
        "payload": None if headers.get("warc-type") == "revisit" else payload,
    }


READ_SCHEMA = (
    "archive string, offset long, warc_type string, record_id string, target_uri string, refers_to string, "
    "declared_digest string, declared_bytes long, payload binary"
)


def read_archives(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the archives in ``folder``, read by byte ranges."""
    share_package(spark)
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    sized = archives.where("length > 0").select("path", "length")
    total = sized.agg(F.sum(F.expr(f"(length - 1) div {split_bytes}L + 1"))).first()[0] or 1
    ranges = sized.select("path", F.explode(F.expr(f"sequence(0, length - 1, {split_bytes}L)")).alias("start"))
    # With a number given, adaptive execution does not merge these few rows into one task.
    ranges = ranges.repartition(min(total, MOST_TASKS), "path", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, start in zip(batch["path"], batch["start"], strict=True):
                system, path = _open(uri)
                with system.open_input_file(path) as handle:
                    rows, size = [], 0
                    for offset, content in members(_Bytes(handle), int(start), int(start) + split_bytes, uri):
                        rows.append({"archive": uri, "offset": offset} | parse_record(content))
                        size += len(content)
                        if size > split_bytes:
                            yield pd.DataFrame(rows)
                            rows, size = [], 0
                    if rows:
                        yield pd.DataFrame(rows)

    return ranges.mapInPandas(read, READ_SCHEMA)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write all pages, read them back, and give size, digest, type and reference of each."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archives(pages, folder)
    key = lambda c: F.nullif(F.regexp_replace(c, f"^{ID_PREFIX}", ""), F.lit("")).cast("long")
    full = F.col("warc_type") == "response"
    return read_archives(spark, folder).select(
        key("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        key("refers_to").alias("refers_to"),
    )
