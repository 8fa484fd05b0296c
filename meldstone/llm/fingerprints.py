"""Document fingerprints by one-permutation MinHash with optimal densification.

A document's set holds its distinct shingles of five words (A-Z in lower case; a shorter
text is one shingle). Every shingle is hashed once. The upper bits of the hash choose one
of ``BINS`` bins, the rest competes for the bin's minimum. An empty bin takes over the
minimum of another bin: each bin has a random order of all bins, fixed for all documents,
and goes to the first one of its order that is filled. That is what hashing (bin, attempt)
until a filled bin is hit amounts to, and keeps bins independent of each other, so the
share of bins in which two documents agree estimates the Jaccard similarity of their sets.
Of each minimum, mixed with the number of its bin, only the lowest ``BITS`` bits are stored.
Two different minima still agree in these with probability 2^-BITS, in each bin anew even if
few minima fill them all; the likeness corrects for that.

Defined results: NULL is treated as the empty text; texts without a word have the empty
fingerprint, likeness 1 with each other and 0 with all others; texts are taken whole
whatever their length; equal texts have equal fingerprints.

The report puts documents in the order of their ids with one range exchange and compares
neighbours while walking over a partition; only the last document of each partition meets
the first of the next one in joins of one row per partition. Rows that share an id follow
each other by a hash of their text; rows with a NULL id come first. Every row has its
result, repeated rows theirs each. A single document is its own next one. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meldstone.llm.common import batches_of, share_package
from meldstone.llm.near_dedup import shingle_hashes
from meldstone.sources.storage import materialise

BINS = 1024
BITS = 2

_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_PER_BYTE = 8 // BITS
_LOW = np.uint64((1 << BITS) - 1)
_CHANCE = 2.0**-BITS
_SALTS = np.random.default_rng(12).integers(0, 1 << 63, BINS, dtype=np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Number of BITS-wide fields that are zero in each byte value.
_ZERO_FIELDS = np.array(
    [sum((value >> (BITS * k)) & ((1 << BITS) - 1) == 0 for k in range(_PER_BYTE)) for value in range(256)], dtype=np.int64
)
# A comparison of empty with filled bins of up to this size is done at once.
_AT_ONCE = 1 << 15
# Texts go to Python in batches of so many rows.
_BATCH_TEXTS = 500


class Orders:
    """The order in which each bin looks at all bins, and each bin's place in it."""

    _made: Orders | None = None

    def __init__(self):
        each = np.tile(np.arange(BINS, dtype=np.uint16), (BINS, 1))
        self.order = np.random.default_rng(11).permuted(each, axis=1)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order.astype(np.int64), each, axis=1)
        self.attempts = np.ascontiguousarray(self.order.T)

    @classmethod
    def get(cls) -> Orders:
        """One for each Python worker."""
        if cls._made is None:
            cls._made = cls()
        return cls._made

    def donors(self, filled: np.ndarray) -> np.ndarray:
        """For each bin the filled bin whose minimum it bears; ``filled`` has a True at least."""
        donor = np.arange(BINS)
        empty, full = np.flatnonzero(~filled), np.flatnonzero(filled)
        if len(empty) * len(full) <= _AT_ONCE:
            if len(empty):
                donor[empty] = full[self.place[np.ix_(empty, full)].argmin(axis=1)]
            return donor
        for tried in self.attempts:
            target = tried[empty]
            hit = filled[target]
            donor[empty[hit]] = target[hit]
            empty = empty[~hit]
            if not len(empty):
                break
        return donor


def minima(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(minimum of each bin, whether the bin is filled) of sorted distinct hashes."""
    bins = (hashes >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    least, filled = np.zeros(BINS, dtype=np.uint64), np.zeros(BINS, dtype=bool)
    least[bins[first]], filled[bins[first]] = hashes[first], True
    return least, filled


def fingerprint_of(text: str | None) -> bytes:
    """BITS bits of each of BINS densified minima; empty for a text without a word."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return b""
    least, filled = minima(hashes)
    mixed = (least[Orders.get().donors(filled)] ^ _SALTS) * _FACTOR
    low = ((mixed ^ (mixed >> np.uint64(32))) & _LOW).astype(np.uint8).reshape(-1, _PER_BYTE)
    packed = np.zeros(len(low), dtype=np.uint8)
    for k in range(_PER_BYTE):
        packed |= low[:, k] << np.uint8(BITS * k)
    return packed.tobytes()


def likeness_of(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity of the sets behind two fingerprints."""
    if not a or not b:
        return float(a == b)
    differ = np.frombuffer(a, dtype=np.uint8) ^ np.frombuffer(b, dtype=np.uint8)
    agreeing = _ZERO_FIELDS[differ].sum() / BINS
    return float(max(0.0, (agreeing - _CHANCE) / (1 - _CHANCE)))


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text as binary."""
    return F.pandas_udf(lambda texts: texts.map(fingerprint_of, na_action=None), "binary")(text)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1; NULL if one is."""

    def compare(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else likeness_of(x, y) for x, y in zip(left, right, strict=True)], dtype=float)

    return F.pandas_udf(compare, "double")(a, b)


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter gives way to the beginning of another text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


_DONE, _FIRST, _LAST = 0, 1, 2
_RESULT = "n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _result(text: str, own: bytes, next_text: str, next_own: bytes) -> tuple:
    changed = edited(text, next_text)
    changed_own = own if changed == text else fingerprint_of(changed)
    digest = hashlib.sha256(changed.encode("utf-8")).digest()
    return len(text), digest, own, changed_own, likeness_of(own, changed_own), likeness_of(own, next_own)


def _rows(found: list[tuple]) -> pd.DataFrame:
    names = ["kind", "part", "id", "text", *(c.split()[0] for c in _RESULT.split(", "))]
    return pd.DataFrame(found, columns=names, dtype=object)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of all documents of a sorted partition but the last one, whose next one lies elsewhere."""
    part, held = TaskContext.get().partitionId(), None
    nothing = (None,) * 6
    for batch in batches:
        found = []
        for key, text in zip(batch["id"], batch["text"], strict=True):
            text = text or ""
            key = None if pd.isna(key) else int(key)
            here = key, text, fingerprint_of(text)
            if held is None:
                found.append((_FIRST, part, key, text, *nothing))
            else:
                found.append((_DONE, part, held[0], None, *_result(held[1], held[2], text, here[2])))
            held = here
        yield _rows(found)
    if held is not None:
        yield _rows([(_LAST, part, held[0], held[1], *nothing)])


def _close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of the last documents of partitions, beside the first ones of the next partitions."""
    for batch in batches:
        found = [
            (_DONE, None, None if pd.isna(key) else int(key), None, *_result(text, fingerprint_of(text), other, fingerprint_of(other)))
            for key, text, other in zip(batch["id"], batch["text"], batch["next_text"], strict=True)
        ]
        yield _rows(found)


def neighbour_report(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and its likeness to that and to the next document."""
    spark = docs.sparkSession
    share_package(spark)
    schema = f"kind int, part int, id bigint, text string, {_RESULT}"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    with batches_of(spark, _BATCH_TEXTS):
        walked = materialise(ordered.mapInPandas(_walk, schema), "fingerprints")
        first, last = (walked.where(F.col("kind") == k).select("part", "id", "text") for k in (_FIRST, _LAST))
        # One row per partition that holds documents: small enough for a window without partitioning.
        ring = Window.orderBy("part")
        following = F.coalesce(F.lead("part").over(ring), F.min("part").over(Window.partitionBy()))
        pairs = first.select("part").withColumn("next_part", following)
        beginnings = first.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
        ends = last.join(pairs, "part").join(beginnings, "next_part").select("id", "text", "next_text")
        closed = materialise(ends.mapInPandas(_close, schema), "partition-ends")
    done = walked.where(F.col("kind") == _DONE).unionByName(closed)
    return done.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        *[F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
        "near_edited",
        "near_next",
    )
