"""Shards of near equal bytes through fixed virtual slots.

Every record is hashed into one of ``SLOTS`` virtual slots, bytes and rows are summed per
slot, and a stored, versioned map leads from slots to shards. Rebalancing never rehashes a
record: it edits the map, moving slots from the fullest shard to the emptiest one, and
stores the edit as the next version. Growing by a shard moves slots into the new shard
only. The law of the result is ``bytes``: sizes of shards near equal.

All per-record work is DataFrame code. The driver sees one row per slot, SLOTS at most.
Records of a shard are numbered from 0 without gaps by a range-partitioned sort on (shard,
virtual slot, id), so no shard, slot or id has to fit in one task.

The hash covers id, size and checksum: records that share an id, or a text, still spread.
Records equal in all three are told apart by their place in the table, so that one row
repeated a million times fills all slots alike.

Defined results: a NULL text has size 1 and checksum 0, as an empty one; NULL ids are
hashed like others; repeated rows are separate records with positions of their own; an
empty table gives empty shards; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldstone.operators.sequence import sequential_ids
from meldstone.sources.storage import list_folders, materialise, scratch_path

SLOTS = 4096
SHARDS = 8
#: Rebalancing ends once the fullest and the emptiest shard differ by this share of the mean.
TOLERANCE = 0.0005


def even_map(shards: int) -> list[int]:
    """Shard of each slot before anything is known about bytes."""
    return [slot * shards // SLOTS for slot in range(SLOTS)]


def rebalance(slot_map: list[int], slot_bytes: list[int], shards: int) -> list[int]:
    """The map after moving slots from the fullest to the emptiest shard until near equal."""
    edited = list(slot_map)
    load = [0] * shards
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(edited):
        load[shard] += slot_bytes[slot]
        held[shard].add(slot)
    allowed = TOLERANCE * sum(load) / shards
    while True:
        full = max(range(shards), key=lambda s: (load[s], -s))
        empty = min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        # A slot of less than the gap makes the two more equal, one of half of it most.
        movable = [s for s in held[full] if 0 < slot_bytes[s] < gap]
        if gap <= allowed or not movable:
            return edited
        slot = min(movable, key=lambda s: (abs(gap - 2 * slot_bytes[s]), s))
        edited[slot] = empty
        held[full].remove(slot)
        held[empty].add(slot)
        load[full] -= slot_bytes[slot]
        load[empty] += slot_bytes[slot]


def grow(slot_map: list[int], slot_bytes: list[int], shards: int) -> list[int]:
    """The map for ``shards`` + 1: each shard gives slots to the new one, none gets any."""
    edited = list(slot_map)
    target = sum(slot_bytes) / (shards + 1)
    load = [0] * shards
    for slot, shard in enumerate(slot_map):
        load[shard] += slot_bytes[slot]
    taken = 0
    for slot in sorted(range(SLOTS), key=lambda s: (-slot_bytes[s], s)):
        shard = slot_map[slot]
        if load[shard] - slot_bytes[slot] >= target and taken + slot_bytes[slot] <= target:
            edited[slot] = shards
            load[shard] -= slot_bytes[slot]
            taken += slot_bytes[slot]
    return edited


class SlotMapStore:
    """Versions of the slot-to-shard map in a folder; none is ever changed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def versions(self) -> list[int]:
        names = list_folders(self.spark, self.folder)
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def save(self, slot_map: list[int]) -> int:
        version = max(self.versions(), default=-1) + 1
        rows = self.spark.createDataFrame(list(enumerate(slot_map)), "virtual_slot int, shard int")
        rows.coalesce(1).write.parquet(f"{self.folder}/version={version}")
        return version

    def load(self, version: int | None = None) -> DataFrame:
        version = max(self.versions()) if version is None else version
        return self.spark.read.schema("virtual_slot int, shard int").parquet(f"{self.folder}/version={version}")


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, size, checksum, place and virtual slot of every record."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).cast("long").alias("text_crc32"),
    )
    rows = rows.withColumn("_hash", F.xxhash64("doc_id", "size", "text_crc32"))
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    repeated = rows.groupBy("_hash").agg(F.count("*").alias("n")).where("n > 1").select("_hash", F.lit(True).alias("_again"))
    key = F.when(F.col("_again"), F.xxhash64("_hash", "_row")).otherwise(F.col("_hash"))
    slot = F.pmod(key, F.lit(SLOTS)).cast("int")
    return rows.join(repeated, "_hash", "left").withColumn("virtual_slot", slot).drop("_hash", "_again")


def slot_totals(rows: DataFrame) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot."""
    slot_bytes, slot_rows = [0] * SLOTS, [0] * SLOTS
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        slot_bytes[r["virtual_slot"]], slot_rows[r["virtual_slot"]] = r["size"], r["n"]
    return slot_bytes, slot_rows


def shard_records(docs: DataFrame, store: SlotMapStore, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, shard, position) by the newest version of the map.

    An empty store gets the even map as its first version. The map is rebalanced on the
    bytes of ``docs`` and stored as a new version if that edits it.
    """
    rows = materialise(records(docs), "records")
    slot_bytes, slot_rows = slot_totals(rows)
    if not store.versions():
        store.save(even_map(shards))
    current = [r["shard"] for r in store.load().orderBy("virtual_slot").collect()]
    edited = rebalance(current, slot_bytes, shards)
    if edited != current:
        store.save(edited)
    first = [0] * (shards + 1)
    for slot, shard in enumerate(edited):
        first[shard + 1] += slot_rows[slot]
    for shard in range(shards):
        first[shard + 1] += first[shard]
    # The map has SLOTS rows, whatever the size of the data.
    placed = rows.join(F.broadcast(store.load()), "virtual_slot")
    keys = ["shard", "virtual_slot", "doc_id", "size", "text_crc32", "_row"]
    numbered = sequential_ids(placed, keys, "_place")
    start = F.element_at(F.array(*[F.lit(n) for n in first]).cast("array<bigint>"), F.col("shard") + 1)
    return numbered.withColumn("position", F.col("_place") - 1 - start).drop("_place", "_row")


def shard_report(docs: DataFrame) -> DataFrame:
    """All documents in shards 0 to 7 under the law ``bytes``."""
    spark = docs.sparkSession
    placed = shard_records(docs, SlotMapStore(spark, scratch_path(spark, "slot-map")))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
