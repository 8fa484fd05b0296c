"""Benchmark passages in documents, by SimHash fingerprints of item-sized windows.

A window has as many words as a benchmark item and lies where the item would lie if one of
the window's five-word shingles came from it. A window can only be similar to an item of its
length if three quarters of the item's shingles are known ones of items of that length, so
only such windows are formed: they are told by counting places, before any words are taken
from the texts, and nothing that matters is left out. Which item a window resembles is not
decided there.

Each window and each item gets ``FINGERPRINTS`` SimHash fingerprints of 64 bits over its
words. Fingerprints are cut into ``BLOCKS`` blocks of 16 bits. Two that differ in at most
``RADIUS`` bits differ in at most RADIUS // BLOCKS = 3 bits of some block, so the join of
the items' block values with up to ``ITEM_FLIPS`` bits flipped and the windows' with up to
``WINDOW_FLIPS`` finds every one within the radius. An unrelated window meets about one item
in twenty of its length there for each fingerprint, and the join's rows are numbers only.
What is within the radius is compared exactly: similarity is the sum of the smaller over the
sum of the larger weights of the shingles, a shingle's weight being its number of
occurrences; a passage is found from 0.75 on.

Everything is DataFrame code. The benchmark's shingles and fingerprints are rows of fixed
width; they and the places of windows are broadcast up to ``BROADCAST_BYTES`` and exchanged
beyond, by hash: then the texts of documents are exchanged once, to take the windows' words.
A fingerprint of one changed word in forty differs in about 5 bits; the second fingerprint
catches what the first misses by chance.

Defined results: case is ignored; NULL and empty texts have no windows; an item of fewer
than five words is a single shingle of all its words and found where they stand in a row;
items without words are never found; a window cut by the start or end of its document is
shorter than the item; items of NULL id take part, and are reported as NULL; rows equal in
id and text are one record, each of them gets its result; other columns pass untouched.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meldstone.llm.common import free_name, words
from meldstone.sources.storage import materialise

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 75
FINGERPRINTS = 2
BLOCKS = 4
RADIUS = 15
ITEM_FLIPS = 1
WINDOW_FLIPS = RADIUS // BLOCKS - ITEM_FLIPS
BROADCAST_BYTES = 32 << 20

_BITS = 64
_BLOCK_BITS = _BITS // BLOCKS


def _shingles(found: Column, size: int = SHINGLE_WORDS) -> Column:
    """Hashes of all runs of ``size`` words, in order."""
    count = F.size(found) - size + 1
    runs = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(found, i, F.lit(size))))
    return F.when(count >= 1, runs).otherwise(F.array().cast("array<bigint>"))


def _weights(found: Column, n: Column) -> Column:
    """Shingles for items of ``n`` words: runs of five words, or of all of them."""
    sized = F.when(n >= SHINGLE_WORDS, _shingles(found))
    for size in range(1, SHINGLE_WORDS):
        sized = sized.when(n == size, _shingles(found, size))
    return sized


def fingerprint(found: Column, seed: int) -> Column:
    """SimHash of an array of words: each bit is the majority over the words' hashes."""
    hashes = F.transform(found, lambda w: F.xxhash64(w, F.lit(seed)))
    ones = lambda bit: F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, bit).cast("int"))
    bits = F.transform(F.sequence(F.lit(0), F.lit(_BITS - 1)), lambda b: F.when(2 * ones(b) > F.size(found), 1).otherwise(0))
    # The bits as one number, the highest place first.
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda value, bit: F.shiftleft(value, 1).bitwiseOR(bit.cast("bigint")))


def similarity_counts(left: Column, right: Column) -> tuple[Column, Column]:
    """Sums of the smaller and of the larger weights of two arrays of shingles.

    Linear where one of both has no shingle twice, as usual.
    """
    count = lambda runs, run: F.size(F.filter(runs, lambda other: other == run))
    single = lambda runs: F.size(F.array_distinct(runs)) == F.size(runs)
    common = F.array_intersect(left, right)
    several = F.aggregate(common, F.lit(0), lambda n, run: n + F.least(count(left, run), count(right, run)))
    shared = F.when(single(left) | single(right), F.size(common)).otherwise(several)
    return shared, F.size(left) + F.size(right) - shared


def _items(benchmark: DataFrame) -> DataFrame:
    """Items of equal words as one row: number, words, their count, ids."""
    rows = benchmark.select("item_id", words(F.lower("text")).alias("item"))
    rows = rows.withColumn("n", F.size("item")).where(F.col("n") > 0)
    grouped = rows.groupBy("item", "n").agg(
        F.collect_set("item_id").alias("ids"), F.count_if(F.col("item_id").isNull()).alias("nameless")
    )
    return grouped.withColumn("item_no", F.monotonically_increasing_id())


#: Bytes that a row of a few numbers takes in a broadcast table, with its pointers.
_ROW_BYTES = 96


def _spread(numbers: DataFrame) -> DataFrame:
    """A written table of numbers, to be broadcast if its rows take at most BROADCAST_BYTES."""
    return F.broadcast(numbers) if numbers.count() * _ROW_BYTES <= BROADCAST_BYTES else numbers.hint("shuffle_merge")


def _keyed(docs: DataFrame, id_name: str, key_name: str) -> DataFrame:
    """Records: the id, 0 for NULL, and a key that tells NULL and the text."""
    return docs.withColumn(id_name, F.coalesce("doc_id", F.lit(0))).withColumn(
        key_name, F.xxhash64(F.col("doc_id").isNull(), "text")
    )


def _places(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(id, key, start, n): where windows lie that hold enough known shingles."""
    sizes = [r[0] for r in items.select(F.least("n", F.lit(SHINGLE_WORDS)).alias("size")).distinct().collect()]
    index = items.select("n", F.posexplode(_weights(F.col("item"), F.col("n"))).alias("offset", "hash")).distinct()
    index = materialise(index.withColumn("size", F.least("n", F.lit(SHINGLE_WORDS))), "item-shingles")
    rows = _keyed(docs.select("doc_id", "text"), "id", "key").select("id", "key", words(F.lower("text")).alias("found"))
    runs = F.array(
        *[F.struct(F.lit(m).alias("size"), _shingles(F.col("found"), m).alias("runs")) for m in sorted(sizes)]
    ).cast("array<struct<size:int,runs:array<bigint>>>")
    sized = rows.select("id", "key", F.explode(runs).alias("sized"))
    placed = sized.select("id", "key", F.col("sized.size").alias("size"), F.posexplode("sized.runs").alias("place", "hash"))
    met = placed.join(_spread(index), ["size", "hash"])
    # A window's known shingles are the known places before its end less those before its start.
    known = F.struct("place", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("start"))
    start = F.col("place") - F.col("offset")
    opens = F.struct(F.greatest(start, F.lit(0)).alias("place"), F.lit(-1).alias("kind"), start.alias("start"))
    closes = F.struct((start + F.col("n") - F.col("size")).alias("place"), F.lit(1).alias("kind"), start.alias("start"))
    events = met.select("id", "key", "n", "size", F.explode(F.array(known, opens, closes)).alias("event")).distinct()
    order = Window.partitionBy("id", "key", "n", "size").orderBy("event.place", "event.kind")
    before = F.count_if(F.col("event.kind") == 0).over(order.rowsBetween(Window.unboundedPreceding, 0))
    counted = events.withColumn("before", before).where("event.kind != 0")
    held = counted.groupBy("id", "key", "n", "size", "event.start").agg(F.sum(F.col("event.kind") * F.col("before")).alias("held"))
    enough = held.where(100 * F.col("held") >= SIMILAR_PERCENT * (F.col("n") - F.col("size") + 1))
    return enough.select("id", "key", "start", "n")


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(id, key, start, n, window): item-sized windows with enough known shingles, and their words."""
    places = materialise(_places(docs, items), "window-places")
    grouped = places.groupBy("id", "key").agg(F.collect_list(F.struct("start", "n")).alias("places"))
    small = places.count() * _ROW_BYTES <= BROADCAST_BYTES
    rows = _keyed(docs.select("doc_id", "text"), "id", "key").select("id", "key", "text")
    met = rows.join(F.broadcast(grouped) if small else grouped, ["id", "key"])
    found = met.select("id", "key", "places", words(F.lower("text")).alias("found"))
    cut = found.select("id", "key", "found", F.explode("places").alias("at"))
    first, last = F.greatest(F.col("at.start"), F.lit(0)), F.least(F.col("at.start") + F.col("at.n"), F.size("found"))
    window = F.slice("found", first + 1, last - first)
    rows = cut.select("id", "key", first.alias("start"), F.col("at.n").alias("n"), window.alias("window"))
    # Equal rows of documents bring equal windows; a window cut at the start may come with several lengths.
    return rows.distinct().withColumn("window_no", F.monotonically_increasing_id())


def flips(most: int) -> list[int]:
    """Masks of a block with at most ``most`` bits set."""
    return [sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(_BLOCK_BITS), k)]


def _blocks(rows: DataFrame, found: str, number: str, most: int) -> DataFrame:
    """(number, n, which, print, block, value): every block of every fingerprint, with up to ``most`` bits flipped."""
    prints = F.array(*[fingerprint(F.col(found), seed) for seed in range(FINGERPRINTS)])
    printed = rows.select(number, "n", F.posexplode(prints).alias("which", "print"))
    mask = (1 << _BLOCK_BITS) - 1
    values = F.array(*[F.shiftrightunsigned("print", b * _BLOCK_BITS).bitwiseAND(F.lit(mask)) for b in range(BLOCKS)])
    blocks = printed.select("*", F.posexplode(values).alias("block", "plain"))
    near = F.transform(F.array(*[F.lit(m) for m in flips(most)]), lambda m: F.col("plain").bitwiseXOR(m))
    return blocks.select(number, "n", "which", "print", "block", F.explode(near).alias("value"))


def candidates(items: DataFrame, cut: DataFrame) -> DataFrame:
    """(window_no, item_no) of equal length with a fingerprint within the radius."""
    known = materialise(_blocks(items, "item", "item_no", ITEM_FLIPS).withColumnRenamed("print", "item_print"), "item-blocks")
    met = _blocks(cut, "window", "window_no", WINDOW_FLIPS).join(_spread(known), ["which", "n", "block", "value"])
    near = met.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    return near.select("window_no", "item_no").distinct()


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(id, key, start, words, ids, nameless, shared, total) for each passage of an item in a record."""
    items = materialise(_items(benchmark), "items")
    cut = materialise(windows(docs, items), "windows")
    pairs = materialise(candidates(items, cut), "window-items")
    both = pairs.join(cut, "window_no").join(items.drop("n"), "item_no")
    shared, total = similarity_counts(_weights(F.col("window"), F.col("n")), _weights(F.col("item"), F.col("n")))
    compared = both.withColumn("shared", shared).withColumn("total", total)
    passages = compared.where(100 * F.col("shared") >= SIMILAR_PERCENT * F.col("total"))
    return passages.select("id", "key", "start", F.size("window").alias("words"), "ids", "nameless", "shared", "total")


def _by_record(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_passages(docs, benchmark)
    span = F.struct("start", (F.col("start") + F.col("words")).alias("end"))
    return found.groupBy("id", "key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids"),
        F.sum("nameless").alias("nameless"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.max(F.col("shared") / F.col("total")).alias("similarity"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    id_name, key_name = free_name(docs, "record_id"), free_name(docs, "record_key")
    found = find_passages(docs, benchmark).select(F.col("id").alias(id_name), F.col("key").alias(key_name)).distinct()
    kept = _keyed(docs, id_name, key_name).join(found, [id_name, key_name], "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: whether it holds passages, of which items, where (in words), how similar."""
    rows = docs.select("doc_id", "text")
    base = _keyed(rows, "id", "key").select("doc_id", "id", "key")
    joined = base.join(_by_record(rows, benchmark), ["id", "key"], "left")
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return joined.select(
        "doc_id",
        F.col("spans").isNotNull().alias("contaminated"),
        F.coalesce(F.array_join(F.col("item_ids").cast("array<string>"), ","), F.lit("")).alias("item_ids"),
        F.coalesce(listed, F.lit("")).alias("spans"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )
