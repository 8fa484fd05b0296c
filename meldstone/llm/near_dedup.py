"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds its distinct shingles of five words (A-Z in lower case; a shorter
text is one shingle). Documents are linked if the sets' Jaccard similarity is 0.75 or more;
a component of links is a class, named by its smallest id.

1. One pass makes a digest and a MinHash signature of each set. Documents with equal sets
   meet by digest and go on as one, the smallest id.
2. The signature gives ``TREES`` orders. Each order sorts documents by a label of
   ``LABEL_DEPTH`` hashes; a region is a stretch of equal first ``LEAST_DEPTH`` hashes. All
   orders are range-partitioned and sorted in one exchange, so a region of any size is
   spread over tasks. Each document meets its ``REACH`` neighbours to either side, the ones
   with the longest common prefix of labels: where a region is dense, these agree far
   beyond LEAST_DEPTH; where it is sparse, LEAST_DEPTH is enough. That is the adaptive depth.
3. Links are confirmed on full sets from whole texts: first the best partner of each
   document, then the other candidates that still lie in different components.
4. In regions wider than REACH that hold several components by then, members outside of
   the largest component are compared with all members of others, on full sets and block
   by block, so that no task holds a region and only links leave a task. So every pair that
   shares a region is confirmed, refused, or already in one component. A large group of
   near copies is one component by then and costs nothing.

A pair of similarity 0.75 shares a region in one order with probability 0.75^4 = 0.32, in
none of 24 orders with 0.0001; above 0.8 with less than 0.00001.

Defined results: NULL, empty and blank texts have an empty set and link with nothing;
rows that share an id are one document with several texts; a row with a NULL id links with
nothing, has a NULL component and is kept; other columns pass untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldstone.llm.common import batches_of, bounded_task, free_name, share_package
from meldstone.operators.clusters import connected_components
from meldstone.sources.storage import materialise

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 75
TREES = 24
LABEL_DEPTH = 8
LEAST_DEPTH = 4
REACH = 4
#: Members of a wide region, and shingles of them, that a task holds for each side.
BLOCK_MEMBERS = 2048
BLOCK_SHINGLES = 1_000_000
#: Shingles whose matrix a task holds at a time.
BLOCK_COLUMNS = 2048

_HASH_BYTES = 2
_LABEL_BYTES = LABEL_DEPTH * _HASH_BYTES
_HASHES = TREES * LABEL_DEPTH
_RANDOM = np.random.default_rng(20)
_MASKS = _RANDOM.integers(0, 1 << 32, (_HASHES, 1), dtype=np.uint32)
_FACTORS = _RANDOM.integers(0, 1 << 32, (_HASHES, 1), dtype=np.uint32) | np.uint32(1)
_WEIGHTS = _RANDOM.integers(0, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) | np.uint64(1)
_NAME = "near_dedup"
# Texts go to Python in batches of so many rows, pairs of texts likewise.
_BATCH_TEXTS = 1000
# Hashes of a long text are worked off in pieces of this many shingles.
_PIECE = 4096


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(words) < SHINGLE_WORDS:
        whole = b" ".join(words)
        return np.array([xxhash.xxh64_intdigest(whole, seed=1)], dtype=np.uint64)
    count = len(words) - SHINGLE_WORDS + 1
    mixed = np.zeros(count, dtype=np.uint64)
    for place, weight in enumerate(_WEIGHTS):
        mixed = (mixed ^ (mixed >> np.uint64(29))) + hashes[place : place + count] * weight
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def signature(hashes: np.ndarray) -> bytes:
    """Labels of all trees: LABEL_DEPTH hashes of two bytes for each."""
    least = np.full(_HASHES, 0xFFFFFFFF, dtype=np.uint32)
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(small), _PIECE):
        piece = (small[start : start + _PIECE] ^ _MASKS) * _FACTORS
        np.minimum(least, piece.min(axis=1), out=least)
    return (least & np.uint32(0xFFFF)).astype(">u2").tobytes()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * shared >= SIMILAR_PERCENT * (len(a) + len(b) - shared)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            hashes = shingle_hashes(text)
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            rows.append((len(hashes), digest, signature(hashes) if len(hashes) else None))
        found = pd.DataFrame(rows, columns=["n_shingles", "digest", "labels"])
        found.insert(0, "doc_id", batch["doc_id"].array)
        yield found


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, labels) of each row that has an id."""
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    return rows.mapInPandas(bounded_task(_NAME, _sets), "doc_id bigint, n_shingles bigint, digest binary, labels binary")


NEIGHBOUR_SCHEMA = "kind string, tree int, label binary, a bigint, b bigint, n bigint, depth int"


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows sorted by (tree, label, a): neighbours, members of wide regions, edges.

    ``pair`` rows are neighbours of one region with their common depth; ``dense`` rows are
    members with a fellow out of reach; ``edge`` rows are the first and last of the
    partition, whose neighbours may lie in the next one.
    """
    reach, first, last = REACH + 1, True, None
    for batch in batches:
        rows = batch if last is None else pd.concat([last, batch], ignore_index=True)
        if first and len(rows):
            yield rows.head(reach).assign(kind="edge", b=0, depth=0)
            first = False
        begin = 0 if last is None else len(last)
        tree, ids, sizes = (rows[c].to_numpy() for c in ("tree", "a", "n"))
        halves = np.frombuffer(b"".join(rows["label"]), dtype=">u8").reshape(len(rows), -1).astype(np.uint64)
        region, deeper = halves[:, 0], halves[:, 1]
        out = np.zeros(len(rows), dtype=bool)
        for distance in range(1, reach + 1):
            right = np.arange(max(distance, begin), len(rows))
            left = right - distance
            together = (tree[left] == tree[right]) & (region[left] == region[right])
            left, right = left[together], right[together]
            if distance == reach:
                out[left] = out[right] = True
                break
            fits = 100 * np.minimum(sizes[left], sizes[right]) >= SIMILAR_PERCENT * np.maximum(sizes[left], sizes[right])
            fits &= ids[left] != ids[right]
            left, right = left[fits], right[fits]
            differ = deeper[left] ^ deeper[right]
            depth = LEAST_DEPTH + sum((differ >> np.uint64(shift) == 0).astype(np.int64) for shift in (48, 32, 16, 0))
            yield pd.DataFrame(
                {
                    "kind": "pair",
                    "tree": 0,
                    "label": b"",
                    "a": np.minimum(ids[left], ids[right]),
                    "b": np.maximum(ids[left], ids[right]),
                    "n": 0,
                    "depth": depth,
                }
            )
        yield rows[out].assign(kind="dense", b=0, depth=0)
        last = rows.tail(reach)
    if last is not None:
        yield last.assign(kind="edge", b=0, depth=0)


def candidates(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Neighbour pairs (a, b, weight), and members (tree, region, id, n) of wide regions."""
    label = lambda t: F.substring("labels", t * _LABEL_BYTES + 1, _LABEL_BYTES)
    rows = sets.select(
        F.posexplode(F.array(*[label(t) for t in range(TREES)])).alias("tree", "label"),
        F.col("doc_id").alias("a"),
        F.col("n_shingles").alias("n"),
    )
    order = ["tree", "label", "a"]
    near = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    near = materialise(near.mapInPandas(bounded_task(_NAME, _neighbours), NEIGHBOUR_SCHEMA), "neighbours")
    # A few rows from each end of each partition: those next to each other across a cut.
    edges = near.where("kind = 'edge'").select("tree", "label", "a", "n").distinct()
    across = edges.repartition(1).sortWithinPartitions(*order).mapInPandas(bounded_task(_NAME, _neighbours), NEIGHBOUR_SCHEMA)
    both = near.unionByName(across)
    pairs = both.where("kind = 'pair'").groupBy("a", "b").agg(F.sum("depth").alias("weight"))
    region = F.substring("label", 1, LEAST_DEPTH * _HASH_BYTES).alias("region")
    dense = both.where("kind = 'dense'").select("tree", region, F.col("a").alias("id"), "n").distinct()
    return materialise(pairs, "pairs"), materialise(dense, "dense")


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        linked = [similar(shingle_hashes(x), shingle_hashes(y)) for x, y in zip(batch["text_a"], batch["text_b"], strict=True)]
        yield batch.loc[linked, ["a", "b"]]


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar, as a written table."""
    named = lambda side: texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))
    both = pairs.select("a", "b").hint("merge").join(named("a"), "a").hint("merge").join(named("b"), "b")
    with batches_of(pairs.sparkSession, _BATCH_TEXTS // 2):
        return materialise(both.mapInPandas(bounded_task(_NAME, _confirm), "a bigint, b bigint").distinct(), "links")


def _components(links: DataFrame) -> DataFrame:
    return connected_components(links.select(F.col("a").alias("id_a"), F.col("b").alias("id_b")))


def _apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    for side in ("a", "b"):
        pairs = pairs.join(
            components.select(F.col("id").alias(side), F.col("cluster_id").alias(f"in_{side}")), side, "left"
        )
    return pairs.where(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).drop("in_a", "in_b")


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        hashes = [shingle_hashes(text).tobytes() for text in batch["text"]]
        yield pd.DataFrame({"id": batch["doc_id"], "hashes": hashes})


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common hashes of each left with each right set, as a matrix."""
    sizes = [len(x) for x in (*left, *right)]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, holders = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    several = holders[column] > 1
    owner, column = owner[several], np.unique(column[several], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, BLOCK_COLUMNS):
        low, high = np.searchsorted(column, [start, start + BLOCK_COLUMNS])
        marks = np.zeros((len(sizes), BLOCK_COLUMNS), dtype=np.float32)
        marks[owner[low:high], column[low:high] - start] = 1
        shared += marks[: len(left)] @ marks[len(left) :].T
    return shared


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the left and the right members of one pair of blocks, on full sets."""
    sets = [np.frombuffer(h, dtype=np.uint64) for h in rows["hashes"]]
    side = rows["side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    ids, parts = rows["id"].to_numpy(), rows["part"].to_numpy()
    sizes = np.array([len(s) for s in sets])
    shared = _shared([sets[i] for i in left], [sets[i] for i in right])
    whole = sizes[left][:, None] + sizes[right][None, :] - shared
    del sets
    x, y = np.nonzero((100 * shared >= SIMILAR_PERCENT * whole) & (parts[left][:, None] != parts[right][None, :]))
    return pd.DataFrame({"a": np.minimum(ids[left[x]], ids[right[y]]), "b": np.maximum(ids[left[x]], ids[right[y]])})


def wide_region_links(dense: DataFrame, components: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between different components inside of wide regions, on full sets.

    Members outside of a region's largest component meet all its members; those inside have
    nothing to find among each other. A region is dealt over blocks of at most about
    BLOCK_MEMBERS members and BLOCK_SHINGLES shingles; a task compares one pair of blocks
    and gives links only.
    """
    members = dense.join(components, "id", "left").withColumn("part", F.coalesce("cluster_id", "id")).drop("cluster_id")
    parts = members.groupBy("tree", "region", "part").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    regions = parts.groupBy("tree", "region").agg(
        F.max(F.struct("size", "part")).alias("top"),
        F.count("*").alias("parts"),
        F.greatest(F.sum("size") / BLOCK_MEMBERS, F.sum("n") / BLOCK_SHINGLES).alias("fill"),
    )
    mixed = regions.where("parts > 1").select("tree", "region", F.col("top.part").alias("top"), F.ceil("fill").alias("blocks"))
    chosen = materialise(members.join(mixed, ["tree", "region"]), "mixed")
    ids = chosen.select(F.col("id").alias("doc_id")).distinct()
    with batches_of(dense.sparkSession, _BATCH_TEXTS):
        sets = materialise(texts.join(ids.hint("merge"), "doc_id").mapInPandas(bounded_task(_NAME, _packed), "id bigint, hashes binary"), "hashes")
    own, all_blocks = F.pmod(F.xxhash64("id"), F.col("blocks")), F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    left = chosen.where("part != top").select("*", own.alias("l"), F.explode(all_blocks).alias("r"), F.lit(0).alias("side"))
    right = chosen.select("*", F.explode(all_blocks).alias("l"), own.alias("r"), F.lit(1).alias("side"))
    dealt = left.unionByName(right).join(sets.hint("merge"), "id").select("tree", "region", "l", "r", "side", "id", "part", "hashes")
    found = dealt.groupBy("tree", "region", "l", "r").applyInPandas(_block_links, "a bigint, b bigint")
    return materialise(found.distinct(), "wide-links")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs`` with an id."""
    share_package(docs.sparkSession)
    with batches_of(docs.sparkSession, _BATCH_TEXTS):
        sets = materialise(shingle_sets(docs), "sets")
    firsts = sets.where("n_shingles > 0").groupBy("digest")
    distinct = firsts.agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("labels").alias("labels")
    )
    distinct = materialise(distinct, "distinct")
    pairs, dense = candidates(distinct)
    ids = pairs.select("a").union(pairs.select("b")).union(dense.select("id")).toDF("doc_id").distinct()
    # Joins with texts are merges at every size: what they move grows in proportion.
    texts = materialise(docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi"), "texts")

    best = pairs.groupBy("b").agg(F.max(F.struct("weight", (-F.col("a")).alias("a"))).alias("best"))
    best = materialise(best.select((-F.col("best.a")).alias("a"), "b"), "best")
    links = confirmed(best, texts)
    components = _components(links)
    others = _apart(pairs.join(best, ["a", "b"], "left_anti"), components)
    links = links.union(confirmed(others, texts))
    if not dense.isEmpty():
        links = links.union(wide_region_links(dense, _components(links), texts))

    # Documents of equal sets hang on the smallest of them.
    copies = sets.where("n_shingles > 0").join(distinct.select("digest", F.col("doc_id").alias("first")), "digest")
    copies = copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).where("a != b")
    classes = _components(links.union(copies.distinct()))
    named = sets.select("doc_id", "n_shingles").join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("cluster_id", "doc_id").alias("component_id"))


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """Per document: size of its set, its component, and whether it is the one to keep."""
    nameless = docs.where(F.col("doc_id").isNull()).select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"))
    rows = near_duplicate_classes(docs).unionByName(nameless.withColumn("component_id", F.lit(None).cast("bigint")))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents whose id names their class; rows without an id all stay."""
    dropped = free_name(docs, "dropped")
    others = near_duplicate_classes(docs).where("doc_id != component_id").select(F.col("doc_id").alias(dropped)).distinct()
    return docs.join(others, F.col("doc_id") == F.col(dropped), "left_anti")
