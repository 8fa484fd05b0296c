import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meldstone.llm import decontamination as dc

SCHEMA = "doc_id bigint, text string, id string, record_key int"


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain(docs, items, cut):
    """Similarity of every item-sized window of every document to every item.

    With ``cut``, windows may reach beyond the ends of the document.
    """
    found = set()
    listed = [(i, (t or "").lower().split()) for i, t in items]
    for place, (_, text, *_) in enumerate(docs):
        words = (text or "").lower().split()
        for item_id, item in listed:
            n, want = len(item), shingles(item)
            if n < 5:
                continue
            starts = range(-n + 5, len(words) - 4) if cut else range(max(1, len(words) - n + 1))
            for start in starts:
                have = shingles(words[max(start, 0) : start + n])
                shared = sum((have & want).values())
                if shared and 100 * shared >= 75 * sum((have | want).values()):
                    found.add((place, item_id))
    return found


def invented(rng):
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 5))) for _ in range(200)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, some(rng.randrange(16, 60))) for i in range(20)]
    docs = []
    for i in range(90):
        body = some(rng.randrange(0, 120))
        for _ in range(rng.choice([0, 1, 1, 2])):
            passage = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(passage))
                passage[at : at + rng.randrange(2)] = some(rng.randrange(2))
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        docs.append((i, " ".join(body).title(), "x", 1))
    return docs, [(i, " ".join(w)) for i, w in items]


def test_passages_equal_all_windows(spark):
    wanted = both = 0
    for seed in range(3):
        docs, items = invented(random.Random(seed))
        report = dc.contamination_report(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id bigint, text string"))
        rows = report.collect()
        assert len(rows) == len(docs)
        found = {(r["doc_id"], int(i)) for r in rows for i in r["item_ids"].split(",") if i}
        want = plain(docs, items, cut=False)
        assert found <= plain(docs, items, cut=True)
        wanted, both = wanted + len(want), both + len(found & want)
    assert both >= 0.99 * wanted > 50


def test_exact_passages_are_always_found(spark):
    path = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/benchmark.parquet")
    report = dc.contamination_report(docs, items)
    pairs = {(r["doc_id"], int(i)) for r in report.collect() for i in r["item_ids"].split(",") if i}
    inside = docs.crossJoin(F.broadcast(items.select("item_id", F.col("text").alias("item")))).where(F.contains("text", "item"))
    exact = {(r["doc_id"], r["item_id"]) for r in inside.select("doc_id", "item_id").collect()}
    assert exact and exact <= pairs and report.count() == docs.count()
    plans = report._jdf.queryExecution().toString()
    assert not any(word in plans for word in ("Python", "Arrow", "Pandas", "Cartesian"))


def test_fingerprints_within_the_radius_meet(spark, rng):
    mask = (1 << dc._BLOCK_BITS) - 1
    blocks = lambda v: [(v >> (k * dc._BLOCK_BITS)) & mask for k in range(dc.BLOCKS)]
    items, windows = dc.flips(dc.ITEM_FLIPS), dc.flips(dc.WINDOW_FLIPS)
    reached = {i ^ w for i in items for w in windows}
    assert reached == set(dc.flips(dc.RADIUS // dc.BLOCKS))
    for i in range(1000):
        a = b = rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randrange(dc.RADIUS + 1)):
            b ^= 1 << bit
        assert any(x ^ y in reached for x, y in zip(blocks(a), blocks(b), strict=True))


def test_candidates_are_few_among_many_items_of_one_length(spark, rng):
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(5000)]
    some = lambda: [rng.choice(vocabulary) for _ in range(30)]
    items = spark.createDataFrame([(i, some(), 30) for i in range(3000)], "item_no long, item array<string>, n int")
    cut = items.where("item_no < 300").select(F.col("item_no").alias("window_no"), F.col("item").alias("window"), "n")
    met = dc._blocks(cut, "window", "window_no", dc.WINDOW_FLIPS).join(
        dc._blocks(items, "item", "item_no", dc.ITEM_FLIPS).drop("print"), ["which", "n", "block", "value"]
    )
    # Calculated for fair bits: 1 - (1 - 697 / 2**16) ** 8, or 8.2 %; ties of even windows favour 0. 16 blocks of 4 bits met 87 %.
    assert met.select("window_no", "item_no").distinct().count() < 0.12 * 300 * 3000
    near = dc.candidates(items, cut)
    assert near.where("window_no = item_no").count() == 300 and near.count() < 400


def test_windows_need_three_quarters_of_known_shingles(spark):
    item = [f"w{i}" for i in range(24)]
    docs = [(1, " ".join(["x"] * 30 + item + ["x"] * 30), "a", 1), (2, " ".join(item[:17]), "a", 1)]
    docs += [(3, " ".join(item[:12]) + " y " + " ".join(item[13:]), "a", 1)]
    items = dc._items(spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string"))
    rows = dc._places(spark.createDataFrame(docs, SCHEMA), items).collect()
    # Of 20 shingles: windows up to five words beside the passage hold 15; 13 and 15 are left in the others.
    assert sorted((r["id"], r["start"]) for r in rows) == [(1, s) for s in range(30, 31)] + [(3, 0)]


def test_fingerprint_is_a_majority(spark):
    words = ["one", "two", "two", "three", "four"]
    frame = spark.createDataFrame([(words,)], "w array<string>")
    value, hashes = frame.select(dc.fingerprint(F.col("w"), 1), F.transform("w", lambda x: F.xxhash64(x, F.lit(1)))).first()
    for bit in range(64):
        ones = sum((h >> bit) & 1 for h in hashes)
        assert ((value % 2**64) >> (63 - bit)) & 1 == (2 * ones > len(words))


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_nulls_short_items_copies_and_clashing_names(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "BROADCAST_BYTES", limit)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    docs = [(1, f"x {item} y", "a", 1), (1, "clean text of another row with the same id", "b", None), (None, item.upper(), None, 2)]
    docs += [(None, None, None, None), (2, "", "c", 3), (3, "alpha beta", "d", 4), (4, (item + " ") * 500, "e", 5), (4, (item + " ") * 500, "e", 5)]
    docs += [(6, " ".join(item.split()[:14]), "f", 6), (7, " ".join(item.split()[:8]), "f", 6), (8, "w " * 50_000, "g", 1)]
    items = [(5, item), (None, item), (9, "alpha beta"), (7, None), (8, "")]
    frame = spark.createDataFrame(docs, SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = dc.contamination_report(frame, benchmark).collect()
    assert Counter((r["doc_id"], r["contaminated"], r["item_ids"]) for r in rows) == Counter(
        [(1, True, "5,9"), (1, False, ""), (None, True, "5,9"), (None, False, ""), (2, False, ""), (3, True, "9"), (4, True, "5,9"),
         (4, True, "5,9"), (6, True, "5,9"), (7, True, "9"), (8, False, "")]
    )
    kept = dc.decontaminate(frame, benchmark)
    assert kept.columns == frame.columns and kept.count() == 4
    assert dc.decontaminate(frame, benchmark.limit(0)).count() == len(docs)
    assert dc.contamination_report(frame.limit(0), benchmark).count() == 0
