import random
from collections import defaultdict

import numpy as np
import pytest

from meldstone.llm import near_dedup

SCHEMA = "doc_id bigint, text string, dropped string"


def plain_sets(docs):
    sets = defaultdict(list)
    for doc_id, text, *_ in docs:
        words = (text or "").encode().lower().split()
        shingles = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        sets[doc_id].append(shingles)
    return sets


def plain_components(docs):
    sets = plain_sets(docs)
    sets.pop(None, None)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(set)
    for i, several in sets.items():
        for s in several:
            for shingle in s:
                holders[shingle].add(i)
    seen = set()
    for ids in holders.values():
        ids = sorted(ids)
        for x in range(len(ids)):
            for y in range(x + 1, len(ids)):
                pair = (ids[x], ids[y])
                if pair in seen:
                    continue
                seen.add(pair)
                if any(100 * len(s & t) >= 75 * len(s | t) for s in sets[pair[0]] for t in sets[pair[1]]):
                    a, b = sorted(map(root, pair))
                    parent[b] = a
    return {i: root(i) for i in sets}


def invented(rng, count):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    docs = []
    for i in range(count):
        if docs and rng.random() < 0.6:
            body = rng.choice(docs)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
                at = rng.randrange(len(body))
                body[at : at + rng.randrange(2)] = [rng.choice(words)]
        else:
            body = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 80, 300]))]
        docs.append((i, " ".join(body), None))
    rng.shuffle(docs)
    return docs


def check(spark, docs, columns=SCHEMA):
    rows = near_dedup.near_duplicate_report(spark.createDataFrame(docs, columns).repartition(6)).collect()
    want = plain_components(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return rows


def test_components_equal_all_pairs(spark, rng):
    docs = invented(rng, 700)
    rows = check(spark, docs)
    sets = plain_sets(docs)
    assert all(r["n_shingles"] == len(sets[r["doc_id"]][0]) for r in rows)


@pytest.mark.parametrize("members", [60, 2048])
def test_large_group_of_near_copies_and_a_common_passage(spark, rng, monkeypatch, members):
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(near_dedup, "BLOCK_COLUMNS", 100)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(120)]
    docs = []
    for i in range(400):
        body = list(base)
        for _ in range(rng.randrange(1, 7)):
            body[rng.randrange(len(body))] = word()
        docs.append((i, " ".join(body), None))
    passage = [word() for _ in range(60)]
    for i in range(400, 700):
        docs.append((i, " ".join(passage + [word() for _ in range(rng.choice([6, 15, 25]))]), None))
    check(spark, docs)


def test_nulls_empty_long_repeated(spark):
    long = " ".join(f"w{i % 5000}x{i % 77}" for i in range(150_000))
    docs = [(1, None, "x"), (2, "", None), (3, " \n\t", None), (4, "one two", None), (5, "ONE  two", "y"), (6, long, None)]
    docs += [(7, long + " tail", None), (None, "one two", None), (None, None, None), (4, "one two", None), (9, "É a b c", None), (8, "é a b c", None)]
    rows = check(spark, docs)
    assert {r["doc_id"] for r in rows if not r["kept"]} == {5, 7}
    frame = spark.createDataFrame(docs, SCHEMA)
    kept = near_dedup.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 3, 4, 4, 6, 8, 9, None, None], key=str)
    assert near_dedup.near_duplicate_report(frame.limit(0)).count() == 0


def test_one_region_over_many_partitions(spark, monkeypatch, rng):
    """Regions cut by partitions keep the neighbours across the cut."""
    docs = [(i, "same words here as in all of them " * 3 + f"{i % 40}", None) for i in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        check(spark, docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("size", [1, 5, 4096, 9000])
def test_signature_estimates_similarity(size):
    rng = random.Random(size)
    shared = [rng.getrandbits(64) for _ in range(size)]
    own = lambda: [rng.getrandbits(64) for _ in range(size // 6)]
    a, b = (np.unique(np.array(shared + own(), dtype=np.uint64)) for _ in range(2))
    left, right = (np.frombuffer(near_dedup.signature(x), ">u2") for x in (a, b))
    true = size / (len(a) + len(b) - size)
    assert abs((left == right).mean() - true) < 0.13
