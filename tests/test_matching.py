import itertools
import random

import pytest
from pyspark.sql import functions as F

from meldstone.operators import matching
from meldstone.operators.clusters import connected_components, entity_clusters
from meldstone.sources.storage import materialise

RECORDS = "id bigint, name string, block_key string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def brute_force(records):
    reps = {}
    for i, name, block in records:
        if block is not None:
            reps[(block, name)] = min(i, reps.get((block, name), i))
    found = {}
    for ((block_a, a), i), ((block_b, b), j) in itertools.combinations(reps.items(), 2):
        if block_a == block_b:
            d = distance(a, b)
            if d * 20 <= 3 * max(len(a), len(b)):
                found[(min(i, j), max(i, j))] = d
    for i, name, block in records:
        if block is not None and i != reps[(block, name)]:
            found[(reps[(block, name)], i)] = 0
    return found


def edited(rng, name, edits):
    for _ in range(edits):
        at = rng.randrange(len(name) + 1)
        kind = rng.choice("ids")
        if kind == "i":
            name = name[:at] + rng.choice("abcxyz019") + name[at:]
        elif kind == "d" and name:
            name = name[:at] + name[at + 1 :]
        else:
            name = name[:at] + rng.choice("abcxyz019") + name[at + 1 :]
    return name


def family(rng, stem, n, most_edits):
    return [edited(rng, stem, rng.randrange(most_edits + 1)) for _ in range(n)]


def sample(seed, lengths, shared="", n=12, most_edits=6):
    rng = random.Random(seed)
    names = []
    for length in lengths:
        stem = shared + "".join(rng.choice("abcdef0123456789") for _ in range(length - len(shared)))
        names += family(rng, stem, n, most_edits)
    rng.shuffle(names)
    return [(i, name, rng.choice(["north", "south"])) for i, name in enumerate(names, 1)]


def found(spark, records):
    frame = spark.createDataFrame(records, RECORDS)
    return {(r.id_a, r.id_b): r.distance for r in matching.fuzzy_matches(frame).collect()}


@pytest.mark.parametrize(
    "lengths, most_edits",
    [((1, 3, 6, 7, 8), 2), ((12, 13, 14, 17), 4), ((18, 19, 20, 21), 5), ((24, 27, 33, 40), 9), ((60,), 12)],
)
def test_no_pair_is_missed(spark, lengths, most_edits):
    records = sample(sum(lengths), lengths, most_edits=most_edits)
    assert found(spark, records) == brute_force(records)


def test_no_pair_is_missed_where_segments_are_common(spark):
    records = sample(3, (26, 30, 34, 39), shared="international business ", n=14, most_edits=7)
    records += [(1000 + i, n, "north") for i, (_, n, _) in enumerate(sample(5, (39,), shared="seller ", n=30))]
    assert found(spark, records) == brute_force(records)


def test_repeated_names_are_linked_to_the_first(spark):
    records = [(i, "Acme Trading House", "north") for i in (9, 4, 7)] + [(1, "Acme Trading Hause", "north")]
    records += [(20, "Acme Trading House", "south"), (21, "Acme Trading House", None), (22, "", "north"), (23, "", "north")]
    names = {(1, 4): 1, (4, 7): 0, (4, 9): 0}
    assert found(spark, records) == names
    frame = spark.createDataFrame(records, RECORDS)
    best = {r.id: (r.match_id, r.similarity) for r in matching.best_match(matching.fuzzy_matches(frame)).collect()}
    assert best[9] == (4, 1.0) and best[4] == (7, 1.0) and best[1][0] == 4 and 22 not in best


def test_threshold_edge(spark):
    base = "abcdefghij0123456789"
    three, four = "xyz" + base[3:], "wxyz" + base[4:]
    rows = spark.createDataFrame([(1, base, "b"), (2, three, "b")], RECORDS)
    match = matching.fuzzy_matches(rows).first()
    assert (match.distance, match.similarity) == (3, 0.85)
    assert matching.best_match(matching.fuzzy_matches(rows)).count() == 0
    assert found(spark, [(1, base, "b"), (2, four, "b")]) == {}


def test_candidates_cover_matches_once(spark):
    records = sample(11, (18, 25), n=25)
    frame = spark.createDataFrame(records, RECORDS)
    pairs = [(r.id_a, r.id_b) for r in matching.block_candidates(frame).collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    assert set(brute_force(records)) <= set(pairs)


def test_a_block_is_not_paired_all_with_all(spark):
    rng = random.Random(1)
    records = [(i, "".join(rng.choice("abcdefghijklmnop") for _ in range(16)), "one") for i in range(300)]
    assert matching.block_candidates(spark.createDataFrame(records, RECORDS)).count() < 100


def test_joins_on_signatures_never_broadcast(spark):
    frame = spark.createDataFrame(sample(2, (18, 30)), RECORDS)
    reps = matching.representatives(frame)
    plan = matching._short_pairs(reps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "CartesianProduct" not in plan


def components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "nothing"])
def test_components(spark, kind):
    rng = random.Random(5)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 40)] + [(100, 101)],
        "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(90)],
        "nothing": [],
    }[kind]
    edges = [(a, b) for a, b in edges if a != b]
    frame = spark.createDataFrame([tuple(rng.sample(e, 2)) for e in edges], "id_a bigint, id_b bigint")
    got = {r.id: r.cluster_id for r in connected_components(frame).collect()}
    assert got == components(edges)


def test_clusters_mark_chained_members(spark):
    base = "abcdefghij0123456789"
    near, far = "xyz" + base[3:], "xyz" + base[3:17] + "xyz"
    records = [(1, base, "b"), (2, near, "b"), (3, far, "b"), (4, "something else", "b"), (5, base, "c")]
    frame = spark.createDataFrame(records, RECORDS)
    rows = {r.id: r for r in entity_clusters(frame, matching.fuzzy_matches(frame)).collect()}
    assert {i: r.cluster_id for i, r in rows.items()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    assert rows[1].cluster_size == 3 and rows[4].cluster_size == 1
    assert [rows[i].is_chained for i in (1, 2, 3, 4)] == [False, False, True, False]
    assert rows[3].rep_similarity == 0.7 and rows[2].rep_similarity == 0.85


def test_potential_duplicates(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "corporate_name string")
    assert tuple(matching.potential_duplicates(rows).first()) == (5, 2)
    stats = matching.match_statistics({"x": rows, "y": rows.limit(2)})
    assert {r.source: r.entities for r in stats.collect()} == {"x": 6, "y": 2, "total": 8}


@pytest.mark.parametrize("dense", [1, 10**9])
def test_no_pair_is_missed_in_tiles_or_segments(spark, monkeypatch, dense):
    monkeypatch.setattr(matching, "FEW", 8)
    monkeypatch.setattr(matching, "DENSE", dense)
    monkeypatch.setattr(matching, "TILE", 7)
    records = sample(7, (24, 26, 33), shared="house of ", n=15, most_edits=6)
    records += [(1000 + i, f"customer {i:06d} {m} trading company", "north") for i, m in enumerate(["building", "furniture"] * 25)]
    records += [(2000 + i, f"customer {i * 97:09d}", "south") for i in range(40)]
    assert found(spark, records) == brute_force(records)


def test_names_that_differ_in_a_number_meet_once(spark, monkeypatch):
    monkeypatch.setattr(matching, "FEW", 8)
    records = [(i, f"customer {i:06d} building trading company", "north") for i in range(60)]
    reps = matching.representatives(spark.createDataFrame(records, RECORDS))
    met = [(r.id_a, r.id_b) for r in matching._long_pairs(matching.trimmed(reps)).collect()]
    assert len(met) == len(set(met)) == 60 * 59 // 2
    assert {r.rest for r in matching.trimmed(reps).collect()} == {f"{i:02d}" for i in range(60)}


def test_the_truth_is_found_without_signatures(spark, monkeypatch):
    monkeypatch.setattr(matching, "TILE", 5)
    records = sample(13, (8, 18, 25), n=12)
    reps = matching.representatives(spark.createDataFrame(records, RECORDS))
    truth = [(r.id_a, r.id_b) for r in matching.all_near_pairs(reps).collect()]
    assert len(truth) == len(set(truth))
    assert set(truth) == {pair for pair, distance in brute_force(records).items() if distance > 0}


@pytest.mark.parametrize("dense", [1, 10**9])
def test_pairs_of_two_old_names_are_left_out(spark, monkeypatch, dense):
    monkeypatch.setattr(matching, "FEW", 5)
    monkeypatch.setattr(matching, "DENSE", dense)
    records = sample(17, (26, 30), n=12)
    names = materialise(matching.representatives(spark.createDataFrame(records, RECORDS)), "names")
    none = spark.createDataFrame([], "id_a bigint, id_b bigint")
    got = matching.new_pairs(names.withColumn("new", F.col("id") % 3 == 0), none, matching.segment_signatures(names))
    got = [(r.id_a, r.id_b) for r in got.collect()]
    want = {(a, b) for (a, b), distance in brute_force(records).items() if distance > 0 and (a % 3 == 0 or b % 3 == 0)}
    assert len(got) == len(set(got)) and set(got) == want


def test_tiles_are_dealt_by_number_not_by_bytes(spark):
    names = materialise(matching.trimmed(matching.representatives(spark.createDataFrame(sample(19, (24, 26)), RECORDS))), "names")
    lengths = matching._length_pairs(names)
    plan = matching._tiled_pairs(names, lengths)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("REPARTITION_BY_NUM" in line for line in plan) == 2
    assert not [line for line in plan if "hashpartitioning(tile" in line and "ENSURE_REQUIREMENTS" in line]


def test_tiles_find_the_distance_of_names_of_words(spark):
    rng = random.Random(23)
    words = ["anna", "annas", "lamp", "lamps", "a", "aa", "house", "mouse", "11", "12"]
    tails = [" ".join(rng.sample(words, 4)) for _ in range(3)]
    names = {f"{rng.choice(words)} {rng.choice(tails)} {rng.choice(words)}" for _ in range(90)}
    records = [(i, name, "one") for i, name in enumerate(sorted(n for n in names if len(n) >= 20))]
    reps = matching.trimmed(matching.representatives(spark.createDataFrame(records, RECORDS)))
    got = {(r.id_a, r.id_b): r.distance for r in matching._tiled_pairs(reps, matching._length_pairs(reps)).collect()}
    assert got == brute_force(records) and len(got) > 10


def test_variants_come_once_each(spark):
    names = ["aabbab", "abcabc", "aaaa", "ab", "a"]
    frame = spark.createDataFrame([(i, n, b) for i, n in enumerate(names) for b in (1, 2)], "id int, rest string, budget int")
    got = [(r.rest, r.budget, r.variant) for r in matching._with_variants(frame.withColumnRenamed("budget", "wanted"), F.col("wanted")).collect()]
    want = {
        (n, min(b, len(n)), "".join(kept)) for n in names for b in (1, 2) for kept in itertools.combinations(n, max(len(n) - b, 0))
    }
    assert set(got) == want
    assert len([g for g in got if len(g[0]) > 1]) == len([w for n in names if len(n) > 1 for w in want if w[0] == n])


def test_only_lengths_that_a_block_has_are_looked_for(spark):
    rows = [(1, "customer 000000017", "x"), (2, "customer 000000071", "x"), (3, "customer 0000000017", "y")]
    reps = matching.representatives(spark.createDataFrame(rows, RECORDS))
    assert matching._signed(matching.trimmed(reps)).where("NOT longest").isEmpty()


def test_best_match_exchanges_no_pairs(spark):
    records = sample(29, (9, 14, 18, 24), n=20, most_edits=3)
    frame = spark.createDataFrame(records, RECORDS)
    matches = matching.fuzzy_matches(frame, once=False)
    best = {r.id: (r.match_id, r.similarity) for r in matching.best_match(matches).collect()}
    assert best == {r.id: (r.match_id, r.similarity) for r in matching.best_match(matching.fuzzy_matches(frame)).collect()}
    short = spark.createDataFrame(sample(31, (9, 14), n=20), RECORDS)
    plan = matching.best_match(matching.fuzzy_matches(short, once=False))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id_a" not in plan and plan.count("SortAggregate(key=[id#") <= 2
    assert not [line for line in plan.splitlines() if "SortAggregate" in line and "similarity" in line.split("functions")[0]]


def test_every_record_is_paired_with_all_its_matches(spark, monkeypatch):
    monkeypatch.setattr(matching, "LIST", 3)
    rng = random.Random(37)
    records = [(i, name, block) for i, name, block in sample(37, (7, 14, 22, 30), n=6)]
    copied = [(1000 + i, name, block) for i, (_, name, block) in enumerate(rng.choices(records, k=40))]
    crowd = [(2000 + i, "Common Trading House", "north") for i in range(20)] + [(2100, "Common Trading Hause", "north")]
    odd = [(3000, "", "north"), (3001, None, "north"), (3002, "Common Trading House", None), (None, "Common Trading House", "north")]
    records += copied + crowd + crowd[:5] + odd + [(2000, "Common Trading Hausen", "north")]
    want = {}
    named = sorted({(i, name, block) for i, name, block in records if i is not None and block and name})
    for (i, a, block_a), (j, b, block_b) in itertools.combinations(named, 2):
        if i != j and block_a == block_b and (d := distance(a.lower(), b.lower())) * 20 <= 3 * max(len(a), len(b)):
            want.setdefault((i, j), []).append(d)
    got = {}
    for r in matching.fuzzy_matches(spark.createDataFrame(records, RECORDS), every=True).collect():
        got.setdefault((r.id_a, r.id_b), []).append(r.distance)
        assert r.similarity == 1.0 or r.distance > 0
    assert {pair: sorted(d) for pair, d in got.items()} == {pair: sorted(d) for pair, d in want.items()}


def test_every_match_without_repeated_names(spark):
    records = sample(41, (14, 25), n=10)
    records = list({(name, block): (i, name, block) for i, name, block in records}.values())
    frame = spark.createDataFrame(records, RECORDS)
    assert {(r.id_a, r.id_b): r.distance for r in matching.fuzzy_matches(frame, every=True).collect()} == brute_force(records)


def test_the_truth_of_names_that_differ_in_characters_and_places(spark, monkeypatch):
    monkeypatch.setattr(matching, "TILE", 30)
    rng = random.Random(43)
    names = {"customer " + "".join(rng.choice("0123") for _ in range(rng.choice([4, 5, 6, 9]))) for _ in range(150)}
    names |= {"customer ", "ab", "ba", "abcdefg", "bacdefg", "abcdefgh"} | {"customer" + " x" * n for n in range(9)}
    records = [(i, name.strip(), block) for block in ("one", "two") for i, name in enumerate(sorted(names))]
    records = [(i + 1000 * (block == "two"), name, block) for i, name, block in records if block == "one" or name.startswith("customer")]
    reps = matching.representatives(spark.createDataFrame(records, RECORDS))
    truth = [(r.id_a, r.id_b) for r in matching.all_near_pairs(reps).collect()]
    assert len(truth) == len(set(truth)) and set(truth) == {pair for pair, d in brute_force(records).items() if d > 0}


def test_most_pairs_are_told_apart_without_a_distance(spark):
    rng = random.Random(47)
    records = [(i, f"customer {n:09d}", "one") for i, n in enumerate(rng.sample(range(10**6), 300))]
    names = matching._described(matching.trimmed(matching.representatives(spark.createDataFrame(records, RECORDS))))
    for c, half, around in (("low", 0, 0), ("high", 1, 0), ("low_near", 0, 1), ("high_near", 1, 1)):
        names = names.withColumn(c, matching._in_places(half, around))
    names = materialise(names, "told")
    met = matching._of_side(names, "x").join(matching._of_side(names, "y"), F.expr("id_x < id_y")).where(F.expr(matching._in_order()))
    assert len(brute_force(records)) <= met.count() < 300 * 299 // 2 // 20


def test_candidates_are_distinct_without_an_exchange_of_pairs(spark, monkeypatch):
    records = sample(53, (9, 14, 17, 18), n=25, most_edits=3) + [(1, "abcdefgh", "north"), (1, "abcdefgi", "north"), (None, "abcdefgk", "north")]
    frame = spark.createDataFrame(records, RECORDS)
    reps = materialise(matching.trimmed(matching.representatives(frame)), "names")
    shared = {(r.block_key, r.id_a, r.id_b) for r in matching._short_pairs(reps).collect()}
    for slab in (10000, 7):
        monkeypatch.setattr(matching, "SLAB", slab)
        pairs = matching._short_candidates(reps)
        got = [tuple(r) for r in pairs.collect()]
        assert len(got) == len(set(got)) and set(got) == shared and len(got) > 50
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan and "hashpartitioning(block_key" in plan and "sig" not in "".join(
        line for line in plan.splitlines() if "Exchange" in line
    )


def numbered(seed, n):
    rng = random.Random(seed)
    words = ["machinery", "building", "furniture", "mac", "b1lding"]
    names = {f"customer {rng.randrange(10 ** rng.choice([3, 5, 6]))} {rng.choice(words)} trading" for _ in range(n)}
    return [(i, name, block) for i, (name, block) in enumerate(itertools.product(sorted(names), ["one", "two"]))]


@pytest.mark.parametrize("words", [64, 3])
def test_no_pair_of_numbered_names_is_missed(spark, monkeypatch, words):
    monkeypatch.setattr(matching, "WORDS", words)
    monkeypatch.setattr(matching, "FEW", 8)
    monkeypatch.setattr(matching, "TILE", 40)
    records = numbered(59, 110)
    assert found(spark, records) == brute_force(records)


def test_last_words_tell_numbered_names_apart(spark):
    records = [(i, f"{name} house", block) for i, name, block in numbered(61, 100) if "1l" not in name and block == "one"]
    names = matching._described(matching.trimmed(matching.representatives(spark.createDataFrame(records, RECORDS))))
    names = matching._with_words(names)
    met = matching._of_side(names, "s").join(matching._of_side(names, "t"), F.expr("len_s < len_t OR (len_s = len_t AND id_s < id_t)"))
    met = met.where("word_s != word_t").select(F.expr(matching._may_be_alike()).alias("told"), F.expr("levenshtein(name_s, name_t) <= allowed_t").alias("near")).collect()
    assert not [r for r in met if r.near and not r.told]
    assert sum(r.told for r in met) < 2 * sum(r.near for r in met) + len(met) // 10


def test_segments_that_all_names_share_are_not_counted(spark, monkeypatch):
    monkeypatch.setattr(matching, "FEW", 8)
    monkeypatch.setattr(matching, "_selective_cuts", None)
    records = [(i, f"customer {i:06d} building trading company", "north") for i in range(40)]
    reps = matching.representatives(spark.createDataFrame(records, RECORDS))
    assert matching._long_pairs(matching.trimmed(reps)).count() == 40 * 39 // 2
