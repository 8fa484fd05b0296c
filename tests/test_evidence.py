import itertools
import random
import re

import pytest

from meldstone.operators import evidence
from tests.test_matching import RECORDS, distance, edited


def accepted(a, b, names):
    """The rule in plain words, on the distinct names of a block."""
    ta, tb = a.split(" "), b.split(" ")
    only_a, only_b = [t for t in dict.fromkeys(ta) if t not in tb], [t for t in dict.fromkeys(tb) if t not in ta]
    if not only_a and not only_b:
        return True
    if any(re.search("[0-9]", t) for t in only_a + only_b):
        return False
    x, y = " ".join(only_a), " ".join(only_b)
    if distance(x, y) > max(len(x), len(y)) / 4:
        return False
    held = lambda side: min(sum(t in n.split(" ") for n in names) for t in side)
    few, many = sorted([held(only_a), held(only_b)])
    return few == 1 or many >= 5 * few


def by_hand(rows):
    reps = {}
    for i, name, block in rows:
        if block is not None and name:
            reps[block, name] = min(i, reps.get((block, name), i))
    found = {(reps[b, n], i) for i, n, b in rows if b is not None and n and reps[b, n] != i}
    for ((block, a), i), ((other, b), j) in itertools.combinations(reps.items(), 2):
        if block == other and distance(a, b) * 20 <= 3 * max(len(a), len(b)):
            if accepted(a, b, [n for k, n in reps if k == block]):
                found.add((min(i, j), max(i, j)))
    return found


@pytest.mark.parametrize("a, b, together", [
    ("seller s 1001", "seller s 1002", False),
    ("northern lights printing house", "northern light printing house", True),
    ("northern lights printing house", "northern lights printing horse", True),
    ("companhia brasileira de sapatos sul", "companhia brasileira de sapatos rio", False),
    ("quiet corner books 12", "quiet corner boks 12", True),
    ("quiet corner books 12", "quiet corner books 13", False),
    ("paper and ink and glue and very fine brushes", "paper and ink and glue very fine brushes", True),
    ("oak street bakery", "oak street bakery x", False),
])
def test_what_tells_names_apart(spark, a, b, together):
    rows = spark.createDataFrame([(1, a, "x"), (2, b, "x")], RECORDS)
    assert evidence.evident_matches(rows).count() == int(together)


def test_two_words_in_common_use_are_two_words(spark):
    many = [(i, f"maria {t} foods", "x") for i, t in enumerate(["silva", "souza", "lima", "costa"])]
    other = [(10 + i, f"mario {t} foods", "x") for i, t in enumerate(["silva", "souza", "rocha"])]
    both = spark.createDataFrame(many + other, RECORDS)
    assert evidence.evident_matches(both).isEmpty()
    alone = spark.createDataFrame(many + other[:1], RECORDS)
    assert [(r.id_a, r.id_b) for r in evidence.evident_matches(alone).collect()] == [(0, 10)]


def test_rule_equals_brute_force(spark):
    rng = random.Random(6)
    stems = ["northern lights printing house", "quiet corner books 12", "maria silva foods", "mario silva foods", "oak street bakery 7"]
    rows = [(i, edited(rng, rng.choice(stems), rng.randrange(3)), rng.choice(["x", "y", None])) for i in range(160)]
    rows = [(i, re.sub(" +", " ", n).strip(), b) for i, n, b in rows]
    got = {(r.id_a, r.id_b) for r in evidence.evident_matches(spark.createDataFrame(rows, RECORDS)).collect()}
    assert got == by_hand(rows) and len(got) > 20


def test_names_of_different_numbers_never_meet(spark, monkeypatch):
    met, near_names = [], evidence.matching.near_names
    monkeypatch.setattr(evidence.matching, "near_names", lambda reps: met.append(near_names(reps)) or met[-1])
    rows = [(i, f"quiet corner {kind} {i % 20:03d}", "x\ny\n") for i, kind in enumerate(["books"] * 20 + ["boks"] * 3)]
    links = {(r.id_a, r.id_b) for r in evidence.evident_matches(spark.createDataFrame(rows, RECORDS)).collect()}
    assert links == {(i, i + 20) for i in range(3)} == {(r.id_a, r.id_b) for r in met[0].collect()}
