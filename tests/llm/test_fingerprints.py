import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meldstone.llm import fingerprints as fp
from meldstone.llm.near_dedup import shingle_hashes

DOCS = "doc_id bigint, text string"


def text_of(rng, n):
    return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))


def exact(a, b):
    x, y = set(shingle_hashes(a).tolist()), set(shingle_hashes(b).tolist())
    return len(x & y) / len(x | y) if x | y else 1.0


def by_hand(rows):
    """Result of the whole report on rows in order, without any bins for the exact likeness."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        changed = text[: len(text) - cut] + following[:cut]
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), exact(text, changed), exact(text, following)))
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_report_equals_brute_force(spark, partitions):
    rng = random.Random(partitions)
    rows = [(i * 3, text_of(rng, rng.choice([0, 1, 4, 5, 30, 300]))) for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "é𝄞 ÷ß x"), (1004, text_of(rng, 20000)), (1005, rows[7][1]), (1006, rows[7][1])]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"lang": F.lit("x"), "n_chars": F.lit(-1)}).repartition(partitions)
    got = {r.doc_id: r for r in fp.neighbour_report(docs).collect()}
    assert len(got) == len(rows)
    prints = {}
    for key, n, digest, near_edited, near_next in by_hand(rows):
        row = got[key]
        assert (row.n_chars, row.edited_sha256) == (n, digest)
        assert abs(row.near_edited - near_edited) < 0.12 and abs(row.near_next - near_next) < 0.12
        prints[key] = row.fingerprint
    texts = dict(rows)
    assert prints[1005] == prints[1006] == prints[21] and got[1005].near_next == 1.0
    assert prints[1000] == prints[1001] == prints[1002] == "" and got[1000].near_next == 1.0
    assert len(prints[1004]) == fp.BINS * fp.BITS // 4 and texts[1004]


def test_repeated_ids_null_ids_and_a_single_row(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "g h i j k l"), (None, "n"), (9, "z")]
    report = fp.neighbour_report(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in report) == [(False, 5)] * 3 + [(False, 9), (True, 0)]
    assert sum(r.near_next == 1.0 for r in report if r.doc_id == 5) == 1
    (only,) = fp.neighbour_report(spark.createDataFrame([(1, "a b c d e f g h")], DOCS)).collect()
    assert only.near_next == 1.0 and only.n_chars == 15
    assert only.edited_sha256 == hashlib.sha256(b"a b c d e f a b").hexdigest()
    assert fp.neighbour_report(spark.createDataFrame([], DOCS)).count() == 0


def test_likeness_estimates_the_jaccard_similarity():
    rng = random.Random(4)
    errors = []
    for _ in range(150):
        words = text_of(rng, rng.choice([40, 400, 3000])).split()
        other = list(words)
        for i in rng.sample(range(len(words)), rng.randrange(len(words) // 8)):
            other[i] = f"w{rng.randrange(10**9)}"
        a, b = " ".join(words), " ".join(other)
        errors.append(fp.likeness_of(fp.fingerprint_of(a), fp.fingerprint_of(b)) - exact(a, b))
    errors = np.array(errors)
    assert abs(errors.mean()) < 0.01 and np.sqrt((errors**2).mean()) < 0.05


def test_both_ways_of_filling_bins_agree():
    orders, rng = fp.Orders.get(), np.random.default_rng(1)
    for size in (1, 3, 60, 500, 1023, 1024):
        filled = np.zeros(fp.BINS, dtype=bool)
        filled[rng.choice(fp.BINS, size, replace=False)] = True
        slow = [next(j for j in orders.order[i] if filled[j]) if not filled[i] else i for i in range(fp.BINS)]
        assert orders.donors(filled).tolist() == slow


def test_columns(spark):
    pairs = spark.createDataFrame([("a b c d e f", "a b c d e f"), ("a", None), (None, "")], "x string, y string")
    rows = pairs.select(fp.likeness(fp.fingerprint(F.col("x")), fp.fingerprint(F.col("y"))).alias("l")).collect()
    assert [r.l for r in rows] == [1.0, 0.0, 1.0]
