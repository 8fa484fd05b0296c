import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meldstone.llm import quality_rules as qr

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, stats string, parts int"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_base_equals_plain_counts(spark, rng):
    bits = ["a", "b", "é", "#", "|<", "\U0001f600", " ", "  ", "\n", "\n\n", "\t", "\x0b", " ", "\x1c", "word"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(60))) for _ in range(250)]
    texts += [" ".join(rng.choice("ab") for _ in range(n)) for n in (4, 5, 6, 9, 10, 40, 200)]
    texts += [None, "", " ", "\n", "x\n" * 300, "one two three four five " * 3, "w " * 70_000]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, "a b", None, None), (0, "again", "s", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    report = qr.rules_report(docs, labels).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = Counter((r["doc_id"], *[r[n] for n in names]) for r in report)
    assert got == Counter((i, *plain(t)) for i, t, *_ in rows)
    assert all(r["kept"] == (not r["base_failed"]) and r["rule"] is None for r in report)


def test_learns_the_table(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    report = qr.rules_report(docs, labels)
    assert report.count() == docs.count()
    counts = {(r["quality"], r["kept"]): r["count"] for r in report.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    good = counts.get((1, True), 0) / (counts.get((1, True), 0) + counts.get((1, False), 0))
    bad = counts.get((0, False), 0) / (counts.get((0, False), 0) + counts.get((0, True), 0))
    assert good > 0.93 and bad > 0.7
    assert not any(map(re.compile("Python|Arrow|Pandas").search, report._jdf.queryExecution().toString().split("\n")))


def made(spark, rows):
    stats = F.struct(*[(F.col("v") if s == "n_words" else F.col("w") if s == "upper_share" else F.lit(1.0)).cast("double").alias(s) for s in qr.RATIOS])
    return spark.createDataFrame(rows, "doc_id bigint, v double, w double, quality int").select("doc_id", stats.alias("stats"), "quality")


def test_list_is_ordered_and_finds_a_conjunction(spark, rng):
    rows = []
    for i in range(3000):
        v, w = rng.random(), rng.random()
        rows.append((i, v, w, 0 if (v > 0.8 and w > 0.7) or v < 0.1 else 1))
    frame = made(spark, rows)
    rules = qr.learn_rules(frame)
    assert any(len(r) >= 2 for r in rules)
    marked = frame.select("quality", qr.decision(rules, F.col("stats")).isNotNull().alias("marked"))
    right = marked.agg(F.avg(((F.col("quality") == 0) == F.col("marked")).cast("int"))).first()[0]
    assert right > 0.96


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 1), (2, 1), (None, 0)], [(1, 0), (1, 1), (2, 5)]])
def test_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "some words here", None, 1), (2, None, None, 1), (None, "x", None, 1)], SCHEMA)
    report = qr.rules_report(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert report.count() == 3 and report.where("kept").count() == 0
    assert qr.rules_report(docs.limit(0), spark.createDataFrame(labels, "doc_id bigint, quality int")).count() == 0
