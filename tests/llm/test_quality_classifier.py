import numpy as np
import pytest
from pyspark.sql import functions as F

from meldstone.llm import quality_classifier as qc

DATA = "/root/testdata/sf0.01"


def area(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return ((good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()).item()


def test_held_out_ranking(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    report = qc.quality_report(docs, labels)
    rows = report.join(labels, "doc_id").where("held_out").toPandas()
    assert area(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.9
    assert (rows["predicted"] == rows["quality"]).mean() > 0.9
    whole = report.toPandas()
    assert len(whole) == docs.count() and whole["score"].between(0, 1).all()
    assert (whole["predicted"] == (whole["score"] >= 0.5)).all()


def test_moments_equal_numpy(spark):
    rng = np.random.default_rng(1)
    features = rng.normal(size=(300, qc.FEATURES)) @ rng.normal(size=(qc.FEATURES, qc.FEATURES))
    label = (features[:, 0] > 0.5).astype(int)
    frame = spark.createDataFrame([(int(y), [float(v) for v in x]) for x, y in zip(features, label)], "quality int, features array<double>")
    model = qc.fit(frame, pooling=0.2, ridge=0.1)
    z = (features - features.mean(0)) / features.std(0)
    scatter = {k: (z[label == k] - z[label == k].mean(0)).T @ (z[label == k] - z[label == k].mean(0)) for k in (0, 1)}
    logs = []
    for k in (0, 1):
        n = (label == k).sum()
        cov = 0.8 * scatter[k] / n + 0.2 * (scatter[0] + scatter[1]) / 300
        cov = 0.9 * cov + 0.1 * np.trace(cov) / qc.FEATURES * np.eye(qc.FEATURES)
        away = z - z[label == k].mean(0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
        logs.append(np.log(n / 300) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * distance)
    assert np.allclose(model.scores(features), 1 / (1 + np.exp(logs[0] - logs[1])))


SCHEMA = "doc_id bigint, text string, score string, features int"
DOCS = [(1, None, "a", 1), (2, "", None, None), (None, "x", "b", 2), (3, "word " * 60_000, "c", 3), (3, "again", None, 4), (4, "\n\n\t", None, 5)]


@pytest.mark.parametrize(
    ("labels", "expected"),
    [([], 0.5), ([(1, None, 0), (None, 1, 0)], 0.5), ([(2, 1, 1), (3, 1, 0)], 1.0), ([(2, 0, 1)], 0.0)],
)
def test_few_labels(spark, labels, expected):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, text int")
    labels = labels.withColumn("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("doc_id")))
    learned = labels.dropna().where(~qc.held_out(F.col("doc_id"))).join(docs.select("doc_id"), "doc_id").count()
    report = qc.quality_report(docs, labels)
    assert report.count() == len(DOCS)
    assert {r["score"] for r in report.collect()} == {expected if learned else 0.5}


def test_both_classes_with_odd_rows(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] + [(3, 0), (2, 7)], "doc_id bigint, quality int")
    rows = qc.quality_report(docs, labels).collect()
    assert len(rows) == len(DOCS) and all(0 <= r["score"] <= 1 for r in rows)
    assert qc.quality_report(docs.limit(0), labels).count() == 0


def test_statistics_keep_columns(spark):
    docs = spark.createDataFrame([(1, "Ab c1!", "z")], "doc_id bigint, text string, parts string")
    row = qc.statistics(docs).first()
    assert row["parts"] == "z" and len(row["features"]) == qc.FEATURES
    assert row["features"][0] == pytest.approx(np.log(7)) and row["features"][1] == pytest.approx(np.log(3))
