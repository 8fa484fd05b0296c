import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from meldstone.operators import analytics, features, metrics
from meldstone.operators import contracts as c
from meldstone.operators import model as ml
from meldstone.plans import inputs
from meldstone.plans.training import run_training, training_features

EIGHT = [
    ("q1", 7200.0, 1944.0, 0.27, 9, 1), ("q2", 3100.0, 310.0, 0.10, 4, 0), ("q3", 18500.0, 4070.0, 0.22, 31, 1),
    ("q4", 640.0, 32.0, 0.05, 2, 0), ("q5", 9900.0, 2871.0, 0.29, 12, 1), ("q6", 2750.0, 220.0, 0.08, 17, 0),
    ("q7", 12000.0, 2520.0, 0.21, 8, 1), ("q8", 5300.0, 371.0, 0.07, 6, 0),
]
TRAINING = "corporate_id string, revenue double, profit double, profit_margin double, activity_places int, label int"


@pytest.fixture
def eight(spark):
    return spark.createDataFrame(EIGHT, TRAINING)


@pytest.fixture(scope="module")
def registry(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        revenue = round(rng.lognormvariate(7, 1), 2)
        rows.append((f"C{i:04}", revenue, round(revenue * 0.18, 2), rng.randrange(1, 40),
                     ",".join(f"p{j}" for j in range(rng.randrange(5))) or None, rng.choice(["a", "a", "b"])))
    return spark.createDataFrame(
        rows, "corporate_id string, revenue double, profit double, activity_places int, top_suppliers string, source_system string"
    )


def test_labels_and_features(spark):
    rows = spark.createDataFrame(
        [("a", 1000.0, 180.0, ""), ("b", 1000.1, 180.01, "x"), ("c", 0.0, 5.0, "x,y"), ("d", -5.0, 1.0, "  ")],
        "corporate_id string, revenue double, profit double, top_suppliers string",
    )
    out = {r.corporate_id: r for r in features.add_features(features.label_high_profit(rows)).collect()}
    assert [out[k].high_profit_label for k in "abcd"] == [0, 1, 0, 0]
    assert [out[k].top_suppliers_count for k in "abcd"] == [0, 1, 2, 0]
    assert out["a"].profit_margin == 0.18 and out["c"].profit_margin == out["d"].profit_margin == 0.0


@pytest.mark.parametrize("n", [1, 2, 7, 10])
def test_exact_median(spark, n):
    rng = random.Random(n)
    values = [rng.choice([1.5, 2.5, 9.0, 4.0]) for _ in range(n)]
    frame = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)] + [("null", None)], "k string, v double")
    assert features.exact_median(frame.repartition(5), "v", "k") == sorted(values + values)[n - 1 : n + 1][0] / 2 + sorted(values + values)[n] / 2


def test_median_of_nothing(spark):
    assert features.exact_median(spark.createDataFrame([], "k string, v double"), "v", "k") is None


def test_profit_per_location(spark):
    rows = spark.createDataFrame([(200000.0, 50), (1.0, 0), (1.0, None)], "profit double, activity_places int")
    got = [r.avg_profit_per_location for r in features.profit_per_location(rows).collect()]
    assert got == [4000.0, None, None]


def test_split_depends_on_the_key_only(spark, eight):
    many = spark.range(2000).withColumnRenamed("id", "k")
    train, test = features.hash_split(many, "k")
    assert train.count() + test.count() == 2000 and 0.77 < train.count() / 2000 < 0.83
    again, _ = features.hash_split(many.repartition(11).orderBy(F.rand(1)), "k")
    assert again.exceptAll(train).isEmpty()
    train, test = features.hash_split(eight, "corporate_id")
    assert train.count() + test.count() == 8


def test_missing_values(spark):
    rows = spark.createDataFrame([(1.0, 1), (None, 0), (2.0, 1), (None, 0)], "feature double, label int")
    assert features.drop_missing(rows, ["feature"]).count() == 2


def test_distributions(spark, eight):
    assert eight.count() == 8 and len(eight.columns) == 6
    assert [(r.label, r.n) for r in analytics.class_distribution(eight, "label").collect()] == [(0, 4), (1, 4)]
    three = eight.where("corporate_id IN ('q1', 'q2', 'q3')")
    got = analytics.label_distribution(three, "label").collect()
    assert [(r.label, r.n, round(r.pct, 1), r.single_class) for r in got] == [(0, 1, 33.3, False), (1, 2, 66.7, False)]
    assert analytics.label_distribution(three.where("label = 1"), "label").first().single_class
    assert all(r.associated for r in analytics.feature_label_association(eight, "label").collect())
    stats = {r.feature: r for r in analytics.feature_statistics(eight).collect()}
    assert (stats["activity_places"].min, stats["activity_places"].max, stats["revenue"].mean) == (2.0, 31.0, 7423.75)
    row = analytics.training_statistics(eight, "label").first()
    assert (row.total_records, row.high_profit_count, row.low_profit_count, row.avg_revenue) == (8, 4, 4, 7423.75)


def test_scaling(spark):
    rows = spark.createDataFrame(
        [("a", 1000000.0, 0.20, 1, 0, "s"), ("b", 500000.0, 0.15, 1, 1, "s"), ("c", 200000.0, 0.10, 1, 2, "t")],
        "corporate_id string, revenue double, profit_margin double, activity_places int, top_suppliers_count int, source_system string",
    )
    scaled = ml.scaled_features(rows).collect()
    for name in ml.FEATURES:
        values = [r[f"scaled_{name}"] for r in scaled]
        assert abs(sum(values)) < 1e-9
        spread = math.sqrt(sum(v * v for v in values) / 2)
        assert abs(spread - (0 if name == "activity_places" else 1)) < 1e-9


SCORES = "k int, y int, s double, p int"


def scored(spark, rows):
    return spark.createDataFrame([(i, y, s, int(s > 0.5)) for i, (y, s) in enumerate(rows)], SCORES)


def test_metrics_by_hand(spark):
    frame = scored(spark, [(0, 0.1), (1, 0.9), (1, 0.8), (0, 0.2), (1, 0.7)])
    assert metrics.auc_exact(frame, "s", "y", "k").first().auc == 1.0
    assert metrics.f1_binary(frame, "p", "y").first().f1 == metrics.f1_weighted(frame, "p", "y").first().f1 == 1.0


def test_metrics_equal_the_library_on_ties(spark):
    rng = random.Random(9)
    frame = scored(spark, [(rng.randrange(2), rng.randrange(8) / 8) for _ in range(300)]).repartition(5)
    vectors = frame.select("*", F.col("y").cast("double").alias("label"), F.col("p").cast("double").alias("prediction"),
                           array_to_vector(F.array(1 - F.col("s"), "s")).alias("rawPrediction"))
    auc = BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(vectors)
    f1 = MulticlassClassificationEvaluator(labelCol="label", metricName="f1").evaluate(vectors)
    assert math.isclose(metrics.auc_exact(frame, "s", "y", "k").first().auc, auc)
    assert math.isclose(metrics.f1_weighted(frame, "p", "y").first().f1, f1)


def test_metrics_of_one_class(spark):
    frame = scored(spark, [(1, 0.1), (1, 0.9)])
    assert metrics.auc_exact(frame, "s", "y", "k").first().auc is None
    assert metrics.f1_binary(scored(spark, [(0, 0.1)]), "p", "y").first().f1 == 0.0


def test_training_end_to_end(spark, registry, tmp_path):
    run_id, trained = run_training(spark, registry, str(tmp_path), threshold="median")
    assert 0.5 < trained.auc <= 1 and 0.5 < trained.f1 <= 1
    rows = {(r.kind, r.key): r.value for r in spark.read.parquet(str(tmp_path / "runs")).collect()}
    assert float(rows[("metric", "auc")]) == trained.auc and rows[("param", "maxIter")] == "100"
    frame = training_features(registry, "median")
    scores = ml.score(trained.model, frame, "2025-12-17T10:00:00")
    assert c.is_valid(scores, c.ML_PREDICTION)
    assert scores.where("abs(confidence - greatest(prediction_probability, 1 - prediction_probability)) > 1e-12").isEmpty()
    loaded = ml.load_model(str(tmp_path / "models" / run_id))
    assert ml.score(loaded, frame, "t").drop("prediction_timestamp").exceptAll(scores.drop("prediction_timestamp")).isEmpty()
    importance = {r.feature: r.importance for r in ml.feature_importance(trained.model, frame).collect()}
    assert set(importance) == set(ml.FEATURES) and all(v >= 0 for v in importance.values())
    assert importance["revenue"] == max(importance.values()) > 0


def test_scores_equal_the_library(spark, registry):
    rows = training_features(registry, "median")
    model = ml.fit(rows)
    odd = rows.limit(3).withColumn("source_system", F.lit("unseen")).unionByName(rows)
    library = model.transform(odd.withColumn("n", F.monotonically_increasing_id()))
    both = ml.scored(model, odd.withColumn("n", F.monotonically_increasing_id())).alias("e").join(
        library.select("n", vector_to_array("probability")[1].alias("p"), F.col("prediction").alias("q")), "n")
    assert both.count() == 403 and both.where("abs(probability - p) > 1e-9 OR prediction <> q").isEmpty()
    plan = ml.scored(model, odd)._jdf.queryExecution().executedPlan().toString()
    assert "UDF(" not in plan


def test_training_after_registry_loads_and_observed_metrics(spark, registry, tmp_path):
    inputs.loaded_store(spark, "/root/testdata/sf0.001")
    seen = Observation()
    spark.range(5).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 5
    _, trained = run_training(spark, registry, str(tmp_path), threshold="median")
    assert ml.score(trained.model, training_features(registry, "median"), "t").count() == 400


def test_one_class_is_refused(spark, registry):
    with pytest.raises(ValueError, match="both classes"):
        ml.train(training_features(registry, threshold=1e12))


def test_null_features(spark, registry):
    frame = training_features(registry.withColumn("activity_places", F.when(F.col("corporate_id") != "C0001", F.col("activity_places"))), "median")
    with pytest.raises(Exception, match="null"):
        ml.train(frame)
    skipping = ml.train(frame, handle_invalid="skip")
    assert skipping.auc > 0.5 and ml.scored(skipping.model, frame).count() == 399
    keeping = ml.fit(registry_without_nulls(frame), handle_invalid="keep")
    assert ml.scored(keeping, frame).where("prediction IS NULL").count() == 1


def registry_without_nulls(frame):
    return features.drop_missing(frame, ["activity_places"])


def test_pipeline_settings():
    classifier = ml.build_pipeline().getStages()[-1]
    assert (classifier.getRegParam(), classifier.getElasticNetParam(), classifier.getMaxIter()) == (0.01, 0.5, 100)
    assert classifier.getFamily() == "binomial"
    assert ml.build_pipeline(weight_col="w").getStages()[-1].getWeightCol() == "w"


def test_rows_without_a_label_do_not_count(spark):
    rows = [(0, 0.9, 1), (1, 0.1, 0), (2, 0.95, None), (3, 0.99, None)]
    frame = spark.createDataFrame(rows, "k int, s double, y int")
    row = metrics.auc_exact(frame, "s", "y", "k").first()
    assert (row.positives, row.negatives, row.auc) == (1, 1, 1.0)


def test_class_weights(spark):
    frame = spark.createDataFrame([(0.5, 0)] * 90 + [(0.6, 1)] * 10, f"features double, {features.LABEL} int")
    totals = ml.class_weights(frame).groupBy(features.LABEL).sum("class_weight").collect()
    assert [round(r[1], 6) for r in totals] == [50.0, 50.0]


def test_source_index(spark):
    frame = spark.createDataFrame([("b",)] * 3 + [("a",)] * 3 + [("c",)] * 5, "source_system string")
    got = {r.source_system: r.source_system_idx for r in ml.source_index(frame).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}
