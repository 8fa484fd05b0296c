"""The binary profit classifier: pipeline, training, scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldstone.operators.features import LABEL, hash_split
from meldstone.sources.storage import materialise

# Inputs of the feature vector, in order, and the model settings.
FEATURES = ("revenue", "profit_margin", "activity_places", "top_suppliers_count", "source_system_idx")
MAX_ITERATIONS = 100
REGULARISATION = 0.01
ELASTIC_NET = 0.5
TRAIN_SHARE = 0.8


def indexer() -> StringIndexer:
    """Category index by falling frequency; unseen categories get an index of their own."""
    return StringIndexer(inputCol="source_system", outputCol="source_system_idx", handleInvalid="keep")


def scaling_stages(handle_invalid: str = "error") -> list:
    """Assembler and scaler. ``handle_invalid`` is error, skip or keep for rows with NULLs."""
    return [
        VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid=handle_invalid),
        StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True),
    ]


def build_pipeline(handle_invalid: str = "error", weight_col: str | None = None) -> Pipeline:
    classifier = LogisticRegression(
        featuresCol="scaled_features",
        labelCol=LABEL,
        maxIter=MAX_ITERATIONS,
        regParam=REGULARISATION,
        elasticNetParam=ELASTIC_NET,
        family="binomial",
    )
    if weight_col:
        classifier.setWeightCol(weight_col)
    return Pipeline(stages=[indexer(), *scaling_stages(handle_invalid), classifier])


def source_index(df: DataFrame) -> DataFrame:
    """(source_system, source_system_idx) of every category."""
    return indexer().fit(df).transform(df.select("source_system").distinct())


def scaled_features(df: DataFrame) -> DataFrame:
    """(corporate_id, scaled_<feature> ...) as plain columns.

    Written down first, as the index and the scaler read all rows before they are scaled.
    """
    used = [c for c in df.columns if c in ("corporate_id", "source_system", *FEATURES)]
    df = materialise(df.select(*used), "scaling")
    indexed = indexer().fit(df).transform(df)
    scaled = Pipeline(stages=scaling_stages()).fit(indexed).transform(indexed)
    values = vector_to_array("scaled_features")
    return scaled.select("corporate_id", *[values[i].alias(f"scaled_{c}") for i, c in enumerate(FEATURES)])


def class_weights(df: DataFrame, column: str = "class_weight") -> DataFrame:
    """Rows with a weight that gives both classes the same total."""
    counts = {row[LABEL]: row["n"] for row in df.groupBy(LABEL).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for label, n in counts.items():
        weight = F.when(F.col(LABEL) == label, F.lit(total / (len(counts) * n))).otherwise(weight)
    return df.withColumn(column, weight)


def require_two_classes(df: DataFrame) -> None:
    classes = {row[0] for row in df.select(LABEL).distinct().collect()}
    if len(classes) < 2:
        raise ValueError(f"training needs both classes, found only {sorted(classes)}")


@dataclass
class Trained:
    model: PipelineModel
    predictions: DataFrame
    auc: float
    f1: float


def fit(features: DataFrame, key: str = "corporate_id", handle_invalid: str = "error") -> PipelineModel:
    """Fit on the training side of the key split.

    Rows are kept while fitting passes over them, spilling to disk.
    """
    training = hash_split(features, key, TRAIN_SHARE)[0].persist(StorageLevel.MEMORY_AND_DISK)
    try:
        require_two_classes(training)
        return build_pipeline(handle_invalid).fit(training)
    finally:
        training.unpersist()


def _stage(model: PipelineModel, kind: type) -> Transformer:
    return next(s for s in model.stages if isinstance(s, kind))


def category_index(model: PipelineModel) -> Column:
    """Index of source_system as fitted; NULL and unseen categories share the last one."""
    labels = _stage(model, StringIndexerModel).labelsArray[0]
    unseen = F.lit(float(len(labels)))
    if not labels:
        return unseen
    known = F.create_map(*[F.lit(x) for i, name in enumerate(labels) for x in (name, float(i))])
    return F.coalesce(F.try_element_at(known, F.col("source_system")), unseen)


def margin(model: PipelineModel) -> Column:
    """Log-odds of class 1 as one expression: index, standardisation and dot product.

    It needs neither the model's JVM objects nor the session it was fitted in, runs inside
    of generated code, and is NULL where a feature is NULL or NaN.
    """
    scaler, classifier = _stage(model, StandardScalerModel), _stage(model, LogisticRegressionModel)
    total = F.lit(float(classifier.intercept))
    for name, mean, std, weight in zip(FEATURES, scaler.mean, scaler.std, classifier.coefficients, strict=True):
        raw = category_index(model) if name == "source_system_idx" else F.col(name).cast("double")
        present = F.when(~F.isnan(raw), raw)
        # A feature without spread scales to zero.
        factor = float(weight) / float(std) if std > 0 else 0.0
        total = total + (present - F.lit(float(mean))) * F.lit(factor)
    return total


def _invalid(model: PipelineModel) -> str:
    return _stage(model, VectorAssembler).getHandleInvalid()


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with margin, probability (of class 1) and prediction (double).

    Rows with a NULL feature are refused, skipped or kept without a score, as the
    model's ``handle_invalid`` says.
    """
    rows = df.withColumn("margin", margin(model))
    if _invalid(model) == "skip":
        rows = rows.where(F.col("margin").isNotNull())
    elif _invalid(model) == "error":
        refuse = F.raise_error(F.lit("a feature is null; fit with handle_invalid skip or keep"))
        rows = rows.withColumn("margin", F.coalesce("margin", refuse.cast("double")))
    p = 1 / (1 + F.exp(-F.col("margin")))
    threshold = _stage(model, LogisticRegressionModel).getThreshold()
    return rows.withColumn("probability", p).withColumn(
        "prediction", F.when(F.col("probability") > F.lit(threshold), 1.0).when(F.col("margin").isNotNull(), 0.0)
    )


def evaluate(predictions: DataFrame) -> tuple[float, float]:
    """(AUC, weighted F1) of predictions."""
    kept = predictions.select(LABEL, "margin", "prediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranking = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="margin", metricName="areaUnderROC")
        auc = ranking.evaluate(kept)
        f1 = MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="f1").evaluate(kept)
    finally:
        kept.unpersist()
    return auc, f1


def train(features: DataFrame, key: str = "corporate_id", handle_invalid: str = "error") -> Trained:
    """Fit on the training side of the key split and evaluate on the other."""
    model = fit(features, key, handle_invalid)
    predictions = scored(model, hash_split(features, key, TRAIN_SHARE)[1])
    return Trained(model, predictions, *evaluate(predictions))


def score(model: PipelineModel, df: DataFrame, timestamp: str) -> DataFrame:
    """Predictions in the layout of the prediction contract.

    The probability is that of class 1, the confidence that of the predicted class.
    """
    p = F.col("probability")
    return scored(model, df).select(
        "corporate_id",
        F.col("prediction").cast("int").alias("predicted_class"),
        p.alias("prediction_probability"),
        F.greatest(p, 1 - p).alias("confidence"),
        F.lit(timestamp).alias("prediction_timestamp"),
    )


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, importance): size of each coefficient on the scaled features."""
    coefficients = _stage(model, LogisticRegressionModel).coefficients
    rows = [(name, abs(float(c))) for name, c in zip(FEATURES, coefficients)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
