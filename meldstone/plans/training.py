"""Registry to trained classifier, as one job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from meldstone.operators import model as ml
from meldstone.operators.features import PROFIT_THRESHOLD, add_features, label_high_profit
from meldstone.operators.quality import enforce_gate, quality_gate
from meldstone.operators.runlog import log_run
from meldstone.sources.readers import registry_training_scan
from meldstone.sources.storage import materialise
from pyspark.sql import functions as F


def training_features(registry: DataFrame, threshold: float | str = PROFIT_THRESHOLD) -> DataFrame:
    return add_features(label_high_profit(registry_training_scan(registry), threshold))


def run_training(
    spark: SparkSession,
    registry: DataFrame,
    target: str,
    threshold: float | str = PROFIT_THRESHOLD,
    moment: datetime | None = None,
    required: Sequence[str] = ("unique_key", "key_present"),
    source: str = "",
) -> tuple[str, ml.Trained]:
    """Pass the quality gate, train, store model and run record below ``target``.

    ``required`` names the checks of the gate that stop the job; the outcome of all goes
    into the run record. ``source`` says there which registry, and which version, was read.
    """
    gate = materialise(quality_gate(registry), "gate")
    enforce_gate(gate.where(F.col("check").isin(list(required))))
    checks = {f"gate_{r['check']}": r["passed"] for r in gate.collect()}
    trained = ml.train(training_features(registry, threshold))
    base = target.rstrip("/")
    run_id = log_run(
        spark,
        f"{base}/runs",
        {"auc": trained.auc, "f1": trained.f1},
        {
            "train_test_split": "0.8/0.2",
            "profit_threshold": threshold,
            "registry": source,
            **checks,
            "regParam": ml.REGULARISATION,
            "elasticNetParam": ml.ELASTIC_NET,
            "maxIter": ml.MAX_ITERATIONS,
        },
        moment,
    )
    ml.save_model(trained.model, f"{base}/models/{run_id}")
    return run_id, trained
