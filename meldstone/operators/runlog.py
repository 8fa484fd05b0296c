"""Run records and metrics read back from job logs."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meldstone.functions.numbers import percent
from meldstone.sources import schemas

# Patterns of the messages a training run writes.
AUC = r"AUC:\s+([\d.]+)"
F1 = r"F1-Score:\s+([\d.]+)"
COUNTS = r"\|(\d+)\s+\|(\d+)\s+\|(\d+)"
RUN_ID = r"[Rr]un ID:\s+([a-f0-9]+)"


# Words that mark the message with the counts and the one with the run id.
COUNT_WORDS = ("total_records", "high_profit_count")
RUN_ID_WORDS = ("MLflow run ID:", "MLflow Run ID:")
# Fixed value: prefix of run names.
RUN_PREFIX = "profit-prediction"


def _found(pattern: str, group: int = 1, when: Column | None = None) -> Column:
    message = F.col("message")
    matched = message.rlike(pattern) if when is None else when & message.rlike(pattern)
    return F.when(matched, F.regexp_extract(message, pattern, group))


def _last(value: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), F.col("seq")))


def log_metrics(logs: DataFrame) -> DataFrame:
    """One row per run: first timestamp and the last value logged of each metric."""
    has = [F.col("message").contains(word) for word in (*COUNT_WORDS, *RUN_ID_WORDS)]
    is_counts, is_run_id = has[0] & has[1], has[2] | has[3]
    return logs.groupBy(F.col("run_id").alias("job_run_id")).agg(
        F.date_format(F.min_by("ts", "seq"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        _last(_found(AUC)).try_cast("double").alias("auc"),
        _last(_found(F1)).try_cast("double").alias("f1_score"),
        _last(_found(COUNTS, 1, is_counts)).try_cast("bigint").alias("total_records"),
        _last(_found(COUNTS, 2, is_counts)).try_cast("bigint").alias("high_profit"),
        _last(_found(COUNTS, 3, is_counts)).try_cast("bigint").alias("low_profit"),
        _last(_found(RUN_ID, 1, is_run_id)).alias("mlflow_run_id"),
    )


def successful_runs(runs: DataFrame, logs: DataFrame, latest: int = 10) -> DataFrame:
    """Metrics of the latest runs that succeeded and logged an AUC.

    ``runs`` has run_id, state, started_on (timestamp) and execution_time (seconds).
    """
    recent = runs.orderBy(F.desc("started_on"), "run_id").limit(latest).where(F.col("state") == "SUCCEEDED")
    # At most ``latest`` rows, so the logs are filtered before they are parsed.
    metrics = log_metrics(logs.join(F.broadcast(recent.select("run_id")), "run_id", "left_semi"))
    return recent.join(metrics, recent.run_id == metrics.job_run_id).where("auc IS NOT NULL AND auc <> 0").drop("run_id")


def latest_run_summary(runs: DataFrame, logs: DataFrame) -> DataFrame:
    """The newest successful run with the share of each class."""
    latest = successful_runs(runs, logs).orderBy(F.desc("started_on"), "job_run_id").limit(1)
    return latest.select(
        "job_run_id",
        F.date_format("started_on", "yyyy-MM-dd HH:mm").alias("started_on"),
        "auc",
        "f1_score",
        "total_records",
        "high_profit",
        percent(F.col("high_profit"), F.col("total_records")).alias("high_profit_pct"),
        "low_profit",
        percent(F.col("low_profit"), F.col("total_records")).alias("low_profit_pct"),
        "execution_time",
        "mlflow_run_id",
    )


def log_run(
    spark: SparkSession,
    path: str,
    metrics: dict[str, float],
    params: dict[str, object],
    moment: datetime | None = None,
    prefix: str = RUN_PREFIX,
) -> str:
    """Append one training run to the run table and return its id."""
    moment = moment or datetime.now(timezone.utc)
    run_id = uuid.uuid4().hex
    name = f"{prefix}-{moment:%Y%m%d_%H%M%S}"
    rows = [(run_id, name, moment, "metric", k, str(v)) for k, v in metrics.items()]
    rows += [(run_id, name, moment, "param", k, str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, schemas.RUN_RECORD).coalesce(1).write.mode("append").parquet(path)
    return run_id
