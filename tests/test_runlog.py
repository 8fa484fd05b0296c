from datetime import datetime, timedelta

from meldstone.operators import runlog
from meldstone.sources import readers, schemas

START = datetime(2025, 12, 17, 11, 17)
TABLE = "+---+\n|total_records|high_profit_count|low_profit_count|\n|3095 |1500 |1595 |1.0|"


def logs(spark, *rows):
    return spark.createDataFrame([(run, i, START + timedelta(seconds=i), m) for i, (run, m) in enumerate(rows)], schemas.JOB_LOG)


def runs(spark, *rows):
    full = [(run, state, START + timedelta(minutes=m), 165) for run, state, m in rows]
    return spark.createDataFrame(full, "run_id string, state string, started_on timestamp_ntz, execution_time bigint")


def test_last_value_wins(spark):
    frame = logs(
        spark, ("a", "start"), ("a", "  - AUC: 0.5000"), ("b", "nothing here"), ("a", TABLE),
        ("a", "  - AUC: 0.9440"), ("a", "  - F1-Score: 0.8678"), ("a", "MLflow Run ID: 0af3"), ("a", "Run ID: ffff"),
    )
    rows = {r.job_run_id: r for r in runlog.log_metrics(frame.repartition(3)).collect()}
    a, b = rows["a"], rows["b"]
    assert (a.timestamp, a.auc, a.f1_score) == ("2025-12-17 11:17:00", 0.944, 0.8678)
    assert (a.total_records, a.high_profit, a.low_profit, a.mlflow_run_id) == (3095, 1500, 1595, "0af3")
    assert (b.auc, b.total_records, b.mlflow_run_id) == (None, None, None)


def test_only_recent_successes_with_an_auc(spark):
    messages = [(f"r{i}", f"AUC: 0.{i + 10}") for i in range(13)] + [("zero", "AUC: 0"), ("mute", "x")]
    states = [(f"r{i}", "FAILED" if i == 12 else "SUCCEEDED", i) for i in range(13)]
    states += [("zero", "SUCCEEDED", 20), ("mute", "SUCCEEDED", 21)]
    good = runlog.successful_runs(runs(spark, *states), logs(spark, *messages))
    assert sorted(r.job_run_id for r in good.collect()) == sorted(f"r{i}" for i in range(5, 12))
    latest = runlog.latest_run_summary(runs(spark, *states), logs(spark, *messages, ("r11", TABLE))).first()
    assert (latest.job_run_id, latest.started_on, latest.execution_time) == ("r11", "2025-12-17 11:28", 165)
    assert round(latest.high_profit_pct, 1) == 48.5 and round(latest.low_profit_pct, 1) == 51.5


def test_run_records_append(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = runlog.log_run(spark, path, {"auc": 0.9}, {"table": "t"}, START)
    second = runlog.log_run(spark, path, {"auc": 0.8}, {}, START)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 3 and first != second
    assert {r.run_name for r in rows} == {"profit-prediction-20251217_111700"}


def test_log_files(spark, tmp_path):
    (tmp_path / "log.txt").write_text("AUC: 0.5\nAUC: 0.75\n")
    frame = readers.read_job_log_text(spark, str(tmp_path / "log.txt"), "r1")
    assert runlog.log_metrics(frame).first().auc == 0.75
    frame.write.parquet(str(tmp_path / "stored"))
    assert readers.read_job_log(spark, str(tmp_path / "stored")).count() == 2
