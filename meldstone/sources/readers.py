"""Batch readers for the raw files, prepared sources, registry and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meldstone.sources import schemas

# Relative locations of the raw files; any prefix or suffix of the file names will do.
RAW_FILES = {
    "items": "source_supply/*order_items*.csv",
    "sellers": "source_supply/*sellers*.csv",
    "payments": "source_financial/*order_payments*.csv",
}

RAW_SCHEMAS = {
    "items": schemas.ORDER_ITEMS,
    "sellers": schemas.SELLERS,
    "payments": schemas.PAYMENTS,
}


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header row; types are inferred only when no schema is given.

    With a schema, a file whose header has other names or another order is refused.
    """
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(schema).csv(path)


def read_raw_sources(
    spark: SparkSession, base: str, infer: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, sellers, payments) below ``base``."""

    def load(name: str) -> DataFrame:
        return read_csv(spark, f"{base.rstrip('/')}/{RAW_FILES[name]}", None if infer else RAW_SCHEMAS[name])

    return load("items"), load("sellers"), load("payments")


def read_job_log(spark: SparkSession, path: str) -> DataFrame:
    """Job-log rows (run_id, seq, ts, message) stored as Parquet."""
    return spark.read.schema(schemas.JOB_LOG).parquet(path)


def read_job_log_text(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Plain text log of one run; ``seq`` follows file order within each split."""
    lines = spark.read.text(path)
    return lines.select(
        F.lit(run_id).alias("run_id"),
        F.monotonically_increasing_id().alias("seq"),
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.col("value").alias("message"),
    )


def registry_training_scan(registry: DataFrame) -> DataFrame:
    """Projection of the registry that training reads; rows without money are out."""
    return registry.where("revenue IS NOT NULL AND profit IS NOT NULL").select(
        "corporate_id",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("profit").cast("double").alias("profit"),
        F.col("activity_places").cast("int").alias("activity_places"),
        F.coalesce("top_suppliers", F.lit("")).alias("top_suppliers"),
        F.coalesce("source_system", F.lit("")).alias("source_system"),
    )


def registry_partition(registry: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one load month; on a partitioned table only its folders are read."""
    return registry.where((F.col("year") == year) & (F.col("month") == month))


def row_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """One (dataset, total_records, column_count) row per input."""
    rows = [
        df.agg(F.count("*").alias("total_records")).select(
            F.lit(name).alias("dataset"),
            "total_records",
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in datasets.items()
    ]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result
