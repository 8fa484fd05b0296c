"""Analyst queries over the registry and the prepared sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meldstone.functions.numbers import percent
from meldstone.operators.features import LABEL


def _mean(column: str) -> Column:
    """Average from an exact sum where the column is a decimal."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double"))


def registry_by_source(registry: DataFrame) -> DataFrame:
    return registry.groupBy("source_system").agg(
        F.count("*").alias("total_corporations"), _mean("revenue").alias("avg_revenue"), _mean("profit").alias("avg_profit")
    )


def registry_totals(registry: DataFrame) -> DataFrame:
    return registry.agg(
        F.count("*").alias("total"), _mean("revenue").alias("avg_revenue"), _mean("profit").alias("avg_profit")
    )


def high_profit_top(registry: DataFrame, threshold: float = 200, n: int = 20) -> DataFrame:
    return (
        registry.where(F.col("profit") > threshold)
        .select("corporate_name", "revenue", "profit", "corporate_id")
        .orderBy(F.desc("profit"), "corporate_id")
        .limit(n)
    )


def top_suppliers(summary: DataFrame, n: int = 5) -> DataFrame:
    return (
        summary.select("corporate_id", "corporate_name", "revenue", "profit")
        .orderBy(F.desc("revenue"), "corporate_id")
        .limit(n)
    )


def revenue_statistics(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, total_revenue, avg_revenue, total_profit) per prepared source."""
    result = None
    for name, df in sources.items():
        row = df.agg(
            F.sum("revenue").cast("double").alias("total_revenue"),
            _mean("revenue").alias("avg_revenue"),
            F.sum("profit").cast("double").alias("total_profit"),
        ).select(F.lit(name).alias("source"), "*")
        result = row if result is None else result.unionByName(row)
    return result


def payment_type_distribution(summary: DataFrame, column: str = "main_customers") -> DataFrame:
    """(payment_type, payments, share_pct), most frequent first."""
    counts = summary.groupBy(F.col(column).alias("payment_type")).agg(F.count("*").alias("payments"))
    # The window spans one row per payment type, not the payments.
    total = F.sum("payments").over(Window.partitionBy())
    return counts.withColumn("share_pct", percent(F.col("payments"), total)).orderBy(
        F.desc("payments"), "payment_type"
    )


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(label)


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, n, pct, single_class): share of each class and whether it is the only one."""
    everything = Window.partitionBy()
    return (
        df.groupBy(F.col(label).alias("label"))
        .agg(F.count("*").alias("n"))
        .withColumn("pct", percent(F.col("n"), F.sum("n").over(everything)))
        .withColumn("single_class", F.count("*").over(everything) < 2)
        .orderBy("label")
    )


def training_statistics(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_records"),
        F.count(F.when(F.col(label) == 1, 1)).alias("high_profit_count"),
        F.count(F.when(F.col(label) == 0, 1)).alias("low_profit_count"),
        F.round(F.avg(F.col("revenue").cast("double")), 2).alias("avg_revenue"),
        F.round(F.avg(F.col("profit").cast("double")), 2).alias("avg_profit"),
        F.round(F.stddev_samp(F.col("revenue").cast("double")), 2).alias("stddev_revenue"),
    )


def feature_statistics(df: DataFrame) -> DataFrame:
    """(feature, min, max, mean, std) of revenue, margin and places."""
    features = ("revenue", "profit_margin", "activity_places")
    parts = []
    for c in features:
        value = F.col(c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
            )
        )
    return df.agg(F.array(*parts).alias("rows")).select(F.inline("rows"))


def feature_label_association(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(feature, mean_high, mean_low, associated): whether class 1 has the higher mean."""

    def mean_of(column: str, value: int) -> Column:
        return F.avg(F.when(F.col(label) == value, F.col(column).cast("double")))

    parts = [
        F.struct(
            F.lit(c).alias("feature"), mean_of(c, 1).alias("mean_high"), mean_of(c, 0).alias("mean_low")
        )
        for c in ("profit", "profit_margin")
    ]
    rows = df.agg(F.array(*parts).alias("rows")).select(F.inline("rows"))
    return rows.withColumn("associated", F.coalesce(F.col("mean_high") > F.col("mean_low"), F.lit(False)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
