"""Classifier metrics computed exactly on distributed predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldstone.operators.sequence import sequential_ids


def auc_exact(scored: DataFrame, score: str, label: str, key: str) -> DataFrame:
    """(positives, negatives, auc) by rank sum, ties at their average rank.

    Rows whose label is neither 0 nor 1 do not count.

    Tied rows hold consecutive positions, so the average rank of a score is the
    mean of its first and last position.
    """
    labelled = scored.where(F.col(label).isin(0, 1)).select(key, score, label)
    ranked = sequential_ids(labelled, [score, key], "position")
    tied = ranked.groupBy(score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("positive"),
        F.count("*").alias("rows"),
        ((F.min("position") + F.max("position")).cast("double") / 2).alias("rank"),
    )
    sums = tied.agg(
        F.sum("positive").alias("positives"),
        F.sum(F.col("rows") - F.col("positive")).alias("negatives"),
        F.sum(F.col("rank") * F.col("positive")).alias("rank_sum"),
    )
    p, n = F.col("positives").cast("double"), F.col("negatives").cast("double")
    return sums.select("positives", "negatives", F.try_divide(F.col("rank_sum") - p * (p + 1) / 2, p * n).alias("auc"))


def confusion(scored: DataFrame, prediction: str, label: str) -> DataFrame:
    """One row with tp, fp, fn, tn."""

    def cell(l: int, p: int) -> Column:
        return F.count(F.when((F.col(label) == l) & (F.col(prediction) == p), 1))

    return scored.agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"))


def _f1(hit: str, false: str, missed: str) -> Column:
    return F.coalesce(F.try_divide(2.0 * F.col(hit), 2.0 * F.col(hit) + F.col(false) + F.col(missed)), F.lit(0.0))


def f1_binary(scored: DataFrame, prediction: str, label: str) -> DataFrame:
    """F1 of the positive class."""
    return confusion(scored, prediction, label).select("tp", "fp", "fn", "tn", _f1("tp", "fp", "fn").alias("f1"))


def f1_weighted(scored: DataFrame, prediction: str, label: str) -> DataFrame:
    """Mean of both classes' F1, weighted by how often each class occurs."""
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    weighted = F.try_divide(
        _f1("tp", "fp", "fn") * positives + _f1("tn", "fn", "fp") * negatives, (positives + negatives).cast("double")
    )
    return confusion(scored, prediction, label).select("tp", "fp", "fn", "tn", weighted.alias("f1"))
