"""Text quality by a regularised quadratic discriminant over document statistics.

Statistics of a text are Spark expressions; counts enter as log(1 + x) and shares as
log odds, which brings them near normal. Each class gets the mean and covariance of the
standardised statistics; a covariance is shrunk towards the one pooled over classes
(``POOLING``) and towards a multiple of the identity (``RIDGE``). The score is the logistic
of the difference of log densities plus the log prior odds; densities come from Mahalanobis
distances through Cholesky factors that are computed once and shipped with the model.

Moments are sums over all labelled rows, aggregated by Spark; the driver sees one row for
each class. Scoring is one pass in Arrow batches.

Defined results: NULL and empty texts have the statistics of an empty text and are scored
like others; a document with both labels counts for both; NULL labels and labels other
than 0 and 1 are left out; without labelled rows all scores are 0.5, with one class only
they are 0 or 1 accordingly; repeated rows get equal scores; other columns pass untouched.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldstone.llm.common import fold, free_name, share_package, words
from meldstone.sources.storage import materialise

POOLING = 0.1
RIDGE = 0.02
#: Added to both sides of the odds of a share.
SHARE_FLOOR = 0.005


def _count(text: Column, kind: str) -> Column:
    """Characters of ``text`` in a class of characters."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{kind}+", ""))


def _log(count: Column) -> Column:
    return F.log1p(count.cast("double"))


def _odds(part: Column, whole: Column) -> Column:
    share = F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    return F.log((share + SHARE_FLOOR) / (1 - share + SHARE_FLOOR))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``features``: the transformed statistics of each text."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n"), lambda line: F.trim(line) != "")
    parts = free_name(docs, "parts")
    rows = docs.withColumn(
        parts, F.struct(content.alias("text"), words(content).alias("words"), lines.alias("lines"), F.length(content).alias("n"))
    )
    t, n, found = F.col(f"{parts}.text"), F.col(f"{parts}.n"), F.col(f"{parts}.words")
    n_words, n_lines = F.size(found), F.size(f"{parts}.lines")
    word_chars = F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", ""))
    mean = lambda a, b: _log(F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0)))
    features = [
        _log(n),
        _log(n_words),
        mean(word_chars, n_words),
        mean(n_words, n_lines),
        _log(F.coalesce(F.array_max(F.transform(found, F.length)), F.lit(0))),
        _odds(_count(t, r"\p{Lu}"), n),
        _odds(_count(t, r"\p{L}"), n),
        _odds(_count(t, r"\p{N}"), n),
        _odds(_count(t, r"[.,;:?]"), n),
        _odds(_count(t, r"[#*$%&|<>!~^=_{}\[\]\\]"), n),
        _odds(F.size(F.array_distinct(found)), n_words),
        _odds(F.size(F.array_distinct(f"{parts}.lines")), n_lines),
    ]
    return rows.withColumn("features", F.array(*features)).drop(parts)


FEATURES = 12


class Gaussian(NamedTuple):
    mean: np.ndarray
    factor: np.ndarray  # lower Cholesky factor of the shrunk covariance
    constant: float  # log prior minus half of the log determinant

    def log_density(self, rows: np.ndarray) -> np.ndarray:
        away = np.linalg.solve(self.factor, (rows - self.mean).T)
        return self.constant - 0.5 * (away * away).sum(axis=0)


class Discriminant(NamedTuple):
    centre: np.ndarray
    spread: np.ndarray
    classes: dict[int, Gaussian]

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        if len(self.classes) < 2:
            only = {(): 0.5, (0,): 0.0, (1,): 1.0}[tuple(self.classes)]
            return np.full(len(features), only)
        rows = (features - self.centre) / self.spread
        difference = self.classes[1].log_density(rows) - self.classes[0].log_density(rows)
        return 1.0 / (1.0 + np.exp(-np.clip(difference, -700, 700)))


def fit(labelled: DataFrame, label: str = "quality", pooling: float = POOLING, ridge: float = RIDGE) -> Discriminant:
    """A discriminant from ``features`` and labels 0 and 1 of all rows of ``labelled``."""
    x = [F.element_at("features", i + 1) for i in range(FEATURES)]
    rows = labelled.where(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("label"), *[c.alias(f"x{i}") for i, c in enumerate(x)])
    whole = rows.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(FEATURES)], *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(FEATURES)]).first()
    if whole["m0"] is None:
        return Discriminant(np.zeros(FEATURES), np.ones(FEATURES), {})
    centre = np.array([whole[f"m{i}"] for i in range(FEATURES)])
    spread = np.array([whole[f"s{i}"] for i in range(FEATURES)])
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = [(F.col(f"x{i}") - float(centre[i])) / float(spread[i]) for i in range(FEATURES)]
    pairs = [(i, j) for i in range(FEATURES) for j in range(i + 1)]
    sums = rows.groupBy("label").agg(
        F.count("*").alias("n"),
        *[F.sum(z[i]).alias(f"m{i}") for i in range(FEATURES)],
        *[F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in pairs],
    )
    counts, means, scatters = {}, {}, {}
    for row in sums.orderBy("label").collect():
        k, n = row["label"], row["n"]
        mean = np.array([row[f"m{i}"] for i in range(FEATURES)]) / n
        products = np.zeros((FEATURES, FEATURES))
        for i, j in pairs:
            products[i, j] = products[j, i] = row[f"p{i}_{j}"]
        counts[k], means[k], scatters[k] = n, mean, products - n * np.outer(mean, mean)
    total = sum(counts.values())
    pooled = sum(scatters.values()) / total
    classes = {}
    for k, n in counts.items():
        covariance = (1 - pooling) * scatters[k] / n + pooling * pooled
        scale = max(np.trace(covariance) / FEATURES, 1e-6)
        factor = np.linalg.cholesky((1 - ridge) * covariance + ridge * scale * np.eye(FEATURES))
        constant = float(np.log(n / total) - np.log(np.diag(factor)).sum())
        classes[k] = Gaussian(means[k], factor, constant)
    return Discriminant(centre, spread, classes)


def score(rows: DataFrame, model: Discriminant, result: str = "score") -> DataFrame:
    """``rows`` with the probability of class 1 from their ``features``."""
    share_package(rows.sparkSession)

    def scores(features: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.vstack(features.to_numpy())) if len(features) else [], dtype="float64")

    return rows.withColumn(result, F.pandas_udf(scores, "double")(F.col("features")))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are not learned: crc32 of the id, modulo 3, is 1."""
    return F.coalesce(fold(doc_id, 3) == 1, F.lit(False))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores for all documents by a model of the labels that are not held out."""
    rows = materialise(statistics(docs.select("doc_id", "text")).select("doc_id", "features"), "statistics")
    known = labels.select("doc_id", "quality").dropna().distinct().where(~held_out(F.col("doc_id")))
    model = fit(rows.join(known, "doc_id"))
    return score(rows, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
