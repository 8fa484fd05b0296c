"""Labels, features and the deterministic train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldstone.functions.keys import hash_fraction
from meldstone.functions.numbers import profit_margin
from meldstone.functions.text import list_size
from meldstone.operators.sequence import sequential_ids

# Fixed value: profit above which an entity counts as highly profitable.
PROFIT_THRESHOLD = 180.0
LABEL = "high_profit_label"
_HASH_RANGE = 2**32


def exact_median(df: DataFrame, value: str, key: str) -> float | None:
    """Median of a column, exact; NULLs are left out.

    The built-in exact median gathers all distinct values in one task. Here approximate
    percentiles bracket the middle, one pass counts what lies below the bracket, and only
    the rows inside of it are put in order.
    """
    present = df.where(F.col(value).isNotNull()).select(F.col(value).alias("v"), F.col(key))
    ends = F.percentile_approx("v", F.array(F.lit(0.499), F.lit(0.501)), 10_000)
    found = present.agg(F.count("*").alias("n"), ends.alias("ends"), F.min("v").alias("least"), F.max("v").alias("most")).first()
    n = found["n"]
    if n == 0:
        return None
    low, high = found["ends"]
    inside = F.col("v").between(F.lit(low), F.lit(high))
    below, held = present.agg(F.count_if(F.col("v") < F.lit(low)), F.count_if(inside)).first()
    first, last = (n + 1) // 2 - below, (n + 2) // 2 - below
    if first < 1 or last > held:
        # The percentiles were off by more than the bracket is wide.
        inside = F.col("v").between(F.lit(found["least"]), F.lit(found["most"]))
        first, last = (n + 1) // 2, (n + 2) // 2
    ranked = sequential_ids(present.where(inside), ["v", key], "row_id")
    middle = ranked.where(F.col("row_id").isin(first, last))
    return float(middle.agg(F.avg(F.col("v").cast("double"))).first()[0])


def label_high_profit(df: DataFrame, threshold: float | str = PROFIT_THRESHOLD, key: str = "corporate_id") -> DataFrame:
    """1 where profit exceeds the threshold, else 0. "median" balances the classes."""
    if threshold == "median":
        threshold = exact_median(df, "profit", key)
    above = F.col("profit") > F.lit(threshold)
    return df.withColumn(LABEL, F.when(above, 1).otherwise(0))


def add_features(df: DataFrame) -> DataFrame:
    return df.withColumn("profit_margin", profit_margin(F.col("revenue"), F.col("profit"))).withColumn(
        "top_suppliers_count", list_size(F.col("top_suppliers"))
    )


def profit_per_location(df: DataFrame) -> DataFrame:
    per_place = F.try_divide(F.col("profit").cast("double"), F.col("activity_places").cast("double"))
    return df.withColumn("avg_profit_per_location", per_place)


def hash_split(df: DataFrame, key: str, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test); a row's side depends on its key alone, not on partitioning."""
    marked = with_split(df, key, train_share)
    train = marked.where(F.col("split") == "train").drop("split")
    return train, marked.where(F.col("split") == "test").drop("split")


def with_split(df: DataFrame, key: str, train_share: float = 0.8) -> DataFrame:
    limit = int(train_share * _HASH_RANGE)
    side = F.when(hash_fraction(F.col(key)) < limit, "train").otherwise("test")
    return df.withColumn("split", side)


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)
