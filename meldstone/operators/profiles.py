"""Profiles that add up: one row per part of a table and column, merged on read.

A part is profiled once, when it arrives; its rows stay in a folder of its own. The profile
of the whole is their sum, so a new part costs only itself, and a part that is loaded again
replaces its own rows. Distinct values are counted by mergeable sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.functions.numbers import percent, quoted
from meldstone.sources.storage import list_folders, path_exists

#: Size of the sketches: 2^12 registers, about 1.6 % standard error.
SKETCH_BITS = 12

ROWS = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("column", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("nulls", T.LongType()),
        T.StructField("values_sketch", T.BinaryType()),
    ]
)
_PREFIX = "part="


def profile(df: DataFrame) -> DataFrame:
    """ROWS of a frame: one per column, from one scan without an exchange of rows."""
    names = df.columns
    counted = df.agg(
        F.count("*").alias("records"),
        *[F.count(F.col(quoted(c))).alias(f"present_{i}") for i, c in enumerate(names)],
        *[F.hll_sketch_agg(F.to_json(F.struct(F.col(quoted(c)))), SKETCH_BITS).alias(f"sketch_{i}") for i, c in enumerate(names)],
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            "records",
            (F.col("records") - F.col(f"present_{i}")).alias("nulls"),
            F.col(f"sketch_{i}").alias("values_sketch"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counted.select(F.inline(F.array(*rows)))


def merged(rows: DataFrame) -> DataFrame:
    """(position, column, type, records, nulls, null_pct, distinct_values) over all parts.

    ``type`` lists the types that a column had, where parts differ. NULL is one of the
    distinct values, which are estimated.
    """
    totals = rows.groupBy("column").agg(
        F.min("position").alias("position"),
        F.concat_ws("|", F.array_sort(F.collect_set("type"))).alias("type"),
        F.sum("records").alias("records"),
        F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("values_sketch")).alias("distinct_values"),
    )
    share = percent(F.col("nulls"), F.col("records"))
    return totals.select("position", "column", "type", "records", "nulls", share.alias("null_pct"), "distinct_values")


class ProfileStore:
    """Profiles of the parts of a table, below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def parts(self) -> list[str]:
        names = [n.removeprefix(_PREFIX) for n in list_folders(self.spark, self.path) if n.startswith(_PREFIX)]
        return [n for n in names if path_exists(self.spark, f"{self.path}/{_PREFIX}{n}/_SUCCESS")]

    def add(self, part: str, df: DataFrame) -> None:
        """Profile a part that arrived; nothing else is read."""
        profile(df).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{_PREFIX}{part}")

    def rows(self) -> DataFrame:
        known = self.parts()
        if not known:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*[f"{self.path}/{_PREFIX}{n}" for n in known])

    def merged(self) -> DataFrame:
        return merged(self.rows())
