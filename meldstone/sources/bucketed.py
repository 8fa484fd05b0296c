"""Rows by key in Parquet folders of key buckets, versioned by write.

A write puts version=<name>/bucket=<number>/ (and further partition columns below) and names
the buckets it replaced in <path>_commits/version=<name>. A version counts once that list is
complete, so a write that dies half-way is invisible, and doing it again replaces it. Of each
bucket the newest version is read, among those that a reader asks for; other folders are
neither listed nor opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.sources.storage import list_folders, path_exists, touch

_LAYOUT = "buckets="


class BucketedTable:
    """``schema`` holds the stored columns; ``within`` names those that are folders below a bucket."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        buckets: int,
        version: str = "version",
        within: Sequence[str] = (),
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.version = version
        self.within = tuple(within)
        self.key = key
        self._new_buckets = buckets
        self.schema = T.StructType(
            [*schema.fields, T.StructField(version, T.StringType()), T.StructField("bucket", T.IntegerType())]
        )
        self._listed_schema = f"bucket int, records bigint, changed bigint, {version} string"

    @property
    def buckets(self) -> int:
        """Number of buckets, fixed when the table is first written."""
        known = [n for n in list_folders(self.spark, f"{self.path}_layout") if n.startswith(_LAYOUT)]
        return int(known[0].removeprefix(_LAYOUT)) if known else self._new_buckets

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows: at most as many numbers as there are buckets."""
        return [r[0] for r in rows.select(self.bucket(self.buckets).alias("bucket")).distinct().collect()]

    def versions(self) -> list[str]:
        """Committed versions in the order of their names."""
        prefix = f"{self.version}="
        names = [n.removeprefix(prefix) for n in list_folders(self.spark, f"{self.path}_commits")]
        return [n for n in names if path_exists(self.spark, f"{self.path}_commits/{prefix}{n}/_SUCCESS")]

    def listed(self, versions: Sequence[str]) -> DataFrame:
        """(bucket, records, changed, version): what the versions wrote, one row per bucket."""
        if not versions:
            return self.spark.createDataFrame([], self._listed_schema)
        base = f"{self.path}_commits"
        paths = [f"{base}/{self.version}={v}" for v in versions]
        return self.spark.read.schema(self._listed_schema).option("basePath", base).parquet(*paths)

    def of_versions(self, versions: Sequence[str]) -> DataFrame:
        """All rows that the versions wrote."""
        return self._folders([f"{self.path}/{self.version}={v}" for v in versions])

    def _folders(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)

    def newest(self, versions: Sequence[str], buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of each bucket's newest version among ``versions``, of the given buckets alone."""
        listed = self.listed(versions)
        if buckets is not None:
            listed = listed.where(F.col("bucket").isin(list(buckets)))
        newest = listed.groupBy("bucket").agg(
            F.max(self.version).alias("newest"), F.max_by("records", self.version).alias("records")
        )
        # At most one row per bucket.
        rows = newest.where("records > 0").collect()
        return self._folders([f"{self.path}/{self.version}={r.newest}/bucket={r.bucket}" for r in rows])

    def write(
        self, rows: DataFrame, version: str, replaced: Sequence[int], alive: Column | None = None, changed: Column | None = None
    ) -> None:
        """Write ``rows`` as the new content of the buckets ``replaced``, then the list that makes it count.

        ``alive`` and ``changed`` say which rows the list counts. Rebalancing sizes the files
        and splits a huge bucket over several.
        """
        buckets = self.buckets
        folder = f"{self.path}/{self.version}={version}"
        partitions = ("bucket", *self.within)
        placed = rows.withColumn("bucket", self.bucket(buckets))
        placed.hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(folder)
        touch(self.spark, f"{self.path}_layout/{_LAYOUT}{buckets}/_SUCCESS")
        every = F.lit(True)
        counts = self.of_versions([version]).groupBy("bucket").agg(
            F.count_if(every if alive is None else alive).alias("records"),
            F.count_if(every if changed is None else changed).alias("changed"),
        )
        listed = self.spark.createDataFrame([(b,) for b in replaced], "bucket int").join(counts, "bucket", "left")
        note = listed.select("bucket", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("records", "changed")])
        note.coalesce(1).write.mode("overwrite").parquet(f"{self.path}_commits/{self.version}={version}")
