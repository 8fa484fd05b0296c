"""The registry: a bucketed table whose versions are the times of the loads.

A load reads and writes the buckets of its own keys and leaves every other file alone. Rows
bear what their load changed, so the history of keys needs no second copy and no comparison
of versions.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.operators.registry import CHANGE, DELETED, KEY, marked_replacement, marked_upsert, repeated_keys
from meldstone.sources import schemas
from meldstone.sources.bucketed import BucketedTable
from meldstone.sources.storage import materialise, path_exists, touch

_FORMAT = "%Y%m%dT%H%M%S"
_STORED = T.StructType([*schemas.REGISTRY.fields, *[T.StructField(c, T.StringType()) for c in CHANGE]])

#: Buckets of a new registry; an existing one keeps its number. A bucket is what a load
#: rewrites for one key, so a registry of more rows wants more of them, within what one
#: listing of folders can bear (some thousands).
BUCKETS = 64


def _version(moment: datetime) -> str:
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return moment.strftime(_FORMAT)


class RegistryStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.table = BucketedTable(spark, path, _STORED, KEY, buckets, "commit_ts", ("year", "month"))

    def versions(self) -> list[str]:
        """Committed versions, oldest first."""
        return self.table.versions()

    def _newest(self, versions: list[str], buckets: list[int] | None = None) -> DataFrame:
        alive = ~F.col("_change_kind").eqNullSafe(DELETED)
        return self.table.newest(versions, buckets).where(alive).select(*schemas.REGISTRY.names)

    def read(self, as_of: datetime | None = None) -> DataFrame | None:
        """Newest registry, or the newest one not after ``as_of``; None if there is none."""
        versions = self.versions()
        if as_of is not None:
            versions = [v for v in versions if v <= _version(as_of)]
        return self._newest(versions) if versions else None

    def snapshots(self) -> DataFrame:
        """The registry as of each committed version, with that version's commit_ts."""
        known = self.versions()
        views = [self._newest(known[: i + 1]).withColumn("commit_ts", F.lit(v)) for i, v in enumerate(known)]
        result = views[0]
        for view in views[1:]:
            result = result.unionByName(view)
        return result

    def _next_version(self, moment: datetime) -> str:
        version = _version(moment)
        latest = max(self.versions(), default="")
        if version == latest:
            raise ValueError(f"version {version} already exists")
        if version < latest:
            # It would never be the newest one, and what it holds would be lost to readers.
            raise ValueError(f"version {version} is older than the newest one, {latest}")
        return version

    def _write(self, marked: DataFrame, version: str, replaced: list[int]) -> None:
        alive = ~F.col("_change_kind").eqNullSafe(DELETED)
        self.table.write(marked, version, replaced, alive, F.col("_change_kind").isNotNull())

    def replace(self, registry: DataFrame, moment: datetime) -> str:
        """Make ``registry`` the whole content; keys that it lacks are noted as deleted."""
        version = self._next_version(moment)
        current = self._newest(self.versions())
        self._write(marked_replacement(current, registry), version, list(range(self.table.buckets)))
        return version

    def load(self, staging: DataFrame, moment: datetime) -> DataFrame:
        """Create the registry or upsert into it; returns the quarantined rows.

        Only the buckets of the staged keys are read and written. Staging is written down
        first, so that checking and merging it do not compute it twice.
        """
        staging = materialise(staging, "staging")
        repeated = repeated_keys(staging).head(5)
        if repeated:
            raise ValueError(f"staging repeats keys, for example {[r[0] for r in repeated]}")
        version = self._next_version(moment)
        touched = self.table.touched(staging.where(F.col(KEY).isNotNull()))
        merged, quarantined = marked_upsert(self._newest(self.versions(), touched), staging)
        self._write(merged, version, touched)
        return quarantined

    def history(self) -> DataFrame:
        """(commit_ts, total_records, changed_records) per version, from the lists of the loads."""
        versions = self.versions()
        before = F.lag("records", 1, 0).over(Window.partitionBy("bucket").orderBy("commit_ts"))
        grown = self.table.listed(versions).withColumn("grown", F.col("records") - before)
        per_version = grown.groupBy("commit_ts").agg(F.sum("grown").alias("grown"), F.sum("changed").alias("changed"))
        known = self.spark.createDataFrame([(v,) for v in versions], "commit_ts string")
        # One row per version: small enough for a window without partitioning.
        so_far = Window.orderBy("commit_ts").rowsBetween(Window.unboundedPreceding, 0)
        return known.join(per_version, "commit_ts", "left").select(
            "commit_ts",
            F.coalesce(F.sum("grown").over(so_far), F.lit(0)).alias("total_records"),
            F.coalesce("changed", F.lit(0)).alias("changed_records"),
        )

    def changes(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """(corporate_id, commit_ts, kind, old_hash, new_hash, columns) of versions after ``since`` up to ``until``.

        ``kind`` is insert, update or delete; ``columns`` names what an update changed, in
        layout order. The rows are those that the loads wrote; only these columns are read.
        """
        wanted = self.versions()
        if since is not None:
            wanted = [v for v in wanted if v > _version(since)]
        if until is not None:
            wanted = [v for v in wanted if v <= _version(until)]
        return self.table.of_versions(wanted).where("_change_kind IS NOT NULL").select(
            KEY, "commit_ts", *[F.col(c).alias(c.removeprefix("_change_")) for c in CHANGE]
        )

    def compare(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """(corporate_id, kind, old_hash, new_hash, versions): keys that differ between two moments.

        A key that changed and changed back, or came and went, is left out.
        """
        ends = self.changes(since, until).groupBy(KEY).agg(
            F.min_by("old_hash", "commit_ts").alias("old_hash"),
            F.max_by("new_hash", "commit_ts").alias("new_hash"),
            F.count("*").alias("versions"),
        )
        kind = F.when(F.col("old_hash").isNull(), "insert").when(F.col("new_hash").isNull(), "delete").otherwise("update")
        return ends.where(~F.col("old_hash").eqNullSafe(F.col("new_hash"))).select(
            KEY, kind.alias("kind"), "old_hash", "new_hash", "versions"
        )

    def load_batch(self, staging: DataFrame, stream: str, batch_id: int) -> None:
        """Load a batch of a stream unless it is already in, as after a replay.

        The version bears the time of the commit, moved on by a second where the newest
        version is not older. A note <path>_batches/<stream>/<batch> is left behind it; a
        load that died before its note is repeated, which an upsert of equal rows allows.
        Rows without a key are kept next to the registry, in <path>_quarantine.
        """
        note = f"{self.path}_batches/{stream}/{batch_id}"
        if path_exists(self.spark, note):
            return
        staging = materialise(staging, "staging")
        lost = staging.where(F.col(KEY).isNull())
        lost.write.mode("overwrite").parquet(f"{self.path}_quarantine/stream={stream}/batch_id={batch_id}")
        moment = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        if latest := max(self.versions(), default=None):
            moment = max(moment, datetime.strptime(latest, _FORMAT) + timedelta(seconds=1))
        self.load(staging.where(F.col(KEY).isNotNull()), moment)
        touch(self.spark, note)
