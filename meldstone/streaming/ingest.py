"""Incremental ingestion of item files into the registry.

Which (seller, product) and (seller, order) pairs were seen before is the state of a
streaming deduplication, kept by key in RocksDB and spread by the whole pair, so a seller
with a third of all items is no hot key. A batch thus brings the new pairs and the money of
its items; they are summed up per seller and added to per-seller aggregates, a bucketed
table of one row per seller. No earlier item is read again: the work of a batch follows its
own size and the number of sellers in the buckets it touches.

A batch that is delivered again starts from the deduplication state before it and from the
aggregates of the batches before it, so it gives the same rows and replaces its own version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.operators.harmonize import harmonize, harmonize_clusters, keyed_supply, resolved_ids
from meldstone.operators.registry import registry_staging
from meldstone.operators.seller_state import FACT, STATE, amounts, facts, increments, merged, sources_of
from meldstone.sources.bucketed import BucketedTable
from meldstone.sources.registry_store import RegistryStore
from meldstone.sources.storage import materialise

#: Buckets of the per-seller aggregates.
BUCKETS = 64

# Settings of a stream whose state outgrows memory and is saved by its changes.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class RegistryIngest:
    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        schema: T.StructType,
        sellers: DataFrame,
        store: RegistryStore,
        state_path: str,
        checkpoint: str,
        stream: str = "items",
        buckets: int = BUCKETS,
        clusters: DataFrame | None = None,
    ):
        self.spark = spark
        self.landing = landing
        self.schema = schema
        self.sellers = sellers
        self.store = store
        self.state = BucketedTable(spark, state_path, STATE, "seller_id", buckets, "batch")
        self.checkpoint = checkpoint
        self.stream = stream
        # (id, cluster_id) of sellers that stand for one entity, as run_etl resolves them.
        self.clusters = clusters

    def _harmonized(self, state: DataFrame, sellers: DataFrame) -> DataFrame:
        sources = sources_of(state, sellers)
        return harmonize(*sources) if self.clusters is None else harmonize_clusters(*sources, self.clusters)

    def news(self, items: DataFrame) -> DataFrame:
        """(seller_id, kind, value, amount): pairs that no earlier item had, and all items' money."""
        fresh = facts(items).dropDuplicates(list(FACT))
        money = amounts(items)
        nothing = F.lit(None)
        return fresh.withColumn("amount", nothing.cast(money.schema["amount"].dataType)).unionByName(
            money.withColumn("value", nothing.cast("string"))
        )

    def state_before(self, batch_id: int, buckets: list[int]) -> DataFrame:
        """Aggregates of the batches before this one, in the given buckets; no other file is read."""
        earlier = [v for v in self.state.versions() if v < _name(batch_id)]
        return self.state.newest(earlier, buckets).select(*STATE.names)

    def _kin(self, touched: DataFrame) -> DataFrame:
        """seller_id of the touched sellers and of those that share an entity with one of them."""
        keyed = keyed_supply(sources_of(self.spark.createDataFrame([], STATE), self.sellers)[0])
        if self.clusters is not None:
            keyed = resolved_ids(keyed, self.clusters)
        ids = keyed.select("seller_id", "corporate_id").distinct()
        shared = ids.join(touched, "seller_id", "left_semi").select("corporate_id").distinct()
        return ids.join(shared, "corporate_id", "left_semi").select("seller_id").unionByName(touched).distinct()

    def _apply(self, batch: DataFrame, batch_id: int) -> None:
        # Written down: counted, listed and looked up from files instead of from the stream's state.
        new = materialise(batch, "news")
        added = materialise(increments(new), "increments")
        touched = self.state.touched(added)
        whole = merged(self.state_before(batch_id, touched), added)
        self.state.write(whole, _name(batch_id), touched)

        # The first batch also brings in sellers that have no items yet.
        kin = materialise(self._kin(added.select("seller_id")), "kin")
        sellers = self.sellers if batch_id == 0 else self.sellers.join(kin, "seller_id", "left_semi")
        known = self.state_before(batch_id + 1, self.state.touched(kin))
        of_kin = known.join(kin.withColumnRenamed("seller_id", "kin"), F.col("seller_id").eqNullSafe(F.col("kin")), "left_semi")
        staged = registry_staging(self._harmonized(of_kin, sellers))
        self.store.load_batch(staged, self.stream, batch_id)

    def run(self, files_per_batch: int = 1000) -> None:
        """Process every file that arrived since the last run, then stop."""
        items = (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(self.landing)
        )
        before = {name: self.spark.conf.get(name, None) for name in STATE_SETTINGS}
        for name, value in STATE_SETTINGS.items():
            self.spark.conf.set(name, value)
        try:
            query = (
                self.news(items)
                .writeStream.foreachBatch(self._apply)
                .option("checkpointLocation", self.checkpoint)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        finally:
            for name, value in before.items():
                if value is None:
                    self.spark.conf.unset(name)
                else:
                    self.spark.conf.set(name, value)


def _name(batch_id: int) -> str:
    """Name of a batch's version; names sort like numbers."""
    return f"{batch_id:018d}"
