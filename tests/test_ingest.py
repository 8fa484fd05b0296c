import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meldstone.operators.harmonize import harmonize
from meldstone.operators.prepare import prepare_sources
from meldstone.operators.registry import registry_staging
from meldstone.operators.seller_state import FACT, amounts, facts, increments, merged, sources_of
from meldstone.sources.registry_store import RegistryStore
from meldstone.sources.storage import list_folders, scratch_path
from meldstone.streaming.ingest import RegistryIngest

ITEMS = "order_id string, product_id string, seller_id string, price double, freight_value double"
SELLERS = "seller_id string, seller_city string, seller_state string"
START = datetime(2025, 12, 17, 10)


def data_columns(df):
    return df.drop("load_date", "_etl_processed_dttm", "year", "month")


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def some_items(rng, n):
    return [
        (f"o{rng.randrange(60)}", rng.choice([None, f"p{rng.randrange(30)}"]), f"s{rng.randrange(6)}", round(rng.random() * 100, 2), 1.0)
        for _ in range(n)
    ]


class Streamed:
    """A landing folder and a registry that follows it."""

    def __init__(self, spark, sellers):
        self.spark = spark
        self.landing, self.state, stream = (scratch_path(spark, name) for name in ("landing", "state", "stream"))
        self.store = RegistryStore(spark, scratch_path(spark, "registry"), 4)
        self.sellers = spark.createDataFrame(sellers, SELLERS)
        schema = spark.createDataFrame([], ITEMS).schema
        self.ingest = RegistryIngest(spark, self.landing, schema, self.sellers, self.store, self.state, stream, buckets=4)
        self.rows = []

    def land(self, rows, files):
        self.rows += rows
        self.spark.createDataFrame(rows, ITEMS).repartition(files).write.mode("append").parquet(self.landing)

    def equals_a_rebuild(self):
        whole = harmonize(*prepare_sources(self.spark.createDataFrame(self.rows, ITEMS), self.sellers))
        want = registry_staging(whole, START).where("corporate_id IS NOT NULL")
        return same(data_columns(self.store.read()), data_columns(want))


def test_batches_equal_a_full_rebuild(spark):
    rng = random.Random(2)
    streamed = Streamed(spark, [(f"s{i}", f"City {i % 3}", "SP") for i in range(7)])
    streamed.land(some_items(rng, 120), 3)
    streamed.ingest.run(files_per_batch=2)
    assert len(streamed.store.versions()) == 2
    again = some_items(rng, 60)
    streamed.land(again + again[:20] + [("o1", "p1", "ghost", 5.0, 0.0), ("o1", "p1", None, 5.0, 0.0)], 2)
    streamed.ingest.run(files_per_batch=1)
    assert len(streamed.store.versions()) == 4
    assert streamed.store.read().count() == 7 and streamed.equals_a_rebuild()
    lost = spark.read.parquet(f"{streamed.store.path}_quarantine")
    assert "seller ghost" in {r.corporate_name for r in lost.collect()}
    before = streamed.store.versions()
    streamed.ingest.run()
    assert streamed.store.versions() == before


def test_a_batch_that_failed_half_way_is_repeated(spark, monkeypatch):
    rng = random.Random(3)
    streamed = Streamed(spark, [(f"s{i}", "City", "SP") for i in range(6)])
    streamed.land(some_items(rng, 80), 2)
    load, calls = RegistryStore.load_batch, []

    def fails_once(self, staging, stream, batch_id):
        calls.append(batch_id)
        if calls == [0, 1]:
            raise RuntimeError("lost the registry")
        return load(self, staging, stream, batch_id)

    monkeypatch.setattr(RegistryStore, "load_batch", fails_once)
    with pytest.raises(Exception, match="lost the registry"):
        streamed.ingest.run(files_per_batch=1)
    # The aggregates of batch 1 are written already; they must not be added twice.
    assert len(streamed.ingest.state.versions()) == 2 and len(streamed.store.versions()) == 1
    streamed.ingest.run(files_per_batch=1)
    assert calls == [0, 1, 1] and streamed.equals_a_rebuild()


def test_a_batch_reads_aggregates_of_its_buckets_only(spark):
    rng = random.Random(4)
    streamed = Streamed(spark, [(f"s{i}", "City", "SP") for i in range(6)])
    read = []
    for _ in range(4):
        streamed.land([(o, p, "s1", *rest) for o, p, _, *rest in some_items(rng, 40)], 1)
        streamed.ingest.run()
        known = streamed.ingest.state_before(10**6, streamed.ingest.state.touched(spark.createDataFrame([("s1",)], "seller_id string")))
        read.append((known.count(), len(known.inputFiles())))
    # One row of one file each time, however many batches came before.
    assert read == [(1, 1)] * 4 and streamed.equals_a_rebuild()
    for n in range(4):
        names = list_folders(spark, f"{streamed.state}/batch={n:018d}")
        assert len([x for x in names if x.startswith("bucket=")]) == 1


def test_sellers_that_share_an_entity_are_loaded_together(spark):
    streamed = Streamed(spark, [("a-b", "City", "SP"), ("a b", "City", "SP"), ("c", "City", "SP")])
    streamed.land([("o1", "p1", "a-b", 50.0, 0.0), ("o2", "p2", "c", 1.0, 0.0)], 1)
    streamed.ingest.run()
    streamed.land([("o3", "p3", "a b", 20.0, 0.0)], 1)
    streamed.ingest.run()
    assert streamed.equals_a_rebuild() and float(streamed.store.read().agg(F.max("revenue")).first()[0]) == 50.0


@pytest.mark.parametrize("cuts", [1, 3, 7])
def test_aggregates_do_not_depend_on_the_cut(spark, cuts):
    rng = random.Random(cuts)
    rows = some_items(rng, 150) + [("o1", "p1", None, None, None)]
    sellers = spark.createDataFrame([(f"s{i}", "City", "SP") for i in range(7)], SELLERS)
    state, seen = None, spark.createDataFrame([], "seller_id string, kind string, value string")
    for part in range(cuts):
        items = spark.createDataFrame(rows[part::cuts], ITEMS)
        fresh = facts(items).distinct().subtract(seen)
        seen = seen.union(fresh)
        new = fresh.withColumn("amount", F.lit(None).cast("decimal(38,4)")).unionByName(
            amounts(items).withColumn("value", F.lit(None).cast("string"))
        )
        added = increments(new)
        state = added if state is None else merged(state, added)
    got = sources_of(state, sellers)
    want = prepare_sources(spark.createDataFrame(rows, ITEMS), sellers)
    assert all(same(g.select(w.columns), w) for g, w in zip(got, want)) and len(FACT) == 3
