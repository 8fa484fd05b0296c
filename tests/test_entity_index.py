import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.operators.clusters import connected_components
from meldstone.operators.entity_index import EntityIndex
from meldstone.operators.evidence import evident_matches
from meldstone.operators.harmonize import harmonize_clusters, resolve_sellers
from meldstone.operators.prepare import prepare_sources
from meldstone.operators.registry import registry_staging
from meldstone.plans.etl import run_etl
from meldstone.sources.pruning import scans
from meldstone.sources.registry_store import RegistryStore
from meldstone.sources.storage import scratch_path
from tests.test_ingest import SELLERS, START, Streamed, data_columns, same, some_items
from tests.test_matching import RECORDS, edited
from tests.test_registry import NOVEMBER, DECEMBER, write_raw


def in_one_go(spark, rows):
    links = evident_matches(spark.createDataFrame(rows, RECORDS)).select("id_a", "id_b")
    return {(r.id, r.cluster_id) for r in connected_components(links).collect()}


def some_records(rng, n):
    stems = ["northern lights printing house", "quiet corner books 12", "maria silva foods", "mario silva foods", "oak bakery 7", "salt"]
    rows = [(i, edited(rng, rng.choice(stems), rng.randrange(3)), rng.choice(["x", "y", "z", None])) for i in range(n)]
    return [(i, re.sub(" +", " ", name).strip(), block) for i, name, block in rows]


def test_loads_equal_one_resolution_even_if_one_dies(spark, monkeypatch):
    rng = random.Random(2)
    rows = some_records(rng, 120)
    rng.shuffle(rows)
    index = EntityIndex(spark, scratch_path(spark, "index"), T.LongType(), 2)
    index.add(spark.createDataFrame(rows[:70], RECORDS), "1")
    first = in_one_go(spark, rows[:70])
    with monkeypatch.context() as patch:
        patch.setattr("meldstone.operators.entity_index.touch", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            index.add(spark.createDataFrame(rows[70:], RECORDS), "2")
    assert {(r.id, r.cluster_id) for r in index.clusters().collect()} == first
    index.add(spark.createDataFrame(rows[70:], RECORDS), "2")
    assert {(r.id, r.cluster_id) for r in index.clusters().collect()} == in_one_go(spark, rows) != first
    index.add(spark.createDataFrame(rows[:9], RECORDS), "2")
    assert index.loads() == ["1", "2"]
    with pytest.raises(ValueError, match="older"):
        index.add(spark.createDataFrame(rows[:9], RECORDS), "00")


def test_a_load_signs_new_names_only(spark):
    rows = some_records(random.Random(1), 40)
    index = EntityIndex(spark, scratch_path(spark, "index"), T.LongType(), 2)
    index.add(spark.createDataFrame(rows, RECORDS), "1")
    known = [(i + 1000, name, block) for i, name, block in rows]
    index.add(spark.createDataFrame(known + [(9, "entirely new name", "x")], RECORDS), "2")
    assert [r.name for r in index._stored("names", ["2"]).collect()] == ["entirely new name"]
    assert {r.id for r in index._stored("cut", ["2"]).collect()} | {r.id for r in index._stored("short", ["2"]).collect()} == {9}
    assert index._stored("near", ["2"]).isEmpty()
    assert {(r.id, r.cluster_id) for r in index.clusters().collect()} == in_one_go(spark, rows + known)
    (read,) = scans(index._stored("cut", ["2"]).select("sig"))
    assert read.columns == ("sig",)


def test_ingestion_and_the_job_agree_on_resolved_sellers(spark):
    rng = random.Random(9)
    names = ["quiet corner books", "quiet corner boks", "quite corner books", "oak bakery", "s1", "s2"]
    streamed = Streamed(spark, [(n, "City", "SP") for n in names])
    supply, _ = prepare_sources(spark.createDataFrame([], streamed.ingest.schema), streamed.sellers)
    clusters = resolve_sellers(supply)
    assert clusters.count() >= 2
    streamed.ingest.clusters = clusters
    for _ in range(2):
        streamed.land([(o, p, rng.choice(names), *rest) for o, p, _, *rest in some_items(rng, 40)], 1)
        streamed.ingest.run()
    sources = prepare_sources(spark.createDataFrame(streamed.rows, streamed.ingest.schema), streamed.sellers)
    want = registry_staging(harmonize_clusters(*sources, clusters), START).where("corporate_id IS NOT NULL")
    assert same(data_columns(streamed.store.read()), data_columns(want)) and want.count() < len(names)


def test_the_job_resolves_a_second_load_against_the_first(spark, tmp_path):
    write_raw(tmp_path / "raw", "quiet corner books,01,sao paulo,SP\nother,22000,rio,RJ\n")
    run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "out"), NOVEMBER, resolve="fuzzy")
    write_raw(tmp_path / "again", "quiet corner books,01,sao paulo,SP\nquiet corner bookz,02,sao paulo,SP\n")
    run_etl(spark, str(tmp_path / "again"), str(tmp_path / "out"), DECEMBER, resolve="fuzzy")
    store = RegistryStore(spark, str(tmp_path / "out/corporate_registry"))
    assert store.read().where("city = 'sao paulo'").count() == 1
    assert SELLERS and store.read().agg(F.count("*")).first()[0] == 2
