"""Every registered query against its SQL, and the plans of the heavy ones."""

import re

import pytest

import __spark_entry__ as entry
from meldstone.operators import harmonize, prepare, quality
from meldstone.plans import catalog, inputs
from meldstone.sources import schemas, tables
from tools import check_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_queries.duck(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, con, name):
    verdict = check_queries.compare(spark, con, name, SF)
    assert not verdict.startswith("FAIL"), verdict
    assert ":" not in verdict.split("s", 1)[-1], verdict


def test_entry(spark):
    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(schemas.TABLES))
def test_declared_schemas_match_the_files(spark, name):
    actual = spark.read.parquet(f"{SF}/{name}.parquet").schema
    assert [(f.name, f.dataType) for f in actual] == [(f.name, f.dataType) for f in schemas.TABLES[name]]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["harmonize", "build_supply", "prepare_financial", "prep_item_supply", "seller_supply_summary", "log_metrics",
             "contract_source", "cleanse_name", "payment_financial_summary"],
)
def test_no_python_and_no_single_task_exchange(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "EvalPython" not in text and "MapInPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name == "payment_financial_summary":
        # The only single task adds up one row per range partition.
        assert text.count("SinglePartition") == 1 and "Window [sum(_rows" in text
    else:
        assert "SinglePartition" not in text


def test_scans_read_only_what_they_use(spark):
    text = plan(prepare.financial_metrics(tables.order_items(spark, SF)))
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert columns == ["l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_tax:double"]


def test_top_products_are_limited_before_the_exchange(spark):
    text = plan(prepare.product_breadth(tables.order_items(spark, SF)))
    assert "row_number(), 10, Partial" in text and "row_number(), 10, Final" in text


def test_duplicate_check_compares_only_suspects(spark):
    text = plan(quality._repeats(tables.order_items(spark, SF)))
    # No hash repeats, so the full rows are filtered by a broadcast and not exchanged by hash.
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert not re.search(r"Exchange hashpartitioning\(_hash", text)


@pytest.mark.parametrize("partitions", [1, 13])
def test_harmonise_does_not_depend_on_partitioning(spark, partitions):
    items, sellers = tables.order_items(spark, SF), tables.sellers(spark, SF)
    again = harmonize.harmonize(*prepare.prepare_sources(items.repartition(partitions), sellers.repartition(partitions)))
    assert sorted(map(str, again.collect())) == sorted(map(str, inputs.harmonized(spark, SF).collect()))


def test_the_truth_about_candidates_has_all_pairs(spark):
    near = entry.queries()["fuzzy_matches"](spark, SF).where("distance > 0").count()
    assert tuple(entry.queries()["candidate_misses"](spark, SF).first()) == (near, 0)


def test_months_are_scanned_after_both_whole_loads(spark):
    rows = entry.queries()["registry_partition_scan"](spark, SF)
    assert rows.count() == inputs.loaded_store(spark, SF).read().count() > 0


def test_more_items_land_in_more_files(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(inputs, "LANDED_ROWS", 1000)

    def spied(ingest, files_per_batch):
        landed = spark.read.parquet(ingest.landing)
        taken.append((files_per_batch, len(landed.inputFiles()), landed.count()))
        raise RuntimeError("landed")

    monkeypatch.setattr(catalog.RegistryIngest, "run", spied)
    with pytest.raises(RuntimeError, match="landed"):
        entry.queries()["incremental_ingest"](spark, SF)
    ((batch, files, rows),) = taken
    assert files == -(-rows // 1000) > 4 and batch == -(-files // 2)


def test_scaling_computes_its_input_once(spark):
    text = plan(entry.queries()["standard_scaling"](spark, SF))
    assert "scaling-" in text and "lineitem" not in text
