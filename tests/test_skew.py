"""Hot keys: results stay whole and the work stays spread."""

import random
from datetime import date

from pyspark.sql import functions as F

from meldstone.operators import clusters, matching, prepare


def test_heavy_hub_in_components(spark):
    edges = spark.range(1, 200).select(F.lit(0).cast("bigint").alias("id_a"), F.col("id").alias("id_b"))
    edges = edges.union(spark.createDataFrame([(500, 501), (502, 501)], "id_a bigint, id_b bigint"))
    got = {r.id: r.cluster_id for r in clusters.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(200)} | {500: 500, 501: 500, 502: 500}


def test_long_paths_settle(spark):
    ids = list(range(300))
    random.Random(3).shuffle(ids)
    path = spark.createDataFrame(list(zip(ids, ids[1:])), "id_a bigint, id_b bigint")
    assert {r.cluster_id for r in clusters.connected_components(path).collect()} == {0}


def test_common_segments_do_not_multiply_candidates(spark):
    rng = random.Random(4)
    names = ["seller " + "".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(150)]
    frame = spark.createDataFrame([(i, n, "one") for i, n in enumerate(names)], "id bigint, name string, block_key string")
    assert matching.candidate_pairs(matching.representatives(frame)).count() < 50


def test_nameless_records_match_nobody(spark):
    rows = [(1, None, "b"), (2, "", "b"), (3, "?!", "b"), (4, "name", "b"), (5, "name", "b")]
    frame = spark.createDataFrame(rows, "id bigint, name string, block_key string")
    assert [(r.id_a, r.id_b) for r in matching.fuzzy_matches(frame).collect()] == [(4, 5)]


def test_a_third_of_all_copies_in_one_name(spark):
    rows = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "Same Name").otherwise(F.concat(F.lit("other "), F.md5(F.col("id").cast("string")))).alias("name"), F.lit("b").alias("block_key"))
    matches = matching.fuzzy_matches(rows)
    assert matches.where("distance = 0").count() == 299
    sizes = clusters.entity_clusters(rows, matches).groupBy("cluster_id").count()
    assert sizes.agg(F.max("count")).first()[0] == 300


def test_hot_seller(spark):
    items = spark.range(3000).select(
        F.col("id").cast("string").alias("order_id"),
        F.concat(F.lit("p"), F.col("id") % 1000).alias("product_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("seller_id"),
        F.lit(1.0).alias("price"),
        F.lit(0.0).alias("freight_value"),
    )
    hot = prepare.product_breadth(items).where("seller_id = 'hot'").first()
    assert hot.activity_places == 1000 and hot.top_suppliers.startswith("p0,p1,p10,p100,p101")
    sellers = spark.createDataFrame([("hot", "c", "SS")], "seller_id string, seller_city string, seller_state string")
    summary = prepare.seller_supply_summary(items, sellers, date(2025, 12, 17)).where("corporate_id = 'hot'").collect()
    assert [r.n_products for r in summary] == [1000]
    assert prepare.seller_product_list(items).where("corporate_id = 'hot'").count() == 1000
