"""Entities from matching pairs: connected components on DataFrames.

Every id carries a label, at first the smallest of its neighbours and itself. In each
round it takes the smallest label among its neighbours and the label of its own label, so
distances to the smallest id halve. Only ids travel: a hub's neighbours are reduced before
the exchange, and lookups by a hub are plain joins, which adaptive execution splits. Each
round ends in a written table, so lineage stays short and a lost executor never restarts
the loop; the table of the round before is then deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldstone.functions.text import cleanse_name
from meldstone.operators.matching import THRESHOLD, similarity
from meldstone.sources.storage import materialise, remove_path, scratch_path, written


def _fingerprint(labels: DataFrame) -> tuple:
    h = F.xxhash64("id", "cluster_id")
    return tuple(labels.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, cluster_id) for every id on an edge; cluster_id is the smallest id reached.

    ``edges`` has columns id_a and id_b. The rounds end once no label changes; labels only
    ever become smaller, and their number grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col("id_a").alias("u"), F.col("id_b").alias("v")).where(F.col("u") != F.col("v"))
    links = materialise(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    first = links.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("cluster_id"))
    path = scratch_path(spark, "labels")
    labels = written(first.select("id", F.least("id", "cluster_id").alias("cluster_id")), path)
    before = None
    while before != (now := _fingerprint(labels)):
        before, spent = now, path
        near = links.join(labels.withColumnRenamed("id", "v"), "v").select(F.col("u").alias("id"), "cluster_id")
        hops = labels.select(F.col("id").alias("cluster_id"), F.col("cluster_id").alias("further"))
        onward = labels.join(hops, "cluster_id").select("id", F.col("further").alias("cluster_id"))
        path = scratch_path(spark, "labels")
        labels = written(near.unionByName(onward).groupBy("id").agg(F.min("cluster_id").alias("cluster_id")), path)
        remove_path(spark, spent)
    return labels


def entity_clusters(records: DataFrame, matches: DataFrame) -> DataFrame:
    """(id, cluster_id, cluster_size, rep_similarity, is_chained) for every record.

    rep_similarity compares a member with the record its cluster is named after;
    is_chained marks members that reach it only through others.
    """
    named = records.select("id", cleanse_name(F.col("name")).alias("name"))
    labels = materialise(connected_components(matches), "labels")
    sizes = labels.groupBy("cluster_id").agg(F.count("*").alias("cluster_size"))
    heads = named.select(F.col("id").alias("cluster_id"), F.col("name").alias("head_name"))
    # A plain join: adaptive execution splits a large cluster.
    headed = labels.join(materialise(sizes.join(heads, "cluster_id"), "heads"), "cluster_id")
    longer = F.greatest(F.length("name"), F.length("head_name"))
    distance = F.levenshtein("name", "head_name")
    rep_similarity = F.when(F.col("cluster_id").isNull(), F.lit(1.0)).otherwise(similarity(distance, longer))
    return (
        named.join(headed, "id", "left")
        .withColumn("rep_similarity", rep_similarity)
        .select(
            "id",
            F.coalesce("cluster_id", "id").alias("cluster_id"),
            F.coalesce("cluster_size", F.lit(1)).alias("cluster_size"),
            "rep_similarity",
            (F.col("rep_similarity") < THRESHOLD).alias("is_chained"),
        )
    )
