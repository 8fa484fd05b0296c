"""Merging the supply and financial sources into one row per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meldstone.functions.keys import corporate_id
from meldstone.functions.numbers import profit_margin
from meldstone.functions.text import cleanse_name, normalize_address
from meldstone.operators import evidence
from meldstone.operators.clusters import connected_components
from meldstone.operators.prepare import FINANCIAL, SUPPLY

# Columns whose value is taken from the best-ranked row that has one.
SURVIVING = ("corporate_name", "address", "city", "state", "top_suppliers", "main_customers")
METRICS = ("revenue", "profit", "transaction_count")


def keyed_supply(supply: DataFrame) -> DataFrame:
    """Supply rows with their cleansed name and entity id."""
    name = cleanse_name(F.col("canonical_name"))
    return supply.select(
        "seller_id",
        corporate_id(name, normalize_address(F.col("address"))).alias("corporate_id"),
        name.alias("corporate_name"),
        "address",
        "city",
        "state",
        F.col("activity_places").cast("int").alias("activity_places"),
        F.col("top_suppliers").cast("string").alias("top_suppliers"),
    )


def union_sources(supply: DataFrame, financial: DataFrame) -> DataFrame:
    """Both sources in one layout of 13 columns.

    Financial rows take id and place from the supply row of the same seller; a
    seller without one keeps NULLs. The sources meet in a single join whose rows
    are then split in two, so neither is computed twice.
    """
    supply_row = {
        "seller_id": F.col("seller_id"),
        "corporate_id": F.col("corporate_id"),
        "corporate_name": F.col("corporate_name"),
        "address": F.col("address"),
        "city": F.col("city"),
        "state": F.col("state"),
        "activity_places": F.col("activity_places"),
        "top_suppliers": F.col("top_suppliers"),
        "main_customers": F.lit(None).cast("string"),
        "revenue": F.lit(None).cast("double"),
        "profit": F.lit(None).cast("double"),
        "transaction_count": F.lit(None).cast("int"),
        "source_system": F.lit(SUPPLY),
    }
    financial_row = supply_row | {
        "seller_id": F.col("fin_seller_id"),
        "corporate_name": cleanse_name(F.concat(F.lit("seller "), F.col("fin_seller_id"))),
        "activity_places": F.lit(None).cast("int"),
        "top_suppliers": F.lit(None).cast("string"),
        "revenue": F.col("revenue"),
        "profit": F.col("profit"),
        "transaction_count": F.col("transaction_count"),
        "source_system": F.lit(FINANCIAL),
    }

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[value.alias(name) for name, value in values.items()])

    metrics = financial.select(
        F.col("seller_id").alias("fin_seller_id"),
        F.lit(True).alias("in_financial"),
        F.col("revenue").cast("double").alias("revenue"),
        F.col("profit").cast("double").alias("profit"),
        F.col("transaction_count").cast("int").alias("transaction_count"),
    )
    joined = (
        keyed_supply(supply)
        .withColumn("in_supply", F.lit(True))
        .join(metrics, F.col("seller_id") == F.col("fin_seller_id"), "full_outer")
    )
    rows = F.array(F.when(F.col("in_supply"), row(supply_row)), F.when(F.col("in_financial"), row(financial_row)))
    return joined.select(F.inline(F.array_compact(rows)))


def first_by_priority(value: str) -> Column:
    """Value of the first row that has one: supply before financial, then smallest seller id."""
    order = F.struct(F.col("source_system") != SUPPLY, "seller_id", value)
    return F.min_by(value, F.when(F.col(value).isNotNull(), order))


def source_tags() -> Column:
    """Comma-joined tags of the sources present in a group, in name order."""
    tags = [F.when(F.max(F.col("source_system") == tag), F.lit(tag)) for tag in sorted((SUPPLY, FINANCIAL))]
    return F.concat_ws(",", *tags)


def merge_entities(unioned: DataFrame, metric_merge: str = "max") -> DataFrame:
    """One row per corporate_id.

    Every aggregate has a map-side partial form, so a group of any size (for
    instance all rows without an id) reaches its reducer as one row per task.
    ``metric_merge`` is "max" or "sum".
    """
    combine = {"max": F.max, "sum": F.sum}[metric_merge]
    types = {f.name: f.dataType for f in unioned.schema.fields}
    if metric_merge == "sum":
        # A seller with several supply rows brings its financial row several times.
        place = F.row_number().over(Window.partitionBy("corporate_id", "seller_id", "source_system").orderBy(*METRICS))
        again = (F.col("source_system") == FINANCIAL) & (place > 1)
        unioned = unioned.withColumn("_again", again)
        unioned = unioned.withColumns({c: F.when(~F.col("_again"), F.col(c)) for c in METRICS}).drop("_again")
    merged = unioned.groupBy("corporate_id").agg(
        *[first_by_priority(c).alias(c) for c in SURVIVING],
        F.max("activity_places").alias("activity_places"),
        *[combine(c).cast(types[c]).alias(c) for c in METRICS],
        source_tags().alias("source_system"),
    )
    return merged.select(
        "corporate_id",
        "corporate_name",
        "address",
        "city",
        "state",
        "activity_places",
        "top_suppliers",
        "main_customers",
        "revenue",
        "profit",
        "transaction_count",
        "source_system",
        profit_margin(F.col("revenue"), F.col("profit")).alias("profit_margin"),
    )


def seller_records(supply: DataFrame) -> DataFrame:
    """Sellers as records to resolve: (id, name, block_key). A seller without a city or state has no block."""
    return supply.select(
        F.col("seller_id").alias("id"),
        F.col("canonical_name").alias("name"),
        F.concat("city", F.lit("|"), "state").alias("block_key"),
    )


def resolve_sellers(supply: DataFrame) -> DataFrame:
    """(id, cluster_id) of sellers whose names stand for one entity within a city and state."""
    links = evidence.evident_matches(seller_records(supply)).select("id_a", "id_b")
    return connected_components(links)


def harmonize(supply: DataFrame, financial: DataFrame, metric_merge: str = "max") -> DataFrame:
    return merge_entities(union_sources(supply, financial), metric_merge)


def harmonize_clusters(
    supply: DataFrame, financial: DataFrame, clusters: DataFrame, metric_merge: str = "max"
) -> DataFrame:
    """Harmonise after fuzzy resolution.

    ``clusters`` maps a seller id (column id) to the seller id that stands for its
    cluster (column cluster_id); members take that seller's corporate_id and merge.
    """
    unioned = union_sources(supply, financial)
    return merge_entities(resolved_ids(unioned, clusters, keyed_supply(supply)), metric_merge)


def resolved_ids(rows: DataFrame, clusters: DataFrame, keyed: DataFrame | None = None) -> DataFrame:
    """``rows`` (seller_id, corporate_id, ...) with the corporate_id of the seller that heads their cluster.

    ``keyed`` has the corporate_id of every seller; by default ``rows`` themselves do.
    """
    heads = rows if keyed is None else keyed
    ids = heads.groupBy(F.col("seller_id").alias("cluster_id")).agg(F.min("corporate_id").alias("cluster_corporate_id"))
    mapping = clusters.select(F.col("id").alias("seller_id"), "cluster_id").join(ids, "cluster_id")
    resolved = rows.join(mapping, "seller_id", "left").withColumn(
        "corporate_id", F.coalesce("cluster_corporate_id", "corporate_id")
    )
    return resolved.drop("cluster_id", "cluster_corporate_id")
