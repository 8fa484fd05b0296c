"""Composite inputs that several registered queries share."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldstone.functions.numbers import MONEY
from meldstone.operators.harmonize import harmonize
from meldstone.operators.prepare import (
    FINANCIAL_SUMMARY,
    FINANCIAL_SUMMARY_MARGIN,
    margin_share,
    payment_totals,
    prepare_sources,
)
from meldstone.operators.registry import registry_staging
from meldstone.sources import tables
from meldstone.sources.registry_store import RegistryStore
from meldstone.sources.storage import scratch_path

# Two loads of the registry, both with all sellers: items shipped before the cutoff, then
# the others, undated ones included. The second load also brings the purchases of the event
# log, whose sellers are not in the seller table, so that they have no entity id.
CUTOFF = datetime(1998, 6, 1)
FIRST_LOAD = datetime(2025, 11, 15, 10, 0, 0)
SECOND_LOAD = datetime(2025, 12, 17, 10, 0, 0)
BETWEEN_LOADS = datetime(2025, 12, 1)
# Where only a part of the sellers takes part in the second load: those of this state.
LATE_STATE = "AS"
# The sellers of the shared tables are few; a registry of millions takes more buckets.
REGISTRY_BUCKETS = 8
# Items in a file that lands for the stream.
LANDED_ROWS = 1_000_000


def sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(supply, financial) of the whole tables."""
    return prepare_sources(tables.order_items(spark, sf), tables.sellers(spark, sf))


def harmonized(spark: SparkSession, sf: str) -> DataFrame:
    return harmonize(*sources(spark, sf))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return registry_staging(harmonized(spark, sf), SECOND_LOAD)


def _load(spark: SparkSession, sf: str, first: bool) -> DataFrame:
    early = F.coalesce(F.col("shipping_limit_date") < F.lit(CUTOFF), F.lit(False))
    items = tables.order_items(spark, sf).where(early if first else ~early)
    if not first:
        items = items.unionByName(tables.unknown_seller_items(spark, sf))
    sellers = tables.sellers(spark, sf)
    return registry_staging(harmonize(*prepare_sources(items, sellers)), FIRST_LOAD if first else SECOND_LOAD)


def first_load(spark: SparkSession, sf: str) -> DataFrame:
    return _load(spark, sf, True)


def second_load(spark: SparkSession, sf: str) -> DataFrame:
    return _load(spark, sf, False)


def loaded_store(spark: SparkSession, sf: str) -> RegistryStore:
    """A registry that both loads went into."""
    store = RegistryStore(spark, scratch_path(spark, "registry"), REGISTRY_BUCKETS)
    store.load(first_load(spark, sf), FIRST_LOAD)
    store.load(second_load(spark, sf), SECOND_LOAD)
    return store


def regional_store(spark: SparkSession, sf: str) -> RegistryStore:
    """A registry whose second load brought the sellers of LATE_STATE only."""
    store = RegistryStore(spark, scratch_path(spark, "registry"), REGISTRY_BUCKETS)
    store.load(first_load(spark, sf), FIRST_LOAD)
    store.load(second_load(spark, sf).where(F.col("state") == LATE_STATE), SECOND_LOAD)
    return store


def training_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Harmonised sellers plus one entity per (order, payment type)."""
    merged = harmonized(spark, sf).select(
        "corporate_id",
        F.col("revenue").cast(MONEY).alias("revenue"),
        F.col("profit").cast(MONEY).alias("profit"),
        "activity_places",
        "top_suppliers",
        "source_system",
    )
    paid = payment_totals(tables.payments(spark, sf)).select(
        F.concat_ws("-", "order_id", "payment_type").alias("corporate_id"),
        "revenue",
        margin_share("revenue", FINANCIAL_SUMMARY_MARGIN).alias("profit"),
        F.lit(1).alias("activity_places"),
        F.lit(None).cast("string").alias("top_suppliers"),
        F.lit(FINANCIAL_SUMMARY).alias("source_system"),
    )
    return merged.unionByName(paid)


def account_contract_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in the layout of the prepared contract; account balances can be negative."""
    orders = tables.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").cast("int").alias("n"))
    companies = tables.companies(spark, sf)
    rate = F.when(F.col("market") == "MACHINERY", 0.2).otherwise(0.18)
    return companies.join(orders, companies.id == orders.o_custkey, "left").select(
        F.col("id").cast("string").alias("corporate_id"),
        F.col("balance").alias("revenue"),
        (F.col("balance") * rate).alias("profit"),
        F.lit(0.18).alias("profit_margin"),
        "market",
        F.when(F.col("market") == "FURNITURE", F.col("city")).otherwise(F.col("state")).alias("state"),
        F.lit(1).alias("activity_places"),
        F.col("n").alias("transaction_count"),
        F.ascii("state").alias("state_code"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """One run per user of the event log; it failed if its last event is an error."""
    events = tables.table(spark, sf, "events")
    last = F.max_by("event_type", "event_id")
    return (
        events.groupBy("user_id")
        .agg(
            F.min("ts").alias("started_on"),
            F.max("ts").alias("ended_on"),
            last.alias("last_type"),
        )
        .select(
            F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
            F.when(F.col("last_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state"),
            "started_on",
            F.timestamp_diff("SECOND", "started_on", "ended_on").alias("execution_time"),
        )
    )


def all_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its length as score; the label is NULL where it has none."""
    documents = tables.table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    labels = tables.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents.join(labels, "doc_id", "left")


def quality_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with their length as score and a length rule as prediction."""
    documents = tables.table(spark, sf, "documents").select("doc_id", "n_chars")
    labels = tables.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return labels.join(documents, "doc_id").select(
        "doc_id",
        "label",
        F.col("n_chars").cast("double").alias("score"),
        F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("prediction"),
    )
