"""The reference-shaped sources derived from the shared star-schema tables.

Money leaves the scan as decimals: input prices carry two places, so sums are
exact and do not depend on the order in which partitions are added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldstone.sources.schemas import TABLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation with its two-letter region code (AF, AM, AS, EU, MI)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name", F.upper(F.substring("r_name", 1, 2)).alias("state")
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _nations(spark, sf_dir)
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(nations, supplier.s_nationkey == nations.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.col("n_name").alias("seller_city"),
        F.col("state").alias("seller_state"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(16,4)").alias("freight_value"),
    )


def unknown_seller_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the event log as items of sellers that the seller table lacks."""
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return bought.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("order_id"),
        F.lit(1).alias("order_item_id"),
        F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("product_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("seller_id"),
        F.col("ts").alias("shipping_limit_date"),
        F.col("value").cast("decimal(12,2)").alias("price"),
        F.lit(0).cast("decimal(16,4)").alias("freight_value"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    after_discount = (price * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
    value = after_discount * (1 + F.col("l_tax").cast("decimal(4,2)"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        value.cast("decimal(18,2)").alias("payment_value"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as match candidates, blocked by city and state."""
    nations = _nations(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    return customer.join(nations, customer.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat_ws("|", "n_name", "state").alias("block_key"),
        F.col("n_name").alias("city"),
        F.col("state").alias("state"),
        F.col("c_mktsegment").alias("market"),
        F.col("c_acctbal").alias("balance"),
    )


def long_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under names of more than 20 characters, blocked by city and state."""
    name = F.concat("name", F.lit(" "), "market", F.lit(" trading company of "), "city")
    return companies(spark, sf_dir).select("id", name.alias("name"), "block_key")


def shop_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as shops named after them, blocked by brand; some names lack a letter, some bear a number."""
    name, turn = F.col("p_name"), F.col("p_partkey") % 5
    lacking = F.concat(F.substring(name, 1, 2), F.substring(name, F.lit(4), F.length(name)))
    numbered = F.concat(name, F.lit(" branch "), F.col("p_size").cast("string"))
    shop = F.when(turn == 1, lacking).when(turn == 2, numbered).otherwise(name)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(shop, F.lit(" "), "p_type", F.lit(" trading works")).alias("name"),
        F.col("p_brand").alias("block_key"),
    )


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows rendered as training-job log messages, one run per user."""
    events = table(spark, sf_dir, "events")
    value = F.col("value").cast("decimal(12,2)").cast("string")
    counted = F.col("event_id").cast("string")
    message = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("  - AUC: "), value))
        .when(F.col("event_type") == "click", F.concat(F.lit("  - F1-Score: "), value))
        .when(
            F.col("event_type") == "view",
            F.concat(
                F.lit("|total_records|high_profit_count|low_profit_count|\n|"),
                (F.col("event_id") + F.col("user_id") + 1).cast("string"),
                F.lit(" |"),
                counted,
                F.lit(" |"),
                (F.col("user_id") + 1).cast("string"),
                F.lit(" |"),
            ),
        )
        .when(F.col("event_type") == "signup", F.concat(F.lit("MLflow run ID: "), F.md5(counted)))
        .otherwise(F.concat(F.lit("Could not set option: "), F.col("props")))
    )
    return events.select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
        F.col("event_id").alias("seq"),
        "ts",
        message.alias("message"),
    )
