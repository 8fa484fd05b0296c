"""Shaping of the supply and financial sources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meldstone.functions.numbers import MONEY, money
from meldstone.operators.sequence import sequential_ids

# Source tags of the prepared sources.
SUPPLY = "supply_chain"
FINANCIAL = "financial"
SUPPLY_SUMMARY = "olist_supply_chain"
FINANCIAL_SUMMARY = "olist_financial"

DEFAULT_MARGIN = 0.18
SUPPLY_SUMMARY_MARGIN = 0.20
FINANCIAL_SUMMARY_MARGIN = 0.15

TOP_PRODUCTS = 10


def prepare_supply(raw_sellers: DataFrame) -> DataFrame:
    """Supply source: canonical name, joined address, source tag."""
    return raw_sellers.select(
        "seller_id",
        "seller_name",
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        "activity_places",
        "top_suppliers",
        F.lower(F.trim(F.coalesce("seller_name", F.lit("")))).alias("canonical_name"),
        F.concat_ws(", ", "seller_city", "seller_state").alias("address"),
        F.lit(SUPPLY).alias("source_system"),
    )


def seller_products(items: DataFrame) -> DataFrame:
    """Distinct (seller, product) pairs.

    Grouping by both keys pre-aggregates on the map side and spreads one huge
    seller over every reducer.
    """
    return items.select("seller_id", "product_id").distinct()


def product_breadth(items: DataFrame, top: int = TOP_PRODUCTS) -> DataFrame:
    """Per seller: number of distinct products and the first ``top`` ids in string order.

    The rank filter is applied before the exchange as well as after it, so a map
    task ships at most ``top`` ids per seller.
    """
    pairs = seller_products(items)
    counts = pairs.groupBy("seller_id").agg(F.count("product_id").try_cast("int").alias("activity_places"))
    # NULLs rank last and are dropped after the limit, so that both branches read
    # the same exchange of distinct pairs.
    by_product = Window.partitionBy("seller_id").orderBy(F.asc_nulls_last("product_id"))
    first = (
        pairs.withColumn("position", F.row_number().over(by_product))
        .where((F.col("position") <= top) & F.col("product_id").isNotNull())
        .groupBy("seller_id")
        .agg(F.concat_ws(",", F.array_sort(F.collect_list("product_id"))).alias("top_suppliers"))
    )
    return counts.join(first, "seller_id", "left").select(
        "seller_id", "activity_places", F.coalesce("top_suppliers", F.lit("")).alias("top_suppliers")
    )


def sellers_left_products(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Every seller with its product breadth; NULLs where it sold nothing."""
    return sellers.select("seller_id", "seller_city", "seller_state").join(
        product_breadth(items), "seller_id", "left"
    )


def build_supply(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Supply source from items and sellers; the name is made up from the id."""
    return supply_of(sellers_left_products(items, sellers))


def supply_of(sellers_with_breadth: DataFrame) -> DataFrame:
    """Supply source from sellers that bear their product breadth already."""
    name = F.concat(F.lit("Seller_"), F.col("seller_id"))
    return prepare_supply(sellers_with_breadth.withColumn("seller_name", name))


def seller_dimension(sellers: DataFrame) -> DataFrame:
    """One (city, state) per seller id; the smallest pair wins, NULLs last."""
    ranked = F.struct(F.col("city").isNull(), F.col("state").isNull(), "city", "state")
    picked = F.min_by(F.struct("city", "state"), ranked)
    return sellers.groupBy("seller_id").agg(picked.alias("place")).select("seller_id", "place.city", "place.state")


def financial_metrics(items: DataFrame, margin: float = DEFAULT_MARGIN) -> DataFrame:
    """Per seller: revenue, distinct orders and profit.

    Spark evaluates the distinct count in two steps, first by (seller, order),
    so a seller with a third of all rows is still counted in parallel.
    """
    total = F.sum(money(items, "price") + money(items, "freight_value"))
    return items.groupBy("seller_id").agg(
        total.cast("double").alias("revenue"),
        F.count_distinct("order_id").try_cast("int").alias("transaction_count"),
    ).withColumn("profit", F.col("revenue") * F.lit(margin))


def prepare_financial(items: DataFrame, sellers: DataFrame, margin: float = DEFAULT_MARGIN) -> DataFrame:
    """Financial source: per-seller metrics with the seller's city and state.

    ``sellers`` is a prepared supply source (columns seller_id, city, state).
    """
    return financial_of(financial_metrics(items, margin), sellers)


def financial_of(metrics: DataFrame, sellers: DataFrame) -> DataFrame:
    """Financial source from per-seller metrics."""
    return metrics.withColumn("source_system", F.lit(FINANCIAL)).join(seller_dimension(sellers), "seller_id", "left")


def prepare_sources(
    items: DataFrame, sellers: DataFrame, margin: float = DEFAULT_MARGIN
) -> tuple[DataFrame, DataFrame]:
    """(supply, financial) from raw items and sellers.

    The financial source takes its places from the raw sellers: they are those of
    the supply source, without its item aggregation.
    """
    places = sellers.select("seller_id", F.col("seller_city").alias("city"), F.col("seller_state").alias("state"))
    return build_supply(items, sellers), prepare_financial(items, places, margin)


def item_supply(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Item-level supply source, one output row per item."""
    place = sellers.select("seller_id", "seller_city", "seller_state")
    return items.select("seller_id", "product_id", "price").join(place, "seller_id", "left").select(
        F.col("seller_id").alias("corporate_id"),
        F.col("seller_city").alias("corporate_name"),
        F.col("seller_city").alias("address"),
        F.col("seller_state").alias("state"),
        F.lit(1).alias("activity_places"),
        F.col("product_id").alias("top_suppliers"),
        F.lit(None).cast("string").alias("main_customers"),
        F.col("price").cast("double").alias("revenue"),
        F.lit(0).alias("profit"),
        F.lit(SUPPLY).alias("source_system"),
    )


def order_financial(payments: DataFrame) -> DataFrame:
    """Order-level financial source: everything paid for one order."""
    total = F.sum(money(payments, "payment_value")).cast("double")
    return payments.groupBy("order_id").agg(total.alias("revenue")).select(
        F.col("order_id").alias("corporate_id"),
        F.lit("Financial Entity").alias("corporate_name"),
        F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("int").alias("activity_places"),
        F.lit(None).cast("string").alias("top_suppliers"),
        F.lit("unknown").alias("main_customers"),
        "revenue",
        F.col("revenue").alias("profit"),
        F.lit(FINANCIAL).alias("source_system"),
    )


def _seller_revenue(items: DataFrame, sellers: DataFrame, how: str) -> DataFrame:
    """Revenue per (seller, city, state), items aggregated before the join.

    Copies of a dimension row multiply the items they match, as a plain join
    would, so the number of copies is carried along.
    """
    totals = items.groupBy("seller_id").agg(F.sum(money(items, "price")).alias("total"))
    places = sellers.groupBy("seller_id", "seller_city", "seller_state").agg(F.count("*").alias("copies"))
    copies = F.coalesce("copies", F.lit(1)).cast("decimal(10,0)")
    return totals.join(places, "seller_id", how).select(
        "seller_id",
        "seller_city",
        "seller_state",
        (F.col("total") * copies).try_cast(MONEY).alias("revenue"),
    )


def margin_share(revenue: str, margin: float) -> Column:
    """Profit as a fixed share of decimal revenue, to two places."""
    return (F.col(revenue) * F.lit(f"{margin:.4f}").cast("decimal(6,4)")).try_cast(MONEY)


def seller_product_list(items: DataFrame) -> DataFrame:
    """The full product list of every seller, one (corporate_id, product_id) row each."""
    return seller_products(items).where(F.col("product_id").isNotNull()).withColumnRenamed("seller_id", "corporate_id")


def seller_product_chunks(items: DataFrame, size: int) -> DataFrame:
    """(corporate_id, chunk, n_products, products): every seller's products in order, ``size`` to a row.

    Joined in the order of their chunks, the lists of a seller are its sorted product list,
    however long. All pairs are numbered in one range-partitioned order, so no seller's list
    is ever in one place.
    """
    listed = sequential_ids(seller_product_list(items).where(F.col("corporate_id").isNotNull()), ["corporate_id", "product_id"], "place")
    begins = listed.groupBy(F.col("corporate_id").alias("of")).agg(F.min("place").alias("begin"))
    chunk = F.floor((F.col("place") - F.col("begin")) / size)
    placed = listed.join(begins, F.col("corporate_id") == F.col("of")).withColumn("chunk", chunk)
    return placed.groupBy("corporate_id", "chunk").agg(
        F.count("*").alias("n_products"), F.array_sort(F.collect_list("product_id")).alias("products")
    )


def seller_supply_summary(
    items: DataFrame, sellers: DataFrame, load_date: date, margin: float = SUPPLY_SUMMARY_MARGIN
) -> DataFrame:
    """Seller-level supply source: one row per seller and place, of money and product count.

    The products themselves are the rows of ``seller_product_list``, so a row has the same
    size for any seller.
    """
    counts = seller_products(items).groupBy("seller_id").agg(F.count("product_id").alias("n_products"))
    counts = counts.withColumnRenamed("seller_id", "counted_id")
    revenue = _seller_revenue(items, sellers, "left")
    return revenue.join(counts, F.col("seller_id").eqNullSafe(F.col("counted_id"))).select(
        F.col("seller_id").alias("corporate_id"),
        F.col("seller_city").alias("corporate_name"),
        F.concat("seller_city", F.lit(", "), "seller_state").alias("address"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        F.lit(1).alias("activity_places"),
        "n_products",
        F.lit(None).cast("string").alias("main_customers"),
        "revenue",
        margin_share("revenue", margin).alias("profit"),
        F.lit(SUPPLY_SUMMARY).alias("source_system"),
        F.lit(load_date).alias("load_date"),
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    """Amount per (order, payment type)."""
    return payments.groupBy("order_id", "payment_type").agg(
        F.sum(money(payments, "payment_value")).try_cast(MONEY).alias("revenue")
    )


def payment_financial_summary(
    payments: DataFrame, load_date: date, margin: float = FINANCIAL_SUMMARY_MARGIN
) -> DataFrame:
    """Payment-level financial source, numbered in (order, payment type) order."""
    numbered = sequential_ids(payment_totals(payments), ["order_id", "payment_type"], "corporate_id")
    return numbered.select(
        "corporate_id",
        F.concat(F.lit("Order_"), "order_id").alias("corporate_name"),
        F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.lit(1).alias("activity_places"),
        F.lit(None).cast("string").alias("top_suppliers"),
        F.col("payment_type").alias("main_customers"),
        "revenue",
        margin_share("revenue", margin).alias("profit"),
        F.lit(FINANCIAL_SUMMARY).alias("source_system"),
        F.lit(load_date).alias("load_date"),
    )


def supplier_diversity(items: DataFrame, sellers: DataFrame, margin: float = SUPPLY_SUMMARY_MARGIN) -> DataFrame:
    """Per supplier: revenue and number of different products; rows without a place are out."""
    located = sellers.where(
        F.col("seller_id").isNotNull() & F.col("seller_city").isNotNull() & F.col("seller_state").isNotNull()
    )
    products = seller_products(items).groupBy("seller_id").agg(F.count("*").alias("product_diversity"))
    return (
        _seller_revenue(items, located, "inner")
        .join(products, "seller_id")
        .select(
            F.col("seller_id").alias("corporate_id"),
            F.col("seller_city").alias("corporate_name"),
            F.col("seller_state").alias("state"),
            F.col("revenue").cast("double").alias("revenue"),
            "product_diversity",
            F.concat("seller_city", F.lit(", "), "seller_state").alias("address"),
            F.lit(SUPPLY_SUMMARY).alias("source_system"),
            (F.col("revenue").cast("double") * F.lit(margin)).alias("profit"),
        )
    )
