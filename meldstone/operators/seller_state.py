"""Per-seller aggregates that can be added to.

A distinct count or a list of the first products cannot be added up from items, but it can
from pairs that were never seen before. ``facts`` turns items into (seller, product) and
(seller, order) facts, of which the caller passes on the new ones only, and rows of money;
``increments`` sums these up per seller, and ``merged`` adds them to what is known. All
three have the same result however the items were cut into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.functions.numbers import money
from meldstone.operators.prepare import DEFAULT_MARGIN, TOP_PRODUCTS, financial_of, supply_of

_TOTAL = T.DecimalType(38, 4)
STATE = T.StructType(
    [
        T.StructField("seller_id", T.StringType()),
        T.StructField("products", T.LongType()),
        T.StructField("first_products", T.ArrayType(T.StringType())),
        T.StructField("orders", T.LongType()),
        T.StructField("revenue", _TOTAL),
    ]
)

#: Columns that identify a fact; a fact counts once.
FACT = ("seller_id", "kind", "value")


def facts(items: DataFrame) -> DataFrame:
    """(seller_id, kind, value): the seller's products and orders, repeated as items repeat them."""
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value"))
                      for kind, column in (("product", "product_id"), ("order", "order_id"))])
    return items.select("seller_id", F.explode(pairs).alias("fact")).select("seller_id", "fact.kind", "fact.value")


def amounts(items: DataFrame) -> DataFrame:
    """(seller_id, kind, amount) of every item, in the layout that goes with facts."""
    amount = (money(items, "price") + money(items, "freight_value")).cast(_TOTAL)
    return items.select("seller_id", F.lit("item").alias("kind"), amount.alias("amount"))


def increments(new: DataFrame) -> DataFrame:
    """STATE rows from new facts and amounts (seller_id, kind, value, amount).

    The rank filter works before the exchange as well as after it, so a task ships at most
    ten products of a seller.
    """
    of_kind = lambda kind: F.count(F.when(F.col("kind") == kind, F.col("value")))
    sums = new.groupBy("seller_id").agg(
        of_kind("product").alias("products"), of_kind("order").alias("orders"), F.sum("amount").cast(_TOTAL).alias("revenue")
    )
    products = new.where("kind = 'product' AND value IS NOT NULL").select("seller_id", "value")
    rank = F.row_number().over(Window.partitionBy("seller_id").orderBy("value"))
    first = products.withColumn("rank", rank).where(F.col("rank") <= TOP_PRODUCTS)
    lists = first.groupBy(F.col("seller_id").alias("of")).agg(F.array_sort(F.collect_list("value")).alias("first_products"))
    joined = sums.join(lists, F.col("seller_id").eqNullSafe(F.col("of")), "left")
    none = F.array().cast("array<string>")
    return joined.withColumn("first_products", F.coalesce("first_products", none)).select(*STATE.names)


def merged(known: DataFrame, added: DataFrame) -> DataFrame:
    """STATE rows of both, those of one seller added up."""
    rows = known.select(*STATE.names).unionByName(added.select(*STATE.names))
    # A seller has two rows at most, so the lists that meet are two.
    both = F.flatten(F.collect_list("first_products"))
    return rows.groupBy("seller_id").agg(
        F.sum("products").alias("products"),
        F.slice(F.array_sort(both), 1, TOP_PRODUCTS).alias("first_products"),
        F.sum("orders").alias("orders"),
        F.sum("revenue").cast(_TOTAL).alias("revenue"),
    )


def sources_of(state: DataFrame, sellers: DataFrame, margin: float = DEFAULT_MARGIN) -> tuple[DataFrame, DataFrame]:
    """(supply, financial) as prepare_sources gives them, from STATE rows and sellers."""
    breadth = state.select(
        "seller_id",
        F.col("products").try_cast("int").alias("activity_places"),
        F.concat_ws(",", "first_products").alias("top_suppliers"),
    )
    located = sellers.select("seller_id", "seller_city", "seller_state").join(breadth, "seller_id", "left")
    revenue = F.col("revenue").cast("double")
    metrics = state.select(
        "seller_id",
        revenue.alias("revenue"),
        F.col("orders").try_cast("int").alias("transaction_count"),
        (revenue * F.lit(margin)).alias("profit"),
    )
    places = sellers.select("seller_id", F.col("seller_city").alias("city"), F.col("seller_state").alias("state"))
    return supply_of(located), financial_of(metrics, places)
