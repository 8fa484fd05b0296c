import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from meldstone.operators import prepare
from meldstone.operators.sequence import sequential_ids
from tests.conftest import ITEM_COLUMNS

FULL_ITEMS = "order_id string, product_id string, seller_id string, price double, freight_value double"
SELLERS = "seller_id string, seller_city string, seller_state string"


def by(rows, key):
    return {r[key]: r for r in rows.collect()}


def test_prepare_supply(raw_sellers):
    rows = by(prepare.prepare_supply(raw_sellers), "seller_id")
    assert len(rows) == 2
    paper = rows["w-17"]
    assert (paper.canonical_name, paper.activity_places, paper.state) == ("kestrel paper", 4, "NO")
    assert (paper.address, paper.source_system) == ("Tromso, NO", "supply_chain")


def test_address_skips_nulls(spark):
    raw = spark.createDataFrame(
        [("1", " Acme ", None, "SP", 1, ""), ("2", None, None, None, 1, "")],
        "seller_id string, seller_name string, seller_city string, seller_state string, activity_places int, top_suppliers string",
    )
    rows = by(prepare.prepare_supply(raw), "seller_id")
    assert (rows["1"].address, rows["1"].canonical_name) == ("SP", "acme")
    assert (rows["2"].address, rows["2"].canonical_name) == ("", "")


def test_prepare_financial(spark, raw_sellers):
    items = spark.createDataFrame(
        [("a9", "w-17", 41.5, 3.25), ("a9", "w-17", 8.5, 0.75), ("b2", "w-17", 146.0, 0.0), ("c4", "w-18", 12.0, 1.0)],
        ITEM_COLUMNS,
    )
    rows = by(prepare.prepare_financial(items, prepare.prepare_supply(raw_sellers)), "seller_id")
    assert len(rows) == 2
    paper = rows["w-17"]
    assert math.isclose(paper.revenue, 200.0) and math.isclose(paper.profit, 36.0)
    assert (paper.transaction_count, paper.source_system, paper.city) == (2, "financial", "Tromso")


def test_seller_dimension_picks_one_row(spark):
    sellers = spark.createDataFrame(
        [("1", "Rio", "RJ"), ("1", "Belem", "PA"), ("1", None, "AA"), ("2", None, None)],
        "seller_id string, city string, state string",
    )
    rows = by(prepare.seller_dimension(sellers.repartition(3)), "seller_id")
    assert (rows["1"].city, rows["1"].state) == ("Belem", "PA")
    assert (rows["2"].city, rows["2"].state) == (None, None)


def items_with(spark, pairs):
    return spark.createDataFrame([(f"o{i}", p, s, 1.0, 0.0) for i, (s, p) in enumerate(pairs)], FULL_ITEMS)


def test_first_ten_products_in_string_order(spark):
    pairs = [("many", str(n)) for n in range(1, 13)] * 2 + [("ten", f"p{n}") for n in range(10)]
    pairs += [("none", None), ("two", "10"), ("two", "2")]
    sellers = spark.createDataFrame([(s, "c", "SS") for s in ("many", "ten", "none", "two", "idle")], SELLERS)
    rows = by(prepare.build_supply(items_with(spark, pairs), sellers), "seller_id")
    assert rows["many"].activity_places == 12
    assert rows["many"].top_suppliers == ",".join(sorted(str(n) for n in range(1, 13))[:10])
    assert (rows["ten"].activity_places, len(rows["ten"].top_suppliers.split(","))) == (10, 10)
    assert rows["two"].top_suppliers == "10,2"
    assert (rows["none"].activity_places, rows["none"].top_suppliers) == (0, "")
    assert (rows["idle"].activity_places, rows["idle"].top_suppliers) == (None, None)
    assert rows["many"].seller_name == "Seller_many"


LOADED = date(2025, 12, 17)


def test_summary_has_one_row_per_seller_and_the_list_is_whole(spark):
    pairs = [("big", f"p{n % 50}") for n in range(400)] + [("small", "x"), (None, "y"), ("bare", None)]
    sellers = spark.createDataFrame([("big", "c", "SS")], SELLERS)
    items = items_with(spark, pairs)
    summary = by(prepare.seller_supply_summary(items, sellers, LOADED), "corporate_id")
    assert {k: (r.n_products, r.revenue, r.load_date) for k, r in summary.items()} == {
        "big": (50, 400, LOADED), "small": (1, 1, LOADED), None: (1, 1, LOADED), "bare": (0, 1, LOADED)
    }
    listed = prepare.seller_product_list(items).collect()
    assert len(listed) == 52 and {r.product_id for r in listed if r.corporate_id == "big"} == {f"p{n}" for n in range(50)}


def test_money_that_does_not_fit_becomes_null(spark):
    items = spark.createDataFrame([("o", "s", 1e300, 0.0)], ITEM_COLUMNS).withColumn("product_id", F.lit("p"))
    assert prepare.seller_supply_summary(items, spark.createDataFrame([], SELLERS), LOADED).first().revenue is None


def test_repeated_dimension_rows_multiply_revenue(spark):
    items = items_with(spark, [("1", "a"), ("1", "b")])
    sellers = spark.createDataFrame([("1", "c", "SS"), ("1", "c", "SS"), ("1", "d", "SS")], SELLERS)
    got = {r.corporate_name: r.revenue for r in prepare.supplier_diversity(items, sellers).collect()}
    assert got == {"c": 4.0, "d": 2.0}
    joined = items.join(sellers, "seller_id").groupBy("seller_city").sum("price").collect()
    assert {r[0]: r[1] for r in joined} == got


def test_null_places_are_left_out_of_diversity(spark):
    items = items_with(spark, [("1", "a"), ("2", "a"), ("3", "a")])
    sellers = spark.createDataFrame([("1", "c", "SS"), ("2", None, "SS")], SELLERS)
    assert [r.corporate_id for r in prepare.supplier_diversity(items, sellers).collect()] == ["1"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_sequential_ids_order_and_ties(spark, partitions):
    payments = spark.createDataFrame(
        [(f"o{n % 100:03}", t, 1.0) for n in range(400) for t in ("boleto", "card")],
        "order_id string, payment_type string, payment_value double",
    ).repartition(partitions)
    rows = prepare.payment_financial_summary(payments, LOADED).orderBy("corporate_id").collect()
    assert [r.corporate_id for r in rows] == list(range(1, 201))
    assert [(r.corporate_name, r.main_customers) for r in rows] == sorted((r.corporate_name, r.main_customers) for r in rows)
    assert rows[0].revenue == 4 and float(rows[0].profit) == 0.6


def test_sequential_ids_of_nothing(spark):
    empty = spark.createDataFrame([], "a string")
    assert sequential_ids(empty, ["a"]).count() == 0


def test_order_financial(spark):
    payments = spark.createDataFrame(
        [("o1", 1.1), ("o1", 2.2), ("o2", 3.0), (None, 4.0)], "order_id string, payment_value double"
    )
    rows = by(prepare.order_financial(payments), "corporate_id")
    assert rows["o1"].revenue == rows["o1"].profit == 3.3
    assert rows["o1"].main_customers == "unknown" and len(rows) == 3


def test_item_supply_keeps_every_item(spark):
    items = items_with(spark, [("1", "a"), ("1", "a"), ("9", "b")])
    sellers = spark.createDataFrame([("1", "c", "SS")], SELLERS)
    rows = prepare.item_supply(items, sellers).collect()
    assert len(rows) == 3
    assert {(r.corporate_id, r.corporate_name, r.top_suppliers) for r in rows} == {("1", "c", "a"), ("9", None, "b")}
