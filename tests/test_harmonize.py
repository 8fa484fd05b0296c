from meldstone.operators import prepare
from meldstone.operators.harmonize import harmonize, harmonize_clusters, resolve_sellers, union_sources
from tests.conftest import ITEM_COLUMNS, SELLER_COLUMNS


def sources(spark, sellers, items):
    supply = prepare.prepare_supply(spark.createDataFrame(sellers, SELLER_COLUMNS))
    financial = prepare.prepare_financial(spark.createDataFrame(items, ITEM_COLUMNS), supply)
    return supply, financial


TWO = [
    ("w-17", "Kestrel Paper", "Tromso", "NO", 4, "Fjord Pulp"),
    ("w-18", "Harbour Lamps", "Galway", "IE", 6, "Wick & Oil"),
]


def test_merges_both_sources(spark):
    items = [("a9", "w-17", 41.5, 3.25), ("a9", "w-17", 8.5, 0.75), ("b2", "w-17", 146.0, 0.0)]
    rows = harmonize(*sources(spark, TWO, items)).collect()
    assert len(rows) == 2
    record = next(r for r in rows if r.city == "Tromso")
    assert (record.activity_places, record.transaction_count) == (4, 2)
    assert record.source_system == "financial,supply_chain"
    assert (record.revenue, round(record.profit, 2), round(record.profit_margin, 4)) == (200.0, 36.0, 0.18)
    other = next(r for r in rows if r.city == "Galway")
    assert (other.revenue, other.profit_margin, other.source_system) == (None, 0.0, "supply_chain")
    assert record.corporate_name == "kestrel paper"


def test_unmatched_financial_rows_share_the_null_group(spark):
    items = [("o1", "seller_x", 10.0, 0.0), ("o2", "seller_y", 30.0, 0.0), ("o3", "w-17", 5.0, 0.0)]
    rows = harmonize(*sources(spark, TWO, items)).collect()
    assert len(rows) == 3
    null_group = next(r for r in rows if r.corporate_id is None)
    assert null_group.corporate_name == "seller seller x"
    assert (null_group.revenue, null_group.source_system, null_group.city) == (30.0, "financial", None)


def test_same_name_and_address_merge(spark):
    sellers = [
        ("b", "ACME  Corp", "Sao Paulo", "SP", None, None),
        ("a", "Acme corp", "Sao-Paulo", "SP", 7, None),
        ("c", "Acme corp.", "Sao Paulo", "SP", 2, "late"),
    ]
    items = [("o1", "a", 10.0, 0.0), ("o2", "b", 30.0, 0.0)]
    supply, financial = sources(spark, sellers, items)
    for partitions in (1, 5):
        row = harmonize(supply.repartition(partitions), financial.repartition(partitions)).first()
        assert (row.activity_places, row.revenue, row.city) == (7, 30.0, "Sao-Paulo")
        assert row.top_suppliers == "late" and row.main_customers is None
    assert harmonize(supply, financial, metric_merge="sum").first().revenue == 40.0


def test_repeated_seller_ids_fan_out_like_a_join(spark):
    sellers = [("a", "One", "X", "SP", 1, "p"), ("a", "Two", "Y", "RJ", 2, "q")]
    supply, financial = sources(spark, sellers, [("o1", "a", 10.0, 0.0)])
    rows = union_sources(supply, financial).collect()
    assert len(rows) == 4
    assert sorted(r.city for r in rows if r.source_system == "financial") == ["X", "Y"]
    assert sorted(r.corporate_name for r in rows) == ["one", "seller a", "seller a", "two"]


def test_union_has_thirteen_columns(spark):
    assert union_sources(*sources(spark, TWO, [])).columns == [
        "seller_id", "corporate_id", "corporate_name", "address", "city", "state", "activity_places",
        "top_suppliers", "main_customers", "revenue", "profit", "transaction_count", "source_system",
    ]


def test_clusters_feed_back(spark):
    items = [("o1", "w-17", 10.0, 0.0), ("o2", "w-18", 30.0, 0.0)]
    clusters = spark.createDataFrame([("w-17", "w-17"), ("w-18", "w-17")], "id string, cluster_id string")
    rows = harmonize_clusters(*sources(spark, TWO, items), clusters).collect()
    assert len(rows) == 1
    assert (rows[0].corporate_name, rows[0].revenue, rows[0].activity_places) == ("kestrel paper", 30.0, 6)


def test_sums_count_a_financial_row_once(spark):
    sellers = [("a", "One", "X", "NO", 1, "p"), ("a", "One", "X", "NO", 2, "q"), ("b", "one", "X", "NO", 1, "r")]
    supply, financial = sources(spark, sellers, [("o1", "a", 10.0, 0.0), ("o2", "b", 7.0, 0.0)])
    row = harmonize(supply, financial, metric_merge="sum").first()
    assert (row.revenue, row.transaction_count) == (17.0, 2)


def test_similar_sellers_of_a_place_become_one_entity(spark):
    sellers = [
        ("s1", "Northern Lights Printing House", "Bodo", "NO", 1, "p"),
        ("s2", "Northern Light Printing House", "Bodo", "NO", 2, "q"),
        ("s3", "Northern Lights Printing House", "Cork", "IE", 3, "r"),
        ("s4", "...", "Bodo", "NO", 1, None),
        ("s5", None, "Bodo", "NO", 1, None),
    ]
    supply, financial = sources(spark, sellers, [("o1", "s1", 10.0, 0.0), ("o2", "s2", 30.0, 0.0)])
    resolved = resolve_sellers(supply)
    assert {(r.id, r.cluster_id) for r in resolved.collect()} == {("s1", "s1"), ("s2", "s1")}
    rows = harmonize_clusters(supply, financial, resolved).collect()
    # The nameless sellers share an exact id, as before; they are nobody's fuzzy match.
    assert len(rows) == 3 and max(r.revenue or 0 for r in rows) == 30.0


def test_ids_that_count_up_and_sellers_without_a_place_stay_apart(spark):
    sellers = [(f"S-{n}", f"Seller_S-{n}", *place, 1, None) for n, place in
               ((1001, ("Bodo", "NO")), (1002, ("Bodo", "NO")), (2001, (None, None)), (2002, (None, None)))]
    supply, financial = sources(spark, sellers, [("o1", "S-1001", 10.0, 0.0), ("o2", "S-1002", 30.0, 0.0)])
    assert resolve_sellers(supply).isEmpty()
    rows = harmonize_clusters(supply, financial, resolve_sellers(supply)).collect()
    assert len(rows) == 4 and sorted(r.revenue for r in rows if r.revenue) == [10.0, 30.0]
    half = [("a", "Quiet Corner Books", "Bodo", None, 1, None), ("b", "Quiet Corner Book", "Bodo", None, 1, None)]
    assert resolve_sellers(sources(spark, half, [])[0]).isEmpty()
