import random

from pyspark.sql import functions as F

from meldstone.operators import prepare, profiles, quality
from meldstone.sources import tables
from meldstone.sources.storage import list_folders, scratch_path

SF = "/root/testdata/sf0.001"
COUNTS = ("position", "column", "type", "records", "nulls", "null_pct")


def test_merged_profile_equals_a_full_pass(spark):
    items = tables.table(spark, SF, "lineitem").withColumn("a`b", F.when(F.col("l_linenumber") == 1, "x"))
    store = profiles.ProfileStore(spark, scratch_path(spark, "profiles"))
    assert store.merged().isEmpty()
    for line in (1, 2, 3):
        store.add(str(line), items.where(F.least(F.col("l_linenumber"), F.lit(3)) == line))
    assert len(list_folders(spark, store.path)) == 3
    got = {r.column: r for r in store.merged().collect()}
    whole = {r.column: r for r in profiles.merged(profiles.profile(items)).collect()}
    assert {c: [r[k] for k in COUNTS] for c, r in got.items()} == {c: [r[k] for k in COUNTS] for c, r in whole.items()}
    for c in items.columns:
        exact = items.select(F.col("`" + c.replace("`", "``") + "`")).distinct().count()
        assert abs(got[c].distinct_values - exact) <= max(2, 0.06 * exact)
    # A part that comes again replaces itself; an empty one adds nothing.
    store.add("1", items.where("l_linenumber = 1"))
    store.add("none", items.where("false"))
    assert {r.column: r.records for r in store.merged().collect()} == {c: r.records for c, r in whole.items()}


def test_types_that_differ_between_parts_are_both_named(spark):
    store = profiles.ProfileStore(spark, scratch_path(spark, "profiles"))
    store.add("1", spark.createDataFrame([(1,)], "a int"))
    store.add("2", spark.createDataFrame([("x", 2)], "a string, b int"))
    rows = {r.column: (r.type, r.records, r.nulls) for r in store.merged().collect()}
    assert rows == {"a": ("int|string", 2, 0), "b": ("int", 1, 0)}


def test_chunks_join_to_the_sorted_list(spark):
    rng = random.Random(5)
    pairs = {(rng.choice(["s1", "s2", "s3", None]), rng.choice([None, *(f"p{i}" for i in range(90))])) for _ in range(400)}
    rows = [(f"o{i}", p, s, 1.0, 1.0) for i, (s, p) in enumerate(sorted(pairs, key=str) * 2)]
    items = spark.createDataFrame(rows, "order_id string, product_id string, seller_id string, price double, freight_value double")
    chunks = prepare.seller_product_chunks(items.repartition(5), 7).orderBy("corporate_id", "chunk").collect()
    joined, sizes = {}, {}
    for r in chunks:
        assert r.chunk == len(sizes.setdefault(r.corporate_id, [])) and r.n_products == len(r.products) <= 7
        sizes[r.corporate_id].append(r.n_products)
        joined.setdefault(r.corporate_id, []).extend(r.products)
    want = {s: sorted(p for x, p in pairs if x == s and p is not None) for s in ("s1", "s2", "s3")}
    assert joined == want and all(n == 7 for of in sizes.values() for n in of[:-1])


def test_schema_review_counts_rows_without_a_value(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, 1.5, None)], "a int, b double, c string")
    declared = spark.createDataFrame([], "a bigint, b double, d string").schema
    got = {r.column: (r.problem, r.records, r.nulls) for r in quality.schema_review(rows, declared).collect()}
    assert got == {"a": ("type", 2, 0), "c": ("extra", 2, 1), "d": ("missing", 2, 2)}
