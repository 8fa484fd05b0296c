import hashlib
import re

from pyspark.sql import functions as F

from meldstone.functions import keys, text
from meldstone.functions.sql_functions import register_sql_functions


def plain_cleanse(value):
    if not value:
        return ""
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]+", " ", value.lower())).strip()


NAMES = [
    "Acme Corporation S.A.",
    "Rua dos Acacias, 100 - Sao Paulo",
    "São José\tLtda.",
    "",
    None,
    "--- !!! ---",
    "  a b c  ",
    "Kelvin ﬁrm",
    "tab\tnew\nline",
]


def test_cleansing_equals_two_step_rule(spark):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "i int, n string")
    got = {r.i: r.c for r in rows.select("i", text.cleanse_name(F.col("n")).alias("c")).collect()}
    assert got == {i: plain_cleanse(n) for i, n in enumerate(NAMES)}
    assert got[0] == "acme corporation s a"
    assert got[1] == "rua dos acacias 100 sao paulo"
    assert got[4] == ""


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("c")).first().c


def test_suffixes_only_at_the_end(spark):
    def strip(c):
        return text.cleanse_name(c, strip_suffixes=True)

    assert one(spark, strip, "Acme, Inc.") == "acme"
    assert one(spark, strip, "Acme Corp LLC") == "acme"
    assert one(spark, strip, "Inc Media Ltd") == "inc media"
    assert one(spark, strip, "Incorp") == "incorp"
    assert one(spark, strip, "LLC") == ""


def test_accent_folding_is_optional(spark):
    assert one(spark, lambda c: text.cleanse_name(c, fold_accents=True), "São José Ção") == "sao jose cao"
    assert one(spark, text.cleanse_name, "São") == "s o"


def test_address(spark):
    raw = "12 Main St., Apt 4B, Springfield, IL 62704"
    assert one(spark, text.standardize_address, raw) == "12 main street springfield il 62704"
    assert one(spark, text.standardize_address, "5 Ocean Ave Suite 9") == "5 ocean avenue"
    parts = text.address_parts(F.lit(raw))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert (row.city, row.state, row.zip) == ("Springfield", "IL", "62704")
    parts = text.address_parts(F.lit("nowhere"))
    assert spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first() == (None, None, None)


def test_entity_ids(spark):
    row = spark.range(1).select(
        keys.corporate_id(F.lit("acme"), F.lit("rua um")).alias("a"),
        keys.corporate_id(F.lit("acme"), F.lit("rua um")).alias("b"),
        keys.corporate_id(F.lit("acme"), F.lit("rua dois")).alias("c"),
        keys.corporate_id_md5(F.lit("acme"), F.lit("rua um"), F.lit("rio")).alias("m"),
    ).first()
    assert row.a == row.b == "81ef7e12fbbf815d"
    assert row.a != row.c
    assert row.m == hashlib.md5(b"acmerua umrio").hexdigest()


def test_entity_hash_tells_null_from_empty(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("a", "x")], "k string, v string")
    assert rows.select(keys.entity_hash(["k", "v"])).distinct().count() == 3


def test_list_size(spark):
    rows = spark.createDataFrame([("",), ("  ",), ("a",), ("a,b,c",)], "v string")
    assert [r.n for r in rows.select(text.list_size(F.col("v")).alias("n")).collect()] == [0, 0, 1, 3]


def test_sql_functions_are_inlined(spark):
    register_sql_functions(spark)
    rows = spark.createDataFrame([("Acme, S.A.",), (None,)], "v string")
    rows.createOrReplaceTempView("raw_names")
    result = spark.sql("SELECT cleanse_company_name(v) AS c, compute_corporate_id('acme', 'rua um') AS i FROM raw_names")
    assert {(r.c, r.i) for r in result.collect()} == {("acme s a", "81ef7e12fbbf815d"), ("", "81ef7e12fbbf815d")}
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
