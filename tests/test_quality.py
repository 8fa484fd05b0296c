import math

import pytest

from meldstone.operators import quality
from meldstone.sources import schemas

FRAME = "col1 double, col2 string"
BRONZE = [(1.0, "a"), (2.0, "b"), (None, "c"), (4.0, "d"), (5.0, "e")]
CLEAN = [(float(i), c) for i, c in enumerate("abcde")]


def tier(spark, rows, name):
    return quality.quality_tier(spark.createDataFrame(rows, FRAME), name).first()


def test_tiers(spark):
    bronze = tier(spark, BRONZE, "bronze")
    assert (bronze.quality_score, bronze.passed, bronze.total_records, bronze.column_count) == (0.5, True, 5, 2)
    assert bronze.missing_values == {"col1": 1, "col2": 0} and bronze.null_percentage == {"col1": 20.0, "col2": 0.0}
    assert bronze.data_types == {"col1": "double", "col2": "string"}
    for name in ("silver", "gold"):
        clean = tier(spark, CLEAN, name)
        assert (clean.quality_score, clean.passed) == (1.0, True)
        torn = tier(spark, BRONZE, name)
        assert (round(torn.quality_score, 10), torn.passed) == (0.9, False)


def test_empty_frame_passes_nothing(spark):
    assert [(t, tier(spark, [], t).quality_score, tier(spark, [], t).passed) for t in quality.TIERS] == [
        ("bronze", 0.5, False), ("silver", 0.0, False), ("gold", 0.0, False)
    ]


def test_silver_limits(spark):
    rows = [(float(i), "x") for i in range(100)]
    assert tier(spark, rows + [(0.0, "x")], "silver").passed
    assert not tier(spark, rows + [(0.0, "x"), (1.0, "x")], "silver").passed
    assert tier(spark, rows[:91] + [(None, str(i)) for i in range(9)], "silver").passed
    assert not tier(spark, rows[:90] + [(None, str(i)) for i in range(10)], "silver").passed
    with pytest.raises(ValueError):
        tier(spark, rows, "platinum")


def test_duplicates_treat_missing_as_equal(spark):
    rows = [(None, "a"), (math.nan, "a"), (None, None), (None, None), (1.0, None), (1.0, None), (1.0, "b"), (0.0, "z"), (-0.0, "z")]
    frame = spark.createDataFrame(rows, FRAME)
    assert tuple(quality.duplicate_rows(frame.repartition(4)).first()) == (9, 4)


def test_duplicates_whose_hash_collides(spark):
    frame = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), ("a", "a")], "x string, y string")
    assert quality.duplicate_rows(frame).first().duplicate_count == 1


def test_duplicates_with_maps(spark):
    frame = spark.createDataFrame([({"a": 1},), ({"a": 1},), ({"a": 2},)], "m map<string,int>")
    assert quality.duplicate_rows(frame).first().duplicate_count == 1


def test_null_counts(spark):
    frame = spark.createDataFrame([(None, "a"), (math.nan, None), (1.0, "b"), (2.0, "c")], FRAME)
    assert {r.column: r.nulls for r in quality.column_null_counts(frame).collect()} == {"col1": 2, "col2": 1}
    assert {r.column: r.null_pct for r in quality.column_null_pct(frame).collect()} == {"col1": 50.0, "col2": 25.0}
    whole = quality.completeness_pct(frame).first()
    assert (whole.total_cells, whole.null_cells, whole.null_pct) == (8, 3, 37.5)
    profile = quality.null_profile({"d": (frame, ["col2"])}).first()
    assert (profile.dataset, profile.total_records, profile.column, profile.nulls) == ("d", 4, "col2", 1)


def test_key_uniqueness(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    row = quality.key_uniqueness(frame, "k").first()
    assert (row.total_records, row.distinct_keys, row.duplicate_ids) == (5, 3, 2)


def test_schema_checks(spark):
    frame = spark.createDataFrame([("a", 1, 2.0)], "corporate_id string, activity_places bigint, extra double")
    assert [r.column for r in quality.missing_columns(frame, ["corporate_id", "revenue"]).collect()] == ["revenue"]
    problems = {(r.column, r.problem) for r in quality.schema_differences(frame, schemas.REGISTRY).collect()}
    assert {("extra", "extra"), ("activity_places", "type"), ("revenue", "missing")} <= problems
    assert ("corporate_id", "type") not in problems
    assert quality.schema_differences(spark.createDataFrame([], schemas.REGISTRY), schemas.REGISTRY).isEmpty()
    assert [r.type for r in quality.column_types(frame).orderBy("position").collect()] == ["string", "bigint", "double"]


def test_key_difference(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    right = spark.createDataFrame([("b",), ("c",)], "k string")
    assert {(r.k, r.side) for r in quality.key_difference(left, right, "k").collect()} == {("a", "missing"), ("c", "extra")}
    assert quality.key_difference(left, left, "k").isEmpty()


def test_gate(spark):
    good = spark.createDataFrame([("a", "x", None), ("b", "y", None)], "corporate_id string, v string, main_customers string")
    quality.enforce_gate(quality.quality_gate(good))
    bad = good.union(good)
    assert {r.check: r.passed for r in quality.quality_gate(bad).collect()} == {
        "gold_tier": False, "unique_key": False, "key_present": True
    }
    with pytest.raises(ValueError, match="unique_key"):
        quality.enforce_gate(quality.quality_gate(bad))
