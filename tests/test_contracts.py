import math

import pytest

from meldstone.operators import contracts as c

SOURCE = "order_id string, customer_id string, seller_id string, payment_value double, order_status string"
PREPARED = (
    "corporate_id string, revenue double, profit double, profit_margin double, market string, state string, "
    "activity_places int, transaction_count int"
)
FEATURE = "corporate_id string, revenue double, profit double, profit_margin double, activity_places int, label int"
PREDICTION = (
    "corporate_id string, predicted_class int, prediction_probability double, confidence double, "
    "prediction_timestamp string"
)


def broken(spark, contract, schema, *rows):
    violations = c.validate(spark.createDataFrame(list(rows), schema), contract)[1]
    return sorted((r.field, r.rule) for r in violations.collect())


GOOD = ("CORP_001", 1000000.0, 250000.0, 0.25, "retail", "SP", 50, 1000)


def prepared(**changes):
    names = [p.split()[0] for p in PREPARED.split(", ")]
    return tuple(changes.get(n, v) for n, v in zip(names, GOOD))


@pytest.mark.parametrize(
    "value, rule",
    [(50000.0, None), (1e6, None), (-1000.0, "greater_than"), (0.0, "greater_than"), (1000000.01, "maximum"),
     (math.nan, "not_a_number"), (None, "required")],
)
def test_source(spark, value, rule):
    got = broken(spark, c.SOURCE, SOURCE, ("123", "cust_001", "sell_001", value, "delivered"))
    assert got == ([("payment_value", rule)] if rule else [])


def test_source_requires_text(spark):
    assert broken(spark, c.SOURCE, SOURCE, (None, "", "s", 1.0, None)) == [("order_id", "required"), ("order_status", "required")]


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, []),
        ({"profit_margin": 0.50}, [("profit_margin", "margin_consistent")]),
        ({"state": "INVALID"}, [("state", "length")]),
        ({"state": None, "market": None}, [("state", "required")]),
        ({"revenue": -1.0}, [("revenue", "minimum")]),
        ({"revenue": 0.0, "profit_margin": 0.9}, []),
        ({"profit_margin": 1.5}, [("profit_margin", "maximum")]),
        ({"profit": math.nan}, []),
        ({"profit": None, "profit_margin": 0.9}, [("profit", "required")]),
        ({"revenue": math.nan}, [("revenue", "not_a_number")]),
        ({"revenue": 100.0, "profit": 25.0, "profit_margin": 0.2599}, []),
        ({"revenue": 1.0, "profit": 0.0, "profit_margin": 0.01}, []),
        ({"revenue": 100.0, "profit": 25.0, "profit_margin": 0.2601}, [("profit_margin", "margin_consistent")]),
        ({"activity_places": -1, "transaction_count": None}, [("activity_places", "minimum"), ("transaction_count", "required")]),
    ],
)
def test_prepared(spark, changes, expected):
    assert broken(spark, c.PREPARED, PREPARED, prepared(**changes)) == expected


def test_feature_and_prediction(spark):
    assert broken(spark, c.ML_FEATURE, FEATURE, ("a", 1e6, 250000.0, 0.25, 50, 1)) == []
    assert broken(spark, c.ML_FEATURE, FEATURE, ("a", 0.0, 1.0, 0.25, 50, 5)) == [("label", "maximum"), ("revenue", "greater_than")]
    assert broken(spark, c.ML_PREDICTION, PREDICTION, ("a", 1, 0.7, 0.7, "2025-12-17T10:00:00")) == []
    assert broken(spark, c.ML_PREDICTION, PREDICTION, ("a", 2, -0.1, 1.2, None)) == [
        ("confidence", "maximum"), ("predicted_class", "maximum"),
        ("prediction_probability", "minimum"), ("prediction_timestamp", "required"),
    ]


def test_text_numbers_are_read(spark):
    schema = SOURCE.replace("payment_value double", "payment_value string")
    assert broken(spark, c.SOURCE, schema, ("1", "c", "s", "100", "x")) == []
    assert broken(spark, c.SOURCE, schema, ("1", "c", "s", "lots", "x")) == [("payment_value", "type")]


def test_fractions_are_no_integers(spark):
    schema = FEATURE.replace("label int", "label double")
    assert broken(spark, c.ML_FEATURE, schema, ("a", 1.0, 0.1, 0.1, 1, 1.0)) == []
    assert broken(spark, c.ML_FEATURE, schema, ("a", 1.0, 0.1, 0.1, 1, 0.5)) == [("label", "integer")]


def test_missing_column_breaks_its_rule(spark):
    frame = spark.createDataFrame([("1", "c", "s", 5.0)], "order_id string, customer_id string, seller_id string, payment_value double")
    assert [(r.field, r.rule) for r in c.validate(frame, c.SOURCE)[1].collect()] == [("order_status", "required")]


def test_counts_and_valid_rows(spark):
    frame = spark.createDataFrame([prepared(), prepared(profit_margin=0.5, state="X"), prepared(state="LONG")], PREPARED)
    row = c.violation_counts(frame, c.PREPARED).first()
    assert (row.total_records, row.valid_records, row.invalid_records) == (3, 1, 2)
    assert not c.is_valid(frame, c.PREPARED)
    assert c.is_valid(frame.where("state = 'SP' AND profit_margin = 0.25"), c.PREPARED)
    assert c.validate(frame, c.PREPARED)[0].columns == frame.columns


def test_checking_needs_no_exchange(spark):
    frame = spark.createDataFrame([prepared()], PREPARED)
    plan = c.validate(frame, c.PREPARED)[1]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def rules(spark, *rows):
    frame = spark.createDataFrame(list(rows), PREPARED)
    return {r.rule: r.failures for r in c.transformation_rules(frame).collect()}


def test_transformation_rules(spark):
    three = [prepared(), prepared(revenue=500000.0, profit=50000.0, profit_margin=0.10, state="RJ"),
             prepared(revenue=750000.0, profit=150000.0, profit_margin=0.20, state="MG")]
    assert set(rules(spark, *three).values()) == {0}
    # Exactly 0.01 apart passes the contract but not the transformation rule.
    assert rules(spark, prepared(revenue=1.0, profit=0.0, profit_margin=0.01))["margin_consistent"] == 1
    bad = rules(spark, prepared(revenue=-1.0), prepared(state=None), prepared(revenue=0.0), prepared(revenue=math.nan))
    assert bad == {"margin_consistent": 3, "revenue_not_negative": 2, "state_two_letters": 1}


def test_missing_columns_and_other_types_are_violations(spark):
    frame = spark.createDataFrame([(7, 1.0)], "corporate_id bigint, revenue double")
    got = sorted((r.field, r.rule) for r in c.validate(frame, c.PREPARED)[1].collect())
    assert got == [
        ("activity_places", "required"), ("corporate_id", "type"), ("profit", "required"), ("profit_margin", "required"),
        ("state", "required"), ("transaction_count", "required"),
    ]
    keyless = spark.createDataFrame([(1.0,)], "revenue double")
    assert ("corporate_id", "required") in {(r.field, r.rule) for r in c.validate(keyless, c.PREPARED)[1].collect()}


@pytest.mark.parametrize("text, rule", [("3", None), ("3.0", None), (" 4 ", None), ("3.5", "integer"), ("abc", "type"), (None, "required"), ("-1", "minimum")])
def test_numbers_as_text(spark, text, rule):
    schema = PREPARED.replace("activity_places int", "activity_places string")
    got = broken(spark, c.PREPARED, schema, prepared(activity_places=text))
    assert got == ([("activity_places", rule)] if rule else [])
