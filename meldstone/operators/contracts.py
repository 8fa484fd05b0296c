"""Data contracts: per-field and cross-field rules checked on a whole table.

A contract is declared as data. Checking adds one array column per row, so it
costs a single scan with no exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, NumericType, StringType

from meldstone.functions.numbers import profit_margin


@dataclass(frozen=True)
class Field:
    """A required or optional value with bounds; bounds are inclusive unless ``above`` is used."""

    name: str
    type: str
    required: bool = True
    minimum: float | None = None
    maximum: float | None = None
    above: float | None = None
    length: int | None = None


@dataclass(frozen=True)
class CrossRule:
    """A rule over several fields, skipped where one of ``fields`` already failed."""

    name: str
    field: str
    fields: tuple[str, ...]
    holds: Callable[[], Column]


@dataclass(frozen=True)
class Contract:
    name: str
    key: str
    fields: tuple[Field, ...]
    cross: tuple[CrossRule, ...] = field(default_factory=tuple)


# Margin tolerance of the contract and of the transformation rule.
MARGIN_TOLERANCE = 0.01


def _margin_gap() -> Column:
    return F.abs(F.col("profit_margin") - F.try_divide(F.col("profit"), F.col("revenue")))


def _margin_consistent() -> Column:
    return (F.col("revenue") <= 0) | (_margin_gap() <= MARGIN_TOLERANCE) | F.isnan(_margin_gap())


# The four contracts.
SOURCE = Contract(
    "source",
    "order_id",
    (
        Field("order_id", "string"),
        Field("customer_id", "string"),
        Field("seller_id", "string"),
        Field("payment_value", "double", above=0, maximum=1_000_000),
        Field("order_status", "string"),
    ),
)
PREPARED = Contract(
    "prepared",
    "corporate_id",
    (
        Field("corporate_id", "string"),
        Field("revenue", "double", minimum=0),
        Field("profit", "double"),
        Field("profit_margin", "double", minimum=-1, maximum=1),
        Field("market", "string", required=False),
        Field("state", "string", length=2),
        Field("activity_places", "int", minimum=0),
        Field("transaction_count", "int", minimum=0),
    ),
    (
        CrossRule(
            "margin_consistent", "profit_margin", ("revenue", "profit", "profit_margin"), _margin_consistent
        ),
    ),
)
ML_FEATURE = Contract(
    "ml_feature",
    "corporate_id",
    (
        Field("corporate_id", "string"),
        Field("revenue", "double", above=0),
        Field("profit", "double"),
        Field("profit_margin", "double", minimum=-1, maximum=1),
        Field("activity_places", "int", minimum=0),
        Field("label", "int", minimum=0, maximum=1),
    ),
)
ML_PREDICTION = Contract(
    "ml_prediction",
    "corporate_id",
    (
        Field("corporate_id", "string"),
        Field("predicted_class", "int", minimum=0, maximum=1),
        Field("prediction_probability", "double", minimum=0, maximum=1),
        Field("confidence", "double", minimum=0, maximum=1),
        Field("prediction_timestamp", "string"),
    ),
)


def _unreadable(name: str) -> str:
    """Column that tells whether text of a field could not be read as a number."""
    return f"_unreadable_{name}"


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Numbers held as text are read as numbers.

    Text that is no number becomes NULL; a column beside it keeps that there was some. A
    number with decimals stays one, so that it breaks the rule ``integer`` rather than none.
    """
    result = df
    for rule in contract.fields:
        if rule.name in df.columns and rule.type != "string":
            if isinstance(df.schema[rule.name].dataType, StringType):
                number = F.trim(F.col(rule.name)).try_cast("double")
                result = result.withColumn(_unreadable(rule.name), F.col(rule.name).isNotNull() & number.isNull())
                result = result.withColumn(rule.name, number)
    return result


def _fits(data_type: DataType, declared: str) -> bool:
    """Whether a column of this type can hold values of a declared type."""
    if declared == "string":
        return isinstance(data_type, StringType)
    return isinstance(data_type, NumericType)


def _broken(df: DataFrame, rule: Field) -> Column:
    """Name of the first rule the field breaks, NULL if it keeps them all."""
    if rule.name not in df.columns:
        return F.lit("required") if rule.required else F.lit(None).cast("string")
    value = F.col(rule.name)
    data_type = df.schema[rule.name].dataType
    if not _fits(data_type, rule.type):
        return F.lit("type")
    checks: list[tuple[str, Column]] = []
    if _unreadable(rule.name) in df.columns:
        checks.append(("type", F.col(_unreadable(rule.name))))
    if rule.required:
        checks.append(("required", value.isNull()))
    is_float = isinstance(data_type, (FloatType, DoubleType))
    if rule.type == "int" and is_float:
        checks.append(("integer", F.isnan(value) | (value != F.floor(value))))
    elif rule.type == "int" and isinstance(data_type, DecimalType):
        checks.append(("integer", value != F.floor(value)))
    if is_float and any(bound is not None for bound in (rule.above, rule.minimum, rule.maximum)):
        # Spark orders NaN above every number, so bounds alone would let it pass.
        checks.append(("not_a_number", F.isnan(value)))
    if rule.above is not None:
        checks.append(("greater_than", value <= rule.above))
    if rule.minimum is not None:
        checks.append(("minimum", value < rule.minimum))
    if rule.maximum is not None:
        checks.append(("maximum", value > rule.maximum))
    if rule.length is not None:
        checks.append(("length", F.length(value) != rule.length))
    broken = F.lit(None).cast("string")
    for name, failed in reversed(checks):
        broken = F.when(failed, F.lit(name)).otherwise(broken)
    return broken


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """Input rows plus ``violations``: array of (field, rule), empty where the row is valid."""
    typed = coerce(df, contract)
    broken = {rule.name: _broken(typed, rule) for rule in contract.fields}
    found = [
        F.when(rule.isNotNull(), F.struct(F.lit(name).alias("field"), rule.alias("rule")))
        for name, rule in broken.items()
    ]
    for rule in contract.cross:
        if not set(rule.fields) <= set(typed.columns):
            continue  # the missing field has its own violation
        inputs_fine = F.lit(True)
        for name in rule.fields:
            inputs_fine = inputs_fine & broken[name].isNull()
        found.append(
            F.when(
                inputs_fine & ~rule.holds(),
                F.struct(F.lit(rule.field).alias("field"), F.lit(rule.name).alias("rule")),
            )
        )
    helpers = [_unreadable(rule.name) for rule in contract.fields]
    return typed.withColumn("violations", F.array_compact(F.array(*found))).drop(*helpers)


def validate(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, violations as (key, field, rule))."""
    checked = check(df, contract)
    valid = checked.where(F.size("violations") == 0).drop("violations")
    if contract.key not in checked.columns:
        checked = checked.withColumn(contract.key, F.lit(None).cast("string"))
    violations = checked.select(F.col(contract.key), F.explode("violations").alias("v")).select(
        contract.key, "v.field", "v.rule"
    )
    return valid, violations


def is_valid(df: DataFrame, contract: Contract) -> bool:
    return validate(df, contract)[1].isEmpty()


def violation_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """(contract, total_records, valid_records, invalid_records)."""
    bad = F.size("violations") > 0
    return check(df, contract).agg(
        F.count("*").alias("total_records"),
        F.count(F.when(~bad, 1)).alias("valid_records"),
        F.count(F.when(bad, 1)).alias("invalid_records"),
    ).select(F.lit(contract.name).alias("contract"), "total_records", "valid_records", "invalid_records")


def transformation_rules(df: DataFrame) -> DataFrame:
    """(rule, failures, passed) for margin consistency, revenue sign and state length."""
    gap = F.abs(F.try_divide(F.col("profit"), F.col("revenue")) - F.col("profit_margin"))
    rules: Sequence[tuple[str, Column]] = (
        ("margin_consistent", F.coalesce((gap < MARGIN_TOLERANCE) & ~F.isnan(gap), F.lit(False))),
        ("revenue_not_negative", F.coalesce((F.col("revenue") >= 0) & ~F.isnan("revenue"), F.lit(False))),
        ("state_two_letters", F.coalesce(F.length("state") == 2, F.lit(False))),
    )
    counted = df.agg(*[F.count(F.when(~holds, 1)).alias(name) for name, holds in rules])
    return counted.unpivot([], [name for name, _ in rules], "rule", "failures").withColumn(
        "passed", F.col("failures") == 0
    )


def with_margin(df: DataFrame) -> DataFrame:
    return df.withColumn("profit_margin", profit_margin(F.col("revenue"), F.col("profit")))
