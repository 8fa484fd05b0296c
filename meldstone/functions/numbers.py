"""Money and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

MONEY = "decimal(18,2)"


def money(df: DataFrame, name: str) -> Column:
    """Column as a decimal, so sums are the same in whatever order rows arrive."""
    if isinstance(df.schema[name].dataType, DecimalType):
        return F.col(name)
    return F.col(name).try_cast("decimal(18,4)")


def profit_margin(revenue: Column, profit: Column) -> Column:
    """profit / revenue where revenue is positive, else 0.0."""
    ratio = F.try_divide(profit.cast("double"), revenue.cast("double"))
    return F.when(revenue > 0, ratio).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, NULL when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def quoted(name: str) -> str:
    """A column name as F.col takes it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column."""
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        missing = missing | F.isnan(name)
    return missing
