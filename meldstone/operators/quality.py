"""Profiling, quality tiers and checks on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from meldstone.functions.numbers import is_missing, percent, quoted
from meldstone.sources.storage import materialise

TIERS = ("bronze", "silver", "gold")

# Silver limits in percent.
SILVER_NULL_LIMIT = 5
SILVER_DUPLICATE_LIMIT = 1


def _missing_counts(df: DataFrame) -> list[Column]:
    return [F.count(F.when(is_missing(df, c), 1)).alias(c) for c in df.columns]


def null_profile(datasets: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(dataset, total_records, column, nulls) for the named columns, one scan per dataset."""
    profiles = None
    for name, (df, columns) in datasets.items():
        counted = df.agg(
            F.count("*").alias("total_records"),
            *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns],
        )
        profile = counted.unpivot("total_records", list(columns), "column", "nulls").select(
            F.lit(name).alias("dataset"), "total_records", "column", "nulls"
        )
        profiles = profile if profiles is None else profiles.unionByName(profile)
    return profiles


def column_null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, total_records) for every column, in one pass."""
    counted = df.agg(F.count("*").alias("total_records"), *_missing_counts(df))
    return counted.unpivot("total_records", df.columns, "column", "nulls").select(
        "column", "nulls", "total_records"
    )


def column_null_pct(df: DataFrame) -> DataFrame:
    return column_null_counts(df).select("column", percent(F.col("nulls"), F.col("total_records")).alias("null_pct"))


def completeness_pct(df: DataFrame) -> DataFrame:
    """Share of missing cells over the whole frame, in percent."""
    counted = df.agg(F.count("*").alias("total_records"), *_missing_counts(df))
    missing = sum((F.col(c) for c in df.columns), F.lit(0))
    cells = F.col("total_records") * len(df.columns)
    return counted.select(
        cells.alias("total_cells"), missing.alias("null_cells"), percent(missing, cells).alias("null_pct")
    )


def _comparable(df: DataFrame) -> list[Column]:
    """Columns as grouping keys.

    Maps have no equality, so they compare by their JSON text. NaN counts as a
    missing value and therefore groups with NULL.
    """
    keys = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (FloatType, DoubleType)):
            key = F.nanvl(field.name, F.lit(None).cast(field.dataType))
        elif "map<" in field.dataType.simpleString():
            key = F.to_json(field.name)
        else:
            key = F.col(field.name)
        keys.append(key.alias(field.name))
    return keys


def _repeats(df: DataFrame) -> DataFrame:
    """One row with ``duplicate_count``: rows that repeat an earlier one.

    Only a hash of each row is exchanged at first. Rows whose hash occurs once
    cannot repeat. The hashes that occur more often are written down, so that their
    size is known when the rows carrying them are picked out and compared in full.
    """
    keys = df.select(*_comparable(df))
    hashed = keys.withColumn("_hash", F.xxhash64(*keys.columns))
    shared = hashed.groupBy("_hash").agg(F.count("*").alias("_rows")).where(F.col("_rows") > 1).select("_hash")
    suspects = hashed.join(materialise(shared, "hashes"), "_hash", "left_semi")
    groups = suspects.groupBy(*keys.columns).agg(F.count("*").alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_count"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier one; NULL equals NULL and NaN equals NaN."""
    total = df.agg(F.count("*").alias("total_records"))
    return _side_by_side(total, _repeats(df))


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row frames as one row."""
    return left.withColumn("_one", F.lit(1)).join(right.withColumn("_one", F.lit(1)), "_one").drop("_one")


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Number of rows whose key already occurred."""
    groups = df.groupBy(key).agg(F.count("*").alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_records"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_ids"),
    )


def column_types(df: DataFrame) -> DataFrame:
    """(position, column, type) of the frame's schema."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def missing_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required columns that the frame lacks."""
    rows = [(c,) for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame(rows, "column string")


def schema_differences(df: DataFrame, expected: StructType) -> DataFrame:
    """(column, problem, expected, actual) where the frame departs from a declared schema."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(c, "missing", t, None) for c, t in wanted.items() if c not in actual]
    rows += [(c, "extra", None, t) for c, t in actual.items() if c not in wanted]
    rows += [(c, "type", t, actual[c]) for c, t in wanted.items() if c in actual and actual[c] != t]
    return df.sparkSession.createDataFrame(rows, "column string, problem string, expected string, actual string")


def schema_review(df: DataFrame, expected: StructType) -> DataFrame:
    """schema_differences with the rows of the frame and those without a value in the column; one scan.

    A missing column has no value in any row.
    """
    present = {c: F.count(F.col(quoted(c))) for c in df.columns}
    counted = df.agg(F.count("*").alias("records"), *[n.alias(f"_present_{i}") for i, n in enumerate(present.values())])
    filled = [x for i, c in enumerate(present) for x in (F.lit(c), F.col(f"_present_{i}"))]
    totals = counted.select("records", F.create_map(*filled).alias("_filled"))
    joined = schema_differences(df, expected).withColumn("_one", F.lit(1)).join(totals.withColumn("_one", F.lit(1)), "_one")
    nulls = F.col("records") - F.coalesce(F.try_element_at("_filled", F.col("column")), F.lit(0))
    return joined.select("column", "problem", "expected", "actual", "records", nulls.alias("nulls"))


def quality_tier(df: DataFrame, tier: str) -> DataFrame:
    """Quality metrics of a frame, judged for one tier.

    Missing cells of all columns come from one scan without an exchange.
    """
    if tier not in TIERS:
        raise ValueError(f"unknown tier {tier!r}")
    # Read three times below: counted, hashed, and compared where hashes repeat.
    df = materialise(df, "judged")
    missing = [F.count(F.when(is_missing(df, c), 1)).alias(f"_missing_{i}") for i, c in enumerate(df.columns)]
    counted = df.agg(F.count("*").alias("total_records"), *missing)
    totals = _side_by_side(counted, _repeats(df))
    rows = F.col("total_records")
    counts = [F.col(f"_missing_{i}") for i in range(len(df.columns))]
    null_pct = percent(sum(counts, F.lit(0)), rows * len(df.columns))
    duplicate_pct = percent(F.col("duplicate_count"), rows)
    names = [F.lit(c) for c in df.columns]
    pair = [x for name, value in zip(names, counts) for x in (name, value)]
    pair_pct = [x for name, value in zip(names, counts) for x in (name, percent(value, rows))]
    pair_type = [x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))]

    # An empty frame has no percentages: its score is 0 and it passes nothing.
    score = F.coalesce(F.greatest(F.lit(0.0), 100 - null_pct - duplicate_pct) / 100, F.lit(0.0))
    if tier == "bronze":
        score, passed = F.lit(0.5), rows > 0
    elif tier == "silver":
        passed = (null_pct < SILVER_NULL_LIMIT) & (duplicate_pct < SILVER_DUPLICATE_LIMIT)
    else:
        passed = (null_pct == 0) & (duplicate_pct == 0)
    return totals.select(
        F.lit(tier).alias("tier"),
        "total_records",
        F.create_map(*pair).alias("missing_values"),
        F.create_map(*pair_pct).alias("null_percentage"),
        "duplicate_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.create_map(*pair_type).alias("data_types"),
        score.alias("quality_score"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def quality_gate(
    registry: DataFrame, key: str = "corporate_id", unfilled: Sequence[str] = ("main_customers",)
) -> DataFrame:
    """(check, passed) between load and training: gold tier on the data, unique keys.

    ``unfilled`` names columns that no source fills; they are left out of the tier.
    """
    filled_columns = registry.drop(*unfilled)
    gold = quality_tier(filled_columns, "gold").select(F.lit("gold_tier").alias("check"), "passed")
    unique = key_uniqueness(registry, key).select(
        F.lit("unique_key").alias("check"), (F.col("duplicate_ids") == 0).alias("passed")
    )
    filled = registry.agg((F.count("*") == F.count(key)).alias("passed")).select(
        F.lit("key_present").alias("check"), "passed"
    )
    return gold.unionByName(unique).unionByName(filled)


def enforce_gate(gate: DataFrame) -> None:
    """Raise if any check of a gate failed."""
    failed = [row["check"] for row in gate.where(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"quality gate failed: {', '.join(failed)}")


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only: (key, side) with side 'missing' or 'extra' seen from ``left``."""
    # Distinct first: a key held by many rows then reaches the join once.
    left_keys, right_keys = left.select(key).distinct(), right.select(key).distinct()
    missing = left_keys.join(right_keys, key, "left_anti").withColumn("side", F.lit("missing"))
    extra = right_keys.join(left_keys, key, "left_anti").withColumn("side", F.lit("extra"))
    return missing.unionByName(extra)
