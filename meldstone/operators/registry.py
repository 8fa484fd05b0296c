"""Registry maintenance: staging, upsert, change history."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meldstone.functions.keys import entity_hash
from meldstone.functions.numbers import MONEY
from meldstone.sources import schemas

# Fixed value: version tag written to every registry row.
CONTRACT_VERSION = "1.0"

KEY = "corporate_id"
AUDIT = ("_etl_processed_dttm", "_data_contract_version", "year", "month")
DATA = tuple(c for c in schemas.REGISTRY.names if c != KEY and c not in AUDIT)
HASHED = (KEY, *(c for c in DATA if c != "load_date"))


def registry_staging(harmonized: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Registry layout of harmonised rows; money that does not fit becomes NULL.

    ``loaded_at`` (UTC) fixes the audit columns, so that a repeated load writes
    the same rows; by default it is the current time.
    """
    moment = loaded_at or datetime.now(timezone.utc)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    loaded = F.lit(moment)
    staged = {
        "activity_places": F.col("activity_places").cast("int"),
        "top_suppliers": F.col("top_suppliers").cast("string"),
        "main_customers": F.col("main_customers").cast("string"),
        "revenue": F.col("revenue").try_cast(MONEY),
        "profit": F.col("profit").try_cast(MONEY),
        "load_date": loaded,
        "source_system": F.col("source_system").cast("string"),
        "_etl_processed_dttm": loaded,
        "_data_contract_version": F.lit(CONTRACT_VERSION),
        "year": F.lit(moment.astimezone(timezone.utc).year),
        "month": F.lit(moment.astimezone(timezone.utc).month),
    }
    return harmonized.select(*[staged.get(c, F.col(c)).alias(c) for c in schemas.REGISTRY.names])


def repeated_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """Keys carried by more than one row; must be empty before an upsert."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


#: Columns of a marked merge, NULL where nothing changed: what happened to the key (insert,
#: update, delete), its hash before and after, and the data columns an update changed.
CHANGE = ("_change_kind", "_change_old_hash", "_change_new_hash", "_change_columns")
DELETED = "delete"


def upsert(target: DataFrame, staging: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(merged registry, quarantined staging rows)."""
    merged, quarantined = marked_upsert(target, staging, key)
    return merged.drop(*CHANGE), quarantined


def marked_upsert(target: DataFrame, staging: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(merged registry with the columns CHANGE, quarantined staging rows).

    Matched rows take every non-NULL new value and the new audit columns, new
    keys are inserted, other target rows stay. Staging rows without a key could
    never match and would be inserted again by each load, so they are set aside.
    """
    quarantined = staging.where(F.col(key).isNull())

    def value(c: str, new: Column, old: Column, is_new: Column) -> Column:
        return F.when(is_new, new).otherwise(old) if c in AUDIT else F.coalesce(new, old)

    return _marked(target, staging.where(F.col(key).isNotNull()), key, value, F.lit(False)), quarantined


def marked_replacement(target: DataFrame, registry: DataFrame, key: str = KEY) -> DataFrame:
    """``registry`` with the columns CHANGE, and the rows of ``target`` that it lacks as deleted."""

    def value(c: str, new: Column, old: Column, is_new: Column) -> Column:
        return F.when(is_new, new).otherwise(old)

    return _marked(target, registry, key, value, F.lit(True))


def _marked(target: DataFrame, new_rows: DataFrame, key: str, value: Callable, drops: Column) -> DataFrame:
    """Full outer join of both on the key; ``drops`` says whether keys only in ``target`` are deleted."""
    t = target.withColumn("_was", F.lit(True)).alias("t")
    s = new_rows.withColumn("_new", F.lit(True)).alias("s")
    is_new, was_there = F.col("_new").isNotNull(), F.col("_was").isNotNull()
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(
        *[value(c, F.col(f"s.{c}"), F.col(f"t.{c}"), is_new).alias(c) for c in target.columns],
        *[F.col(f"t.{c}").alias(f"_old_{c}") for c in HASHED],
        is_new.alias("_is_new"),
        was_there.alias("_was_there"),
    )
    differ = [F.when(~F.col(c).eqNullSafe(F.col(f"_old_{c}")), F.lit(c)) for c in HASHED if c != key]
    changed = F.concat_ws(",", *differ)
    kind = (
        F.when(~F.col("_is_new"), F.when(drops, F.lit(DELETED)))
        .when(~F.col("_was_there"), "insert")
        .when(changed != "", "update")
    )
    marked = joined.withColumn("_change_kind", kind)
    old = F.when(marked["_change_kind"].isin("update", DELETED), entity_hash([f"_old_{c}" for c in HASHED]))
    new = F.when(marked["_change_kind"].isin("update", "insert"), entity_hash(HASHED))
    return marked.withColumns(
        {
            "_change_old_hash": old,
            "_change_new_hash": new,
            "_change_columns": F.when(marked["_change_kind"] == "update", changed),
        }
    ).select(*target.columns, *CHANGE)


def merge_statement(target: str, staging: str, key: str = KEY) -> str:
    """MERGE INTO text for catalogs whose tables support row-level updates."""
    updates = [f"t.{c} = coalesce(s.{c}, t.{c})" for c in DATA] + [f"t.{c} = s.{c}" for c in AUDIT]
    names = schemas.REGISTRY.names
    return (
        f"MERGE INTO {target} t USING (SELECT * FROM {staging} WHERE {key} IS NOT NULL) s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {', '.join(updates)} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) VALUES ({', '.join('s.' + c for c in names)})"
    )


def with_entity_hash(registry: DataFrame) -> DataFrame:
    """Registry rows with a hash over their data columns, for change detection."""
    return registry.withColumn("entity_hash", entity_hash([c for c in HASHED if c in registry.columns]))


def history(snapshots: DataFrame) -> DataFrame:
    """(commit_ts, total_records, changed_records) per version.

    A row counts as changed when its data differs from the key's previous version
    or the key is new. A window holds one row per version of a key.
    """
    previous = F.lag("entity_hash").over(Window.partitionBy(KEY).orderBy("commit_ts"))
    compared = (
        with_entity_hash(snapshots)
        .select(KEY, "commit_ts", "entity_hash")
        .withColumn("changed", ~F.col("entity_hash").eqNullSafe(previous))
    )
    return compared.groupBy("commit_ts").agg(
        F.count("*").alias("total_records"), F.count(F.when(F.col("changed"), 1)).alias("changed_records")
    )
