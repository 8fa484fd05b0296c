"""Raw files to registry, as one job."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.functions.sql_functions import register_sql_functions
from meldstone.operators.entity_index import EntityIndex
from meldstone.operators.harmonize import harmonize, harmonize_clusters, seller_records
from meldstone.operators.prepare import prepare_sources
from meldstone.operators.registry import KEY, merge_statement, registry_staging, repeated_keys, upsert
from meldstone.sources.readers import read_raw_sources
from meldstone.sources.registry_store import RegistryStore
from meldstone.sources.storage import materialise
from meldstone.sources.writers import (
    WITHOUT_ROW_UPDATES,
    create_database,
    create_partitioned_table,
    replace_partitions,
    write_prepared,
)


def run_etl(
    spark: SparkSession, source: str, target: str, loaded_at: datetime | None = None, resolve: str = "exact"
) -> DataFrame:
    """Read raw CSV files below ``source``, write prepared sources and the registry below ``target``.

    Harmonising reads the prepared sources back from their files, so the item
    aggregation runs once. ``resolve`` is "exact", where only equal names and addresses are one
    entity, or "fuzzy", where sellers of one city and state are as well whose names differ by
    what the evidence rule takes for a slip; only new names are then compared with those of
    earlier loads. An entity bears the id of its smallest seller: where a smaller one joins in a
    later load, the row under the earlier id stays in the registry. Returns the quarantined rows.
    """
    if resolve not in ("fuzzy", "exact"):
        raise ValueError(f"unknown resolution {resolve!r}")
    register_sql_functions(spark)
    moment = loaded_at or datetime.now(timezone.utc)
    items, sellers, _ = read_raw_sources(spark, source)
    base = target.rstrip("/")
    written = []
    for name, df in zip(("source1_supply", "source2_financial"), prepare_sources(items, sellers)):
        path = f"{base}/prepared_sources/{name}"
        write_prepared(df, path)
        written.append(spark.read.schema(df.schema).parquet(path))
    if resolve == "exact":
        merged = harmonize(*written)
    else:
        index = seller_index(spark, f"{base}/entity_index")
        index.add(seller_records(written[0]), f"{moment:%Y%m%dT%H%M%S}")
        merged = harmonize_clusters(*written, index.clusters())
    staged = registry_staging(merged, moment)
    return RegistryStore(spark, f"{base}/corporate_registry").load(staged, moment)


def seller_index(spark: SparkSession, path: str) -> EntityIndex:
    """The index of sellers that jobs of one target share."""
    return EntityIndex(spark, path, T.StringType())


def load_table(
    spark: SparkSession, staging: DataFrame, database: str, table: str, table_format: str, location: str | None = None
) -> DataFrame:
    """Load into a catalog table: create it on the first run, upsert afterwards.

    Formats with row-level updates take a MERGE. Plain files have their touched partitions
    replaced. ``location`` is where a new table's files go. Returns the quarantined rows,
    those without a key.
    """
    staging = materialise(staging, "staging")
    repeated = repeated_keys(staging).head(5)
    if repeated:
        raise ValueError(f"staging repeats keys, for example {[r[0] for r in repeated]}")
    keyed, quarantined = staging.where(F.col(KEY).isNotNull()), staging.where(F.col(KEY).isNull())
    create_database(spark, database)
    target = f"{database}.{table}"
    if not spark.catalog.tableExists(target):
        create_partitioned_table(keyed, target, table_format, location=location)
    elif table_format.lower() in WITHOUT_ROW_UPDATES:
        _upsert_partitions(spark, keyed, target)
    else:
        keyed.createOrReplaceTempView("staging_corporate_registry")
        spark.sql(merge_statement(target, "staging_corporate_registry"))
    return quarantined


def _upsert_partitions(spark: SparkSession, keyed: DataFrame, target: str) -> None:
    """Upsert by replacing the months that hold a staged key now and those that it goes to.

    The merged rows are written aside first, as a table cannot be read while its files are
    replaced; months whose rows have all moved on are dropped.
    """
    current, keys = spark.table(target), keyed.select(KEY)
    month = ["year", "month"]
    held = current.join(keys, KEY, "left_semi").select(*month).distinct()
    touched = materialise(held.unionByName(keyed.select(*month)).distinct(), "months")
    affected = current.join(F.broadcast(touched), month, "left_semi")
    merged = materialise(upsert(affected, keyed)[0].select(*current.columns), "merged")
    replace_partitions(merged, target)
    # A row per month of the registry's life.
    for row in touched.join(merged.select(*month).distinct(), month, "left_anti").collect():
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (year = {row['year']}, month = {row['month']})")
        spark.sql(f"REFRESH TABLE {target}")
