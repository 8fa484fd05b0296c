"""Batch writers for prepared sources and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_prepared(df: DataFrame, path: str) -> None:
    """Replace a prepared source."""
    df.write.mode("overwrite").parquet(path)


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


#: File formats whose tables cannot update single rows.
WITHOUT_ROW_UPDATES = ("parquet", "orc", "csv", "json", "avro", "text")


def create_partitioned_table(
    df: DataFrame, table: str, table_format: str, keys: tuple[str, ...] = ("year", "month"), location: str | None = None
) -> None:
    """First-run create of a table partitioned by load year and month."""
    first, *rest = keys
    writer = df.writeTo(table).using(table_format).partitionedBy(first, *rest)
    if location is not None:
        writer = writer.tableProperty("location", location)
    writer.create()


_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace those partitions of a table that ``df`` has rows of; its columns are in the table's order.

    The mode is a setting of the session: an insert into a catalog table takes it from there
    and would replace all partitions otherwise.
    """
    conf = df.sparkSession.conf
    before = conf.get(_OVERWRITE)
    conf.set(_OVERWRITE, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(_OVERWRITE, before)
