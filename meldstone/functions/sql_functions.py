"""SQL-callable forms of the cleansing functions.

They are registered as SQL expressions rather than Python functions, so the
optimiser inlines them into the query that calls them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_CLEANSE = "trim(regexp_replace(lower(coalesce(raw, '')), '[^a-z0-9]+', ' '))"

SQL_FUNCTIONS = {
    "cleanse_company_name": ("raw STRING", _CLEANSE),
    "normalize_address": ("raw STRING", _CLEANSE),
    "compute_corporate_id": (
        "name STRING, address STRING",
        "substring(sha2(concat(name, '|', address), 256), 1, 16)",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    for name, (parameters, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS STRING RETURN {body}")
