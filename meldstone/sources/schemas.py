"""Declared schemas of the raw, registry and log tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "money": T.DecimalType(18, 2),
    "floats": T.ArrayType(T.FloatType()),
}


def _struct(columns: str) -> T.StructType:
    """Schema from 'name type, ...'; unlike a DDL string it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


ORDER_ITEMS = _struct(
    "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date string, price double, freight_value double"
)
PAYMENTS = _struct(
    "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double"
)
# The postal prefix stays a string: inference would read 01037 as the number 1037.
SELLERS = _struct(
    "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
)

# activity_places is a distinct product count and top_suppliers a list of product
# ids; the names are part of the registry's published layout.
REGISTRY = _struct(
    "corporate_id string, corporate_name string, address string, city string, state string, "
    "activity_places int, top_suppliers string, main_customers string, "
    "revenue money, profit money, load_date timestamp, source_system string, "
    "_etl_processed_dttm timestamp, _data_contract_version string, year int, month int"
)

JOB_LOG = _struct("run_id string, seq bigint, ts timestamp_ntz, message string")
RUN_RECORD = _struct("run_id string, run_name string, ts timestamp, kind string, key string, value string")

# The shared test tables. Declared schemas spare a footer read per table.
TABLES = {
    "region": _struct("r_regionkey int, r_name string"),
    "nation": _struct("n_nationkey int, n_name string, n_regionkey int"),
    "supplier": _struct("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "customer": _struct(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": _struct(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": _struct(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": _struct(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": _struct("doc_id bigint, text string, lang string, source string, n_chars bigint"),
    "embeddings": _struct("vec_id bigint, embedding floats, label int"),
    "pages": _struct("page_id bigint, url string, html string"),
    "benchmark": _struct("item_id bigint, text string"),
    "labels": _struct("doc_id bigint, quality int, toxic int"),
    "conversations": _struct("conv_id bigint, turn bigint, role string, text string"),
}
