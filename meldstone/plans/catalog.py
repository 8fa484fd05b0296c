"""Every registered query: a Spark plan over the shared tables and, where SQL can
express it, an equivalent statement for another engine."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.functions import keys, text
from meldstone.functions.sql_functions import register_sql_functions
from meldstone.operators import analytics, clusters, contracts, evidence, features, matching, metrics, prepare, quality
from meldstone.operators import harmonize as harm
from meldstone.operators import model as ml
from meldstone.operators import profiles, runlog
from meldstone.operators import registry as reg
from meldstone.operators.entity_index import EntityIndex
from meldstone.operators.sequence import sequential_ids
from meldstone.plans import etl, inputs, training
from meldstone.plans import oracle as o
from meldstone.sources import readers, schemas, tables
from meldstone.sources.registry_store import RegistryStore
from meldstone.sources.storage import materialise, scratch_path
from meldstone.streaming.ingest import RegistryIngest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def _items(spark, sf):
    return tables.order_items(spark, sf)


def _sellers(spark, sf):
    return tables.sellers(spark, sf)


def _without_times(df: DataFrame) -> DataFrame:
    return df.drop("load_date", "_etl_processed_dttm")


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# ---------------------------------------------------------------- sources and counts


@register(
    "source_row_counts",
    f"""WITH {o.SELLERS}, {o.ITEMS}, {o.PAYMENTS}
SELECT 'order_items' AS dataset, count(*) AS total_records, 7 AS column_count FROM items
UNION ALL SELECT 'payments', count(*), 5 FROM payments
UNION ALL SELECT 'sellers', count(*), 4 FROM sellers""",
)
def source_row_counts(spark, sf):
    return readers.row_counts(
        {"order_items": _items(spark, sf), "payments": tables.payments(spark, sf), "sellers": _sellers(spark, sf)}
    )


# ---------------------------------------------------------------- source preparation


@register(
    "prepare_supply",
    f"""WITH {o.SELLERS}
SELECT seller_id, seller_name, seller_city AS city, seller_state AS state, 1 AS activity_places,
       CAST(NULL AS VARCHAR) AS top_suppliers, lower(trim(coalesce(seller_name, ''))) AS canonical_name,
       concat_ws(', ', seller_city, seller_state) AS address, 'supply_chain' AS source_system FROM sellers""",
)
def prepare_supply(spark, sf):
    raw = _sellers(spark, sf).withColumns(
        {"activity_places": F.lit(1), "top_suppliers": F.lit(None).cast("string")}
    )
    return prepare.prepare_supply(raw)


@register(
    "build_supply",
    f"""{o.BASE} SELECT seller_id, seller_name, city, state, activity_places, top_suppliers, canonical_name, address,
       source_system FROM supply""",
)
def build_supply(spark, sf):
    return prepare.build_supply(_items(spark, sf), _sellers(spark, sf))


@register(
    "prepare_financial",
    f"{o.BASE} SELECT seller_id, revenue, transaction_count, profit, source_system, city, state FROM financial",
)
def prepare_financial(spark, sf):
    items, sellers = _items(spark, sf), _sellers(spark, sf)
    places = sellers.select("seller_id", F.col("seller_city").alias("city"), F.col("seller_state").alias("state"))
    return prepare.prepare_financial(items, places)


@register("prep_item_supply", f"WITH {o.SELLERS}, {o.ITEMS}, {o.ITEM_SUPPLY} SELECT * FROM item_supply")
def prep_item_supply(spark, sf):
    return prepare.item_supply(_items(spark, sf), _sellers(spark, sf))


@register("prep_order_financial", f"WITH {o.PAYMENTS}, {o.ORDER_FINANCIAL} SELECT * FROM order_financial")
def prep_order_financial(spark, sf):
    return prepare.order_financial(tables.payments(spark, sf))


@register("seller_supply_summary", f"WITH {o.SELLERS}, {o.ITEMS}, {o.SELLER_SUMMARY} SELECT * FROM seller_summary")
def seller_supply_summary(spark, sf):
    return prepare.seller_supply_summary(_items(spark, sf), _sellers(spark, sf), inputs.SECOND_LOAD.date())


@register("seller_product_list", f"WITH {o.ITEMS} SELECT DISTINCT seller_id AS corporate_id, product_id FROM items")
def seller_product_list(spark, sf):
    return prepare.seller_product_list(_items(spark, sf))


@register(
    "seller_product_chunks",
    f"""WITH {o.ITEMS}, pairs AS (SELECT DISTINCT seller_id, product_id FROM items WHERE product_id IS NOT NULL AND seller_id IS NOT NULL),
placed AS (SELECT *, (row_number() OVER (PARTITION BY seller_id ORDER BY product_id) - 1) // 100 AS chunk FROM pairs)
SELECT seller_id AS corporate_id, chunk, count(*) AS n_products, string_agg(product_id, ',' ORDER BY product_id) AS products
FROM placed GROUP BY seller_id, chunk""",
)
def seller_product_chunks(spark, sf):
    """The product list of every seller, a hundred products to a row."""
    chunks = prepare.seller_product_chunks(_items(spark, sf), 100)
    return chunks.withColumn("products", F.concat_ws(",", "products"))


@register("payment_financial_summary", f"WITH {o.PAYMENT_SUMMARY} SELECT * FROM summary")
def payment_financial_summary(spark, sf):
    return prepare.payment_financial_summary(tables.payments(spark, sf), inputs.SECOND_LOAD.date())


@register(
    "sequential_ids",
    f"""WITH {o.PAID}
SELECT order_id, payment_type, revenue, row_number() OVER (ORDER BY order_id, payment_type) AS row_id FROM totals""",
)
def sequential(spark, sf):
    return sequential_ids(prepare.payment_totals(tables.payments(spark, sf)), ["order_id", "payment_type"])


_DIVERSITY = f"""WITH {o.SELLERS}, {o.ITEMS}, diversity AS (
  SELECT i.seller_id AS corporate_id, seller_city AS corporate_name, seller_state AS state,
         CAST(sum(price) AS DOUBLE) AS revenue, count(DISTINCT product_id) + max(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END) AS product_diversity,
         seller_city || ', ' || seller_state AS address, '{prepare.SUPPLY_SUMMARY}' AS source_system,
         CAST(sum(price) AS DOUBLE) * CAST(0.2 AS DOUBLE) AS profit
  FROM items i JOIN sellers s ON i.seller_id = s.seller_id GROUP BY i.seller_id, seller_city, seller_state)"""


@register("supplier_diversity", f"{_DIVERSITY} SELECT * FROM diversity")
def supplier_diversity(spark, sf):
    return prepare.supplier_diversity(_items(spark, sf), _sellers(spark, sf))


@register(
    "sellers_left_products",
    f"{o.BASE} SELECT seller_id, city AS seller_city, state AS seller_state, activity_places, top_suppliers FROM supply",
)
def sellers_left_products(spark, sf):
    return prepare.sellers_left_products(_items(spark, sf), _sellers(spark, sf))


# ---------------------------------------------------------------- cleansing and keys


@register("cleanse_name", f"SELECT doc_id, {o.cleanse('text')} AS cleansed FROM documents")
def cleanse_name(spark, sf):
    return tables.table(spark, sf, "documents").select("doc_id", text.cleanse_name(F.col("text")).alias("cleansed"))


_LEGAL_FORMS = {"AUTOMOBILE": " LLC", "BUILDING": ", Inc.", "FURNITURE": " Corp", "MACHINERY": " Ltd."}


@register(
    "cleanse_name_suffix",
    f"""WITH {o.COMPANIES}, named AS (
  SELECT id, name || CASE market WHEN 'AUTOMOBILE' THEN ' LLC' WHEN 'BUILDING' THEN ', Inc.'
                                 WHEN 'FURNITURE' THEN ' Corp' WHEN 'MACHINERY' THEN ' Ltd.' ELSE ' S.A.' END AS raw
  FROM companies)
SELECT id, raw, trim(regexp_replace({o.cleanse('raw')}, '( (llc|inc|corp|ltd))+$', '')) AS cleansed FROM named""",
)
def cleanse_name_suffix(spark, sf):
    form = F.lit(" S.A.")
    for market, suffix in _LEGAL_FORMS.items():
        form = F.when(F.col("market") == market, suffix).otherwise(form)
    named = tables.companies(spark, sf).select("id", F.concat("name", form).alias("raw"))
    return named.withColumn("cleansed", text.cleanse_name(F.col("raw"), strip_suffixes=True))


@register("normalize_address", f"SELECT page_id, {o.cleanse('url')} AS address FROM pages")
def normalize_address(spark, sf):
    return tables.table(spark, sf, "pages").select("page_id", text.normalize_address(F.col("url")).alias("address"))


def _raw_address(companies: DataFrame) -> Column:
    street = F.when(F.col("market") == "BUILDING", " Main Ave., Suite ").otherwise(" Oak St., Apt ")
    number = F.col("id").cast("string")
    return F.concat(number, street, number, F.lit("B, "), "city", F.lit(", "), "state", F.lit(" "), F.lpad(number, 5, "0"))


@register(
    "standardize_address",
    f"""WITH {o.COMPANIES}, raw AS (
  SELECT id, CAST(id AS VARCHAR) || CASE WHEN market = 'BUILDING' THEN ' Main Ave., Suite ' ELSE ' Oak St., Apt ' END
         || CAST(id AS VARCHAR) || 'B, ' || city || ', ' || state || ' ' || lpad(CAST(id AS VARCHAR), 5, '0') AS raw
  FROM companies),
s AS (SELECT id, raw, regexp_replace({o.cleanse('raw')}, '\\b(apt|apartment|suite) [a-z0-9]+\\b', '', 'g') AS a FROM raw),
t AS (SELECT id, raw, regexp_replace(regexp_replace(a, '\\bst\\b', 'street', 'g'), '\\bave\\b', 'avenue', 'g') AS a FROM s)
SELECT id, trim(regexp_replace(a, ' +', ' ', 'g')) AS address,
       trim(string_split(raw, ',')[-2]) AS city, regexp_extract(raw, ', ([A-Z]{{2}}) [0-9]+$', 1) AS state,
       regexp_extract(raw, '([0-9]{{5}})$', 1) AS zip FROM t""",
)
def standardize_address(spark, sf):
    companies = tables.companies(spark, sf)
    raw = companies.select("id", _raw_address(companies).alias("raw"))
    parts = text.address_parts(F.col("raw"))
    return raw.select(
        "id", text.standardize_address(F.col("raw")).alias("address"), *[c.alias(n) for n, c in parts.items()]
    )


_KEYED = f"""WITH {o.SELLERS}, c AS (
  SELECT seller_id, {o.cleanse('seller_name')} AS name, {o.cleanse("concat_ws(', ', seller_city, seller_state)")} AS address,
         seller_city AS city FROM sellers)"""


def _cleansed_sellers(spark, sf) -> DataFrame:
    address = F.concat_ws(", ", "seller_city", "seller_state")
    return _sellers(spark, sf).select(
        "seller_id",
        text.cleanse_name(F.col("seller_name")).alias("name"),
        text.normalize_address(address).alias("address"),
        F.col("seller_city").alias("city"),
    )


@register(
    "corporate_id",
    f"{_KEYED} SELECT seller_id, name, address, substr(sha256(name || '|' || address), 1, 16) AS corporate_id FROM c",
)
def corporate_id(spark, sf):
    return _cleansed_sellers(spark, sf).select(
        "seller_id", "name", "address", keys.corporate_id(F.col("name"), F.col("address")).alias("corporate_id")
    )


@register("corporate_id_md5", f"{_KEYED} SELECT seller_id, md5(name || address || city) AS corporate_id FROM c")
def corporate_id_md5(spark, sf):
    key = keys.corporate_id_md5(F.col("name"), F.col("address"), F.col("city"))
    return _cleansed_sellers(spark, sf).select("seller_id", key.alias("corporate_id"))


@register(
    "sql_function_cleanse",
    f"{_KEYED} SELECT seller_id, name, address, substr(sha256(name || '|' || address), 1, 16) AS corporate_id FROM c",
)
def sql_function_cleanse(spark, sf):
    register_sql_functions(spark)
    _sellers(spark, sf).createOrReplaceTempView("meldstone_sellers")
    return spark.sql(
        """SELECT seller_id, name, address, compute_corporate_id(name, address) AS corporate_id
           FROM (SELECT seller_id, cleanse_company_name(seller_name) AS name,
                        normalize_address(concat_ws(', ', seller_city, seller_state)) AS address
                 FROM meldstone_sellers)"""
    )


# ---------------------------------------------------------------- entity resolution


@register(
    "block_candidates",
    f"""WITH {o.COMPANIES},
named AS (SELECT id, block_key, {o.cleanse('name')} AS name FROM companies),
reps AS (SELECT block_key, name, min(id) AS id, length(name) AS n, (3 * length(name)) // 20 AS allowed
         FROM named GROUP BY block_key, name),
variants AS (
  SELECT DISTINCT block_key, id, substr(name, 1, i - 1) || substr(name, i + 1, j - i - 1) || substr(name, j + 1) AS variant
  FROM (SELECT *, unnest(range(1, n)) AS i FROM reps WHERE allowed = 2), unnest(range(i + 1, n + 1)) AS r(j))
SELECT DISTINCT a.block_key, a.id AS id_a, b.id AS id_b
FROM variants a JOIN variants b ON a.block_key = b.block_key AND a.variant = b.variant AND a.id < b.id""",
)
def block_candidates(spark, sf):
    return matching.block_candidates(tables.companies(spark, sf))


@register("fuzzy_matches", f"WITH {o.EVERY_MATCH} SELECT id_a, id_b, distance, similarity FROM matches")
def fuzzy_matches(spark, sf):
    return matching.fuzzy_matches(tables.companies(spark, sf), every=True)


@register("fuzzy_long_names", f"WITH {o.LONG_MATCHES} SELECT id_a, id_b, distance, similarity FROM matches")
def fuzzy_long_names(spark, sf):
    """Names of 20 characters and more, which share long parts."""
    return matching.fuzzy_matches(tables.long_names(spark, sf))


@register(
    "candidate_misses",
    f"""WITH {o.MATCHES}, near AS (SELECT DISTINCT id_a, id_b FROM matches WHERE distance > 0)
SELECT count(*) AS matches, CAST(0 AS BIGINT) AS missed FROM near""",
)
def candidate_misses(spark, sf):
    """Matches among all pairs of a block, and how many of them the candidates lack."""
    records = materialise(matching.representatives(tables.companies(spark, sf)), "names")
    near = matching.all_near_pairs(records).select("id_a", "id_b").distinct()
    # Candidates that are no matches cannot be missing, so they stay where they met.
    found = matching.near_names(records).select("id_a", "id_b").distinct().withColumn("found", F.lit(True))
    return near.join(found.hint("merge"), ["id_a", "id_b"], "left").agg(
        F.count("*").alias("matches"), F.count_if(F.col("found").isNull()).alias("missed")
    )


@register(
    "entity_clusters",
    f"""WITH RECURSIVE {o.MATCHES},
edges AS (SELECT id_a AS u, id_b AS v FROM matches UNION SELECT id_b, id_a FROM matches),
reach(id, seen) AS (SELECT u, u FROM edges UNION SELECT r.id, e.v FROM reach r JOIN edges e ON r.seen = e.u),
labels AS (SELECT n.id, coalesce(l.cluster_id, n.id) AS cluster_id, n.name
           FROM named n LEFT JOIN (SELECT id, min(seen) AS cluster_id FROM reach GROUP BY id) l ON n.id = l.id),
sized AS (SELECT *, count(*) OVER (PARTITION BY cluster_id) AS cluster_size FROM labels),
scored AS (SELECT s.id, s.cluster_id, s.cluster_size,
  1 - CAST(levenshtein(s.name, h.name) AS DOUBLE) / CAST(greatest(length(s.name), length(h.name)) AS DOUBLE) AS rep_similarity
  FROM sized s JOIN named h ON s.cluster_id = h.id)
SELECT id, cluster_id, cluster_size, rep_similarity, rep_similarity < 0.85 AS is_chained FROM scored""",
)
def entity_clusters(spark, sf):
    companies = tables.companies(spark, sf)
    return clusters.entity_clusters(companies, matching.fuzzy_matches(companies))


@register(
    "best_match",
    f"""WITH {o.MATCHES},
both_ways AS (SELECT id_a AS id, id_b AS match_id, similarity FROM matches WHERE similarity > 0.85
              UNION ALL SELECT id_b, id_a, similarity FROM matches WHERE similarity > 0.85),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, match_id) AS rn FROM both_ways)
SELECT id, match_id, similarity FROM ranked WHERE rn = 1""",
)
def best_match(spark, sf):
    return matching.best_match(matching.fuzzy_matches(tables.companies(spark, sf), once=False))


@register(
    "potential_duplicates",
    f"""{_DIVERSITY}, g AS (SELECT corporate_name, count(*) AS n FROM diversity GROUP BY corporate_name)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_records, count(*) AS duplicate_names FROM g WHERE n > 1""",
)
def potential_duplicates(spark, sf):
    return matching.potential_duplicates(supplier_diversity(spark, sf))


@register(
    "match_statistics",
    f"""WITH {o.PAID}, s AS (SELECT count(DISTINCT l_suppkey) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
f AS (SELECT count(*) AS n FROM totals)
SELECT 'supply' AS source, n AS entities FROM s UNION ALL SELECT 'financial', n FROM f
UNION ALL SELECT 'total', (SELECT n FROM s) + (SELECT n FROM f)""",
)
def match_statistics(spark, sf):
    paid = prepare.payment_totals(tables.payments(spark, sf))
    return matching.match_statistics({"supply": supplier_diversity(spark, sf), "financial": paid})


@register("harmonize", f"{o.BASE} SELECT * FROM harmonized")
def harmonize(spark, sf):
    return inputs.harmonized(spark, sf)


@register(
    "harmonize_resolved",
    f"""WITH RECURSIVE {o.SELLERS}, {o.ITEMS},{o.harmonized()},
records AS (SELECT seller_id AS id, city || '|' || state AS block_key, canonical_name AS name FROM supply
            WHERE city IS NOT NULL AND state IS NOT NULL),
{o.matches('records')}, {o.evident()},
edges AS (SELECT id_a AS u, id_b AS v FROM evident UNION SELECT id_b, id_a FROM evident),
reach(id, seen) AS (SELECT u, u FROM edges UNION SELECT r.id, e.v FROM reach r JOIN edges e ON r.seen = e.u),
labels AS (SELECT id, min(seen) AS head FROM reach GROUP BY id),
resolved AS (
  SELECT u.* REPLACE (coalesce(h.corporate_id, u.corporate_id) AS corporate_id) FROM unioned u
  LEFT JOIN labels l ON u.seller_id = l.id LEFT JOIN keyed h ON l.head = h.seller_id),
{o.merged('r_', 'resolved')}
SELECT * FROM r_harmonized""",
)
def harmonize_resolved(spark, sf):
    """Harmonised rows after sellers of one city and state became one entity where their names say so."""
    supply, financial = inputs.sources(spark, sf)
    return harm.harmonize_clusters(supply, financial, harm.resolve_sellers(supply))


_EVIDENT = f"{o.SHOPS},\n{o.matches('shops')},\n{o.evident()}"


@register("evident_matches", f"WITH {_EVIDENT} SELECT id_a, id_b, distance, similarity FROM evident")
def evident_matches(spark, sf):
    return evidence.evident_matches(tables.shop_names(spark, sf))


@register(
    "refused_matches",
    f"""WITH {_EVIDENT} SELECT id_a, id_b, distance FROM matches
EXCEPT SELECT id_a, id_b, distance FROM evident""",
)
def refused_matches(spark, sf):
    """Similar names that the evidence rule keeps apart."""
    shops = tables.shop_names(spark, sf)
    similar = matching.fuzzy_matches(shops).select("id_a", "id_b", "distance")
    return similar.join(evidence.evident_matches(shops).select("id_a", "id_b"), ["id_a", "id_b"], "left_anti")


@register("union_sources", f"{o.BASE} SELECT * FROM unioned")
def union_sources(spark, sf):
    return harm.union_sources(*inputs.sources(spark, sf))


@register(
    "profit_margin",
    f"""WITH {o.ACCOUNTS} SELECT corporate_id, revenue, profit,
       CASE WHEN revenue > 0 THEN profit / revenue ELSE 0.0 END AS profit_margin FROM accounts""",
)
def profit_margin(spark, sf):
    rows = inputs.account_contract_rows(spark, sf).select("corporate_id", "revenue", "profit")
    return contracts.with_margin(rows)


# ---------------------------------------------------------------- registry


@register("registry_staging", f"{o.BASE} {o.staging('harmonized', 2025, 12)}")
def registry_staging(spark, sf):
    return _without_times(inputs.staged(spark, sf))


@register(
    "entity_hash",
    f"{o.BASE}, staged AS ({o.staging('harmonized', 2025, 12)}) SELECT corporate_id, {o.row_hash()} AS entity_hash FROM staged",
)
def entity_hash(spark, sf):
    return reg.with_entity_hash(inputs.staged(spark, sf)).select("corporate_id", "entity_hash")


@register("registry_upsert", f"{o.LOADS} SELECT {o.VERSION_COLUMNS} FROM version_2")
def registry_upsert(spark, sf):
    kept = inputs.first_load(spark, sf).where("corporate_id IS NOT NULL")
    merged, _ = reg.upsert(kept, inputs.second_load(spark, sf))
    return _without_times(merged)


@register("registry_quarantine", f"{o.LOADS} SELECT {o.VERSION_COLUMNS} FROM staged_2 WHERE corporate_id IS NULL")
def registry_quarantine(spark, sf):
    _, quarantined = reg.upsert(inputs.first_load(spark, sf), inputs.second_load(spark, sf))
    return _without_times(quarantined)


@register("registry_as_of", f"{o.LOADS} SELECT {o.VERSION_COLUMNS} FROM version_1")
def registry_as_of(spark, sf):
    return _without_times(inputs.loaded_store(spark, sf).read(as_of=inputs.BETWEEN_LOADS))


@register(
    "registry_history",
    f"""{o.LOADS}, hashed_1 AS (SELECT corporate_id, {o.row_hash()} AS h FROM version_1),
hashed_2 AS (SELECT corporate_id, {o.row_hash()} AS h FROM version_2)
SELECT '20251115T100000' AS commit_ts, count(*) AS total_records, count(*) AS changed_records FROM hashed_1
UNION ALL
SELECT '20251217T100000', count(*), count(*) FILTER (WHERE a.h IS NULL OR a.h <> b.h)
FROM hashed_2 b LEFT JOIN hashed_1 a ON a.corporate_id = b.corporate_id""",
)
def registry_history(spark, sf):
    return inputs.loaded_store(spark, sf).history()


_DIFFERING = ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in o.HASH_COLUMNS[1:])
_CHANGES = f"""{o.LOADS}, h1 AS (SELECT *, {o.row_hash()} AS h FROM version_1), h2 AS (SELECT *, {o.row_hash()} AS h FROM version_2),
later AS (
  SELECT b.corporate_id, a.h AS old_hash, b.h AS new_hash, concat_ws(',', {_DIFFERING}) AS columns
  FROM h2 b LEFT JOIN h1 a ON a.corporate_id = b.corporate_id WHERE a.h IS NULL OR a.h <> b.h)"""


@register(
    "registry_changes",
    f"""{_CHANGES}
SELECT corporate_id, '20251115T100000' AS commit_ts, 'insert' AS kind, CAST(NULL AS VARCHAR) AS old_hash, h AS new_hash,
       CAST(NULL AS VARCHAR) AS columns FROM h1
UNION ALL
SELECT corporate_id, '20251217T100000', CASE WHEN old_hash IS NULL THEN 'insert' ELSE 'update' END, old_hash, new_hash,
       CASE WHEN old_hash IS NOT NULL THEN columns END FROM later""",
)
def registry_changes(spark, sf):
    return inputs.loaded_store(spark, sf).changes()


@register(
    "registry_compare",
    f"""{_CHANGES}
SELECT corporate_id, CASE WHEN old_hash IS NULL THEN 'insert' ELSE 'update' END AS kind, old_hash, new_hash,
       CAST(1 AS BIGINT) AS versions FROM later""",
)
def registry_compare(spark, sf):
    """Keys that differ between the first load and the second."""
    return inputs.loaded_store(spark, sf).compare(since=inputs.BETWEEN_LOADS)


_SCAN = "corporate_id, corporate_name, revenue, profit, activity_places, top_suppliers"


@register(
    "registry_partition_scan",
    f"{o.LOADS} SELECT month, {_SCAN} FROM version_2 WHERE year = 2025 AND month IN (11, 12)",
)
def registry_partition_scan(spark, sf):
    """Rows of November and of December, each a scan of its partition, after both whole loads.

    An entity bears the month of its last load; those that December lacked stay in November.
    """
    current = inputs.loaded_store(spark, sf).read()
    november, december = (readers.registry_partition(current, 2025, month) for month in (11, 12))
    return november.unionByName(december).select("month", *_SCAN.split(", "))


@register("registry_table_load", f"{o.LOADS} SELECT {o.VERSION_COLUMNS} FROM version_2")
def registry_table_load(spark, sf):
    """Both loads through a catalog table of plain files: created by the first, its months replaced by the second."""
    location, name = scratch_path(spark, "table"), f"registry_{uuid.uuid4().hex}"
    for staged in (inputs.first_load(spark, sf), inputs.second_load(spark, sf)):
        etl.load_table(spark, staged, "meldstone", name, "parquet", location)
    return _without_times(spark.table(f"meldstone.{name}"))


@register(
    "resolved_loads",
    f"""WITH RECURSIVE {_EVIDENT},
edges AS (SELECT id_a AS u, id_b AS v FROM evident UNION SELECT id_b, id_a FROM evident),
reach(id, seen) AS (SELECT u, u FROM edges UNION SELECT r.id, e.v FROM reach r JOIN edges e ON r.seen = e.u)
SELECT id, min(seen) AS cluster_id FROM reach GROUP BY id""",
)
def resolved_loads(spark, sf):
    """Shops resolved in two loads, the second against the index that the first left."""
    shops = tables.shop_names(spark, sf)
    index = EntityIndex(spark, scratch_path(spark, "index"), T.LongType(), inputs.REGISTRY_BUCKETS)
    index.add(shops.where("id % 2 = 0"), "1")
    index.add(shops.where("id % 2 = 1"), "2")
    return index.clusters()


@register(
    "registry_preview",
    f"{o.BASE}, staged AS ({o.staging('harmonized', 2025, 12)}) SELECT {_SCAN} FROM staged ORDER BY corporate_id LIMIT 10",
)
def registry_preview(spark, sf):
    return inputs.staged(spark, sf).select(*_SCAN.split(", ")).orderBy("corporate_id").limit(10)


_REGISTRY = f"{o.BASE}, staged AS ({o.staging('harmonized', 2025, 12)})"


@register(
    "registry_training_scan",
    f"""{_REGISTRY} SELECT corporate_id, CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit,
       activity_places, coalesce(top_suppliers, '') AS top_suppliers, coalesce(source_system, '') AS source_system
FROM staged WHERE revenue IS NOT NULL AND profit IS NOT NULL""",
)
def registry_training_scan(spark, sf):
    return readers.registry_training_scan(inputs.staged(spark, sf))


_MEANS = """CAST(sum(revenue) AS DOUBLE) / CAST(count(revenue) AS DOUBLE) AS avg_revenue,
       CAST(sum(profit) AS DOUBLE) / CAST(count(profit) AS DOUBLE) AS avg_profit"""


@register(
    "registry_by_source",
    f"{o.LOADS} SELECT source_system, count(*) AS total_corporations, {_MEANS} FROM version_2 GROUP BY source_system",
)
def registry_by_source(spark, sf):
    return analytics.registry_by_source(registry_upsert(spark, sf))


@register("registry_totals", f"{_REGISTRY} SELECT count(*) AS total, {_MEANS} FROM staged")
def registry_totals(spark, sf):
    return analytics.registry_totals(inputs.staged(spark, sf))


@register(
    "high_profit_top",
    f"""{_REGISTRY} SELECT corporate_name, revenue, profit, corporate_id FROM staged WHERE profit > 200
ORDER BY profit DESC, corporate_id LIMIT 20""",
)
def high_profit_top(spark, sf):
    return analytics.high_profit_top(inputs.staged(spark, sf))


# ---------------------------------------------------------------- reports


@register(
    "top_suppliers",
    f"""{_DIVERSITY} SELECT corporate_id, corporate_name, revenue, profit FROM diversity
ORDER BY revenue DESC, corporate_id LIMIT 5""",
)
def top_suppliers(spark, sf):
    return analytics.top_suppliers(supplier_diversity(spark, sf))


def _paid(spark, sf) -> DataFrame:
    share = prepare.margin_share("revenue", prepare.FINANCIAL_SUMMARY_MARGIN)
    return prepare.payment_totals(tables.payments(spark, sf)).withColumn("profit", share)


@register(
    "revenue_statistics",
    f"""WITH {o.SELLERS}, {o.ITEMS}, {o.SELLER_SUMMARY}, {o.PAYMENT_SUMMARY}
SELECT 'supply' AS source, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(revenue) AS DOUBLE) / CAST(count(revenue) AS DOUBLE) AS avg_revenue,
       CAST(sum(profit) AS DOUBLE) AS total_profit FROM seller_summary
UNION ALL
SELECT 'financial', CAST(sum(revenue) AS DOUBLE), CAST(sum(revenue) AS DOUBLE) / CAST(count(revenue) AS DOUBLE),
       CAST(sum(profit) AS DOUBLE) FROM summary""",
)
def revenue_statistics(spark, sf):
    supply = prepare.seller_supply_summary(_items(spark, sf), _sellers(spark, sf), inputs.SECOND_LOAD.date())
    return analytics.revenue_statistics({"supply": supply, "financial": _paid(spark, sf)})


@register(
    "payment_type_distribution",
    f"""WITH {o.PAID} SELECT payment_type, count(*) AS payments,
       CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 AS share_pct
FROM totals GROUP BY payment_type""",
)
def payment_type_distribution(spark, sf):
    return analytics.payment_type_distribution(prepare.payment_totals(tables.payments(spark, sf)), "payment_type")


# ---------------------------------------------------------------- profiling and quality


@register(
    "null_profile",
    f"""WITH {o.SELLERS}, {o.ITEMS}, {o.PAYMENTS}
SELECT 'order_items' AS dataset, count(*) AS total_records, 'seller_id' AS "column", count(*) - count(seller_id) AS nulls FROM items
UNION ALL SELECT 'order_items', count(*), 'price', count(*) - count(price) FROM items
UNION ALL SELECT 'order_items', count(*), 'product_id', count(*) - count(product_id) FROM items
UNION ALL SELECT 'payments', count(*), 'order_id', count(*) - count(order_id) FROM payments
UNION ALL SELECT 'payments', count(*), 'payment_value', count(*) - count(payment_value) FROM payments
UNION ALL SELECT 'sellers', count(*), 'seller_id', count(*) - count(seller_id) FROM sellers
UNION ALL SELECT 'sellers', count(*), 'seller_city', count(*) - count(seller_city) FROM sellers""",
)
def null_profile(spark, sf):
    return quality.null_profile(
        {
            "order_items": (_items(spark, sf), ("seller_id", "price", "product_id")),
            "payments": (tables.payments(spark, sf), ("order_id", "payment_value")),
            "sellers": (_sellers(spark, sf), ("seller_id", "seller_city")),
        }
    )


_PROFILED = [f.name for f in schemas.TABLES["lineitem"].fields]
_PROFILE = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS "column", count(*) AS records, count(*) - count({c}) AS nulls,
       CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS null_pct FROM lineitem"""
    for i, c in enumerate(_PROFILED)
)


@register("merged_profile", _PROFILE)
def merged_profile(spark, sf):
    """Items profiled load by load; the whole is the sum of the parts."""
    items = tables.table(spark, sf, "lineitem")
    early = F.coalesce(F.col("l_shipdate") < F.lit(inputs.CUTOFF), F.lit(False))
    store = profiles.ProfileStore(spark, scratch_path(spark, "profiles"))
    store.add("1", items.where(early))
    store.add("2", items.where(~early))
    return store.merged().select("position", "column", "records", "nulls", "null_pct")


_DECLARED = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "string", "value": "decimal(12,2)", "session": "string"}


@register(
    "schema_review",
    """WITH n AS (SELECT count(*) AS records, count(*) - count(user_id) AS no_user, count(*) - count(value) AS no_value,
       count(*) - count(event_type) AS no_type, count(*) - count(props) AS no_props FROM events)
SELECT "column", problem, expected, actual, records, nulls FROM n, LATERAL (VALUES
  ('session', 'missing', 'string', NULL, records), ('event_type', 'extra', NULL, 'string', no_type),
  ('props', 'extra', NULL, 'string', no_props), ('user_id', 'type', 'string', 'bigint', no_user),
  ('value', 'type', 'decimal(12,2)', 'double', no_value)) AS v("column", problem, expected, actual, nulls)""",
)
def schema_review(spark, sf):
    """Where the events depart from a declared schema, and how many of their rows have no value there."""
    events = tables.table(spark, sf, "events")
    declared = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in _DECLARED.items())).schema
    return quality.schema_review(events, declared)


@register("column_null_counts", f'{o.NULL_COUNTS} SELECT "column", nulls, total_records FROM counts')
def column_null_counts(spark, sf):
    return quality.column_null_counts(inputs.harmonized(spark, sf))


@register(
    "column_null_pct",
    f'{o.NULL_COUNTS} SELECT "column", CAST(nulls AS DOUBLE) / CAST(total_records AS DOUBLE) * 100 AS null_pct FROM counts',
)
def column_null_pct(spark, sf):
    return quality.column_null_pct(inputs.harmonized(spark, sf))


@register(
    "completeness_pct",
    f"""WITH {o.PAYMENTS}, {o.ORDER_FINANCIAL}, m AS (
  SELECT count(*) * 10 AS total_cells,
         count(*) * 10 - (count(corporate_id) + count(corporate_name) + count(address) + count(state)
           + count(activity_places) + count(top_suppliers) + count(main_customers) + count(revenue) + count(profit)
           + count(source_system)) AS null_cells FROM order_financial)
SELECT total_cells, null_cells, CAST(null_cells AS DOUBLE) / CAST(total_cells AS DOUBLE) * 100 AS null_pct FROM m""",
)
def completeness_pct(spark, sf):
    return quality.completeness_pct(prep_order_financial(spark, sf))


@register(
    "duplicate_rows",
    f"""WITH {o.PAYMENTS}, g AS (SELECT count(*) AS n FROM payments
  GROUP BY order_id, payment_sequential, payment_type, payment_installments, payment_value)
SELECT CAST(sum(n) AS BIGINT) AS total_records, CAST(sum(n - 1) AS BIGINT) AS duplicate_count FROM g""",
)
def duplicate_rows(spark, sf):
    return quality.duplicate_rows(tables.payments(spark, sf))


@register(
    "key_uniqueness",
    """WITH keyed AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS k FROM events),
g AS (SELECT k, count(*) AS n FROM keyed GROUP BY k)
SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_ids FROM g""",
)
def key_uniqueness(spark, sf):
    """Users of the event log; rows of errors have no key, and NULL is one key."""
    events = tables.table(spark, sf, "events")
    return quality.key_uniqueness(events.select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("k")), "k")


def _tier_row(df: DataFrame, tier: str) -> DataFrame:
    missing = F.aggregate(F.map_values("missing_values"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return quality.quality_tier(df, tier).select(
        "tier",
        "total_records",
        missing.alias("missing_total"),
        "duplicate_count",
        "column_count",
        F.round("quality_score", 10).alias("quality_score"),
        "passed",
    )


_ITEM_COLUMNS = "order_id order_item_id product_id seller_id shipping_limit_date price freight_value".split()
_PAYMENT_COLUMNS = "order_id payment_sequential payment_type payment_installments payment_value".split()


@register("quality_bronze", f"WITH {o.ITEMS}, {o.tier(_ITEM_COLUMNS, 'items', 'bronze')}")
def quality_bronze(spark, sf):
    return _tier_row(_items(spark, sf), "bronze")


@register("quality_silver", f"WITH {o.PAYMENTS}, {o.tier(_PAYMENT_COLUMNS, 'payments', 'silver')}")
def quality_silver(spark, sf):
    return _tier_row(tables.payments(spark, sf).select(*_PAYMENT_COLUMNS), "silver")


@register("quality_gold", f"{o.BASE}, {o.tier(o.NULL_COUNTS_COLUMNS, 'harmonized', 'gold')}")
def quality_gold(spark, sf):
    return _tier_row(inputs.harmonized(spark, sf), "gold")


@register(
    "quality_gate",
    f"""{_REGISTRY}, filled AS (SELECT corporate_id, corporate_name, address, city, state, activity_places, top_suppliers,
       revenue, profit, source_system FROM staged),
n AS (SELECT count(*) FILTER (WHERE corporate_id IS NULL OR corporate_name IS NULL OR address IS NULL OR city IS NULL
        OR state IS NULL OR activity_places IS NULL OR top_suppliers IS NULL OR revenue IS NULL OR profit IS NULL
        OR source_system IS NULL) AS missing, count(*) AS rows, count(DISTINCT corporate_id) AS ids FROM filled),
d AS (SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM filled))
SELECT 'gold_tier' AS "check", missing = 0 AND rows = distinct_rows AND rows > 0 AS passed FROM n, d
UNION ALL SELECT 'unique_key', rows = ids FROM n
UNION ALL SELECT 'key_present', missing = 0 FROM n""",
)
def quality_gate(spark, sf):
    return quality.quality_gate(inputs.staged(spark, sf))


@register(
    "referential_integrity",
    """SELECT doc_id AS id, 'missing' AS side FROM documents WHERE doc_id NOT IN (SELECT user_id FROM events)
UNION ALL
SELECT DISTINCT user_id, 'extra' FROM events WHERE user_id NOT IN (SELECT doc_id FROM documents)""",
)
def referential_integrity(spark, sf):
    """Documents against the users of the event log, whose ids overlap in part."""
    documents = tables.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    users = tables.table(spark, sf, "events").select(F.col("user_id").alias("id"))
    return quality.key_difference(documents, users, "id")


# ---------------------------------------------------------------- contracts

_SOURCE_ROWS = """source_rows AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_suppkey AS VARCHAR) AS seller_id, l_quantity * l_extendedprice AS payment_value,
         o_orderstatus AS order_status FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""


def _source_rows(spark, sf) -> DataFrame:
    line, orders = tables.table(spark, sf, "lineitem"), tables.table(spark, sf, "orders")
    return line.join(orders, line.l_orderkey == orders.o_orderkey, "left").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        (F.col("l_quantity") * F.col("l_extendedprice")).alias("payment_value"),
        F.col("o_orderstatus").alias("order_status"),
    )


_SOURCE_VIOLATIONS = f"""{_SOURCE_ROWS}, source_violations AS (
  SELECT order_id, 'payment_value' AS field,
         CASE WHEN payment_value <= 0 THEN 'greater_than' ELSE 'maximum' END AS rule
  FROM source_rows WHERE payment_value <= 0 OR payment_value > 1000000
  UNION ALL SELECT order_id, 'customer_id', 'required' FROM source_rows WHERE customer_id IS NULL
  UNION ALL SELECT order_id, 'order_status', 'required' FROM source_rows WHERE order_status IS NULL)"""


@register("contract_source", f"WITH {_SOURCE_VIOLATIONS} SELECT * FROM source_violations")
def contract_source(spark, sf):
    return contracts.validate(_source_rows(spark, sf), contracts.SOURCE)[1]


@register("contract_prepared", f"WITH {o.ACCOUNTS}, {o.PREPARED_VIOLATIONS} SELECT * FROM violations")
def contract_prepared(spark, sf):
    return contracts.validate(inputs.account_contract_rows(spark, sf), contracts.PREPARED)[1]


_FEATURE_VIOLATIONS = f"""{o.COMPANIES}, feature_rows AS (
  SELECT CAST(id AS VARCHAR) AS corporate_id, balance AS revenue, n_regionkey AS label
  FROM companies JOIN customer ON id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
feature_violations AS (
  SELECT corporate_id, 'revenue' AS field, 'greater_than' AS rule FROM feature_rows WHERE revenue <= 0
  UNION ALL SELECT corporate_id, 'label', 'maximum' FROM feature_rows WHERE label > 1)"""


def _feature_rows(spark, sf) -> DataFrame:
    nation = tables.table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("label"))
    customer = tables.table(spark, sf, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("corporate_id"),
        F.col("c_acctbal").alias("revenue"),
        (F.col("c_acctbal") * 0.18).alias("profit"),
        F.lit(0.18).alias("profit_margin"),
        F.lit(1).alias("activity_places"),
        "label",
    )


@register("contract_ml_feature", f"WITH {_FEATURE_VIOLATIONS} SELECT * FROM feature_violations")
def contract_ml_feature(spark, sf):
    return contracts.validate(_feature_rows(spark, sf), contracts.ML_FEATURE)[1]


_PREDICTION_VIOLATIONS = """prediction_rows AS (
  SELECT CAST(vec_id AS VARCHAR) AS corporate_id, label AS predicted_class,
         CAST(embedding[1] AS DOUBLE) AS prediction_probability, CAST(embedding[2] AS DOUBLE) AS confidence FROM embeddings),
prediction_violations AS (
  SELECT corporate_id, 'predicted_class' AS field, CASE WHEN predicted_class < 0 THEN 'minimum' ELSE 'maximum' END AS rule
  FROM prediction_rows WHERE predicted_class < 0 OR predicted_class > 1
  UNION ALL SELECT corporate_id, 'prediction_probability', CASE WHEN prediction_probability < 0 THEN 'minimum' ELSE 'maximum' END
  FROM prediction_rows WHERE prediction_probability < 0 OR prediction_probability > 1
  UNION ALL SELECT corporate_id, 'confidence', CASE WHEN confidence < 0 THEN 'minimum' ELSE 'maximum' END
  FROM prediction_rows WHERE confidence < 0 OR confidence > 1)"""


def _prediction_rows(spark, sf) -> DataFrame:
    return tables.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("corporate_id"),
        F.col("label").alias("predicted_class"),
        F.col("embedding")[0].cast("double").alias("prediction_probability"),
        F.col("embedding")[1].cast("double").alias("confidence"),
        F.lit("2025-12-17T10:00:00").alias("prediction_timestamp"),
    )


@register("contract_ml_prediction", f"WITH {_PREDICTION_VIOLATIONS} SELECT * FROM prediction_violations")
def contract_ml_prediction(spark, sf):
    return contracts.validate(_prediction_rows(spark, sf), contracts.ML_PREDICTION)[1]


def _counts_sql(contract: str, rows: str, violations: str, key: str) -> str:
    return f"""SELECT '{contract}' AS contract, (SELECT count(*) FROM {rows}) AS total_records,
       (SELECT count(*) FROM {rows}) - (SELECT count(DISTINCT {key}) FROM {violations}) AS valid_records,
       (SELECT count(DISTINCT {key}) FROM {violations}) AS invalid_records"""


@register(
    "contract_violation_counts",
    f"""WITH {_SOURCE_ROWS}, {o.ACCOUNTS}, {o.PREPARED_VIOLATIONS}, {_FEATURE_VIOLATIONS.replace(o.COMPANIES + ', ', '')},
{_PREDICTION_VIOLATIONS}
SELECT 'source' AS contract, count(*) AS total_records,
       count(*) FILTER (WHERE payment_value > 0 AND payment_value <= 1000000 AND customer_id IS NOT NULL
                          AND order_status IS NOT NULL) AS valid_records,
       count(*) FILTER (WHERE NOT (payment_value > 0 AND payment_value <= 1000000) OR customer_id IS NULL
                          OR order_status IS NULL) AS invalid_records FROM source_rows
UNION ALL {_counts_sql('prepared', 'accounts', 'violations', 'corporate_id')}
UNION ALL {_counts_sql('ml_feature', 'feature_rows', 'feature_violations', 'corporate_id')}
UNION ALL {_counts_sql('ml_prediction', 'prediction_rows', 'prediction_violations', 'corporate_id')}""",
)
def contract_violation_counts(spark, sf):
    counted = contracts.violation_counts(_source_rows(spark, sf), contracts.SOURCE)
    for rows, contract in (
        (inputs.account_contract_rows(spark, sf), contracts.PREPARED),
        (_feature_rows(spark, sf), contracts.ML_FEATURE),
        (_prediction_rows(spark, sf), contracts.ML_PREDICTION),
    ):
        counted = counted.unionByName(contracts.violation_counts(rows, contract))
    return counted


@register(
    "contract_odd_rows",
    """WITH odd AS (
  SELECT CAST(event_id AS VARCHAR) AS corporate_id, event_type,
         CASE event_type WHEN 'click' THEN 'abc' WHEN 'view' THEN CAST(event_id AS VARCHAR) || '.0'
                         WHEN 'signup' THEN CAST(event_id AS VARCHAR) || '.5' ELSE CAST(event_id AS VARCHAR) END AS places,
         CASE WHEN event_type = 'purchase' THEN CAST('NaN' AS DOUBLE) ELSE value END AS revenue FROM events)
SELECT corporate_id, 'revenue' AS field, CASE WHEN isnan(revenue) THEN 'not_a_number' ELSE 'minimum' END AS rule
FROM odd WHERE isnan(revenue) OR revenue < 0
UNION ALL SELECT corporate_id, 'activity_places', CASE event_type WHEN 'click' THEN 'type' ELSE 'integer' END
FROM odd WHERE event_type IN ('click', 'signup')
UNION ALL SELECT corporate_id, f, r FROM odd, (VALUES ('profit', 'required'), ('profit_margin', 'required'), ('state', 'type'),
  ('transaction_count', 'required')) AS v(f, r)""",
)
def contract_odd_rows(spark, sf):
    """Events in the layout of the prepared contract: NaN, numbers as text, columns missing or of another type."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    places = F.when(kind == "click", "abc").when(kind == "view", F.concat(number, F.lit(".0")))
    odd = tables.table(spark, sf, "events").select(
        number.alias("corporate_id"),
        places.when(kind == "signup", F.concat(number, F.lit(".5"))).otherwise(number).alias("activity_places"),
        F.when(kind == "purchase", F.lit(float("nan"))).otherwise(F.col("value")).alias("revenue"),
        F.col("user_id").alias("state"),
    )
    return contracts.validate(odd, contracts.PREPARED)[1]


@register(
    "transformation_rules",
    f"""WITH {o.ACCOUNTS}, c AS (
  SELECT count(*) FILTER (WHERE revenue = 0 OR abs(profit / revenue - profit_margin) >= 0.01) AS margin,
         count(*) FILTER (WHERE revenue < 0) AS revenue, count(*) FILTER (WHERE length(state) <> 2) AS state FROM accounts)
SELECT 'margin_consistent' AS rule, margin AS failures, margin = 0 AS passed FROM c
UNION ALL SELECT 'revenue_not_negative', revenue, revenue = 0 FROM c
UNION ALL SELECT 'state_two_letters', state, state = 0 FROM c""",
)
def transformation_rules(spark, sf):
    return contracts.transformation_rules(inputs.account_contract_rows(spark, sf))


# ---------------------------------------------------------------- features and model


def _training(spark, sf, threshold=features.PROFIT_THRESHOLD) -> DataFrame:
    registry = inputs.training_registry(spark, sf)
    if threshold == "median":
        # Read several times, and a stored table in a real run.
        registry = materialise(registry, "registry")
    return training.training_features(registry, threshold)


@register("high_profit_label", f"{o.TRAINING} SELECT corporate_id, profit, high_profit_label FROM features")
def high_profit_label(spark, sf):
    return _training(spark, sf).select("corporate_id", "profit", "high_profit_label")


@register(
    "median_threshold_label",
    f"""{o.TRAINING}, m AS (SELECT median(profit) AS threshold FROM features)
SELECT corporate_id, profit, CASE WHEN profit > threshold THEN 1 ELSE 0 END AS high_profit_label FROM features, m""",
)
def median_threshold_label(spark, sf):
    return _training(spark, sf, "median").select("corporate_id", "profit", "high_profit_label")


@register(
    "supplier_count_feature",
    f"""{o.TRAINING} SELECT corporate_id, top_suppliers, CAST(top_suppliers_count AS INTEGER) AS top_suppliers_count
FROM features""",
)
def supplier_count_feature(spark, sf):
    return _training(spark, sf).select("corporate_id", "top_suppliers", "top_suppliers_count")


@register(
    "profit_per_location",
    f"""{o.BASE} SELECT corporate_id, profit_margin, CASE WHEN activity_places <> 0 THEN profit / activity_places END
       AS avg_profit_per_location FROM harmonized""",
)
def profit_per_location(spark, sf):
    return features.profit_per_location(inputs.harmonized(spark, sf)).select(
        "corporate_id", "profit_margin", "avg_profit_per_location"
    )


@register(
    "source_index",
    f"""{o.TRAINING}, g AS (SELECT source_system, count(*) AS n FROM features GROUP BY source_system)
SELECT source_system, CAST(row_number() OVER (ORDER BY n DESC, source_system) - 1 AS DOUBLE) AS source_system_idx FROM g""",
)
def source_index(spark, sf):
    return ml.source_index(_training(spark, sf))


_SCALED = ", ".join(
    f"round(CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0 ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END, 4)"
    f" AS scaled_{c}"
    for c in ml.FEATURES
)


@register(
    "standard_scaling",
    f"""{o.TRAINING}, g AS (SELECT source_system, count(*) AS n FROM features GROUP BY source_system),
idx AS (SELECT source_system, CAST(row_number() OVER (ORDER BY n DESC, source_system) - 1 AS DOUBLE) AS source_system_idx FROM g),
f AS (SELECT corporate_id, revenue, profit_margin, activity_places, top_suppliers_count, source_system_idx
      FROM features JOIN idx USING (source_system))
SELECT corporate_id, {_SCALED} FROM f""",
)
def standard_scaling(spark, sf):
    scaled = ml.scaled_features(_training(spark, sf))
    # Adding zero turns a rounded -0.0 into 0.0.
    return scaled.select("corporate_id", *[(F.round(c, 4) + 0.0).alias(c) for c in scaled.columns[1:]])


@register(
    "hash_split",
    """SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < 3435973836
       THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def hash_split(spark, sf):
    return features.with_split(tables.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@register(
    "class_distribution",
    f"{o.TRAINING} SELECT high_profit_label, count(*) AS n FROM features GROUP BY high_profit_label",
)
def class_distribution(spark, sf):
    return analytics.class_distribution(_training(spark, sf))


@register(
    "training_statistics",
    f"""{o.TRAINING} SELECT count(*) AS total_records, count(*) FILTER (WHERE high_profit_label = 1) AS high_profit_count,
       count(*) FILTER (WHERE high_profit_label = 0) AS low_profit_count, round(avg(revenue), 2) AS avg_revenue,
       round(avg(profit), 2) AS avg_profit, round(stddev_samp(revenue), 2) AS stddev_revenue FROM features""",
)
def training_statistics(spark, sf):
    return analytics.training_statistics(_training(spark, sf))


_STATS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM features"
    for c in ("revenue", "profit_margin", "activity_places")
)


@register("feature_statistics", f"{o.TRAINING} {_STATS}")
def feature_statistics(spark, sf):
    return _rounded(analytics.feature_statistics(_training(spark, sf)), 6, "mean", "std")


@register(
    "label_distribution",
    f"""{o.TRAINING} SELECT high_profit_label AS label, count(*) AS n,
       CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 AS pct, count(*) OVER () < 2 AS single_class
FROM features GROUP BY high_profit_label""",
)
def label_distribution(spark, sf):
    return analytics.label_distribution(_training(spark, sf))


_ASSOCIATION = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) FILTER (WHERE high_profit_label = 1) AS h, "
    f"avg({c}) FILTER (WHERE high_profit_label = 0) AS l FROM features"
    for c in ("profit", "profit_margin")
)


@register(
    "feature_label_association",
    f"""{o.TRAINING}, a AS ({_ASSOCIATION})
SELECT feature, round(h, 6) AS mean_high, round(l, 6) AS mean_low, coalesce(h > l, false) AS associated FROM a""",
)
def feature_label_association(spark, sf):
    return _rounded(analytics.feature_label_association(_training(spark, sf)), 6, "mean_high", "mean_low")


@register("distinct_states", f"{o.BASE} SELECT DISTINCT state FROM harmonized")
def distinct_states(spark, sf):
    return analytics.distinct_values(inputs.harmonized(spark, sf), "state")


@register("missing_value_filter", f"{o.BASE} SELECT * FROM unioned WHERE activity_places IS NOT NULL")
def missing_value_filter(spark, sf):
    return features.drop_missing(harm.union_sources(*inputs.sources(spark, sf)), ["activity_places"])


@register(
    "auc_exact",
    f"""WITH {o.SCORED}, t AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM scored GROUP BY score),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM t)
SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
       round(CAST(sum(below * pos + CAST(pos * neg AS DOUBLE) / 2) AS DOUBLE) / (sum(pos) * sum(neg)), 10) AS auc FROM c""",
)
def auc_exact(spark, sf):
    return _rounded(metrics.auc_exact(inputs.all_documents(spark, sf), "score", "label", "doc_id"), 10, "auc")


@register(
    "f1_binary",
    f"{o.CONFUSION} SELECT tp, fp, fn, tn, round(2.0 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 10) AS f1 FROM c",
)
def f1_binary(spark, sf):
    return _rounded(metrics.f1_binary(inputs.quality_labels(spark, sf), "prediction", "label"), 10, "f1")


@register(
    "f1_weighted",
    f"""{o.CONFUSION} SELECT tp, fp, fn, tn,
       round(((2.0 * tp / CAST(2 * tp + fp + fn AS DOUBLE)) * (tp + fn) + (2.0 * tn / CAST(2 * tn + fn + fp AS DOUBLE)) * (tn + fp))
       / CAST(tp + fp + fn + tn AS DOUBLE), 10) AS f1 FROM c""",
)
def f1_weighted(spark, sf):
    return _rounded(metrics.f1_weighted(inputs.quality_labels(spark, sf), "prediction", "label"), 10, "f1")


def _fitted(spark, sf):
    rows = materialise(_training(spark, sf, "median"), "training")
    return rows, ml.fit(rows)


@register("lr_predictions")
def lr_predictions(spark, sf):
    rows, model = _fitted(spark, sf)
    return lr_predictions_of(model, rows)


@register("feature_importance")
def feature_importance(spark, sf):
    rows, model = _fitted(spark, sf)
    return ml.feature_importance(model, rows)


_SIDE = "CAST('0x' || substr(md5(corporate_id), 1, 8) AS BIGINT) < 3435973836"


@register(
    "lr_checks",
    f"""{o.TRAINING}, m AS (SELECT median(profit) AS threshold FROM features),
split AS (SELECT corporate_id, profit > threshold AS high, {_SIDE} AS training FROM features, m)
SELECT count(*) FILTER (WHERE NOT training) AS predictions, count(*) FILTER (WHERE NOT training) AS valid_probabilities,
       count(*) FILTER (WHERE NOT training) AS valid_confidences, count(*) FILTER (WHERE NOT training) AS valid_classes,
       count(*) FILTER (WHERE NOT training AND high) AS positives, true AS auc_above_bound,
       CAST(5 AS BIGINT) AS features, true AS importance_not_negative, 'revenue' AS most_important FROM split""",
)
def lr_checks(spark, sf):
    """What must hold of any fit: how many rows are scored, what a score may be, how well it ranks."""
    rows, model = _fitted(spark, sf)
    testing = features.hash_split(rows, "corporate_id")[1].select("corporate_id", features.LABEL)
    scored = materialise(lr_predictions_of(model, rows).join(testing, "corporate_id"), "scored")
    p, confidence, chosen = F.col("prediction_probability"), F.col("confidence"), F.col("predicted_class")
    auc = metrics.auc_exact(scored, "prediction_probability", features.LABEL, "corporate_id")
    counted = scored.agg(
        F.count("*").alias("predictions"),
        F.count_if(p.between(0, 1)).alias("valid_probabilities"),
        F.count_if(F.abs(confidence - F.greatest(p, 1 - p)) < 1e-9).alias("valid_confidences"),
        F.count_if(chosen == F.when(p > 0.5, 1).otherwise(0)).alias("valid_classes"),
    )
    importance = ml.feature_importance(model, rows).agg(
        F.count("*").alias("features"),
        (F.min("importance") >= 0).alias("importance_not_negative"),
        F.max_by("feature", "importance").alias("most_important"),
    )
    judged = auc.select("positives", (F.col("auc") > 0.9).alias("auc_above_bound"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    return one(counted).join(one(judged), "_one").join(one(importance), "_one").drop("_one")


def lr_predictions_of(model, rows: DataFrame) -> DataFrame:
    return ml.score(model, features.hash_split(rows, "corporate_id")[1], "2025-12-17T10:00:00")


# ---------------------------------------------------------------- run logs


@register("log_metrics", f"WITH {o.LOG} SELECT * FROM log_metrics")
def log_metrics(spark, sf):
    return runlog.log_metrics(tables.job_log(spark, sf))


@register(
    "latest_run_summary",
    f"""WITH {o.LOG}, {o.RUNS},
recent AS (SELECT * FROM runs ORDER BY started_on DESC, run_id LIMIT 10),
good AS (SELECT * FROM recent JOIN log_metrics ON run_id = job_run_id WHERE state = 'SUCCEEDED' AND auc IS NOT NULL AND auc <> 0)
SELECT job_run_id, strftime(started_on, '%Y-%m-%d %H:%M') AS started_on, auc, f1_score, total_records, high_profit,
       CAST(high_profit AS DOUBLE) / CAST(total_records AS DOUBLE) * 100 AS high_profit_pct, low_profit,
       CAST(low_profit AS DOUBLE) / CAST(total_records AS DOUBLE) * 100 AS low_profit_pct,
       date_sub('second', good.started_on, ended_on) AS execution_time, mlflow_run_id
FROM good ORDER BY good.started_on DESC, job_run_id LIMIT 1""",
)
def latest_run_summary(spark, sf):
    return runlog.latest_run_summary(inputs.runs(spark, sf), tables.job_log(spark, sf))


# ---------------------------------------------------------------- streaming


@register("incremental_ingest", f"{o.BASE} SELECT corporate_id, {o.DATA} FROM ({o.staging('harmonized', 2025, 12)})")
def incremental_ingest(spark, sf):
    """All items arrive as files that the stream picks up batch by batch."""
    items = _items(spark, sf)
    landing = scratch_path(spark, "landing")
    # More items are more files, not larger ones; the stream takes half of them at a time.
    files = max(4, math.ceil(items.count() / inputs.LANDED_ROWS))
    items.repartition(files, "order_id").write.parquet(landing)
    store = RegistryStore(spark, scratch_path(spark, "registry"), inputs.REGISTRY_BUCKETS)
    RegistryIngest(
        spark,
        landing,
        items.schema,
        _sellers(spark, sf),
        store,
        scratch_path(spark, "state"),
        scratch_path(spark, "stream"),
        buckets=inputs.REGISTRY_BUCKETS,
    ).run(files_per_batch=math.ceil(files / 2))
    return store.read().select("corporate_id", *o.DATA.split(", "))
