"""Plain SQL statements of the registered queries, for checking in another engine."""

from __future__ import annotations

from meldstone.operators.prepare import FINANCIAL_SUMMARY, SUPPLY_SUMMARY

CLEANSE = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', ' ', 'g'))"


def cleanse(expression: str) -> str:
    return CLEANSE.format(expression)


SELLERS = """sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS seller_name, n_name AS seller_city,
         upper(substr(r_name, 1, 2)) AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

ITEMS = """items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,4)) AS freight_value
  FROM lineitem)"""

PAYMENTS = """payments AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
         l_returnflag AS payment_type, 1 AS payment_installments,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
              * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS payment_value
  FROM lineitem)"""

COMPANIES = """companies AS (
  SELECT c_custkey AS id, c_name AS name, n_name || '|' || upper(substr(r_name, 1, 2)) AS block_key, n_name AS city,
         upper(substr(r_name, 1, 2)) AS state, c_mktsegment AS market, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def merged(p: str, unioned: str) -> str:
    """Common table expressions from unioned rows to <p>harmonized."""
    return f"""{p}merged AS (
  SELECT corporate_id,
         {', '.join(f"first({c} ORDER BY source_system DESC, seller_id) FILTER (WHERE {c} IS NOT NULL) AS {c}"
                    for c in ("corporate_name", "address", "city", "state", "top_suppliers", "main_customers"))},
         max(activity_places) AS activity_places, max(revenue) AS revenue, max(profit) AS profit,
         max(transaction_count) AS transaction_count,
         string_agg(DISTINCT source_system, ',' ORDER BY source_system) AS source_system
  FROM {unioned} GROUP BY corporate_id),
{p}harmonized AS (
  SELECT corporate_id, corporate_name, address, city, state, activity_places, top_suppliers, main_customers,
         revenue, profit, transaction_count, source_system,
         CASE WHEN revenue > 0 THEN profit / revenue ELSE 0.0 END AS profit_margin FROM {p}merged)"""


def harmonized(prefix: str = "", sellers: str = "sellers", items: str = "items") -> str:
    """Common table expressions ending in <prefix>harmonized."""
    p = prefix
    return f"""
{p}pairs AS (SELECT DISTINCT seller_id, product_id FROM {items}),
{p}ranked AS (
  SELECT seller_id, product_id, row_number() OVER (PARTITION BY seller_id ORDER BY product_id) AS rn,
         count(*) OVER (PARTITION BY seller_id) AS n FROM {p}pairs),
{p}breadth AS (
  SELECT seller_id, CAST(max(n) AS INTEGER) AS activity_places,
         string_agg(product_id, ',' ORDER BY product_id) FILTER (WHERE rn <= 10) AS top_suppliers
  FROM {p}ranked GROUP BY seller_id),
{p}supply AS (
  SELECT s.seller_id, 'Seller_' || s.seller_id AS seller_name, seller_city AS city, seller_state AS state,
         activity_places, top_suppliers, lower('Seller_' || s.seller_id) AS canonical_name,
         concat_ws(', ', seller_city, seller_state) AS address, 'supply_chain' AS source_system
  FROM {sellers} s LEFT JOIN {p}breadth b ON s.seller_id = b.seller_id),
{p}financial AS (
  SELECT f.seller_id, revenue, transaction_count, revenue * CAST(0.18 AS DOUBLE) AS profit,
         'financial' AS source_system, city, state
  FROM (SELECT seller_id, CAST(sum(price + freight_value) AS DOUBLE) AS revenue,
               CAST(count(DISTINCT order_id) AS INTEGER) AS transaction_count
        FROM {items} GROUP BY seller_id) f
  LEFT JOIN {p}supply s ON f.seller_id = s.seller_id),
{p}keyed AS (
  SELECT *, {cleanse('canonical_name')} AS clean_name,
         substr(sha256({cleanse('canonical_name')} || '|' || {cleanse('address')}), 1, 16) AS corporate_id
  FROM {p}supply),
{p}unioned AS (
  SELECT seller_id, corporate_id, clean_name AS corporate_name, address, city, state, activity_places,
         top_suppliers, CAST(NULL AS VARCHAR) AS main_customers, CAST(NULL AS DOUBLE) AS revenue,
         CAST(NULL AS DOUBLE) AS profit, CAST(NULL AS INTEGER) AS transaction_count,
         'supply_chain' AS source_system FROM {p}keyed
  UNION ALL
  SELECT f.seller_id, k.corporate_id, {cleanse("'seller ' || f.seller_id")}, k.address, k.city, k.state,
         NULL, NULL, NULL, f.revenue, f.profit, f.transaction_count, 'financial'
  FROM {p}financial f LEFT JOIN {p}keyed k ON f.seller_id = k.seller_id),
{merged(p, p + 'unioned')}"""


BASE = f"WITH {SELLERS}, {ITEMS},{harmonized()}"

DATA = (
    "corporate_name, address, city, state, activity_places, top_suppliers, main_customers, revenue, profit, "
    "source_system"
)


def staging(source: str, year: int, month: int) -> str:
    return f"""SELECT corporate_id, corporate_name, address, city, state, activity_places, top_suppliers,
       main_customers, CAST(revenue AS DECIMAL(18,2)) AS revenue, CAST(profit AS DECIMAL(18,2)) AS profit,
       source_system, '1.0' AS _data_contract_version, {year} AS year, {month} AS month FROM {source}"""


_MERGED_COLUMNS = ", ".join(f"coalesce(s.{c.strip()}, t.{c.strip()}) AS {c.strip()}" for c in DATA.split(","))
LOADS = f"""WITH {SELLERS}, {ITEMS},
items_1 AS (SELECT * FROM items WHERE coalesce(shipping_limit_date < TIMESTAMP '1998-06-01', false)),
items_2 AS (
  SELECT * FROM items WHERE NOT coalesce(shipping_limit_date < TIMESTAMP '1998-06-01', false)
  UNION ALL
  SELECT 'e' || event_id, 1, 'p' || user_id, 'u' || user_id, ts, CAST(value AS DECIMAL(12,2)), CAST(0 AS DECIMAL(16,4))
  FROM events WHERE event_type = 'purchase'),
{harmonized('a_', 'sellers', 'items_1')},
{harmonized('b_', 'sellers', 'items_2')},
staged_1 AS ({staging('a_harmonized', 2025, 11)}),
staged_2 AS ({staging('b_harmonized', 2025, 12)}),
version_1 AS (SELECT * FROM staged_1 WHERE corporate_id IS NOT NULL),
version_2 AS (
  SELECT coalesce(s.corporate_id, t.corporate_id) AS corporate_id, {_MERGED_COLUMNS},
         CASE WHEN s.corporate_id IS NOT NULL THEN s._data_contract_version ELSE t._data_contract_version END
           AS _data_contract_version,
         CASE WHEN s.corporate_id IS NOT NULL THEN s.year ELSE t.year END AS year,
         CASE WHEN s.corporate_id IS NOT NULL THEN s.month ELSE t.month END AS month
  FROM version_1 t FULL OUTER JOIN (SELECT * FROM staged_2 WHERE corporate_id IS NOT NULL) s
    ON t.corporate_id = s.corporate_id)"""

VERSION_COLUMNS = f"corporate_id, {DATA}, _data_contract_version, year, month"

HASH_COLUMNS = (
    "corporate_id corporate_name address city state activity_places top_suppliers main_customers revenue profit "
    "source_system"
).split()


def row_hash() -> str:
    parts = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in HASH_COLUMNS)
    return f"sha256({parts})"


PAID = f"""{PAYMENTS}, totals AS (
  SELECT order_id, payment_type, CAST(sum(payment_value) AS DECIMAL(18,2)) AS revenue
  FROM payments GROUP BY order_id, payment_type)"""

PAYMENT_SUMMARY = f"""{PAID}, summary AS (
  SELECT row_number() OVER (ORDER BY order_id, payment_type) AS corporate_id,
         'Order_' || order_id AS corporate_name, CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city,
         CAST(NULL AS VARCHAR) AS state, 1 AS activity_places, CAST(NULL AS VARCHAR) AS top_suppliers,
         payment_type AS main_customers, revenue,
         CAST(revenue * CAST(0.15 AS DECIMAL(6,4)) AS DECIMAL(18,2)) AS profit,
         '{FINANCIAL_SUMMARY}' AS source_system, DATE '2025-12-17' AS load_date FROM totals)"""

SELLER_SUMMARY = f"""seller_summary AS (
  SELECT i.seller_id AS corporate_id, s.seller_city AS corporate_name,
         s.seller_city || ', ' || s.seller_state AS address, s.seller_city AS city, s.seller_state AS state,
         1 AS activity_places, count(DISTINCT i.product_id) AS n_products,
         CAST(NULL AS VARCHAR) AS main_customers, CAST(sum(i.price) AS DECIMAL(18,2)) AS revenue,
         CAST(CAST(sum(i.price) AS DECIMAL(18,2)) * CAST(0.2 AS DECIMAL(6,4)) AS DECIMAL(18,2)) AS profit,
         '{SUPPLY_SUMMARY}' AS source_system, DATE '2025-12-17' AS load_date
  FROM items i LEFT JOIN sellers s ON i.seller_id = s.seller_id GROUP BY i.seller_id, s.seller_city, s.seller_state)"""

ITEM_SUPPLY = """item_supply AS (
  SELECT i.seller_id AS corporate_id, seller_city AS corporate_name, seller_city AS address, seller_state AS state,
         1 AS activity_places, product_id AS top_suppliers, CAST(NULL AS VARCHAR) AS main_customers,
         CAST(price AS DOUBLE) AS revenue, 0 AS profit, 'supply_chain' AS source_system
  FROM items i LEFT JOIN sellers s ON i.seller_id = s.seller_id)"""

ORDER_FINANCIAL = """order_financial AS (
  SELECT order_id AS corporate_id, 'Financial Entity' AS corporate_name, CAST(NULL AS VARCHAR) AS address,
         CAST(NULL AS VARCHAR) AS state, CAST(NULL AS INTEGER) AS activity_places,
         CAST(NULL AS VARCHAR) AS top_suppliers, 'unknown' AS main_customers, revenue, revenue AS profit,
         'financial' AS source_system
  FROM (SELECT order_id, CAST(sum(payment_value) AS DOUBLE) AS revenue FROM payments GROUP BY order_id))"""

TRAINING = f"""{BASE}, {PAID}, training AS (
  SELECT corporate_id, CAST(CAST(revenue AS DECIMAL(18,2)) AS DOUBLE) AS revenue,
         CAST(CAST(profit AS DECIMAL(18,2)) AS DOUBLE) AS profit, activity_places,
         coalesce(top_suppliers, '') AS top_suppliers, coalesce(source_system, '') AS source_system
  FROM harmonized WHERE revenue IS NOT NULL AND profit IS NOT NULL
  UNION ALL
  SELECT order_id || '-' || payment_type, CAST(revenue AS DOUBLE),
         CAST(CAST(revenue * CAST(0.15 AS DECIMAL(6,4)) AS DECIMAL(18,2)) AS DOUBLE), 1, '', '{FINANCIAL_SUMMARY}'
  FROM totals),
labelled AS (SELECT *, CASE WHEN profit > 180.0 THEN 1 ELSE 0 END AS high_profit_label FROM training),
features AS (
  SELECT *, CASE WHEN revenue > 0 THEN profit / revenue ELSE 0.0 END AS profit_margin,
         CASE WHEN length(trim(top_suppliers)) = 0 THEN 0
              ELSE len(string_split(top_suppliers, ',')) END AS top_suppliers_count FROM labelled)"""

def matches(records: str) -> str:
    """Common table expressions from ``records`` (id, block_key, name) to all matching pairs."""
    return f"""named AS (SELECT id, block_key, {cleanse('name')} AS name FROM {records}),
reps AS (SELECT block_key, name, min(id) AS id FROM named GROUP BY block_key, name),
matches AS (
  SELECT a.id AS id_a, b.id AS id_b, CAST(levenshtein(a.name, b.name) AS INTEGER) AS distance,
         1 - CAST(levenshtein(a.name, b.name) AS DOUBLE) / CAST(greatest(length(a.name), length(b.name)) AS DOUBLE)
           AS similarity
  FROM reps a JOIN reps b ON a.block_key = b.block_key AND a.id < b.id
  WHERE levenshtein(a.name, b.name) * 20 <= 3 * greatest(length(a.name), length(b.name))
  UNION ALL
  SELECT r.id, n.id, 0, 1.0 FROM named n JOIN reps r ON n.block_key = r.block_key AND n.name = r.name AND n.id <> r.id)"""


def evident() -> str:
    """Common table expressions from reps and matches to those matches that the evidence rule accepts."""

    def lacking(side: str, other: str) -> str:
        return f"""SELECT p.id_a, p.id_b, '{side}' AS side, t.token, min(t.pos) AS pos, min(h.n) AS n
  FROM matches p JOIN tok t ON t.id = p.id_{side} JOIN held h ON h.block_key = t.block_key AND h.token = t.token
  WHERE p.distance > 0 AND NOT EXISTS (SELECT 1 FROM tok u WHERE u.id = p.id_{other} AND u.token = t.token)
  GROUP BY p.id_a, p.id_b, t.token"""

    return f"""tok AS (
  SELECT block_key, id, unnest(string_split(name, ' ')) AS token, generate_subscripts(string_split(name, ' '), 1) AS pos FROM reps),
held AS (SELECT block_key, token, count(DISTINCT id) AS n FROM tok GROUP BY block_key, token),
odd AS ({lacking('a', 'b')} UNION ALL {lacking('b', 'a')}),
judged AS (
  SELECT id_a, id_b, string_agg(token, ' ' ORDER BY pos) FILTER (WHERE side = 'a') AS rest_a,
         string_agg(token, ' ' ORDER BY pos) FILTER (WHERE side = 'b') AS rest_b, min(n) FILTER (WHERE side = 'a') AS n_a,
         min(n) FILTER (WHERE side = 'b') AS n_b, bool_or(regexp_matches(token, '[0-9]')) AS numbered
  FROM odd GROUP BY id_a, id_b),
evident AS (
  SELECT m.* FROM matches m LEFT JOIN judged j ON m.id_a = j.id_a AND m.id_b = j.id_b
  WHERE j.id_a IS NULL
     OR (NOT numbered AND levenshtein(rest_a, rest_b) <= greatest(length(rest_a), length(rest_b)) / 4.0
         AND (n_a = 1 OR n_b = 1 OR n_a >= 5 * n_b OR n_b >= 5 * n_a)))"""


SHOPS = """shops AS (
  SELECT p_partkey AS id, p_brand AS block_key,
         CASE p_partkey % 5 WHEN 1 THEN substr(p_name, 1, 2) || substr(p_name, 4)
                            WHEN 2 THEN p_name || ' branch ' || CAST(p_size AS VARCHAR) ELSE p_name END
         || ' ' || p_type || ' trading works' AS name FROM part)"""

MATCHES = f"{COMPANIES},\n{matches('companies')}"
EVERY_MATCH = f"""{COMPANIES},
named AS (SELECT DISTINCT id, block_key, {cleanse('name')} AS name FROM companies),
matches AS (
  SELECT a.id AS id_a, b.id AS id_b, CAST(levenshtein(a.name, b.name) AS INTEGER) AS distance,
         CASE WHEN a.name = b.name THEN 1.0
              ELSE 1 - CAST(levenshtein(a.name, b.name) AS DOUBLE) / CAST(greatest(length(a.name), length(b.name)) AS DOUBLE)
         END AS similarity
  FROM named a JOIN named b ON a.block_key = b.block_key AND a.id < b.id
  WHERE levenshtein(a.name, b.name) * 20 <= 3 * greatest(length(a.name), length(b.name)))"""
LONG_MATCHES = f"""{COMPANIES},
long_names AS (SELECT id, block_key, name || ' ' || market || ' trading company of ' || city AS name FROM companies),
{matches('long_names')}"""

ACCOUNTS = f"""{COMPANIES}, accounts AS (
  SELECT CAST(id AS VARCHAR) AS corporate_id, balance AS revenue,
         balance * CASE WHEN market = 'MACHINERY' THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.18 AS DOUBLE) END AS profit,
         CAST(0.18 AS DOUBLE) AS profit_margin, market,
         CASE WHEN market = 'FURNITURE' THEN city ELSE state END AS state, 1 AS activity_places,
         o.n AS transaction_count, ascii(state) AS state_code
  FROM companies LEFT JOIN (SELECT o_custkey, CAST(count(*) AS INTEGER) AS n FROM orders GROUP BY o_custkey) o
    ON id = o.o_custkey)"""

PREPARED_VIOLATIONS = """broken AS (
  SELECT corporate_id,
         CASE WHEN revenue IS NULL THEN 'required' WHEN revenue < 0 THEN 'minimum' END AS revenue_rule,
         CASE WHEN length(state) <> 2 THEN 'length' END AS state_rule,
         CASE WHEN transaction_count IS NULL THEN 'required' WHEN transaction_count < 0 THEN 'minimum' END
           AS transactions_rule,
         revenue, profit, profit_margin FROM accounts),
violations AS (
  SELECT corporate_id, 'revenue' AS field, revenue_rule AS rule FROM broken WHERE revenue_rule IS NOT NULL
  UNION ALL SELECT corporate_id, 'state', state_rule FROM broken WHERE state_rule IS NOT NULL
  UNION ALL SELECT corporate_id, 'transaction_count', transactions_rule FROM broken WHERE transactions_rule IS NOT NULL
  UNION ALL SELECT corporate_id, 'profit_margin', 'margin_consistent' FROM broken
  WHERE revenue_rule IS NULL AND revenue > 0 AND abs(profit_margin - profit / revenue) > 0.01)"""

LOG = """job_log AS (
  SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id, event_id AS seq, ts,
         CASE event_type
           WHEN 'purchase' THEN '  - AUC: ' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
           WHEN 'click' THEN '  - F1-Score: ' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
           WHEN 'view' THEN '|total_records|high_profit_count|low_profit_count|' || chr(10) || '|' ||
             CAST(event_id + user_id + 1 AS VARCHAR) || ' |' || CAST(event_id AS VARCHAR) || ' |' ||
             CAST(user_id + 1 AS VARCHAR) || ' |'
           WHEN 'signup' THEN 'MLflow run ID: ' || md5(CAST(event_id AS VARCHAR))
           ELSE 'Could not set option: ' || props END AS message
  FROM events),
log_metrics AS (
  SELECT run_id AS job_run_id, strftime(arg_min(ts, seq), '%Y-%m-%d %H:%M:%S') AS timestamp,
         CAST(arg_max(regexp_extract(message, 'AUC:\\s+([\\d.]+)', 1), seq)
           FILTER (WHERE regexp_matches(message, 'AUC:\\s+([\\d.]+)')) AS DOUBLE) AS auc,
         CAST(arg_max(regexp_extract(message, 'F1-Score:\\s+([\\d.]+)', 1), seq)
           FILTER (WHERE regexp_matches(message, 'F1-Score:\\s+([\\d.]+)')) AS DOUBLE) AS f1_score,
         CAST(arg_max(regexp_extract(message, '\\|(\\d+)\\s+\\|(\\d+)\\s+\\|(\\d+)', 1), seq)
           FILTER (WHERE message LIKE '%total_records%') AS BIGINT) AS total_records,
         CAST(arg_max(regexp_extract(message, '\\|(\\d+)\\s+\\|(\\d+)\\s+\\|(\\d+)', 2), seq)
           FILTER (WHERE message LIKE '%total_records%') AS BIGINT) AS high_profit,
         CAST(arg_max(regexp_extract(message, '\\|(\\d+)\\s+\\|(\\d+)\\s+\\|(\\d+)', 3), seq)
           FILTER (WHERE message LIKE '%total_records%') AS BIGINT) AS low_profit,
         arg_max(regexp_extract(message, '[Rr]un ID:\\s+([a-f0-9]+)', 1), seq)
           FILTER (WHERE message LIKE '%MLflow run ID:%') AS mlflow_run_id
  FROM job_log GROUP BY run_id)"""

RUNS = """runs AS (
  SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id,
         CASE WHEN arg_max(event_type, event_id) = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
         min(ts) AS started_on, max(ts) AS ended_on FROM events GROUP BY user_id)"""

SCORED = """scored AS (
  SELECT l.doc_id, quality AS label, CAST(n_chars AS DOUBLE) AS score,
         CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

CONFUSION = f"""WITH {SCORED}, c AS (
  SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM scored)"""

NULL_COUNTS_COLUMNS = (
    "corporate_id corporate_name address city state activity_places top_suppliers main_customers revenue profit "
    "transaction_count source_system profit_margin"
).split()
NULL_COUNTS = BASE + ", counts AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS total_records FROM harmonized"
    for c in NULL_COUNTS_COLUMNS
) + ")"


def tier(columns: list[str], source: str, name: str) -> str:
    missing = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)
    listed = ", ".join(columns)
    passed = {
        "bronze": "total_records > 0",
        "silver": "null_pct < 5 AND dup_pct < 1",
        "gold": "null_pct = 0 AND dup_pct = 0",
    }[name]
    score = "CAST(0.5 AS DOUBLE)" if name == "bronze" else "greatest(0.0, 100 - null_pct - dup_pct) / 100"
    return f"""m AS (SELECT count(*) AS total_records, CAST({missing} AS BIGINT) AS missing_total FROM {source}),
d AS (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_count
      FROM (SELECT count(*) AS n FROM {source} GROUP BY {listed})),
p AS (SELECT *, CAST(missing_total AS DOUBLE) / CAST(total_records * {len(columns)} AS DOUBLE) * 100 AS null_pct,
             CAST(duplicate_count AS DOUBLE) / CAST(total_records AS DOUBLE) * 100 AS dup_pct FROM m, d)
SELECT '{name}' AS tier, total_records, missing_total, duplicate_count, {len(columns)} AS column_count,
       round({score}, 10) AS quality_score, {passed} AS passed FROM p"""
