"""The same queries in DuckDB SQL, written from the definitions.

Rounding: Spark rounds the decimal text of a double, so the SQL goes through text,
too.  Totals: exact decimals on both sides, shown as doubles.
"""

from __future__ import annotations

SQL: dict[str, str] = {}


def m2(x: str) -> str:
    """Two decimals, halves away from zero, of a double."""
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(18,2)) AS DOUBLE)"


def total(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"{total(x)} / COUNT({x})"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part} / {whole} * 100 ELSE 0 END"


TX = """tx AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS transaction_date,
         CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice / l_quantity AS unit_price,
         l_extendedprice AS total_amount, l_extendedprice * l_discount AS discount,
         l_extendedprice - l_extendedprice * l_discount AS final_amount,
         o_orderpriority AS payment_method,
         CASE o_orderstatus WHEN 'F' THEN '  completed' WHEN 'O' THEN 'Pending ' ELSE 'cancelled' END AS status,
         l_returnflag AS shipping_address, l_shipdate AS ingestion_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FLAWED = f"""{TX},
bad AS (
  SELECT * REPLACE (
    CASE WHEN shipping_address <> 'N' THEN customer_id END AS customer_id,
    final_amount - 10000 AS final_amount,
    CAST(NULLIF(quantity - 5, 20) AS DOUBLE) AS quantity) FROM tx)"""

# Standardised transactions, from a relation named in the braces.
SILVER_OF = f"""SELECT * REPLACE (
    upper(trim(status)) AS status,
    {m2('final_amount')} AS final_amount, {m2('total_amount')} AS total_amount, {m2('discount')} AS discount),
    {m2('final_amount - unit_price * quantity * CAST(0.6 AS DOUBLE)')} AS profit,
    {pct('discount', 'total_amount')} AS discount_percentage,
    try_strptime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp
  FROM {{0}}"""

SILVER = f"{TX},\nsilver AS ({SILVER_OF.format('tx')}),\nsales AS (SELECT * FROM silver WHERE status = 'COMPLETED')"

CUSTOMERS = """customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, upper(c_name) AS customer_name,
         lower(c_name || '@example.com') AS email, upper(c_mktsegment) AS segment,
         '2024-01-01' AS registration_date, upper(n_name) AS country, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

PRODUCTS = f"""products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, trim(p_name) AS product_name, upper(trim(p_type)) AS category,
         {m2('p_retailprice')} AS price, {m2('p_retailprice * CAST(0.61 AS DOUBLE)')} AS cost,
         p_size AS stock_quantity,
         {m2(pct('(p_retailprice - p_retailprice * CAST(0.61 AS DOUBLE))', 'p_retailprice'))} AS profit_margin
  FROM part)"""

NEWEST = ("row_number() OVER (PARTITION BY transaction_id ORDER BY ingestion_timestamp DESC NULLS LAST, "
          "product_id NULLS FIRST, quantity NULLS FIRST, total_amount NULLS FIRST, discount NULLS FIRST)")

# -- bronze ---------------------------------------------------------------------

SQL["bronze_enrich"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
       CASE WHEN o_orderstatus = 'P' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS transaction_date,
       TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp, 'orders' AS source_file,
       'ecommerce' AS data_source, DATE '2024-01-01' AS ingestion_date,
       CASE WHEN o_orderstatus <> 'P' THEN date_trunc('second', o_orderdate) END AS transaction_timestamp
FROM orders"""

SQL["raw_csv_scan"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, ' ' || p_name || ' ' AS product_name,
       lower(p_type) || ' ' AS category, p_retailprice AS price,
       p_retailprice * CAST(0.61 AS DOUBLE) AS cost,
       CASE WHEN p_size <= 10 THEN CAST(p_size AS DOUBLE) END AS stock_quantity
FROM part"""

SQL["json_parse"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"""

_VALUE = """'{"transaction_id":"' || event_id || '","customer_id":"' || user_id || '","transaction_date":"'
  || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","final_amount":' || CAST(value AS VARCHAR) || ',"status":"' || event_type || '"}'"""
SQL["json_malformed"] = f"""
WITH m AS (SELECT ts, user_id, {_VALUE} AS v FROM events)
SELECT ts AS timestamp, CAST(user_id AS VARCHAR) AS key,
       CASE WHEN length(v) % 3 = 0 THEN substr(v, 1, 30) ELSE '' END AS value_text FROM m"""

SQL["event_decode"] = """
SELECT CAST(user_id AS VARCHAR) AS kafka_key, CAST(event_id AS VARCHAR) AS transaction_id,
       CAST(user_id AS VARCHAR) AS customer_id, date_trunc('second', ts) AS transaction_timestamp,
       value AS final_amount, event_type AS status
FROM events"""

# -- silver ---------------------------------------------------------------------

SQL["silver_transactions"] = f"WITH {TX}\n{SILVER_OF.format('tx')}"
SQL["silver_customers"] = f"WITH {CUSTOMERS}\nSELECT * FROM customers"
SQL["silver_products"] = f"WITH {PRODUCTS}\nSELECT * FROM products"

_MISSING = "transaction_id IS NULL OR customer_id IS NULL OR quantity IS NULL"
SQL["dq_nulls_valid"] = f"WITH {FLAWED}\nSELECT * FROM bad WHERE NOT ({_MISSING})"
SQL["dq_nulls_invalid"] = f"WITH {FLAWED}\nSELECT * FROM bad WHERE {_MISSING}"
SQL["dq_dedup"] = f"WITH {TX}\nSELECT * FROM tx QUALIFY {NEWEST} = 1"
SQL["dq_duplicates"] = f"WITH {TX}\nSELECT * FROM tx QUALIFY {NEWEST} > 1"
SQL["dq_range_valid"] = f"WITH {FLAWED}\nSELECT * FROM bad WHERE quantity BETWEEN 1 AND 30"
SQL["dq_range_invalid"] = (
    f"WITH {FLAWED}\nSELECT * FROM bad WHERE quantity IS NULL OR quantity < 1 OR quantity > 30")
SQL["dq_range_strict"] = f"""WITH {FLAWED}
SELECT CASE WHEN quantity >= 1 THEN 'accepted' ELSE 'rejected' END AS side, COUNT(*) AS row_count
FROM bad WHERE quantity IS NOT NULL GROUP BY 1"""
_SOLVENT = "SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal >= 0"
_SIZEABLE = "SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 5"
SQL["dq_fk_valid"] = f"WITH {TX}\nSELECT * FROM tx WHERE customer_id IN ({_SOLVENT})"
SQL["dq_fk_invalid"] = f"WITH {TX}\nSELECT * FROM tx WHERE customer_id NOT IN ({_SOLVENT})"
SQL["dq_type"] = """
WITH t AS (
  SELECT o_orderkey, substr(o_orderpriority, 1, 2) AS level,
         regexp_replace(o_orderpriority, '-.*', '') AS digits FROM orders),
v AS (
  SELECT *, CASE WHEN digits IS NOT NULL AND NOT regexp_full_match(digits, '[0-9]+') THEN 'digits is not a valid int'
                 WHEN level IS NOT NULL AND NOT regexp_full_match(level, '-?[0-9]+') THEN 'level is not a valid int'
            END AS error_message FROM t)
SELECT o_orderkey, level, digits,
       CASE WHEN error_message IS NULL THEN 'PASSED' ELSE 'FAILED' END AS validation_status, error_message
FROM v"""

TAGGED = f"""{FLAWED},
ranked AS (
  SELECT *, (transaction_id IS NULL OR customer_id IS NULL OR product_id IS NULL OR final_amount IS NULL) AS missing
  FROM bad),
numbered AS (
  SELECT *, {NEWEST.replace('PARTITION BY transaction_id', 'PARTITION BY missing, transaction_id')} AS n FROM ranked),
judged AS (
  SELECT * EXCLUDE (missing, n), CASE
      WHEN missing THEN 'Null values in required fields'
      WHEN n > 1 THEN 'Duplicate transaction_id'
      WHEN final_amount < 0 THEN 'final_amount must be >= 0'
      WHEN quantity < 1 THEN 'quantity must be >= 1'
      WHEN quantity IS NULL THEN 'quantity is null'
      WHEN customer_id NOT IN ({_SOLVENT}) THEN 'Invalid customer_id'
      WHEN product_id NOT IN ({_SIZEABLE}) THEN 'Invalid product_id' END AS error_message
  FROM numbered),
tagged AS (
  SELECT *, CASE WHEN error_message IS NULL THEN 'PASSED' ELSE 'FAILED' END AS validation_status FROM judged)"""

SQL["validate_transactions_valid"] = f"WITH {TAGGED}\nSELECT * FROM tagged WHERE error_message IS NULL"
SQL["validate_transactions_quarantine"] = f"WITH {TAGGED}\nSELECT * FROM tagged WHERE error_message IS NOT NULL"
SQL["validate_transactions_counts"] = f"""WITH {TAGGED}
SELECT validation_status, error_message, COUNT(*) AS row_count FROM tagged GROUP BY ALL"""

SQL["validate_customers"] = """
WITH seen AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderkey AS VARCHAR) AS customer_name,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS email, o_orderdate AS ingestion_timestamp
  FROM orders),
n AS (
  SELECT *, row_number() OVER (PARTITION BY email IS NULL, customer_id
                               ORDER BY ingestion_timestamp DESC, customer_name) AS n FROM seen),
v AS (
  SELECT * EXCLUDE (n), CASE WHEN email IS NULL THEN 'Null values in required fields'
                             WHEN n > 1 THEN 'Duplicate customer_id' END AS error_message FROM n)
SELECT *, CASE WHEN error_message IS NULL THEN 'PASSED' ELSE 'FAILED' END AS validation_status FROM v"""

SQL["validate_products"] = """
WITH seen AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, NULLIF(l_returnflag, 'N') AS product_name,
         l_extendedprice - 20000 AS price, l_orderkey AS seen_in, l_linenumber AS line, l_quantity AS units,
         l_shipdate AS ingestion_timestamp FROM lineitem),
n AS (
  SELECT *, row_number() OVER (PARTITION BY product_name IS NULL, product_id
    ORDER BY ingestion_timestamp DESC, seen_in, line, price, units, product_name) AS n FROM seen),
v AS (
  SELECT * EXCLUDE (n), CASE WHEN product_name IS NULL THEN 'Null values in required fields'
                             WHEN n > 1 THEN 'Duplicate product_id'
                             WHEN price < 0 THEN 'price must be >= 0' END AS error_message FROM n)
SELECT *, CASE WHEN error_message IS NULL THEN 'PASSED' ELSE 'FAILED' END AS validation_status FROM v"""

SQL["incremental_batch"] = f"WITH {TX}\nSELECT * FROM tx WHERE ingestion_timestamp > TIMESTAMP '2000-01-01'"
SQL["high_water"] = f"WITH {TX}\nSELECT MAX(ingestion_timestamp) AS mark FROM tx"

SQL["upsert_orders"] = """
WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
     new AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01')
SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice, o_orderpriority AS priority,
       CAST(NULL AS VARCHAR) AS o_orderstatus FROM new
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, NULL, o_orderstatus FROM old
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)"""

# -- gold -----------------------------------------------------------------------

SQL["dim_customers"] = f"""WITH {SILVER}, {CUSTOMERS},
m AS (
  SELECT customer_id, {total('final_amount')} AS total_revenue, COUNT(*) AS total_transactions,
         {mean('final_amount')} AS avg_transaction_value,
         MAX(transaction_timestamp) AS last_transaction_date, MIN(transaction_timestamp) AS first_transaction_date
  FROM sales GROUP BY customer_id)
SELECT customers.*, COALESCE(total_revenue, 0) AS total_revenue, COALESCE(total_transactions, 0) AS total_transactions,
       COALESCE(avg_transaction_value, 0) AS avg_transaction_value, last_transaction_date, first_transaction_date,
       COALESCE(total_revenue, 0) AS customer_lifetime_value
FROM customers LEFT JOIN m USING (customer_id)"""

SQL["dim_customers_without_sales"] = f"""WITH {CUSTOMERS}
SELECT *, CAST(0 AS DOUBLE) AS total_revenue, CAST(0 AS BIGINT) AS total_transactions,
       CAST(0 AS DOUBLE) AS avg_transaction_value, CAST(0 AS DOUBLE) AS customer_lifetime_value FROM customers"""

SQL["dim_products"] = f"""WITH {SILVER}, {PRODUCTS},
m AS (
  SELECT product_id, {total('final_amount')} AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
         COUNT(*) AS total_transactions, {mean('final_amount')} AS avg_sale_price,
         MAX(transaction_timestamp) AS last_sale_date
  FROM sales GROUP BY product_id)
SELECT products.*, COALESCE(total_revenue, 0) AS total_revenue, COALESCE(total_quantity_sold, 0) AS total_quantity_sold,
       COALESCE(total_transactions, 0) AS total_transactions, COALESCE(avg_sale_price, 0) AS avg_sale_price,
       last_sale_date
FROM products LEFT JOIN m USING (product_id)"""

SQL["dim_dates"] = """
WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(day(date) AS INTEGER) AS day, monthname(date) AS month_name, dayname(date) AS day_name,
       CAST(weekofyear(date) AS INTEGER) AS week_number, CAST(quarter(date) AS INTEGER) AS quarter,
       strftime(date, '%Y-%m') AS year_month,
       CAST(CASE WHEN isodow(date) <= 5 THEN 1 ELSE 0 END AS INTEGER) AS is_weekday,
       CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key
FROM d"""

_METRICS = f"""COUNT(transaction_id) AS transaction_count, COUNT(DISTINCT customer_id) AS unique_customers,
       COUNT(DISTINCT product_id) AS unique_products, {total('final_amount')} AS total_revenue,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold, {mean('final_amount')} AS avg_transaction_value,
       {total('profit')} AS total_profit"""

DAILY = f"""SELECT CAST(transaction_timestamp AS DATE) AS sale_date, {_METRICS},
       {total('discount')} AS total_discount,
       MAX(final_amount) AS max_transaction_value, MIN(final_amount) AS min_transaction_value,
       CAST(year(CAST(transaction_timestamp AS DATE)) AS INTEGER) AS year,
       CAST(month(CAST(transaction_timestamp AS DATE)) AS INTEGER) AS month,
       CAST(quarter(CAST(transaction_timestamp AS DATE)) AS INTEGER) AS quarter,
       CAST(weekofyear(CAST(transaction_timestamp AS DATE)) AS INTEGER) AS week_number
FROM sales GROUP BY CAST(transaction_timestamp AS DATE)"""

SQL["daily_sales"] = f"WITH {SILVER}\n{DAILY}"
SQL["weekly_sales"] = f"""WITH {SILVER}
SELECT CAST(year(transaction_timestamp) AS INTEGER) AS year,
       CAST(weekofyear(transaction_timestamp) AS INTEGER) AS week_number, {_METRICS}
FROM sales GROUP BY 1, 2"""
SQL["monthly_sales"] = f"""WITH {SILVER}
SELECT CAST(year(transaction_timestamp) AS INTEGER) AS year, CAST(month(transaction_timestamp) AS INTEGER) AS month,
       CAST(quarter(transaction_timestamp) AS INTEGER) AS quarter, {_METRICS}
FROM sales GROUP BY 1, 2, 3"""

SQL["partitioned_gold_read"] = SQL["monthly_sales"].replace(
    "FROM sales GROUP BY", "FROM sales WHERE year(transaction_timestamp) = 1997 GROUP BY")

SQL["rfm_segments"] = f"""WITH {CUSTOMERS},
m AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, {total(m2('o_totalprice / 1000'))} AS monetary_value,
         COUNT(*) AS frequency, MAX(o_orderdate) AS last_transaction_date FROM orders GROUP BY o_custkey),
s AS (
  SELECT *, CAST(date_diff('day', CAST(last_transaction_date AS DATE), DATE '2001-08-02') AS INTEGER) AS recency_days FROM m),
t AS (
  SELECT *,
    CAST(CASE WHEN recency_days <= 30 THEN 5 WHEN recency_days <= 60 THEN 4 WHEN recency_days <= 90 THEN 3
         WHEN recency_days <= 180 THEN 2 ELSE 1 END AS INTEGER) AS recency_score,
    CAST(CASE WHEN frequency >= 20 THEN 5 WHEN frequency >= 10 THEN 4 WHEN frequency >= 5 THEN 3
         WHEN frequency >= 2 THEN 2 ELSE 1 END AS INTEGER) AS frequency_score,
    CAST(CASE WHEN monetary_value >= 5000 THEN 5 WHEN monetary_value >= 2000 THEN 4 WHEN monetary_value >= 1000 THEN 3
         WHEN monetary_value >= 500 THEN 2 ELSE 1 END AS INTEGER) AS monetary_score
  FROM s)
SELECT t.*, CASE
    WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
    WHEN recency_score >= 3 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'Loyal Customers'
    WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'At Risk'
    WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'Lost Customers'
    WHEN recency_score >= 3 AND frequency_score <= 2 THEN 'Potential Loyalists'
    ELSE 'Need Attention' END AS segment,
  customers.customer_name, customers.segment AS original_segment
FROM t LEFT JOIN customers USING (customer_id)"""

PERFORMANCE = f"""{SILVER}, {PRODUCTS},
m AS (
  SELECT product_id, {total('final_amount')} AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
         {total('profit')} AS total_profit, COUNT(*) AS total_transactions,
         COUNT(DISTINCT customer_id) AS unique_customers, {mean('final_amount')} AS avg_sale_price,
         MAX(transaction_timestamp) AS last_sale_date, MIN(transaction_timestamp) AS first_sale_date
  FROM sales GROUP BY product_id),
perf AS (
  SELECT m.*, product_name, category, price, cost, total_profit / NULLIF(total_revenue, 0) * 100 AS profit_margin
  FROM m LEFT JOIN products USING (product_id))"""

SQL["product_performance"] = f"WITH {PERFORMANCE}\nSELECT * FROM perf"
SQL["category_report"] = f"""WITH {PERFORMANCE},
stock AS (SELECT category, CAST(SUM(stock_quantity) AS BIGINT) AS stock_quantity FROM products GROUP BY category),
c AS (
  SELECT category, {total('total_revenue')} AS total_revenue, CAST(SUM(total_quantity_sold) AS BIGINT) AS total_quantity_sold,
         {total('total_profit')} AS total_profit, COUNT(*) AS product_count FROM perf GROUP BY category)
SELECT c.*, stock_quantity, CAST(total_quantity_sold AS DOUBLE) / stock_quantity AS stock_turnover
FROM c LEFT JOIN stock USING (category)"""

for _name, _key in (("top_products_per_day", "product_id"), ("top_customers_per_day", "customer_id")):
    SQL[_name] = f"""WITH {SILVER},
r AS (
  SELECT CAST(transaction_timestamp AS DATE) AS sale_date, {_key}, {total('final_amount')} AS total_revenue,
         COUNT(*) AS transaction_count FROM sales GROUP BY 1, 2)
SELECT *, CAST(rank() OVER (PARTITION BY sale_date ORDER BY total_revenue DESC) AS INTEGER) AS position
FROM r QUALIFY position <= 3"""

SQL["validated_daily_sales"] = f"""WITH {TX},
kept AS (SELECT * FROM tx QUALIFY {NEWEST} = 1),
silver AS ({SILVER_OF.format('kept')}),
sales AS (SELECT * FROM silver WHERE status = 'COMPLETED' AND final_amount >= 0 AND quantity >= 1
          AND customer_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
          AND product_id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part))
{DAILY}"""

# -- versions -------------------------------------------------------------------

_VERSION_OF = """CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 0
       WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 1 ELSE 2 END"""

ORDER_LOG = f"olog AS (SELECT *, {_VERSION_OF} AS v FROM orders)"

# The last order of a customer in each period: one upsert.
UPSERTS = f"""{ORDER_LOG},
ups AS (
  SELECT v, o_custkey, o_orderkey, o_totalprice, o_orderdate FROM olog
  QUALIFY row_number() OVER (PARTITION BY v, o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)"""


def _as_of(version: int, name: str) -> str:
    return f"""{name} AS (
  SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM ups WHERE v <= {version}
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY v DESC) = 1)"""


SQL["version_as_of"] = f"WITH {UPSERTS}, {_as_of(1, 's')}\nSELECT * FROM s"
SQL["version_latest"] = f"WITH {UPSERTS}, {_as_of(2, 's')}\nSELECT * FROM s"
SQL["restore"] = f"WITH {UPSERTS}, {_as_of(0, 's')}\nSELECT * FROM s"
SQL["timestamp_as_of"] = f"WITH {ORDER_LOG}\nSELECT * EXCLUDE (v) FROM olog WHERE v <= 1"
SQL["history"] = f"""WITH {ORDER_LOG}
SELECT CAST(v AS BIGINT) AS version,
       CASE v WHEN 0 THEN TIMESTAMP '1997-01-01' WHEN 1 THEN TIMESTAMP '1999-01-01'
              ELSE TIMESTAMP '2002-01-01' END AS committed_at,
       'APPEND' AS operation, COUNT(*) AS row_count FROM olog GROUP BY v"""
SQL["version_diff"] = f"""WITH {UPSERTS}, {_as_of(0, 'a')}, {_as_of(2, 'b')}
SELECT COUNT(a.o_custkey) AS rows_before, COUNT(b.o_custkey) AS rows_after,
       COUNT(*) FILTER (a.o_custkey IS NULL) AS added, COUNT(*) FILTER (b.o_custkey IS NULL) AS removed,
       COUNT(*) FILTER (a.o_orderkey <> b.o_orderkey) AS changed,
       COUNT(*) FILTER (a.o_orderkey = b.o_orderkey) AS unchanged
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey"""
SQL["append_check"] = f"""WITH {ORDER_LOG}
SELECT COUNT(*) FILTER (v = 0) AS rows_before, COUNT(*) FILTER (v > 0) AS rows_written,
       COUNT(*) AS rows_after, true AS consistent FROM olog"""
SQL["evolve_schema"] = """
SELECT *, CAST(7 AS INTEGER) AS review_round, true AS is_archived FROM orders"""
SQL["change_feed"] = f"""WITH {UPSERTS}
SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate, CAST(v AS BIGINT) AS _version, 'upsert' AS _change
FROM ups WHERE v > 0"""
SQL["compact"] = "SELECT * FROM orders"
SQL["zorder"] = "SELECT * FROM orders"
SQL["expire_versions"] = f"""WITH {UPSERTS}, {_as_of(2, 's')}
SELECT CAST(3 AS INTEGER) AS version, COUNT(*) AS row_count, CAST(SUM(o_orderkey) AS BIGINT) AS checksum FROM s"""

# -- streams --------------------------------------------------------------------

SQL["stream_ingest"] = """
SELECT CAST(user_id AS VARCHAR) AS kafka_key, CAST(event_id AS VARCHAR) AS transaction_id,
       CAST(user_id AS VARCHAR) AS customer_id, date_trunc('second', ts) AS transaction_timestamp,
       value AS final_amount, event_type AS status, 'kafka_stream' AS source_file, 'kafka' AS data_source,
       DATE '2024-01-01' AS ingestion_date
FROM events"""

_WINDOWS = """w AS (
  SELECT time_bucket(INTERVAL 1 HOUR, date_trunc('second', ts)) AS window_start,
         time_bucket(INTERVAL 1 HOUR, date_trunc('second', ts)) + INTERVAL 1 HOUR AS window_end,
         event_type AS status, COUNT(*) AS transaction_count,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
  FROM events GROUP BY 1, 2, 3)"""
SQL["stream_window_update"] = f"WITH {_WINDOWS}\nSELECT * FROM w"
SQL["stream_window_append"] = f"""WITH {_WINDOWS}
SELECT * FROM w WHERE window_end <= (SELECT MAX(date_trunc('second', ts)) FROM events) - INTERVAL 10 MINUTE"""

# -- all layers -----------------------------------------------------------------

_BATCH = f"""{TX},
valid AS (
  SELECT transaction_id, ANY_VALUE(customer_id) AS customer_id, ANY_VALUE(trim(status)) AS status,
         ANY_VALUE(CAST(transaction_date AS TIMESTAMP)) AS happened
  FROM tx WHERE customer_id IN ({_SOLVENT}) GROUP BY transaction_id),
done AS (SELECT * FROM valid WHERE status = 'completed')"""

SQL["batch_run_daily_counts"] = f"""WITH {_BATCH}
SELECT CAST(happened AS DATE) AS sale_date, COUNT(*) AS transaction_count, COUNT(DISTINCT customer_id) AS unique_customers,
       CAST(year(CAST(happened AS DATE)) AS INTEGER) AS year, CAST(month(CAST(happened AS DATE)) AS INTEGER) AS month,
       CAST(weekofyear(CAST(happened AS DATE)) AS INTEGER) AS week_number
FROM done GROUP BY CAST(happened AS DATE)"""

SQL["batch_run_metrics"] = f"""WITH {_BATCH},
n AS (
  SELECT (SELECT COUNT(*) FROM tx) AS raw, (SELECT COUNT(*) FROM valid) AS ok,
         (SELECT COUNT(*) FROM customer WHERE c_acctbal >= 0) AS people, (SELECT COUNT(*) FROM part) AS goods,
         (SELECT COUNT(DISTINCT CAST(happened AS DATE)) FROM done) AS days,
         (SELECT COUNT(DISTINCT (year(happened), weekofyear(happened))) FROM done) AS weeks,
         (SELECT COUNT(DISTINCT (year(happened), month(happened))) FROM done) AS months,
         (SELECT COUNT(DISTINCT customer_id) FROM done) AS buyers,
         (SELECT date_diff('day', MIN(CAST(happened AS DATE)), MAX(CAST(happened AS DATE))) + 1 FROM valid) AS all_days)
SELECT 'bronze' AS layer, 'transactions' AS "table", 'INGEST' AS operation, raw AS row_count,
       CAST(-1 AS BIGINT) AS accepted, CAST(-1 AS BIGINT) AS rejected FROM n
UNION ALL SELECT 'bronze', 'customers', 'INGEST', people, -1, -1 FROM n
UNION ALL SELECT 'bronze', 'products', 'INGEST', goods, -1, -1 FROM n
UNION ALL SELECT 'silver', 'transactions', 'MERGE', ok, ok, raw - ok FROM n
UNION ALL SELECT 'silver', 'customers', 'MERGE', people, people, 0 FROM n
UNION ALL SELECT 'silver', 'products', 'MERGE', goods, goods, 0 FROM n
UNION ALL SELECT 'quarantine', 'transactions', 'QUARANTINE', raw - ok, -1, -1 FROM n
UNION ALL SELECT 'gold', 'dim_customers', 'MERGE', people, -1, -1 FROM n
UNION ALL SELECT 'gold', 'dim_products', 'MERGE', goods, -1, -1 FROM n
UNION ALL SELECT 'gold', 'dim_dates', 'OVERWRITE', all_days, -1, -1 FROM n
UNION ALL SELECT 'gold', 'daily_sales_summary', 'OVERWRITE', days, -1, -1 FROM n
UNION ALL SELECT 'gold', 'weekly_sales_summary', 'OVERWRITE', weeks, -1, -1 FROM n
UNION ALL SELECT 'gold', 'monthly_sales_summary', 'OVERWRITE', months, -1, -1 FROM n
UNION ALL SELECT 'gold', 'customer_segments', 'OVERWRITE', buyers, -1, -1 FROM n
UNION ALL SELECT 'gold', 'product_performance', 'OVERWRITE', sold, -1, -1 FROM (
  SELECT COUNT(DISTINCT product_id) AS sold FROM (
    SELECT product_id FROM tx JOIN done USING (transaction_id)
    QUALIFY row_number() OVER (PARTITION BY transaction_id
      ORDER BY product_id, transaction_date, quantity, unit_price, total_amount, discount) = 1))"""

# -- repaired paths --------------------------------------------------------------

SQL["dq_duplicates_skewed"] = f"""WITH {TX}, t AS (
  SELECT * REPLACE (CASE WHEN shipping_address = 'R' THEN 'hot' ELSE customer_id END AS transaction_id), customer_id AS buyer FROM tx)
SELECT transaction_id, ingestion_timestamp, product_id, quantity, total_amount, discount FROM t
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingestion_timestamp DESC NULLS LAST, product_id NULLS FIRST,
  quantity NULLS FIRST, total_amount NULLS FIRST, discount NULLS FIRST, transaction_date, buyer, payment_method) = 1"""
SQL["incremental_after_compaction"] = f"""WITH {TX}
SELECT DISTINCT transaction_id, upper(trim(status)) AS status FROM tx WHERE final_amount >= 0 AND quantity >= 1"""
SQL["full_refresh"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, trim(p_name) AS product_name,
  upper(trim(p_type)) AS category, round(p_retailprice, 2) AS price FROM part WHERE p_retailprice >= 0"""
SQL["version_diff_repeated_keys"] = """WITH o AS (
  SELECT CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS k, o_orderkey, o_totalprice, o_orderdate, o_custkey FROM orders
), r AS (
  SELECT k, SUM(a) AS a, SUM(b) AS b, o_orderkey, o_totalprice FROM (
    SELECT k, o_orderkey, o_totalprice, 1 AS a, 0 AS b FROM o WHERE o_orderdate < '1999-01-01'
    UNION ALL SELECT k, o_orderkey, o_totalprice, 0, 1 FROM o WHERE o_custkey % 3 <> 0) GROUP BY k, o_orderkey, o_totalprice
), g AS (
  SELECT k, SUM(a) AS a, SUM(b) AS b, SUM(LEAST(a, b)) AS s FROM r GROUP BY k
), c AS (SELECT *, LEAST(a - s, b - s) AS c FROM g)
SELECT CAST(SUM(a) AS BIGINT) AS rows_before, CAST(SUM(b) AS BIGINT) AS rows_after, CAST(SUM(b - s - c) AS BIGINT) AS added,
       CAST(SUM(a - s - c) AS BIGINT) AS removed, CAST(SUM(c) AS BIGINT) AS changed, CAST(SUM(s) AS BIGINT) AS unchanged FROM c"""
SQL["change_feed_restore"] = """
SELECT o_orderkey, o_totalprice, CAST(2 AS BIGINT) AS _version, 'append' AS _change FROM orders WHERE o_orderdate >= '1999-01-01'
UNION ALL SELECT o_orderkey, o_totalprice, CAST(4 AS BIGINT), 'delete' FROM orders WHERE o_orderdate >= '1997-01-01'"""
SQL["zorder_text"] = """SELECT COUNT(*) AS row_count, CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS VARCHAR) AS total,
  true AS one_file_per_key FROM orders"""
SQL["dim_customers_two_runs"] = f"SELECT *, (SELECT COUNT(*) FROM customer) AS rows_written FROM ({SQL['dim_customers']})"
SQL["batch_run_daily"] = f"""WITH {TX},
kept AS (SELECT * FROM tx WHERE customer_id IN ({_SOLVENT}) QUALIFY row_number() OVER (PARTITION BY transaction_id
  ORDER BY product_id, transaction_date, quantity, unit_price, total_amount, discount, final_amount, payment_method, status, shipping_address) = 1),
silver AS ({SILVER_OF.format('kept')}),
sales AS (SELECT * FROM silver WHERE status = 'COMPLETED')
{DAILY}"""
SQL["stream_malformed"] = f"""
WITH m AS (SELECT event_id, {_VALUE} AS v FROM events)
SELECT CASE WHEN length(v) % 3 <> 0 THEN CAST(event_id AS VARCHAR) END AS transaction_id,
       CASE WHEN length(v) % 3 = 0 THEN substr(v, 1, 30) END AS value_text FROM m"""

# -- partition by partition -------------------------------------------------------

SQL["upsert_touches_few"] = """WITH o AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= '2001-06-01' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderdate >= '1998-03-01' AND o_orderdate < '1998-04-01' AND o_custkey % 7 = 0 THEN TIMESTAMP '2001-07-15' ELSE o_orderdate END AS o_orderdate
  FROM orders
), m AS (SELECT *, date_trunc('month', o_orderdate) AS month FROM o), w AS (
  SELECT DISTINCT month FROM m WHERE month >= '2001-06-01' OR month = '1998-03-01')
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, month IN (SELECT month FROM w) AS rewritten,
       (SELECT COUNT(*) FROM w) AS parts_written, (SELECT COUNT(DISTINCT month) FROM m) AS parts_held FROM m"""

SQL["gold_after_three_batches"] = f"""WITH {TX},
kept AS (SELECT * FROM tx QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY shipping_address DESC, ingestion_timestamp DESC,
  customer_id, product_id, transaction_date, quantity, unit_price, total_amount, discount, final_amount, payment_method, status) = 1),
silver AS ({SILVER_OF.format('kept')}),
sales AS (SELECT *, CAST(transaction_timestamp AS DATE) AS d FROM silver WHERE status = 'COMPLETED'),
p AS (
  SELECT 'daily' AS summary, CAST(year(d) AS INTEGER) AS year, CAST(dayofyear(d) AS INTEGER) AS number, * FROM sales
  UNION ALL SELECT 'weekly', CAST(year(d) AS INTEGER), CAST(weekofyear(d) AS INTEGER), * FROM sales
  UNION ALL SELECT 'monthly', CAST(year(d) AS INTEGER), CAST(month(d) AS INTEGER), * FROM sales)
SELECT summary, year, number, {_METRICS} FROM p GROUP BY summary, year, number"""

# An event is dropped if its window had ended at the watermark that the batch before the last one left behind.
_LATE = """b AS (
  SELECT *, date_trunc('second', ts) AS t, time_bucket(INTERVAL 1 HOUR, date_trunc('second', ts)) AS window_start,
         least(5, event_id * 6 // (SELECT MAX(event_id) + 1 FROM events) + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END) AS batch FROM events
), m AS (
  SELECT batch, MAX(t) AS m FROM b GROUP BY batch
), k AS (
  SELECT * FROM b WHERE window_start + INTERVAL 1 HOUR > coalesce((SELECT MAX(m) FROM m WHERE m.batch <= b.batch - 2) - INTERVAL 10 MINUTE, TIMESTAMP '1900-01-01')
), w AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type AS status, COUNT(*) AS transaction_count,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM k GROUP BY ALL)"""
SQL["stream_late_rows"] = f"WITH {_LATE}\nSELECT * FROM w"
SQL["stream_replay"] = f"""WITH {_LATE}
SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(NULL AS TIMESTAMP) AS window_start, event_type AS status, CAST(1 AS BIGINT) AS transaction_count FROM events
UNION ALL SELECT NULL, window_start, status, transaction_count FROM w"""

SQL["stream_metrics"] = f"""WITH {_LATE}
SELECT CAST(batch AS BIGINT) AS batch_id, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_incomplete, MIN(t) AS first_time, MAX(t) AS last_time FROM b GROUP BY batch"""

SQL["csv_quarantine"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_size > 40 THEN 'Unreadable text' END AS error_message,
  p_size > 40 AS text_kept, false AS in_silver FROM part"""
SQL["named_table_after_expire"] = "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'"
SQL["change_feed_images"] = f"""WITH {UPSERTS}, i AS (
  SELECT o_custkey, CAST(v AS BIGINT) AS _version, lag(o_orderkey) OVER w AS o_orderkey_before, o_orderkey AS o_orderkey_after,
         o_totalprice - lag(o_totalprice) OVER w AS more FROM ups WINDOW w AS (PARTITION BY o_custkey ORDER BY v))
SELECT * FROM i WHERE _version > 0"""
SQL["distinct_rollup"] = f"""WITH {SILVER}
SELECT CAST(year(transaction_timestamp) AS INTEGER) AS year, CAST(month(transaction_timestamp) AS INTEGER) AS month,
       COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT product_id) AS unique_products,
       true AS customers_within, true AS products_within FROM sales GROUP BY 1, 2"""

# -- columns without a rewrite, comparison of what differs, raw formats ------------

SQL["evolve_schema_in_place"] = """
SELECT o_orderkey, o_orderdate, CAST(0 AS BIGINT) AS rows_written,
       CAST(CASE WHEN o_orderdate < '1997-01-01' THEN 7 WHEN o_orderdate >= '1999-01-01' THEN 8 END AS INTEGER) AS review_round,
       CASE WHEN o_orderdate < '1997-01-01' THEN 'it''s new' END AS note,
       CASE WHEN o_orderdate < '1997-01-01' THEN '2024-01-02' END AS since,
       CASE WHEN o_orderdate < '1997-01-01' THEN CAST(0.5 AS DOUBLE) END AS share FROM orders"""
SQL["version_diff_few_changed"] = """
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (l_orderkey % 500 <> 1) AS rows_after,
       COUNT(*) FILTER (l_orderkey % 500 = 3) AS added, COUNT(*) FILTER (l_orderkey % 500 IN (1, 3)) AS removed,
       COUNT(*) FILTER (l_orderkey % 500 = 2) AS changed, COUNT(*) FILTER (l_orderkey % 500 NOT IN (1, 2, 3)) AS unchanged,
       true AS few_compared FROM lineitem"""
SQL["raw_csv_inferred"] = """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"""
SQL["bronze_formats_by_day"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, ' ' || p_name || ' ' AS product_name, lower(p_type) || ' ' AS category,
       p_retailprice AS price, p_retailprice * 0.61::DOUBLE AS cost, CAST(p_size AS DOUBLE) AS stock_quantity,
       CASE WHEN p_size <= 20 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS ingestion_date FROM part"""
SQL["layer_compaction"] = """
SELECT 'bronze' AS layer, 'customers' AS "table", true AS done, CAST(3 AS BIGINT) AS version, CAST(NULL AS VARCHAR) AS problem,
       COUNT(*) AS row_count, CAST(1 AS BIGINT) AS files FROM customer
UNION ALL SELECT 'bronze', 'products', true, 3, NULL, COUNT(*), 1 FROM part
UNION ALL SELECT 'bronze', 'transactions', false, NULL, 'no such table', NULL, NULL"""
