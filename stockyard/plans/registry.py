"""Registered queries over the benchmark tables, and their DuckDB oracles.

Each query reads whole tables of a data folder through the stand-in
projections (``sources.standins``) and runs the library's operator on them.
Each oracle is ANSI SQL over the same tables (DuckDB views) computing the
same result with the same column names and types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..sources import standins as S
from ..session import scratch_path
from ..sources.tables import read_table
from . import gold, silver

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _q(values) -> str:
    return ", ".join("'" + v + "'" if isinstance(v, str) else str(v) for v in values)


# ---------------------------------------------------------------------------
# Stand-ins in SQL (same projections as sources.standins)
# ---------------------------------------------------------------------------

SQL_ORDERS = """SELECT CASE WHEN o_totalprice >= 3000 THEN o_orderkey END AS order_id,
  o_custkey AS customer_id,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'lost'
       WHEN o_orderstatus = 'F' THEN ' delivered' WHEN o_orderstatus = 'O' THEN 'processing '
       WHEN o_orderstatus = 'P' THEN 'canceled' ELSE o_orderstatus END AS order_status,
  CASE WHEN NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O') THEN o_orderdate END
    AS order_purchase_timestamp,
  CASE WHEN NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O') THEN o_orderdate END
    AS order_approved_at,
  CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
  CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date,
  CAST(NULL AS TIMESTAMP) AS order_estimated_delivery_date
FROM orders"""

_PRICE = """CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CASE WHEN l_quantity = 1 THEN -1
  WHEN l_quantity = 50 THEN 10000 ELSE 1 END AS DECIMAL(16,2))"""
SQL_ITEMS = f"""SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
  CASE WHEN l_discount < 0.1 THEN l_partkey END AS product_id, l_suppkey AS seller_id,
  l_shipdate AS shipping_limit_date, {_PRICE} AS price,
  CAST({_PRICE} * (CAST(l_tax AS DECIMAL(4,2)) - 0.01) AS DECIMAL(18,4)) AS freight_value
FROM lineitem"""

SQL_PRODUCTS = """SELECT CASE WHEN p_retailprice > 905 THEN p_partkey END AS product_id,
  CASE p_brand WHEN 'Brand#11' THEN '  ' WHEN 'Brand#12' THEN NULL ELSE ' ' || p_type END
    AS product_category_name,
  CAST(length(p_name) AS INTEGER) AS product_name_lenght,
  CAST(length(p_brand) AS INTEGER) AS product_description_lenght,
  CAST(NULL AS INTEGER) AS product_photos_qty,
  p_size - 3 AS product_weight_g, CAST(length(p_name) - 8 AS INTEGER) AS product_length_cm,
  CAST(length(p_brand) - 8 AS INTEGER) AS product_height_cm, p_size - 10 AS product_width_cm
FROM part"""

SQL_CATEGORIES = """SELECT CASE p_brand WHEN 'Brand#11' THEN ' ' ELSE p_type || ' ' END
    AS product_category_name,
  CASE WHEN p_size = 1 THEN '  ' WHEN p_size > 2 THEN p_brand END AS product_category_name_english
FROM part"""

SQL_CUSTOMERS = """SELECT CASE WHEN c_nationkey <> 3 THEN c_custkey END AS customer_id,
  c_name AS customer_unique_id, CAST(c_custkey AS VARCHAR) AS customer_zip_code_prefix,
  ' ' || c_mktsegment AS customer_city, substring(c_mktsegment, 1, 2) AS customer_state
FROM customer"""

SQL_GEO = """SELECT CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END
    AS geolocation_zip_code_prefix,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal / 250 - 30 END AS geolocation_lat,
  c_acctbal / -200 - 35 AS geolocation_lng,
  c_mktsegment AS geolocation_city, substring(c_name, 1, 2) AS geolocation_state
FROM customer"""

SQL_SELLERS = """SELECT CASE WHEN s_nationkey <> 24 THEN s_suppkey END AS seller_id,
  CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) AS VARCHAR) AS seller_zip_code_prefix,
  s_name || '  ' AS seller_city,
  CASE WHEN s_nationkey < 5 THEN 'sp' WHEN s_nationkey < 8 THEN 'XX' WHEN s_nationkey < 16 THEN 'SP'
       ELSE 'RJ' END AS seller_state FROM supplier"""

SQL_PAYMENTS = """SELECT CASE WHEN o_totalprice >= 3000 THEN o_orderkey END AS order_id,
  1 AS payment_sequential,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
       WHEN '3-MEDIUM' THEN 'debit_card' WHEN '4-NOT SPECIFIED' THEN ' Voucher'
       WHEN '5-LOW' THEN 'voucher' END AS payment_type,
  CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS payment_installments,
  o_totalprice * CASE WHEN o_totalprice < 20000 THEN -1
       WHEN o_totalprice > 400000 AND o_orderstatus = 'P' THEN 10000 ELSE 1 END AS payment_value
FROM orders"""

SQL_REVIEWS = """SELECT CASE WHEN source <> 'src7' THEN doc_id END AS review_id,
  CASE WHEN lang <> 'es' THEN doc_id END AS order_id,
  CASE WHEN lang = 'de' THEN 'x' ELSE CAST(n_chars % 8 AS VARCHAR) END AS review_score,
  ' ' || source || ' ' AS review_comment_title, text AS review_comment_message,
  CAST(NULL AS TIMESTAMP) AS review_creation_date, CAST(NULL AS TIMESTAMP) AS review_answer_timestamp
FROM documents"""

# ---------------------------------------------------------------------------
# Silver in SQL
# ---------------------------------------------------------------------------

_STATES = _q(C.STATE_CODES)

SQL_SILVER = {
    "customers": f"""SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
  lower(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state,
  CASE WHEN customer_state NOT IN ({_STATES}) THEN 'invalid_state'
       WHEN length(trim(customer_zip_code_prefix)) < 4 THEN 'invalid_zipcode'
       ELSE 'valid' END AS data_quality_flag
FROM ({SQL_CUSTOMERS}) WHERE customer_id IS NOT NULL""",
    "geolocation": f"""SELECT geolocation_zip_code_prefix,
  CAST(geolocation_lat AS DECIMAL(10,6)) AS geolocation_lat,
  CAST(geolocation_lng AS DECIMAL(10,6)) AS geolocation_lng,
  lower(trim(geolocation_city)) AS geolocation_city,
  upper(trim(geolocation_state)) AS geolocation_state,
  CASE WHEN geolocation_lat IS NULL OR geolocation_lng IS NULL THEN 'missing_coordinates'
       WHEN geolocation_lat < {C.LAT_MIN} OR geolocation_lat > {C.LAT_MAX} THEN 'invalid_latitude'
       WHEN geolocation_lng < {C.LNG_MIN} OR geolocation_lng > {C.LNG_MAX} THEN 'invalid_longitude'
       ELSE 'valid' END AS data_quality_flag
FROM ({SQL_GEO}) WHERE geolocation_zip_code_prefix IS NOT NULL""",
    "orders": f"""SELECT order_id, customer_id, upper(trim(order_status)) AS order_status,
  order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
  order_delivered_customer_date, order_estimated_delivery_date,
  CASE WHEN order_purchase_timestamp IS NULL THEN 'missing_purchase_date'
       WHEN upper(trim(order_status)) NOT IN ({_q(C.ORDER_STATUSES)}) THEN 'invalid_status'
       ELSE 'valid' END AS data_quality_flag
FROM ({SQL_ORDERS}) WHERE order_id IS NOT NULL""",
    "order_items": f"""SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
  TRY_CAST(price AS DECIMAL(10,2)) AS price, TRY_CAST(freight_value AS DECIMAL(10,2)) AS freight_value,
  CASE WHEN price < 0 THEN 'negative_price' WHEN freight_value < 0 THEN 'negative_freight'
       WHEN abs(price) >= 99999999.995 THEN 'overflow_price'
       WHEN abs(freight_value) >= 99999999.995 THEN 'overflow_freight' ELSE 'valid' END AS data_quality_flag
FROM ({SQL_ITEMS}) WHERE order_id IS NOT NULL AND product_id IS NOT NULL""",
    "order_payments": f"""SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
  payment_installments, TRY_CAST(payment_value AS DECIMAL(10,2)) AS payment_value,
  CASE WHEN payment_value < 0 THEN 'invalid_payment_value'
       WHEN payment_type NOT IN ({_q(C.PAYMENT_TYPES)}) THEN 'invalid_payment_type'
       WHEN abs(payment_value) >= 99999999.995 THEN 'overflow_payment_value' ELSE 'valid' END AS data_quality_flag
FROM ({SQL_PAYMENTS}) WHERE order_id IS NOT NULL""",
    "order_reviews": f"""SELECT review_id, order_id, TRY_CAST(review_score AS INTEGER) AS review_score,
  trim(review_comment_title) AS review_comment_title,
  trim(review_comment_message) AS review_comment_message,
  review_creation_date, review_answer_timestamp,
  CASE WHEN order_id IS NULL THEN 'invalid_null_order_id'
       WHEN TRY_CAST(review_score AS INTEGER) NOT IN (1, 2, 3, 4, 5) THEN 'invalid_score'
       WHEN review_score IS NOT NULL AND TRY_CAST(review_score AS INTEGER) IS NULL
         THEN 'unparsable_score' ELSE 'valid' END AS data_quality_flag
FROM ({SQL_REVIEWS}) WHERE review_id IS NOT NULL""",
    "products": f"""SELECT product_id, lower(trim(product_category_name)) AS product_category_name,
  COALESCE(product_name_lenght, 0) AS product_name_lenght,
  COALESCE(product_description_lenght, 0) AS product_description_lenght,
  COALESCE(product_photos_qty, 0) AS product_photos_qty,
  COALESCE(product_weight_g, 0) AS product_weight_g,
  COALESCE(product_length_cm, 0) AS product_length_cm,
  COALESCE(product_height_cm, 0) AS product_height_cm,
  COALESCE(product_width_cm, 0) AS product_width_cm,
  CASE WHEN product_category_name IS NULL OR trim(product_category_name) = '' THEN 'missing_category'
       WHEN product_weight_g < 0 THEN 'negative_weight'
       WHEN product_length_cm < 0 THEN 'negative_length'
       WHEN product_height_cm < 0 THEN 'negative_height'
       WHEN product_width_cm < 0 THEN 'negative_width'
       ELSE 'valid' END AS data_quality_flag
FROM ({SQL_PRODUCTS}) WHERE product_id IS NOT NULL""",
    "product_category_name_translation": f"""SELECT
  lower(trim(product_category_name)) AS product_category_name,
  lower(trim(product_category_name_english)) AS product_category_name_english,
  CASE WHEN trim(product_category_name) = '' THEN 'invalid_empty_name'
       WHEN trim(product_category_name_english) = '' THEN 'invalid_empty_english'
       ELSE 'valid' END AS data_quality_flag
FROM ({SQL_CATEGORIES})
WHERE product_category_name IS NOT NULL AND product_category_name_english IS NOT NULL""",
    "sellers": f"""SELECT seller_id, seller_zip_code_prefix,
  lower(trim(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state,
  CASE WHEN seller_state NOT IN ({_STATES}) THEN 'invalid_state'
       WHEN length(trim(seller_zip_code_prefix)) < 4 THEN 'invalid_zipcode'
       ELSE 'valid' END AS data_quality_flag
FROM ({SQL_SELLERS}) WHERE seller_id IS NOT NULL""",
}

# dataset -> (driver table, stand-in function)
STANDIN = {
    "customers": ("customer", S.customers),
    "geolocation": ("customer", S.geolocation),
    "orders": ("orders", S.orders),
    "order_items": ("lineitem", S.order_items),
    "order_payments": ("orders", S.order_payments),
    "order_reviews": ("documents", S.order_reviews),
    "products": ("part", S.products),
    "product_category_name_translation": ("part", S.category_translation),
    "sellers": ("supplier", S.sellers),
}


def standin(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    table, fn = STANDIN[dataset]
    return fn(read_table(spark, sf_dir, table))


def silver_table(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return silver.DATASETS[dataset](standin(spark, sf_dir, dataset))


def _silver_query(dataset: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver_table(spark, sf_dir, dataset)
    run.__name__ = f"silver_{dataset}"
    run.__doc__ = f"Silver cleaning + quality flag of {dataset} (stand-in input)."
    return run


for _ds, _sql in SQL_SILVER.items():
    register(f"silver_{_ds}", _sql)(_silver_query(_ds))


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------

# Gold: lines of an order and product first, then the product's attributes.
_ATTRS = ("product_category_name", "product_name_lenght", "product_description_lenght",
          "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
SQL_PRODUCT_DEMAND = f"""WITH approved AS (
  SELECT order_id, order_approved_at FROM ({SQL_SILVER['orders']})
  WHERE order_status NOT IN ({_q(x.upper() for x in C.EXCLUDED_ORDER_STATUSES)})
    AND order_approved_at IS NOT NULL),
bought AS (
  SELECT order_id, order_approved_at, product_id, max(order_item_id) AS quantity,
    sum(price) AS price_sum, sum(freight_value) AS freight_sum, count(*) AS n
  FROM approved JOIN ({SQL_SILVER['order_items']}) USING (order_id) GROUP BY ALL)
SELECT order_id, order_approved_at, product_id, {', '.join(_ATTRS)}, quantity,
  CAST(price_sum AS DECIMAL(20,2)) AS total_price,
  CAST(freight_sum AS DECIMAL(20,2)) AS total_freight_value, n AS line_count
FROM bought JOIN ({SQL_SILVER['products']}) USING (product_id)"""


@register("product_demand", SQL_PRODUCT_DEMAND)
def q_product_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold product demand over silver orders, items and products."""
    return gold.product_demand_features(
        silver_table(spark, sf_dir, "orders"),
        silver_table(spark, sf_dir, "order_items"),
        silver_table(spark, sf_dir, "products"))


@register("count_by_status", f"""SELECT order_status, count(*) AS count
FROM ({SQL_SILVER['orders']}) GROUP BY order_status""")
def q_count_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders per status."""
    return gold.order_status_counts(silver_table(spark, sf_dir, "orders"))


# ---------------------------------------------------------------------------
# Inventory line (sales events / stock acquisitions stand-ins from `events`)
# ---------------------------------------------------------------------------

from ..operators import inventory as INV  # noqa: E402

ZONE = C.DEFAULT_ZONE
PARAMS = C.DemandParams.notebook()


def sales(spark, sf_dir):
    return S.sales_events(read_table(spark, sf_dir, "events"))


def acquisitions(spark, sf_dir):
    return S.stock_acquisitions(read_table(spark, sf_dir, "events"))


def daily(spark, sf_dir):
    return INV.inventory_daily(sales(spark, sf_dir), acquisitions(spark, sf_dir),
                               initial_stock=PARAMS.initial_stock, zone=ZONE)


def daily_table(spark, sf_dir):
    """The daily stock series written once as a Parquet table under the shared
    folder, as the pipeline does: jobs that read it in several branches scan
    the events once, and read only the columns they need."""
    path = scratch_path(spark, "inventory-daily")
    daily(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def ranges(spark, sf_dir):
    """Per-SKU [first, last] local day of its movements (from the daily
    stock series)."""
    return INV.sku_ranges(daily_table(spark, sf_dir))


_EVENT_TS = "ts + to_days(CAST(user_id % 24 * 30 AS INTEGER)) AS event_ts"
SQL_SALES = f"""SELECT user_id AS sku_id, printf('S%08d', event_id // 2) AS sales_id, {_EVENT_TS},
  CAST(ceil(value) AS INTEGER) AS quantity,
  CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'canceled'
       ELSE 'placed' END AS status
FROM events WHERE event_type IN ('purchase', 'error', 'view', 'click')"""

SQL_ACQ = f"""SELECT user_id AS sku_id, printf('A%08d', event_id) AS acquisition_id, {_EVENT_TS},
  'planned' AS reason, CAST(ceil(value) AS INTEGER) AS quantity_received
FROM events WHERE event_type = 'signup'"""


def _ld(ts: str) -> str:
    return f"CAST(timezone('{ZONE}', timezone('UTC', {ts})) AS DATE)"


SQL_MOVES = f"""SELECT sku_id, event_date, CAST(sum(r) AS BIGINT) AS received_qty,
  CAST(sum(a) AS BIGINT) AS approved_qty FROM (
  SELECT sku_id, {_ld('event_ts')} AS event_date, 0 AS r, quantity AS a
  FROM ({SQL_SALES}) WHERE status = 'approved'
  UNION ALL
  SELECT sku_id, {_ld('event_ts')} AS event_date, quantity_received AS r, 0 AS a
  FROM ({SQL_ACQ})) GROUP BY sku_id, event_date"""

SQL_RANGES = f"""SELECT sku_id, min(event_date) AS "start", max(event_date) AS "end"
FROM ({SQL_MOVES}) GROUP BY sku_id"""

SQL_DAILY = f"""WITH mv AS ({SQL_MOVES}), rg AS ({SQL_RANGES}),
spine AS (SELECT sku_id, CAST(unnest(generate_series("start", "end", INTERVAL 1 DAY)) AS DATE)
          AS event_date FROM rg),
d AS (SELECT s.sku_id, s.event_date, CAST(COALESCE(m.received_qty, 0) AS BIGINT) AS received_qty,
             CAST(COALESCE(m.approved_qty, 0) AS BIGINT) AS approved_qty
      FROM spine s LEFT JOIN mv m ON m.sku_id = s.sku_id AND m.event_date = s.event_date)
SELECT sku_id, event_date, received_qty, approved_qty,
  CAST({PARAMS.initial_stock} + sum(received_qty) OVER w - sum(approved_qty) OVER w AS BIGINT)
    AS inventory_eod
FROM d WINDOW w AS (PARTITION BY sku_id ORDER BY event_date
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@register("daily_received", f"""SELECT sku_id, {_ld('event_ts')} AS event_date,
  CAST(sum(quantity_received) AS BIGINT) AS received_qty FROM ({SQL_ACQ}) GROUP BY ALL""")
def q_daily_received(spark, sf_dir):
    """Units received per SKU and local day."""
    return INV.daily_received(acquisitions(spark, sf_dir), ZONE)


@register("daily_approved", f"""SELECT sku_id, {_ld('event_ts')} AS event_date,
  CAST(sum(quantity) AS BIGINT) AS approved_qty FROM ({SQL_SALES})
WHERE status = 'approved' GROUP BY ALL""")
def q_daily_approved(spark, sf_dir):
    """Approved units per SKU and local day."""
    return INV.daily_approved(sales(spark, sf_dir), ZONE)


@register("daily_approved_utc", f"""SELECT sku_id, CAST(event_ts AS DATE) AS event_date,
  CAST(sum(quantity) AS BIGINT) AS approved_qty FROM ({SQL_SALES}) s
WHERE status = 'approved'
  AND sales_id NOT IN (SELECT sales_id FROM ({SQL_SALES}) WHERE status = 'canceled')
GROUP BY ALL""")
def q_daily_approved_utc(spark, sf_dir):
    """Approved units per SKU and UTC date minus ids also canceled."""
    return INV.daily_approved_utc(sales(spark, sf_dir))


@register("inventory_daily", SQL_DAILY)
def q_inventory_daily(spark, sf_dir):
    """Per-SKU daily spine, received / approved and end-of-day stock."""
    return daily(spark, sf_dir)


@register("eod_negatives", f"SELECT * FROM ({SQL_DAILY}) WHERE inventory_eod < 0")
def q_eod_negatives(spark, sf_dir):
    """Days that end with negative stock."""
    return INV.eod_negatives(daily(spark, sf_dir))


SQL_LEDGER = f"""WITH m AS (
  SELECT sku_id, event_ts, 0 AS kind, CAST(acquisition_id AS VARCHAR) AS movement_id,
         reason, CAST(quantity_received AS BIGINT) AS delta FROM ({SQL_ACQ})
  UNION ALL
  SELECT sku_id, event_ts, 1 AS kind, CAST(sales_id AS VARCHAR) AS movement_id,
         'sale' AS reason, -CAST(quantity AS BIGINT) AS delta
  FROM ({SQL_SALES}) WHERE status = 'approved')
SELECT sku_id, event_ts, kind, movement_id, reason, delta,
  CAST({PARAMS.initial_stock} + sum(delta) OVER (PARTITION BY sku_id
       ORDER BY event_ts NULLS LAST, kind, CAST(substring(movement_id, 2) AS BIGINT), movement_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS balance
FROM m"""


def ledger(spark, sf_dir):
    return INV.stock_ledger(sales(spark, sf_dir), acquisitions(spark, sf_dir),
                            initial_stock=PARAMS.initial_stock)


@register("stock_ledger", SQL_LEDGER)
def q_stock_ledger(spark, sf_dir):
    """Running stock balance after every movement (two-level prefix sum)."""
    return ledger(spark, sf_dir)


@register("negative_stock_audit", f"SELECT * FROM ({SQL_LEDGER}) WHERE balance < 0")
def q_negative_stock_audit(spark, sf_dir):
    """Ledger rows with a negative balance."""
    return INV.negative_stock_audit(ledger(spark, sf_dir))


@register("stock_conservation", f"""WITH mv AS ({SQL_MOVES}),
t AS (SELECT sku_id, CAST(sum(received_qty) AS BIGINT) AS total_received,
             CAST(sum(approved_qty) AS BIGINT) AS total_approved FROM mv GROUP BY sku_id),
l AS (SELECT sku_id, arg_max(inventory_eod, event_date) AS final_stock
      FROM ({SQL_DAILY}) GROUP BY sku_id)
SELECT COALESCE(t.sku_id, l.sku_id) AS sku_id, total_received, total_approved, final_stock,
  {PARAMS.initial_stock} + COALESCE(total_received, 0) - COALESCE(total_approved, 0) = final_stock
    AS conserved,
  final_stock >= 0 AS non_negative
FROM t FULL JOIN l ON t.sku_id = l.sku_id""")
def q_stock_conservation(spark, sf_dir):
    """Per-SKU conservation check of the daily stock."""
    return INV.stock_conservation(sales(spark, sf_dir), acquisitions(spark, sf_dir),
                                  daily_table(spark, sf_dir), PARAMS.initial_stock, ZONE)
