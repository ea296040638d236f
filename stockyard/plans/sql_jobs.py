"""The SQL-flavoured jobs as Spark SQL over DataFrames.

Same results as the DataFrame operators; Catalyst gives both the same kind
of plan. DataFrames are passed to ``spark.sql`` as named arguments (no
session-wide temp views). Differences from a single-SKU script: every
window has ``PARTITION BY sku_id`` (no single-partition window), the latest
stock is joined on ``sku_id`` (no cross join), and "not canceled" is
``NOT EXISTS`` (a regular shuffled anti join; ``NOT IN`` is planned as a
null-aware anti join that always broadcasts the id list).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import TimestampNTZType

from .. import config as C
from ..operators.aggregates import PRODUCT_ATTRS
from ..operators.windows import to_group, to_join


def _q(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def product_demand_sql(spark: SparkSession, orders: DataFrame, items: DataFrame,
                       products: DataFrame, excluded=C.EXCLUDED_ORDER_STATUSES) -> DataFrame:
    """Product demand with GROUP BY ALL: lines are added up per order and
    product before they meet the product's attributes. The parts that are joined
    come from ``windows.to_join``; most often there is one, the whole tables."""
    bought = [spark.sql("""
        SELECT order_id, order_approved_at, product_id, max(order_item_id) AS quantity,
               sum(price) AS price_sum, sum(freight_value) AS freight_sum, count(*) AS lines
        FROM {lines} GROUP BY ALL""", lines=to_group(spark.sql(f"""
          SELECT * FROM {{items}} JOIN {{orders}} USING (order_id)
          WHERE order_approved_at IS NOT NULL
            AND lower(trim(order_status)) NOT IN ({_q(v.lower() for v in excluded)})""",
          items=i, orders=o), items, "order_id", "order_approved_at", "product_id"))
        for i, o in to_join(items, orders.where("order_approved_at IS NOT NULL"), "order_id")]
    out = [spark.sql(f"""
        WITH kinds AS (
          SELECT product_id, {', '.join(PRODUCT_ATTRS)}, count(*) AS copies
          FROM {{products}} GROUP BY ALL)
        SELECT order_id, order_approved_at, product_id, {', '.join(PRODUCT_ATTRS)}, quantity,
               CAST(price_sum * copies AS DECIMAL(20,2)) AS total_price,
               CAST(freight_sum * copies AS DECIMAL(20,2)) AS total_freight_value,
               lines * copies AS line_count
        FROM {{bought}} JOIN kinds USING (product_id)""", bought=b, products=p)
        for b, p in to_join(reduce(DataFrame.unionByName, bought), products, "product_id", items)]
    return reduce(DataFrame.unionByName, out)


def _local_date(df: DataFrame, zone: str) -> str:
    if isinstance(df.schema["event_ts"].dataType, TimestampNTZType):
        return f"to_date(convert_timezone('UTC', '{zone}', event_ts))"
    return f"to_date(convert_timezone('{zone}', event_ts))"


def inventory_daily_sql(spark: SparkSession, sales: DataFrame, acq: DataFrame,
                        initial_stock: int = 0, zone: str = C.DEFAULT_ZONE) -> DataFrame:
    """Daily received / approved and end-of-day stock per SKU. Both event
    streams are one signed union, grouped by ordinal; a movement day then
    repeats itself up to the day before the next one, with its running stock,
    so days without movement need no spine to join."""
    return spark.sql(f"""
        SELECT sku_id, event_date, if(event_date = moved_on, got, 0L) AS received_qty,
               if(event_date = moved_on, sold, 0L) AS approved_qty, stock AS inventory_eod
        FROM (
          SELECT *, explode(sequence(moved_on, until)) AS event_date FROM (
            SELECT sku_id, moved_on, got, sold,
                   coalesce(date_sub(lead(moved_on) OVER by_day, 1), moved_on) AS until,
                   CAST({int(initial_stock)} + sum(got - sold) OVER by_day AS BIGINT) AS stock
            FROM (
              SELECT sku_id, moved_on, sum(got) AS got, sum(sold) AS sold FROM (
                SELECT sku_id, {_local_date(sales, zone)} AS moved_on, 0L AS got,
                       CAST(quantity AS BIGINT) AS sold
                FROM {{sales}} WHERE status = '{C.STATUS_APPROVED}'
                UNION ALL
                SELECT sku_id, {_local_date(acq, zone)}, CAST(quantity_received AS BIGINT), 0L FROM {{acq}})
              WHERE moved_on IS NOT NULL GROUP BY 1, 2)
            WINDOW by_day AS (PARTITION BY sku_id ORDER BY moved_on)))
        """, acq=acq, sales=sales)


def daily_approved_utc_sql(spark: SparkSession, sales: DataFrame) -> DataFrame:
    """Approved units per SKU and UTC date, minus ids also canceled."""
    return spark.sql(f"""
        SELECT sku_id, {_local_date(sales, 'UTC')} AS event_date, sum(quantity) AS approved_qty
        FROM {{s}} s
        WHERE status = '{C.STATUS_APPROVED}'
          AND NOT EXISTS (SELECT 1 FROM {{s}} c
                          WHERE c.status = '{C.STATUS_CANCELED}' AND c.sales_id = s.sales_id)
        GROUP BY 1, 2""", s=sales)


# The depletion report over a daily stock relation {daily} and a forecast
# relation {pred}: table names for a persistent view, DataFrame arguments
# for spark.sql.
INVENTORY_FORECAST_SQL = """
        SELECT sku_id, week_monday, weekly_demand,
               sum(weekly_demand) OVER up_to_week AS weekly_demand_cum,
               stock - sum(weekly_demand) OVER up_to_week AS remaining_inventory
        FROM (SELECT sku_id, CAST(date_trunc('week', event_date) AS DATE) AS week_monday,
                     CAST(ceil(round(sum(CAST(demand_prediction AS DECIMAL(30,12))), 9)) AS BIGINT)
                       AS weekly_demand
              FROM {pred} GROUP BY ALL)
        JOIN (SELECT sku_id, max_by(inventory_eod, event_date) AS stock FROM {daily} GROUP BY ALL)
        USING (sku_id)
        WINDOW up_to_week AS (PARTITION BY sku_id ORDER BY week_monday)
        ORDER BY sku_id, week_monday"""


def inventory_forecast_sql(spark: SparkSession, daily: DataFrame, pred: DataFrame) -> DataFrame:
    """Weekly depletion: latest stock per SKU (``max_by``) minus the running
    sum of rounded-up weekly demand."""
    return spark.sql(INVENTORY_FORECAST_SQL.format(daily="{d}", pred="{p}"), d=daily, p=pred)


def create_inventory_forecast_view(spark: SparkSession, view: str, daily_table: str,
                                   pred_table: str) -> None:
    """The report as a persistent view over the two tables (computed when
    read, like the source view)."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS "
              + INVENTORY_FORECAST_SQL.format(daily=daily_table, pred=pred_table))
