"""Gold layer: product demand features and order status counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import count_by, product_demand
from ..operators.windows import narrowed
from ..session import written
from ..sinks import publish_changes

# Column types of the typed product-demand feature table.
PRODUCT_DEMAND_DDL = (
    ("order_id", "string", "Order id"),
    ("order_approved_at", "timestamp_ntz", "Order approval time (wall clock of the source)"),
    ("product_id", "string", "Product id"),
    ("product_category_name", "string", "Product category"),
    ("product_name_lenght", "int", "Product name length"),
    ("product_description_lenght", "int", "Product description length"),
    ("product_weight_g", "int", "Product weight"),
    ("product_length_cm", "int", "Product length"),
    ("product_height_cm", "int", "Product height"),
    ("product_width_cm", "int", "Product width"),
    ("quantity", "int", "Quantity"),
    ("total_price", "double", "Total value"),
    ("total_freight_value", "double", "Total freight value"),
)


def product_demand_features(orders: DataFrame, items: DataFrame, products: DataFrame,
                            **kw) -> DataFrame:
    """The feature table of the gold layer (silver inputs)."""
    return product_demand(orders, items, products, **kw)


def order_status_counts(orders: DataFrame) -> DataFrame:
    """Rows per order status."""
    return count_by(orders, "order_status", "count")


def conform(df: DataFrame, ddl=PRODUCT_DEMAND_DDL) -> DataFrame:
    """Project onto a typed table's columns in order (store assignment casts)."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t, _ in ddl])


def touched_orders(items: DataFrame, orders: DataFrame | None = None,
                   order_items: DataFrame | None = None,
                   products: DataFrame | None = None) -> DataFrame:
    """Ids of the orders whose product demand may have changed, given the
    changed rows of silver tables: the orders themselves, those of changed
    items, and those that hold a changed product (``items``: all order items)."""
    found = [df.select("order_id") for df in (orders, order_items) if df is not None]
    if products is not None:
        found.append(items.join(products.select("product_id").distinct(), "product_id", "left_semi")
                     .select("order_id"))
    if not found:
        raise ValueError("no changed table is given")
    out = found[0]
    for df in found[1:]:
        out = out.union(df)
    return out.where(F.col("order_id").isNotNull()).distinct()


def refresh_product_demand(spark: SparkSession, table: str, keys: DataFrame, orders: DataFrame,
                           items: DataFrame, products: DataFrame) -> list[int]:
    """Recompute the product demand of the orders in ``keys`` alone and replace
    their partitions of the published table; returns these. The keys and the
    rows that they select are written aside once, and counted there."""
    keys = written(keys.select("order_id"), "touched")

    def only(df):
        return written(narrowed(df, keys, "order_id", "left_semi"), "touched-rows")

    rows = conform(product_demand_features(only(orders), only(items), products))
    return publish_changes(spark, rows, keys, table)
