"""Aggregations of the gold layer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .filters import filter_not_in
from .windows import to_group, to_join

PRODUCT_ATTRS = (
    "product_category_name", "product_name_lenght", "product_description_lenght",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
)


def count_by(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Row count per value (partial count map-side, so a hot value costs one
    row per task in the shuffle)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def product_demand(orders: DataFrame, items: DataFrame, products: DataFrame,
                   excluded_statuses: Sequence[str] = C.EXCLUDED_ORDER_STATUSES) -> DataFrame:
    """Demand per order x product with the product's attributes.

    orders (status not excluded, approval time known) JOIN items ON order_id
    JOIN products ON product_id, grouped by order, approval time, product and
    its seven attributes:

    * ``quantity`` = max(order_item_id) - kept as defined by the source
      pipeline (a line position, so it over-counts a product whose lines do
      not start at 1); ``line_count`` = count(*) is the number of lines.
    * ``total_price`` / ``total_freight_value`` = sums (decimal, exact).

    Plan: the status / NULL filter and the column pruning reach the orders
    scan. Lines are reduced per order, approval time and product right after
    the join with the orders, so the join with the products (a few products
    can hold most lines) sees one narrow row for each of these, and nothing is
    shuffled by the product's attributes. Products are reduced to one row per
    id and attribute values with its number of copies, by which sums and
    counts are multiplied, as a join with each copy would. Where the session's
    shuffles have too few partitions for the rows, both joins deal them to more
    (``windows.to_join``). The status test is
    case- and blank-insensitive, so it works on raw (lower-case) and silver
    (upper-case) spellings.
    """
    o = filter_not_in(orders, "order_status", excluded_statuses) \
        .filter(F.col("order_approved_at").isNotNull()) \
        .select("order_id", "order_approved_at")
    i = items.select("order_id", "product_id", "order_item_id", "price", "freight_value")
    line = ("order_id", "order_approved_at", "product_id")
    bought = _all([to_group(a.join(b, "order_id", "inner"), i, *line).groupBy(*line).agg(
        F.max("order_item_id").alias("quantity"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"),
        F.count(F.lit(1)).alias("line_count")) for b, a in to_join(i, o, "order_id")])
    times = {c: bought.schema[c].dataType for c in ("total_price", "total_freight_value", "line_count")}
    kinds = [(a, b.groupBy("product_id", *PRODUCT_ATTRS).agg(F.count(F.lit(1)).alias("__copies")))
             for a, b in to_join(bought, products.select("product_id", *PRODUCT_ATTRS), "product_id", i)]
    return _all([a.join(p, "product_id", "inner").select(
        *line, *PRODUCT_ATTRS, "quantity",
        *[(F.col(c) * F.col("__copies")).cast(t).alias(c) for c, t in times.items()]) for a, p in kinds])


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
