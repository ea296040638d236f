"""Stand-in inputs: present the benchmark tables in the entity schemas the
jobs read (orders, order_items, products, customers, sellers, geolocation,
payments, reviews, category translation, sales events, stock acquisitions).

These functions read one table each and only rename, cast, shift and relabel
its columns - the event stand-ins also pick the event types that play sales or
acquisitions - as narrow projections / filters without a shuffle; they do
none of the jobs' work. Some column values play the faults that the rules look
for (unknown states, missing keys, padding, amounts that do not fit), so that
every rule has rows to find. The jobs themselves accept any DataFrame with these
schemas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import format_id


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


# Order status letters of the benchmark's orders table, relabelled to the
# spelling of raw order files (padded; one label that the rules do not know).
ORDER_STATUS_LABELS = {"F": " delivered", "O": "processing ", "P": "canceled"}


def orders(df: DataFrame) -> DataFrame:
    """Orders; low and unspecified priorities play the rows with an unknown
    status, without times and without an id."""
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    label = F.when((status == "F") & (prio == "5-LOW"), "lost") \
        .when(status == "F", ORDER_STATUS_LABELS["F"]) \
        .when(status == "O", ORDER_STATUS_LABELS["O"]) \
        .when(status == "P", ORDER_STATUS_LABELS["P"]).otherwise(status)
    cheap = F.col("o_totalprice") < 3000
    return df.select(
        F.when(~cheap, F.col("o_orderkey")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        label.alias("order_status"),
        F.when(~((prio == "4-NOT SPECIFIED") & (status == "O")), F.col("o_orderdate"))
        .alias("order_purchase_timestamp"),
        F.when(~((prio == "3-MEDIUM") & (status == "O")), F.col("o_orderdate"))
        .alias("order_approved_at"),
        _null("timestamp_ntz").alias("order_delivered_carrier_date"),
        _null("timestamp_ntz").alias("order_delivered_customer_date"),
        _null("timestamp_ntz").alias("order_estimated_delivery_date"),
    )


def order_items(df: DataFrame) -> DataFrame:
    """Order lines; quantities of 1 and 50 play the refunds and the amounts
    that do not fit, the lowest tax rate negative freight."""
    price = F.col("l_extendedprice").cast("decimal(16,2)") * F.when(F.col("l_quantity") == 1, -1) \
        .when(F.col("l_quantity") == 50, 10000).otherwise(1)
    return df.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.when(F.col("l_discount") < 0.1, F.col("l_partkey")).alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.cast("decimal(16,2)").alias("price"),
        (price * (F.col("l_tax").cast("decimal(4,2)") - F.lit(0.01).cast("decimal(4,2)")))
        .cast("decimal(18,4)").alias("freight_value"),
    )


def products(df: DataFrame) -> DataFrame:
    brand = F.col("p_brand")
    return df.select(
        F.when(F.col("p_retailprice") > 905, F.col("p_partkey")).alias("product_id"),
        F.when(brand == "Brand#11", "  ").when(brand == "Brand#12", F.lit(None))
        .otherwise(F.concat(F.lit(" "), F.col("p_type"))).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        _null("int").alias("product_photos_qty"),
        (F.col("p_size") - 3).alias("product_weight_g"),
        (F.length("p_name") - 8).alias("product_length_cm"),
        (F.length("p_brand") - 8).alias("product_height_cm"),
        (F.col("p_size") - 10).alias("product_width_cm"),
    )


def category_translation(df: DataFrame) -> DataFrame:
    return df.select(
        F.when(F.col("p_brand") == "Brand#11", " ").otherwise(F.concat(F.col("p_type"), F.lit(" ")))
        .alias("product_category_name"),
        F.when(F.col("p_size") == 1, "  ").when(F.col("p_size") > 2, F.col("p_brand"))
        .alias("product_category_name_english"),
    )


def customers(df: DataFrame) -> DataFrame:
    return df.select(
        F.when(F.col("c_nationkey") != 3, F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_custkey").cast("string").alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("customer_city"),
        F.substring("c_mktsegment", 1, 2).alias("customer_state"),
    )


def geolocation(df: DataFrame) -> DataFrame:
    return df.select(
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string"))
        .alias("geolocation_zip_code_prefix"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal") / 250 - 30)
        .alias("geolocation_lat"),
        (F.col("c_acctbal") / -200 - 35).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.substring("c_name", 1, 2).alias("geolocation_state"),
    )


def sellers(df: DataFrame) -> DataFrame:
    """Suppliers; nations play the states (one lower-case, one unknown), the
    account balance the zip prefix (short ones included)."""
    nation = F.col("s_nationkey")
    return df.select(
        F.when(nation != 24, F.col("s_suppkey")).alias("seller_id"),
        F.floor(F.abs("s_acctbal")).cast("long").cast("string").alias("seller_zip_code_prefix"),
        F.concat(F.col("s_name"), F.lit("  ")).alias("seller_city"),
        F.when(nation < 5, "sp").when(nation < 8, "XX").when(nation < 16, "SP").otherwise("RJ")
        .alias("seller_state"),
    )


# Order priorities relabelled as payment types (one is no known type).
PAYMENT_LABELS = {"1-URGENT": "credit_card", "2-HIGH": "boleto", "3-MEDIUM": "debit_card",
                  "4-NOT SPECIFIED": " Voucher", "5-LOW": "voucher"}


def order_payments(df: DataFrame) -> DataFrame:
    """One payment per order; dear canceled ones play the amounts that do not
    fit, cheap ones the missing ids and the refunds."""
    total, prio = F.col("o_totalprice"), F.col("o_orderpriority")
    kind = F.lit(None).cast("string")
    for k, v in PAYMENT_LABELS.items():
        kind = F.when(prio == k, v).otherwise(kind)
    return df.select(
        F.when(total >= 3000, F.col("o_orderkey")).alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        kind.alias("payment_type"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_installments"),
        (total * F.when(total < 20000, -1).when(
            (total > 400000) & (F.col("o_orderstatus") == "P"), 10000).otherwise(1))
        .alias("payment_value"),
    )


def order_reviews(df: DataFrame) -> DataFrame:
    """Documents as review messages (line breaks and quotes included); the
    last digit of their length plays the score, the language missing ids."""
    return df.select(
        F.when(F.col("source") != "src7", F.col("doc_id")).alias("review_id"),
        F.when(F.col("lang") != "es", F.col("doc_id")).alias("order_id"),
        F.when(F.col("lang") == "de", "x").otherwise((F.col("n_chars") % 8).cast("string"))
        .alias("review_score"),
        F.concat(F.lit(" "), F.col("source"), F.lit(" ")).alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        _null("timestamp_ntz").alias("review_creation_date"),
        _null("timestamp_ntz").alias("review_answer_timestamp"),
    )


# Benchmark event types relabelled as sales statuses; ``signup`` rows are
# the stock acquisitions.
SALES_EVENT_TYPES = ("purchase", "error", "view", "click")


def _event_time() -> Column:
    """The event's time, moved by 30 days for each user up to 23 times, so
    that the histories lie in different seasons."""
    return F.col("ts") + F.make_dt_interval((F.col("user_id") % 24 * 30).cast("int"))


def sales_events(df: DataFrame) -> DataFrame:
    """Two events with following numbers play one sale and its later state."""
    et = F.col("event_type")
    status = F.when(et == "purchase", "approved").when(et == "error", "canceled") \
        .otherwise("placed")
    return df.filter(et.isin(*SALES_EVENT_TYPES)).select(
        F.col("user_id").alias("sku_id"),
        format_id("S", F.floor(F.col("event_id") / 2)).alias("sales_id"),
        _event_time().alias("event_ts"),
        F.ceil("value").cast("int").alias("quantity"),
        status.alias("status"),
    )


def stock_acquisitions(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type") == "signup").select(
        F.col("user_id").alias("sku_id"),
        format_id("A", "event_id").alias("acquisition_id"),
        _event_time().alias("event_ts"),
        F.lit("planned").alias("reason"),
        F.ceil("value").cast("int").alias("quantity_received"),
    )


def lineitem_sales(df: DataFrame) -> DataFrame:
    """Order lines as sales of a part (SKU) at the ship date, with numeric ids
    (ten to an order); used where a long multi-year history per SKU is wanted.
    Returned lines play the missing statuses, fully taxed and discounted ones
    the missing times."""
    return df.select(
        F.col("l_partkey").alias("sku_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sales_id"),
        F.when(~((F.col("l_tax") > 0.07) & (F.col("l_discount") > 0.09)), F.col("l_shipdate"))
        .alias("event_ts"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_returnflag") != "R", "approved").alias("status"),
    )
