"""Silver datasets: cleaning only, one bronze dataset each, no joins.

Each function is a narrow plan (Filter -> Project) with no shuffle: a null
key filter that Spark pushes into the scan, cleaned / cast columns, and the
``data_quality_flag``. Lineage columns of the bronze layer are passed
through when present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import (cast_coordinates, cast_money, cast_score,
                                  clean_lower, clean_trim, clean_upper, default_zero)
from ..operators import quality as Q
from ..operators.filters import drop_null_keys

LINEAGE = ("_source_file", "_ingestion_time", "_processed_at")
FLAG = "data_quality_flag"


def _lineage(df: DataFrame) -> list:
    return [F.col(c) for c in LINEAGE if c in df.columns]


def customers(bronze: DataFrame, normalize: bool = False) -> DataFrame:
    df = drop_null_keys(bronze, ["customer_id"])
    return df.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        clean_lower("customer_city").alias("customer_city"),
        clean_upper("customer_state").alias("customer_state"),
        Q.quality_flag(Q.malformed_rules(df) + Q.customer_rules(normalize)).alias(FLAG),
        *_lineage(df))


def geolocation(bronze: DataFrame) -> DataFrame:
    df = drop_null_keys(bronze, ["geolocation_zip_code_prefix"])
    return df.select(
        "geolocation_zip_code_prefix",
        cast_coordinates("geolocation_lat").alias("geolocation_lat"),
        cast_coordinates("geolocation_lng").alias("geolocation_lng"),
        clean_lower("geolocation_city").alias("geolocation_city"),
        clean_upper("geolocation_state").alias("geolocation_state"),
        Q.quality_flag(Q.malformed_rules(df) + Q.geolocation_rules()).alias(FLAG),
        *_lineage(df))


def orders(bronze: DataFrame) -> DataFrame:
    df = drop_null_keys(bronze, ["order_id"])
    return df.select(
        "order_id", "customer_id",
        clean_upper("order_status").alias("order_status"),
        "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
        Q.quality_flag(Q.malformed_rules(df) + Q.order_rules()).alias(FLAG),
        *_lineage(df))


def order_items(bronze: DataFrame) -> DataFrame:
    df = drop_null_keys(bronze, ["order_id", "product_id"])
    return df.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
        cast_money("price").alias("price"),
        cast_money("freight_value").alias("freight_value"),
        Q.quality_flag(Q.malformed_rules(df) + Q.order_item_rules()).alias(FLAG),
        *_lineage(df))


def order_payments(bronze: DataFrame, normalize: bool = False) -> DataFrame:
    df = drop_null_keys(bronze, ["order_id"])
    return df.select(
        "order_id", "payment_sequential",
        clean_lower("payment_type").alias("payment_type"),
        "payment_installments",
        cast_money("payment_value").alias("payment_value"),
        Q.quality_flag(Q.malformed_rules(df) + Q.payment_rules(normalize)).alias(FLAG),
        *_lineage(df))


def order_reviews(bronze: DataFrame) -> DataFrame:
    df = drop_null_keys(bronze, ["review_id"])
    return df.select(
        "review_id", "order_id",
        cast_score("review_score").alias("review_score"),
        clean_trim("review_comment_title").alias("review_comment_title"),
        clean_trim("review_comment_message").alias("review_comment_message"),
        "review_creation_date", "review_answer_timestamp",
        Q.quality_flag(Q.malformed_rules(df) + Q.review_rules()).alias(FLAG),
        *_lineage(df))


PRODUCT_MEASURES = (
    "product_name_lenght", "product_description_lenght", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
)


def products(bronze: DataFrame) -> DataFrame:
    df = drop_null_keys(bronze, ["product_id"])
    return df.select(
        "product_id",
        clean_lower("product_category_name").alias("product_category_name"),
        *[default_zero(m).alias(m) for m in PRODUCT_MEASURES],
        Q.quality_flag(Q.malformed_rules(df) + Q.product_rules()).alias(FLAG),
        *_lineage(df))


def category_translation(bronze: DataFrame) -> DataFrame:
    df = drop_null_keys(bronze, ["product_category_name", "product_category_name_english"])
    return df.select(
        clean_lower("product_category_name").alias("product_category_name"),
        clean_lower("product_category_name_english").alias("product_category_name_english"),
        Q.quality_flag(Q.malformed_rules(df) + Q.category_rules()).alias(FLAG),
        *_lineage(df))


def sellers(bronze: DataFrame, normalize: bool = False) -> DataFrame:
    df = drop_null_keys(bronze, ["seller_id"])
    return df.select(
        "seller_id", "seller_zip_code_prefix",
        clean_lower("seller_city").alias("seller_city"),
        clean_upper("seller_state").alias("seller_state"),
        Q.quality_flag(Q.malformed_rules(df) + Q.seller_rules(normalize)).alias(FLAG),
        *_lineage(df))


# dataset name -> silver function
DATASETS = {
    "customers": customers,
    "geolocation": geolocation,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "product_category_name_translation": category_translation,
    "sellers": sellers,
}
