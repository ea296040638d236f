"""Bronze datasets: raw CSV files read as-is plus lineage columns.

Each dataset is one CSV file (or folder) with a header row, read in
PERMISSIVE mode with an explicit schema (no inference pass; zip prefixes
stay strings with their leading zeros). Timestamps in the files carry no
zone, so they are read as ``timestamp_ntz`` wall-clock values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import csv_scan_permissive, lineage_columns


@dataclass(frozen=True)
class BronzeSpec:
    file: str
    schema: str
    multiline: bool = False
    properties: tuple = ()


# Raw file names of the e-commerce data set.
FILES = {
    "customers": "olist_customers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "order_payments": "olist_order_payments_dataset.csv",
    "order_reviews": "olist_order_reviews_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "product_category_name_translation": "product_category_name_translation.csv",
}

TS = "timestamp_ntz"

SCHEMAS = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                 "customer_city string, customer_state string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
                   "geolocation_city string, geolocation_state string",
    "orders": f"order_id string, customer_id string, order_status string, order_purchase_timestamp {TS}, "
              f"order_approved_at {TS}, order_delivered_carrier_date {TS}, "
              f"order_delivered_customer_date {TS}, order_estimated_delivery_date {TS}",
    "order_items": f"order_id string, order_item_id int, product_id string, seller_id string, "
                   f"shipping_limit_date {TS}, price double, freight_value double",
    "order_payments": "order_id string, payment_sequential int, payment_type string, "
                      "payment_installments int, payment_value double",
    "order_reviews": f"review_id string, order_id string, review_score string, review_comment_title string, "
                     f"review_comment_message string, review_creation_date {TS}, review_answer_timestamp {TS}",
    "products": "product_id string, product_category_name string, product_name_lenght int, "
                "product_description_lenght int, product_photos_qty int, product_weight_g int, "
                "product_length_cm int, product_height_cm int, product_width_cm int",
    "product_category_name_translation": "product_category_name string, product_category_name_english string",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
}

DOMAINS = {
    "customers": ("customers", None), "geolocation": ("customers", "geolocation"),
    "orders": ("orders", None), "order_items": ("orders", "items"),
    "order_payments": ("orders", "payments"), "order_reviews": ("orders", "reviews"),
    "products": ("products", None), "product_category_name_translation": ("products", "categories"),
    "sellers": ("sellers", None),
}


def spec(dataset: str) -> BronzeSpec:
    domain, sub = DOMAINS[dataset]
    props = {"quality": "bronze", "domain": domain, "source_system": "csv",
             "layer": "raw_ingestion", "update_frequency": "daily"}
    if sub:
        props["subdomain"] = sub
    return BronzeSpec(FILES[dataset], SCHEMAS[dataset], multiline=(dataset == "order_reviews"),
                      properties=tuple(props.items()))


def bronze_dataset(spark: SparkSession, raw_dir: str, dataset: str,
                   path: str | Sequence[str] | None = None, schema: str | None = None) -> DataFrame:
    """Raw rows of one data set plus ``_source_file``, ``_ingestion_time``,
    ``_processed_at``, from ``path`` (a file, a folder or a list of them) or the
    data set's file in ``raw_dir``. ``schema=None`` uses the explicit schema above; pass
    ``schema=""`` to infer types from the file instead."""
    s = spec(dataset)
    p = path or f"{raw_dir.rstrip('/')}/{s.file}"
    sch = s.schema if schema is None else (schema or None)
    return lineage_columns(csv_scan_permissive(spark, p, sch, multiline=s.multiline))


DATASETS = tuple(FILES)
