"""End-to-end runs: bronze -> silver -> gold tables, and the inventory line.

Dependencies are explicit function calls; each dataset is one Spark job
(reads its input table, writes its output table), so a lost executor only
re-runs tasks of the current job and finished tables are lineage cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from .. import sinks
from ..operators import forecast as FC
from ..operators import inventory as INV
from ..sources.tables import table_scan
from . import bronze, gold, silver, sql_jobs


# One row of each silver table stands for one of these.
GRAINS = {
    "customers": "customer_id", "geolocation": "geolocation_zip_code_prefix", "orders": "order_id",
    "order_items": "order_id, order_item_id", "order_payments": "order_id, payment_sequential",
    "order_reviews": "review_id", "products": "product_id",
    "product_category_name_translation": "product_category_name", "sellers": "seller_id",
}


def silver_properties(dataset: str) -> dict:
    domain, sub = bronze.DOMAINS[dataset]
    p = {"quality": "silver", "domain": domain, "type": "entity", "grain": GRAINS[dataset],
         "description": f"Cleaned {dataset.replace('_', ' ')} with a data quality flag"}
    if sub:
        p["subdomain"] = sub
    return p


def run_bronze(spark: SparkSession, raw_dir: str, db: str = "bronze", fmt: str = "auto",
               datasets=bronze.DATASETS) -> list[str]:
    sinks.ensure_schema(spark, db)
    fmt = sinks.resolve_format(spark, fmt)
    out = []
    for ds in datasets:
        df = bronze.bronze_dataset(spark, raw_dir, ds)
        sinks.publish_dataset(spark, df, f"{db}.{ds}", dict(bronze.spec(ds).properties), fmt)
        out.append(f"{db}.{ds}")
    return out


# Join keys of the gold product-demand job: with ``buckets`` set, these
# silver tables are bucketed on them, so the daily gold join of orders and
# order items reads co-located buckets instead of shuffling both tables.
BUCKET_KEYS = {"orders": ("order_id",), "order_items": ("order_id",)}


def run_silver(spark: SparkSession, bronze_db: str = "bronze", db: str = "silver",
               fmt: str = "auto", datasets=bronze.DATASETS, buckets: int = 0) -> list[str]:
    sinks.ensure_schema(spark, db)
    fmt = sinks.resolve_format(spark, fmt)
    out = []
    for ds in datasets:
        df = silver.DATASETS[ds](table_scan(spark, f"{bronze_db}.{ds}"))
        keys = BUCKET_KEYS.get(ds, ()) if buckets else ()
        sinks.publish_dataset(spark, df, f"{db}.{ds}", silver_properties(ds), fmt,
                              bucket_by=keys, buckets=buckets)
        out.append(f"{db}.{ds}")
    return out


def run_gold(spark: SparkSession, silver_db: str = "silver", db: str = "gold",
             fmt: str = "auto", location: str | None = None) -> str:
    """Typed feature table, created once, content replaced on every run."""
    sinks.ensure_schema(spark, db)
    fmt = sinks.resolve_format(spark, fmt)
    table = f"{db}.product_demand_features_daily"
    sinks.create_typed_table(spark, table, gold.PRODUCT_DEMAND_DDL,
                             "Product features and the dates of the orders that contain them.",
                             fmt, location)
    df = gold.product_demand_features(table_scan(spark, f"{silver_db}.orders"),
                                      table_scan(spark, f"{silver_db}.order_items"),
                                      table_scan(spark, f"{silver_db}.products"))
    sinks.insert_overwrite(gold.conform(df), table)
    return table


def run_inventory(spark: SparkSession, sales: DataFrame, acquisitions: DataFrame,
                  db: str = "gold", params: C.DemandParams = C.DemandParams.notebook(),
                  horizon: int = 28, fmt: str = "auto") -> dict:
    """Daily stock table, forecast table and the depletion view."""
    sinks.ensure_schema(spark, db)
    fmt = sinks.resolve_format(spark, fmt)
    daily_t, pred_t, view = f"{db}.inventory_daily", f"{db}.demand_prediction_28days", \
        f"{db}.inventory_forecast"
    sinks.save_table(INV.inventory_daily(sales, acquisitions, params.initial_stock, params.zone),
                     daily_t, "overwrite", fmt)
    daily = table_scan(spark, daily_t)
    sinks.save_table(FC.forecast_demand(daily, horizon), pred_t, "overwrite", fmt)
    sql_jobs.create_inventory_forecast_view(spark, view, daily_t, pred_t)
    return {"daily": daily_t, "forecast": pred_t, "view": view}


# Data sets the imperative loader moves (the category translation file is
# not among them).
IMPERATIVE_DATASETS = ("customers", "geolocation", "order_items", "order_payments",
                       "order_reviews", "orders", "products", "sellers")


def run_imperative(spark: SparkSession, raw_dir: str, db: str = "raw_silver", gold_db: str = "gold",
                   fmt: str = "parquet", infer: bool = True, location: str | None = None) -> str:
    """The imperative flavour: each CSV file straight to a table (header,
    inferred types, or with ``infer=False`` the declared ones bound by header
    name; schema overwritten on every load, no cleaning), then the typed product-demand table from those raw
    tables. The status filter is case-insensitive, so the raw lower-case
    spellings are excluded as intended."""
    from ..sources.files import CORRUPT_RECORD, INGESTION_TIME, SOURCE_FILE, batch_load, csv_scan, \
        csv_scan_permissive

    sinks.ensure_schema(spark, db)
    paths = {f"{raw_dir.rstrip('/')}/{bronze.FILES[d]}": d for d in IMPERATIVE_DATASETS}
    items = [(p, f"{db}.{d}") for p, d in paths.items()]

    def read(s, p):
        if infer:
            return csv_scan(s, p)
        return csv_scan_permissive(s, p, bronze.SCHEMAS[paths[p]]) \
            .drop(CORRUPT_RECORD, SOURCE_FILE, INGESTION_TIME)

    batch_load(spark, items, lambda df, t: sinks.write_overwrite_schema(df, t, fmt), read)
    sinks.ensure_schema(spark, gold_db)
    table = f"{gold_db}.product_demand_features_daily"
    sinks.create_typed_table(spark, table, gold.PRODUCT_DEMAND_DDL,
                             "Product features and the dates of the orders that contain them.",
                             fmt, location)
    df = gold.product_demand_features(table_scan(spark, f"{db}.orders"),
                                      table_scan(spark, f"{db}.order_items"),
                                      table_scan(spark, f"{db}.products"))
    sinks.insert_overwrite(gold.conform(df), table)
    return table
