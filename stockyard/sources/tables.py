"""Table sources: parquet tables of a data folder, catalog tables, namespace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder (``<dir>/<name>.parquet``).

    Column pruning and filters written later reach the parquet scan
    (``ReadSchema`` / ``PushedFilters`` in the plan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    """Read a catalog table by (possibly qualified) name."""
    return spark.read.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The tables of a schema as a DataFrame (``SHOW TABLES [IN db]``)."""
    if database:
        return spark.sql(f"SHOW TABLES IN {database}")
    return spark.sql("SHOW TABLES")


def session_namespace(spark: SparkSession, database: str | None = None,
                      zone: str | None = "UTC", catalog: str | None = None) -> None:
    """Set current catalog, schema and session time zone (instants are kept in
    UTC). The schema is made if it is missing; the catalog must exist."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        spark.catalog.setCurrentDatabase(database)
    if zone:
        spark.conf.set("spark.sql.session.timeZone", zone)
