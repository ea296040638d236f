"""Sinks: table writes, typed tables, insert-overwrite, views, publishing.

Writes are whole-table overwrites or appends of a DataFrame; Spark writes
the files from the executors in parallel and commits on the driver. An
overwrite goes to a fresh folder, and the table's name passes to it at the end.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows
from ..operators.windows import narrowed
from ..session import scratch_path, written

SAVE_MODES = ("overwrite", "append")
WRITE_MODES = ("none", "table", "view")


def format_available(spark: SparkSession, fmt: str) -> bool:
    """Whether a table format's data source is on the classpath (Delta,
    Iceberg, ... need their jars); probed by reading a path that does not
    exist: a missing source fails differently from a missing path."""
    try:
        spark.read.format(fmt).load("/nonexistent-stockyard-probe")
    except Exception as e:  # noqa: BLE001 - the message tells the two cases apart
        msg = str(e)
        return not ("DATA_SOURCE_NOT_FOUND" in msg or "Failed to find the data source" in msg)
    return True


def resolve_format(spark: SparkSession, fmt: str = "auto") -> str:
    """``auto``: Delta when its data source is available, else parquet."""
    if fmt != "auto":
        return fmt
    return "delta" if format_available(spark, "delta") else "parquet"


def ensure_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    """CREATE SCHEMA IF NOT EXISTS, with its tables under ``location``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))


# Formats that replace a table's content in one commit of their own.
TRANSACTIONAL = ("delta", "iceberg", "hudi")
PREVIOUS = "stockyard.previous_version"


def table_location(spark: SparkSession, table: str) -> str | None:
    """Where a table's files lie; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next((r["data_type"] for r in rows if r["col_name"] == "Location"), None)


def _home(spark: SparkSession, table: str) -> str:
    """The folder under which a table's versions are kept by default."""
    db, _, name = table.rpartition(".")
    rows = spark.sql(f"DESCRIBE DATABASE {db or spark.catalog.currentDatabase()}").collect()
    base = next(r[1] for r in rows if r[0] in ("Location", "Namespace Location"))
    return f"{base.rstrip('/')}/{name}__versions"


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _sibling(table: str, name: str) -> str:
    return f"{table}__{name}"


def recover_table(spark: SparkSession, table: str) -> bool:
    """Bring back a table whose replacement broke off between taking the old
    entry aside and naming the new one. True if there was something to do."""
    aside = _sibling(table, "old")
    if not spark.catalog.tableExists(aside):
        return False
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {aside}")
    else:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
    return True


def write_overwrite_schema(df: DataFrame, table: str, fmt: str = "parquet",
                           partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (),
                           buckets: int = 0, path: str | None = None) -> None:
    """Replace the table's content and schema with ``df``. With
    ``bucket_by`` / ``buckets`` the table is hash-bucketed (and sorted) on
    those columns, so joins of tables bucketed the same way on the same key
    need no shuffle.

    The rows are first written to a fresh folder (under ``path``, or beside the
    other tables of the schema) and read back; only then does the table's name
    pass to them. A job that fails leaves the old rows in place, and a table may
    be rebuilt from itself. The version before stays on disk for readers that
    have begun with it, until the next overwrite. The table is external: dropping
    it leaves its files. Formats with commits of their own do all this
    themselves."""
    spark = df.sparkSession
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by and buckets:
        w = w.bucketBy(int(buckets), *bucket_by).sortBy(*bucket_by)
    if fmt in TRANSACTIONAL:
        w = w.mode("overwrite").option("overwriteSchema", "true")
        (w.option("path", path) if path else w).saveAsTable(table)
        return
    recover_table(spark, table)
    before = table_location(spark, table)
    oldest = spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{PREVIOUS}'").collect() if before else []
    fresh, stage = f"{(path or _home(spark, table)).rstrip('/')}/v-{uuid.uuid4().hex[:12]}", _sibling(table, "new")
    if spark.catalog.tableExists(stage):  # of a job that broke off
        spark.sql(f"DROP TABLE {stage}")
    w.option("path", fresh).saveAsTable(stage)
    _check_written(spark, df, stage)
    if before:
        spark.sql(f"ALTER TABLE {stage} SET TBLPROPERTIES ('{PREVIOUS}' = '{before}')")
        managed = _is_managed(spark, table)
        aside = _sibling(table, "old")
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
        if not managed:  # a managed table's files would go with it
            spark.sql(f"DROP TABLE {aside}")
        for r in oldest:
            if r["value"] not in (before, fresh):
                _remove(spark, r["value"])
    else:
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def _is_managed(spark: SparkSession, table: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return any(r["col_name"] == "Type" and r["data_type"] == "MANAGED" for r in rows)


def _check_written(spark: SparkSession, df: DataFrame, stage: str) -> None:
    """The new version can be read and has the columns asked for."""
    got = spark.read.table(stage)
    if sorted(c.lower() for c in got.columns) != sorted(c.lower() for c in df.columns):
        raise RuntimeError(f"{stage} has columns {got.columns} instead of {df.columns}")
    got.limit(1).collect()


def save_table(df: DataFrame, table: str, mode: str = "overwrite", fmt: str = "parquet",
               path: str | None = None) -> None:
    """Save as a table with ``overwrite`` (see :func:`write_overwrite_schema`)
    or ``append`` (columns matched by name); anything else is an error. ``path``
    is the folder its files lie under."""
    if mode not in SAVE_MODES:
        raise ValueError(f"save mode must be one of {list(SAVE_MODES)}")
    if mode == "overwrite":
        write_overwrite_schema(df, table, fmt, path=path)
        return
    recover_table(df.sparkSession, table)
    if df.sparkSession.catalog.tableExists(table):
        df.select(*df.sparkSession.read.table(table).columns).write.insertInto(table)
    else:
        write_overwrite_schema(df, table, fmt, path=path)


def set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    if properties:
        kv = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kv})")


def publish_dataset(spark: SparkSession, df: DataFrame, table: str,
                    properties: Mapping[str, str] | None = None, fmt: str = "parquet",
                    bucket_by: Sequence[str] = (), buckets: int = 0, path: str | None = None) -> None:
    """A dataset recomputed from its query: overwrite the table (schema
    included, optionally bucketed) and attach descriptive table properties."""
    write_overwrite_schema(df, table, fmt, bucket_by=bucket_by, buckets=buckets, path=path)
    set_properties(spark, table, properties or {})


# Partition column and property of tables that are published by changed keys.
KEY_PART, KEY_PARTS, KEY_NAME = "key_part", "stockyard.key_parts", "stockyard.key"


def key_part(key: str, parts: int):
    """The partition of a key: a hash of its text, modulo ``parts``."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")


def publish_by_key(spark: SparkSession, df: DataFrame, table: str, key: str, parts: int = 64,
                   properties: Mapping[str, str] | None = None, fmt: str = "parquet",
                   path: str | None = None) -> None:
    """Publish a dataset whole, partitioned by a hash of ``key`` (column
    ``key_part``), so that :func:`publish_changes` can replace parts of it."""
    write_overwrite_schema(df.withColumn(KEY_PART, key_part(key, parts)), table, fmt,
                           partition_by=[KEY_PART], path=path)
    set_properties(spark, table, {**(properties or {}), KEY_PARTS: str(parts), KEY_NAME: key})


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of a table that ``df`` (its columns in order) has
    rows for; the other partitions stay."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark = df.sparkSession
    before = spark.conf.get(mode, "STATIC")
    spark.conf.set(mode, "DYNAMIC")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def publish_changes(spark: SparkSession, rows: DataFrame, keys: DataFrame, table: str) -> list[int]:
    """Replace the rows of the changed ``keys`` (one column, named like the
    table's key) by ``rows``, which holds what these keys give now and may lack
    keys that are gone. Only the partitions of changed keys are rewritten: their
    other rows are taken over as they are, all other files stay. Returns the
    partitions replaced.

    The new partitions are written aside first, then swapped in by one dynamic
    overwrite; a job that fails before that leaves the table as it was, and may
    run again."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if KEY_PARTS not in props:
        raise ValueError(f"{table} is not published by key")
    parts, key = int(props[KEY_PARTS]), props[KEY_NAME]
    held = spark.read.table(table)
    kind = held.schema[key].dataType
    keys = keys.select(F.col(key).cast(kind).alias(key)).where(F.col(key).isNotNull()).distinct() \
        .withColumn(KEY_PART, key_part(key, parts))
    touched = sorted(r[0] for r in keys.select(KEY_PART).distinct().collect())  # at most `parts`
    if not touched:
        return []
    same = narrowed(held.where(F.col(KEY_PART).isin(touched)), keys, key, "left_anti")
    rows = written(rows.withColumn(key, F.col(key).cast(kind)).withColumn(KEY_PART, key_part(key, parts)), "rows")
    new = narrowed(rows, keys, key, "left_semi")
    path = scratch_path(spark, "changes")
    both = same.select(*held.columns).unionByName(new.select(*held.columns))
    total = held.where(F.col(KEY_PART).isin(touched)).count() + rows.count()
    share = -(-total // (len(touched) * windows.TASK_ROWS))  # tasks that share a partition
    if share > 1 or not windows.few(spark, total):
        # Finer shares than tasks, so that these get about as many rows each.
        finer = F.pmod(F.xxhash64(F.lit(KEY_PART), F.col(key).cast("string")), F.lit(4 * share))
        both = both.repartition(share * len(touched), F.col(KEY_PART), finer)
    else:
        both = both.repartition(KEY_PART)
    both.write.parquet(path)
    staged = spark.read.schema(held.schema).parquet(path)
    left = {r[0] for r in staged.select(KEY_PART).distinct().collect()}
    location = table_location(spark, table)
    replace_partitions(staged.select(*held.columns), table)
    for p in sorted(set(touched) - left):  # nothing is left of these
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({KEY_PART} = {p})")
        _remove(spark, f"{location}/{KEY_PART}={p}")
    spark.catalog.refreshTable(table)
    return touched


def create_typed_table(spark: SparkSession, table: str, columns: Sequence[tuple[str, str, str]],
                       comment: str | None = None, fmt: str = "parquet",
                       location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS with column types and comments."""
    cols = ", ".join(f"{n} {t}" + (f" COMMENT '{c}'" if c else "") for n, t, c in columns)
    sql = f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING {fmt}"
    if comment:
        sql += f" COMMENT '{comment}'"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace the whole content of an existing table; columns match by
    position and are cast to the table's types (store assignment)."""
    df.write.insertInto(table, overwrite=True)


def temp_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def create_view(spark: SparkSession, view: str, query: str) -> None:
    """CREATE OR REPLACE VIEW over a SQL query (persistent views may only
    reference tables / persistent views, not temp views)."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")


def write_dataset(spark: SparkSession, df: DataFrame, table: str | None, write_mode: str = "none",
                  save_mode: str = "overwrite", fmt: str = "parquet") -> str | None:
    """Write ``df`` as nothing / a table / a view. A view needs data it can
    reference, so the 'view' mode writes a backing table ``<name>_data`` and
    puts the view on it. Returns the name written, or None."""
    if write_mode not in WRITE_MODES:
        raise ValueError(f"write_mode must be one of {list(WRITE_MODES)}")
    if save_mode not in SAVE_MODES:
        raise ValueError(f"save_mode must be one of {list(SAVE_MODES)}")
    if write_mode == "none":
        return None
    if not table:
        raise ValueError("a table name is required for write_mode != 'none'")
    if "." in table:
        ensure_schema(spark, table.rsplit(".", 1)[0])
    if write_mode == "table":
        save_table(df, table, save_mode, fmt)
    else:
        save_table(df, f"{table}_data", save_mode, fmt)
        create_view(spark, table, f"SELECT * FROM {table}_data")
    return table
