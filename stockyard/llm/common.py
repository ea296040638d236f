"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.session import ensure_checkpoint_dir, scratch_path, ship_package

# Bytes of one Arrow batch handed to a Python task. Very long texts thus come
# in batches of few rows; a single longer text is a batch of its own.
BATCH_BYTES = 12 << 20
# Stands for a null id in row keys; no ordinary id is that low.
NO_ID = -(1 << 62) - 1


def prepare(spark: SparkSession) -> None:
    """Shared folder, package on the workers, bounded Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col: str, n: int):
    """crc32 of the id written as text, modulo ``n`` (a null id counts as 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(0))


def row_key(df: DataFrame, id_col: str, text_col: str) -> tuple:
    """Two longs, ``i`` and ``t``, that name a row: its id and its text. Rows
    equal in both are copies of one another."""
    integral = isinstance(df.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType))
    i = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) if integral else F.xxhash64(id_col)
    return i.alias("i"), F.xxhash64(text_col).alias("t")


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def batches_of(rows, schema: pa.Schema, size: int = 50_000):
    """Arrow batches of at most ``size`` rows from an iterator of tuples."""
    part: list[tuple] = []
    for r in rows:
        part.append(r)
        if len(part) >= size:
            yield to_batch(part, schema)
            part = []
    if part:
        yield to_batch(part, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows to the shared folder and read them back: cuts the
    lineage, survives lost executors, and lets Spark drop the shuffle files of
    the step as soon as it has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    path = scratch_path(spark, name)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


_KEPT: list = ["", None]


def once(token: str, build):
    """A task's model, kept by its Python worker for the next tasks of the same
    call (``token``). A worker holds one model at a time."""
    if _KEPT[0] != token:
        _KEPT[:] = ["", None]
        _KEPT[:] = [token, build()]
    return _KEPT[1]


def forget() -> None:
    """Drop the model of an earlier job; for tasks that need no model."""
    _KEPT[:] = ["", None]
