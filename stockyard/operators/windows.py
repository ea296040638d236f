"""Running (prefix) aggregates per key that stay parallel under key skew.

A plain ``sum().over(partitionBy(key).orderBy(...))`` sends every row of a
key to one task. When a key can hold a large share of all rows (one hot SKU)
the prefix is computed in two levels instead:

1. every row gets an order-compatible ``bucket`` (e.g. the hour of its
   timestamp, or an id range); per (key, bucket) totals are a partial +
   final aggregate, so that shuffle carries one row per bucket and task;
2. a window over those totals (one row per bucket, small) gives each
   bucket the total of all earlier buckets;
3. the running value inside each (key, bucket) is a window partitioned by
   (key, bucket) - the unit of work is a bucket, not a key - and is
   combined with the bucket's offset through an equi-join.

With ``bucket=None`` the plain one-window form is used; it is right when the
rows per key are bounded (daily or weekly series).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType
from pyspark.sql.window import Window

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


# Rows that one bucket holds on average; buckets at most.
BUCKET_ROWS, MAX_BUCKETS = 500_000, 10_000


def even_buckets(df: DataFrame, keys: Sequence[str], order: Sequence,
                 rows: int | None = None) -> tuple[DataFrame, str | None]:
    """``df`` with a column ``__even`` of about ``rows`` rows each, which never
    decreases along ``order`` within ``keys``, and the column's name.

    The bounds come from the data: rows are dealt by ranges of (keys, order),
    whose splitters Spark takes from a sample, so a key with a third of all rows,
    an hour that holds most events of a key, or one far-off id make no bucket
    longer than others (rows equal in keys and order stay together). The rows are
    written once under the shared folder, so every later step sees the same
    buckets. Few rows need none: then ``df`` and None are returned, and a window
    over the key does."""
    from ..session import scratch_path

    spark, rows = df.sparkSession, rows or BUCKET_ROWS
    n = df.count()
    if n <= 2 * rows:
        return df, None
    parts = min(MAX_BUCKETS, -(-n // rows))
    path = scratch_path(spark, "buckets")
    df.repartitionByRange(parts, *keys, *order).withColumn("__even", F.spark_partition_id()) \
        .write.parquet(path)
    return spark.read.parquet(path), "__even"


# Rows that a task sorts or groups; classes by which the rows of keys are counted.
TASK_ROWS, KEY_CLASSES = 500_000, 4096


def heavy_keys(df: DataFrame, key: str, limit: int) -> tuple[int, DataFrame | None]:
    """The number of rows, and the keys (NULL counts as one) that more than
    ``limit`` rows share, as a small table with the column ``__heavy``, or None.

    Rows are counted by a hash of the key first, so that one row a class and
    task is shuffled; only the keys of overfull classes are counted themselves."""
    from ..session import scratch_path

    kind = F.pmod(F.xxhash64(key), F.lit(KEY_CLASSES))
    sizes = df.groupBy(kind.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, full = sum(r["n"] for r in sizes), [r["k"] for r in sizes if r["n"] > limit]
    if not full:
        return total, None
    path = scratch_path(df.sparkSession, "heavy")
    df.where(kind.isin(full)).groupBy(F.col(key).alias("__heavy")).agg(F.count(F.lit(1)).alias("__n")) \
        .where(F.col("__n") > limit).select("__heavy").write.parquet(path)
    heavy = df.sparkSession.read.schema(df.select(F.col(key).alias("__heavy")).schema).parquet(path)
    return total, None if heavy.isEmpty() else heavy


def of_keys(df: DataFrame, key: str, heavy: DataFrame, how: str) -> DataFrame:
    """The rows of the ``heavy`` keys (``left_semi``) or of the others (``left_anti``)."""
    return df.join(F.broadcast(heavy), F.col(key).eqNullSafe(F.col("__heavy")), how)


def tasks_kept(spark) -> int:
    """The tasks that a shuffle of the session has for any number of bytes: its
    partitions, but where adaptive execution merges those up to a number of bytes,
    which may be millions of short rows, at most as many as it keeps to use all
    cores; one, if it need not."""
    from ..session import _context

    def on(name: str) -> bool:
        return spark.conf.get(f"spark.sql.adaptive.{name}", "true") == "true"

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not (on("enabled") and on("coalescePartitions.enabled")):
        return parts
    sc = _context(spark)
    if sc is None or not on("coalescePartitions.parallelismFirst"):
        return 1
    return min(parts, sc.defaultParallelism)


def few(spark, rows: int) -> bool:
    """Whether the session's own shuffles give no task more rows than it should hold."""
    return -(-rows // TASK_ROWS) <= tasks_kept(spark)


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as ``rows`` rows need, if these
    are more than the session's shuffles keep."""
    if few(df.sparkSession, rows):
        return df.repartition(*keys)
    return df.repartition(-(-rows // TASK_ROWS), *keys)


def by_key(df: DataFrame, key: str) -> list[DataFrame]:
    """``df`` in parts to be grouped by ``key``, each key in one of them: as it
    is, if the session's shuffles have partitions enough for its rows; else the
    rows dealt to more, and those of heavy keys, if any, as they are."""
    total, heavy = heavy_keys(df, key, TASK_ROWS)
    if few(df.sparkSession, total):
        return [df]
    if heavy is None:
        return [dealt(df, total, key)]
    return [dealt(of_keys(df, key, heavy, "left_anti"), total, key), of_keys(df, key, heavy, "left_semi")]


def to_join(left: DataFrame, right: DataFrame, key: str,
            sized_by: DataFrame | None = None) -> list[tuple[DataFrame, DataFrame]]:
    """Pairs of parts of two tables to be joined on ``key``, each key in one of
    them: the tables as they are, if the session's shuffles have partitions
    enough for their rows; else both dealt to more, and the rows of the left
    table's heavy keys, if any, as they are. ``sized_by`` holds the left rows or
    more of them, where the left table is costly to count."""
    total, heavy = heavy_keys(left if sized_by is None else sized_by, key, TASK_ROWS)
    total += right.count()
    if few(left.sparkSession, total):
        return [(left, right)]
    if heavy is None:
        return [(dealt(left, total, key), dealt(right, total, key))]
    rest, hot = ([of_keys(t, key, heavy, how) for t in (left, right)] for how in ("left_anti", "left_semi"))
    return [(dealt(rest[0], total, key), dealt(rest[1], total, key)), (hot[0], hot[1])]


def narrowed(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is among ``keys`` (``left_semi``) or not
    (``left_anti``), both dealt to as many partitions as they need."""
    return reduce(DataFrame.unionByName, [a.join(b.select(key), key, how) for a, b in to_join(df, keys, key)])


def to_group(df: DataFrame, sized_by: DataFrame, *keys: str) -> DataFrame:
    """``df``, already dealt by some of ``keys``, to be grouped by all of them:
    dealt by these too where the session asks for that and its shuffles have too
    few partitions for the rows of ``sized_by``."""
    spark = df.sparkSession
    if spark.conf.get("spark.sql.requireAllClusterKeysForDistribution", "false") != "true":
        return df
    total = sized_by.count()
    return df if few(spark, total) else dealt(df, total, *keys)


def _combine(op: str, offset: Column, inner: Column) -> Column:
    """max / min of the earlier buckets' value and the in-bucket value
    (``greatest`` / ``least`` skip NULLs, like the aggregates)."""
    if op == "max":
        return F.greatest(offset, inner)
    return F.least(offset, inner)


def _filled(c: Column, kind: DataType) -> Column:
    if isinstance(kind, NumericType):
        return F.coalesce(c, F.lit(0).cast(kind))
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.coalesce(c, F.lit("1970-01-01").cast(kind))
    return F.coalesce(c.cast("string"), F.lit(""))


def running(df: DataFrame, keys: Sequence[str], order: Sequence, value: str, out: str,
            op: str = "sum", bucket: Column | None = None,
            include_current: bool = True) -> DataFrame:
    """Add ``out`` = ``op`` of ``value`` over the rows of the same ``keys``
    that come before (and, with ``include_current``, at) each row in
    ``order``. ``order`` must be a total order inside a key for a
    deterministic result; ``bucket`` must be non-decreasing along it
    (NULL comes first)."""
    agg = _AGG[op]
    end = Window.currentRow if include_current else -1
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumn(out, agg(value).over(w))

    b = "__bucket"
    # Two passes over the input (as any distributed prefix scan): the bucket
    # totals are a partial + final aggregate, so their shuffle carries one
    # row per (key, bucket) and task; only the in-bucket window shuffles rows.
    # Keys and bucket get a NULL-free form, so that the join with the offsets
    # is a plain equi-join on what the window is partitioned by and needs no
    # shuffle of its own.
    d = df.withColumn(b, bucket)
    names = []
    for i, c in enumerate([*keys, b]):
        d = d.withColumn(f"__k{i}", _filled(F.col(c), d.schema[c].dataType)) \
            .withColumn(f"__n{i}", F.col(c).isNull())
        names += [f"__k{i}", f"__n{i}"]
    totals = d.groupBy(*names).agg(agg(value).alias("__tot"), F.first(b).alias(b))
    w_prev = Window.partitionBy(*names[:-2]).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*names, agg("__tot").over(w_prev).alias("__off"))
    w_in = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    inner = d.withColumn("__in", agg(value).over(w_in))
    res = inner.join(offsets, names, "inner").drop(*names)
    if op == "sum":
        val = F.when(F.col("__in").isNull() & F.col("__off").isNull(), F.lit(None)) \
            .otherwise(F.coalesce(F.col("__off"), F.lit(0)) + F.coalesce(F.col("__in"), F.lit(0)))
    else:
        val = _combine(op, F.col("__off"), F.col("__in"))
    return res.withColumn(out, val).drop(b, "__in", "__off")
