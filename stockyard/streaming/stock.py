"""Daily stock carried on from batch to batch.

Each micro-batch of stock movements becomes daily sums per SKU. A SKU whose
movements lie after its last day goes on from its balance of that day, which a
small state table holds. A movement of an earlier day reopens that day: the
series is taken up from the day before it, and the days from then on are made
again from their sums. Only the months that hold changed days are rewritten.

Layout under the home folder: ``daily/month=...`` (the series), ``state/v=<n>``
(last day and balance of every SKU after batch n), ``stage/v=<n>`` (the months
that batch n replaces) and ``rejected/v=<n>``. A batch is computed into its
stage from what the batch before left, and then swapped in; a batch that runs
again after a failure finds its stage complete and only swaps, or starts anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from .. import config as C
from ..functions.dates import local_date
from ..operators.inventory import MAX_GAP_DAYS, ledger_movements

K = "sku_id"
DAILY = [K, "event_date", "received_qty", "approved_qty", "inventory_eod"]


def movement_stream(spark: SparkSession, sales_dir: str, acq_dir: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of stock movements from two Parquet folders of events."""
    def read(path):
        r = spark.readStream.schema(spark.read.parquet(path).schema)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(path)

    return ledger_movements(read(sales_dir), read(acq_dir))


def _path(spark: SparkSession, name: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(name)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    p, fs = _path(spark, name)
    return fs.exists(p)


def _remove(spark: SparkSession, name: str) -> None:
    p, fs = _path(spark, name)
    fs.delete(p, True)


def _state(spark: SparkSession, home: str, number: int, like: DataFrame) -> DataFrame:
    """State after the last batch before ``number``; empty at the start."""
    p, fs = _path(spark, f"{home}/state")
    done = [int(f.getPath().getName()[2:]) for f in (fs.listStatus(p) if fs.exists(p) else [])
            if f.getPath().getName().startswith("v=")]
    earlier = [n for n in done if n < number and _exists(spark, f"{home}/state/v={n}/_SUCCESS")]
    if earlier:
        return spark.read.parquet(f"{home}/state/v={max(earlier)}")
    return like.select(K, F.col("event_date").alias("last_day"), F.lit(0).cast("long").alias("balance")).limit(0)


def apply_batch(movements: DataFrame, number: int, home: str, initial_stock: int = 0,
                zone: str = C.DEFAULT_ZONE, max_gap_days: int = MAX_GAP_DAYS) -> None:
    """Carry the series under ``home`` on by one batch of movements
    (``sku_id, event_ts, kind, delta``). Movements without a time, and those
    more than ``max_gap_days`` from the SKU's other days, go to ``rejected``
    with a reason."""
    spark = movements.sparkSession
    stage = f"{home}/stage/v={number}"
    if not _exists(spark, f"{stage}/_SUCCESS"):
        _compute(spark, movements, number, home, stage, initial_stock, zone, max_gap_days)
    made = spark.read.parquet(stage)
    if made.isEmpty():
        return
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month") \
        .parquet(f"{home}/daily")
    _remove(spark, f"{home}/stage/v={number - 2}")
    _remove(spark, f"{home}/state/v={number - 2}")


def _compute(spark, movements, number, home, stage, initial_stock, zone, max_gap_days):
    day = local_date(movements, "event_ts", zone)
    sums = movements.groupBy(K, day.alias("event_date")).agg(
        F.sum(F.when(F.col("kind") == 0, F.col("delta")).otherwise(0)).alias("received_qty"),
        F.sum(F.when(F.col("kind") == 1, -F.col("delta")).otherwise(0)).alias("approved_qty"))
    kept = f"{home}/sums/v={number}"
    sums.write.mode("overwrite").parquet(kept)
    sums = spark.read.parquet(kept)
    state = _state(spark, home, number, sums)
    near = sums.join(state.select(K, "last_day"), K, "left")
    # A SKU without a state is measured from its first day in the batch.
    near = near.withColumn("anchor", F.coalesce("last_day", F.min("event_date").over(Window.partitionBy(K))))
    far = F.abs(F.datediff("event_date", "anchor")) > max_gap_days
    reason = F.when(F.col("event_date").isNull(), "no_time").when(far, "far_off_day")
    near = near.withColumn("reason", reason)
    near.where("reason IS NOT NULL").select(K, "event_date", "received_qty", "approved_qty", "reason") \
        .write.mode("overwrite").parquet(f"{home}/rejected/v={number}")
    delta = near.where("reason IS NULL").select(K, "event_date", "received_qty", "approved_qty")
    touched = delta.groupBy(K).agg(F.min("event_date").alias("d0"), F.max("event_date").alias("d1")) \
        .join(state, K, "left") \
        .withColumn("late", F.coalesce(F.col("d0") <= F.col("last_day"), F.lit(False)))
    month = F.date_format("event_date", "yyyy-MM")
    old = None
    if _exists(spark, f"{home}/daily"):
        # Months from the day before the first changed one on.
        start = touched.agg(F.min(F.when(F.col("late"), F.date_sub("d0", 1)).otherwise(
            F.coalesce(F.date_add("last_day", 1), F.col("d0"))))).first()[0]
        if start is not None:
            old = spark.read.option("mergeSchema", "false").parquet(f"{home}/daily") \
                .where(F.col("month") >= F.lit(start.strftime("%Y-%m")))
    base = F.coalesce("balance", F.lit(initial_stock))
    rows = delta
    if old is not None:
        reopened = touched.where("late").select(K, "d0")
        again = old.join(reopened, K)
        rows = delta.union(again.where("event_date >= d0").select(*delta.columns))
        before = again.where(F.col("event_date") == F.date_sub("d0", 1)).select(K, F.col("inventory_eod").alias("before"))
        touched = touched.join(before, K, "left")
        base = F.when(F.col("late"), F.coalesce("before", F.lit(initial_stock))).otherwise(base)
    spans = touched.select(
        K, base.cast("long").alias("base"),
        F.when(F.col("late"), F.col("d0")).otherwise(F.coalesce(F.date_add("last_day", 1), F.col("d0"))).alias("a"),
        F.greatest("d1", F.coalesce("last_day", F.col("d1"))).alias("b"))
    days = spans.select(K, "base", F.explode(F.sequence("a", "b")).alias("event_date"))
    rows = rows.groupBy(K, "event_date").agg(F.sum("received_qty").alias("r"), F.sum("approved_qty").alias("s"))
    w = Window.partitionBy(K).orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    new = days.join(rows, [K, "event_date"], "left").select(
        K, "event_date", "base", F.coalesce("r", F.lit(0)).cast("long").alias("received_qty"),
        F.coalesce("s", F.lit(0)).cast("long").alias("approved_qty"))
    new = new.withColumn("inventory_eod", (F.col("base") + F.sum(F.col("received_qty") - F.col("approved_qty")).over(w))
                         .cast("long")).select(*DAILY)
    kept = f"{home}/made/v={number}"
    new.write.mode("overwrite").parquet(kept)
    new = spark.read.parquet(kept)
    last = new.groupBy(K).agg(F.max_by(F.struct("event_date", "inventory_eod"), "event_date").alias("l")) \
        .select(K, F.col("l.event_date").alias("last_day"), F.col("l.inventory_eod").alias("balance"))
    state.join(last, K, "left_anti").select(*last.columns).union(last) \
        .write.mode("overwrite").parquet(f"{home}/state/v={number}")
    whole = new
    if old is not None:
        # The other rows of the months that are replaced.
        months = new.select(month.alias("month")).distinct()
        starts = spans.select(K, "a")
        stay = old.join(months, "month", "left_semi").join(starts, K, "left") \
            .where("a IS NULL OR event_date < a").select(*DAILY)
        whole = stay.union(new)
    whole.withColumn("month", month).write.mode("overwrite").parquet(stage)
    for name in ("sums", "made"):
        _remove(spark, f"{home}/{name}/v={number}")


def carry_stock(movements: DataFrame, home: str, checkpoint: str, initial_stock: int = 0,
                zone: str = C.DEFAULT_ZONE, max_gap_days: int = MAX_GAP_DAYS) -> StreamingQuery:
    """Start an availableNow run that carries the daily stock under ``home`` on
    by the movements that have arrived (see :func:`movement_stream`)."""
    def handle(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            apply_batch(batch, number, home.rstrip("/"), initial_stock, zone, max_gap_days)

    return movements.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def read_daily(spark: SparkSession, home: str) -> DataFrame:
    """The daily stock series so far."""
    return spark.read.parquet(f"{home.rstrip('/')}/daily").select(*DAILY)
