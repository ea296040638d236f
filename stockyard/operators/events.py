"""Sales event hygiene: dedupe and quality flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import id_number
from .late import late_events
from .windows import by_key, even_buckets, running

K = "sku_id"


def dedupe_events(sales: DataFrame, key: str = "sales_id") -> DataFrame:
    """One row per ``key``: the copy with the earliest time (NULL time
    last), then status (NULL last), quantity, SKU.

    The smallest copy is an aggregate with a partial step. Where the session's
    shuffles have too few partitions for the rows, these are dealt by id to as
    many as they need, but for ids with more copies than a task should hold:
    those are reduced inside each task first. Rows with a NULL id are kept
    unchanged."""
    others = [c for c in sales.columns if c != key]
    pick = F.struct(
        F.col("event_ts").isNull().alias("__ts_null"), F.col("event_ts").alias("__ts"),
        F.col("status").isNull().alias("__st_null"), F.col("status").alias("__st"),
        F.col("quantity").alias("__q"), F.col(K).alias("__k"),
        *[F.col(c).alias(c) for c in others])

    def smallest(rows):
        return rows.groupBy(key).agg(F.min(pick).alias("__best")) \
            .select(key, *[F.col(f"__best.{c}").alias(c) for c in others])

    known, nameless = sales.where(F.col(key).isNotNull()), sales.where(F.col(key).isNull())
    out = [smallest(rows) for rows in by_key(known, key)]
    return reduce(DataFrame.unionByName, [*out, nameless.select(key, *others)])


def merge_copies(sales: DataFrame, cap: int = 50, key: str = "sales_id") -> DataFrame:
    """One row per ``key``, each field taken from the copy that can be trusted
    with it:

    * the time: of the known ones that which fits best between the times of the
      ids before and after (of one SKU, in the order of the id numbers; ids whose
      copies agree on their time), ties to the earliest;
    * the status: a known one over NULL;
    * the quantity: one of at most ``cap`` (and known) over others;
    * in both cases of the copy whose time fits best, ties to the earliest, then
      to the smallest value; the other columns together, of the copy with a
      known status and a fitting time.

    Ids that occur once pass through, as do rows with a NULL id. Neighbours come
    from one row an id; the copies of an id are reduced inside each task."""
    others = [c for c in sales.columns if c not in (key, "event_ts", "status", "quantity")]
    ids = sales.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.min("event_ts").alias("__lo"), F.max("event_ts").alias("__hi"),
        F.min(K).alias("__sku"))
    ids = ids.withColumn("__num", id_number(ids, key))
    sure = F.when(F.col("__lo") == F.col("__hi"), F.struct("__num", key, F.col("__lo").alias("t")))
    dealt, bucket = even_buckets(ids.select(key, "__n", "__sku", "__num", sure.alias("__sure")), ["__sku"],
                                 [F.col("__num").asc_nulls_first(), F.col(key)])
    at = None if bucket is None else F.col(bucket)
    order = [F.col("__num").asc_nulls_first(), F.col(key)]
    back = [F.col("__num").desc_nulls_last(), F.col(key).desc()]
    dealt = running(dealt, ["__sku"], order, "__sure", "__before", "max", bucket=at, include_current=False)
    dealt = running(dealt, ["__sku"], back, "__sure", "__after", "min", bucket=None if at is None else -at,
                    include_current=False)
    around = dealt.where("__n > 1").select(key, F.col("__before.t").alias("__before"),
                                           F.col("__after.t").alias("__after"))
    marked = sales.join(around.withColumn("__rep", F.lit(True)), key, "left")
    t = F.col("event_ts")

    def apart(x, y):
        return F.coalesce(F.unix_micros(x.cast("timestamp")) - F.unix_micros(y.cast("timestamp")), F.lit(0))

    misfit = F.greatest(apart(F.col("__before"), t), apart(t, F.col("__after")), F.lit(0))
    fits = [t.isNull().alias("no_t"), misfit.alias("gap"), t.alias("t")]
    unfit = ~F.coalesce(F.col("quantity") <= cap, F.lit(False))
    best = marked.where("__rep").groupBy(key).agg(
        F.min(F.struct(*fits)).alias("time"),
        F.min(F.struct(F.col("status").isNull().alias("none"), *fits, F.col("status").alias("v"))).alias("status"),
        F.min(F.struct(unfit.alias("none"), *fits, F.col("quantity").alias("v"))).alias("quantity"),
        F.min(F.struct(F.col("status").isNull().alias("none"), *fits,
                       *[F.col(c).alias(f"v{i}") for i, c in enumerate(others)])).alias("rest"))
    cells = {key: F.col(key), "event_ts": F.col("time.t"), "status": F.col("status.v"),
             "quantity": F.col("quantity.v")}
    cells |= {c: F.col(f"rest.v{i}") for i, c in enumerate(others)}
    return marked.where("__rep IS NULL").select(*sales.columns).unionByName(
        best.select(*[cells[c].alias(c) for c in sales.columns]))


def event_quality(sales: DataFrame, outlier_threshold: int = 50, order=None,
                  bucket: Column | str | None = "auto", late: str = "running") -> DataFrame:
    """Flag per sales event (first match wins in ``event_quality_flag``):
    null_status, null_event_ts, out_of_order (time below the latest time of
    the SKU's earlier events in id order), quantity_outlier (quantity above
    ``outlier_threshold``), else valid. A +-1 h zone slip looks like a real
    time and is not flagged.

    With ``late="smallest"`` an event is out of order only if it belongs to the
    smallest set of events without which the SKU's times are in order
    (``late.late_events``), so one event stamped too far ahead does not flag all
    that follow it; ``late_kind`` then tells slips of an hour from others.

    Events arrive in the order of their id's number (``order`` replaces it;
    add tie-breakers when ids repeat); ids without a number come first.
    ``bucket`` (non-decreasing along ``order``; "auto" takes buckets of equal
    size from the data, None disables it) makes the running max two-level, see
    ``windows.running``."""
    number = id_number(sales, "sales_id")
    order = order or [number.asc_nulls_first(), F.col("sales_id")]
    kind = []
    if late == "smallest":
        r = late_events(sales, order)
        ooo, kind = F.col("is_late"), ["late_kind"]
    elif late == "running":
        dealt = sales
        if isinstance(bucket, str) and bucket == "auto":
            dealt, name = even_buckets(sales, [K], order)
            bucket = None if name is None else F.col(name)
        r = running(dealt, [K], order, "event_ts", "__prev_max", "max",
                    bucket=bucket, include_current=False)
        ooo = F.coalesce(F.col("event_ts") < F.col("__prev_max"), F.lit(False))
    else:
        raise ValueError("late is 'running' or 'smallest'")
    out = r.select(*sales.columns, *kind,
                   F.col("status").isNull().alias("is_null_status"),
                   F.col("event_ts").isNull().alias("is_null_ts"),
                   ooo.alias("is_out_of_order"),
                   F.coalesce(F.col("quantity") > outlier_threshold, F.lit(False)).alias("is_outlier"))
    flag = F.when(F.col("is_null_status"), "null_status") \
        .when(F.col("is_null_ts"), "null_event_ts") \
        .when(F.col("is_out_of_order"), "out_of_order") \
        .when(F.col("is_outlier"), "quantity_outlier").otherwise("valid")
    return out.withColumn("event_quality_flag", flag)
