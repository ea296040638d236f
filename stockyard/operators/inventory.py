"""Per-SKU inventory line: daily movements, end-of-day stock, stock ledger,
audits and restock rules.

Inputs (any DataFrame with these columns):

* sales: ``sku_id, sales_id, event_ts, quantity, status``
* acquisitions: ``sku_id, acquisition_id, event_ts, reason, quantity_received``

``sku_id`` and the ids are declared NOT NULL (as in the event tables'
schemas); joins on them are plain equi-joins.

Event times are instants; ``timestamp_ntz`` columns are read as UTC. Daily
figures use the local calendar date in ``zone`` unless said otherwise.
Everything is keyed by ``sku_id``: raw events are reduced by partial
aggregates before any shuffle, and windows only run over per-SKU daily
series (bounded by the number of days) or over bucketed event prefixes
(see ``windows.running``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions.dates import local_date, utc_date, weekday_index
from ..functions.ids import id_number
from .calendar import coverage_need, demand_calendar
from .filters import anti_join_ids, filter_equals
from .windows import even_buckets, running

K = "sku_id"
# Days without movement (ten years) beyond which a time is taken for corrupt.
MAX_GAP_DAYS = 3_660


def daily_received(acq: DataFrame, zone: str = C.DEFAULT_ZONE) -> DataFrame:
    """Units received per SKU and local day."""
    return acq.groupBy(K, local_date(acq, "event_ts", zone).alias("event_date")) \
        .agg(F.sum("quantity_received").alias("received_qty"))


def daily_approved(sales: DataFrame, zone: str = C.DEFAULT_ZONE) -> DataFrame:
    """Approved units per SKU and local day."""
    s = filter_equals(sales, "status", C.STATUS_APPROVED)
    return s.groupBy(K, local_date(s, "event_ts", zone).alias("event_date")) \
        .agg(F.sum("quantity").alias("approved_qty"))


def daily_approved_utc(sales: DataFrame, id_keys=("sales_id",)) -> DataFrame:
    """Approved units per SKU and UTC date, leaving out sales whose id also
    occurs with status canceled (``NOT IN`` as an anti join)."""
    appr = filter_equals(sales, "status", C.STATUS_APPROVED)
    canc = filter_equals(sales, "status", C.STATUS_CANCELED)
    kept = anti_join_ids(appr, canc, list(id_keys))
    return kept.groupBy(K, utc_date(kept, "event_ts").alias("event_date")) \
        .agg(F.sum("quantity").alias("approved_qty"))


def _daily_movements(sales: DataFrame, acq: DataFrame, zone: str) -> DataFrame:
    """(sku, day, received, approved): both event streams as one union,
    reduced by a single partial + final aggregate."""
    s = filter_equals(sales, "status", C.STATUS_APPROVED)
    sm = s.select(K, local_date(s, "event_ts", zone).alias("event_date"),
                  F.lit(0).cast("bigint").alias("r"), F.col("quantity").cast("bigint").alias("a"))
    am = acq.select(K, local_date(acq, "event_ts", zone).alias("event_date"),
                    F.col("quantity_received").cast("bigint").alias("r"), F.lit(0).cast("bigint").alias("a"))
    return sm.unionByName(am).groupBy(K, "event_date").agg(
        F.sum("r").alias("received_qty"), F.sum("a").alias("approved_qty"))


def sku_ranges(daily: DataFrame, start=None, end=None) -> DataFrame:
    """(sku_id, start, end): explicit dates, or each SKU's first and last
    day in ``daily`` (daily movements or the daily stock table)."""
    if start is not None and end is not None:
        return daily.select(K).distinct().select(
            K, F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return daily.groupBy(K).agg(F.min("event_date").alias("start"), F.max("event_date").alias("end"))


def inventory_daily(sales: DataFrame, acq: DataFrame, initial_stock: int = 0,
                    zone: str = C.DEFAULT_ZONE, start=None, end=None,
                    max_gap_days: int = MAX_GAP_DAYS) -> DataFrame:
    """End-of-day stock per SKU and local day, one row per day of the range
    (days without movement included):

    inventory_eod = initial_stock + running sum(received) - running sum(approved)

    Columns: sku_id, event_date, received_qty, approved_qty, inventory_eod.

    The range is each SKU's first to last day with a movement, or the
    explicit [start, end] for every SKU with a movement inside it. Days
    without movement are filled in from the movement days themselves: each
    movement day expands to itself plus the empty days up to the next one
    (``lead`` + ``explode(sequence)``), so the raw events are scanned and
    shuffled once and no spine join is needed. Both running sums share one
    window over a per-SKU daily series (length = number of days).

    A SKU without movement for more than ``max_gap_days`` fails the job with a
    message naming the dates: one corrupt far-off time would else fill millions
    of days."""
    mv = _daily_movements(sales, acq, zone)
    explicit = start is not None and end is not None
    first = last = None
    if explicit:
        first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
        mv = mv.filter((F.col("event_date") >= first) & (F.col("event_date") <= last))
    wm = Window.partitionBy(K).orderBy("event_date")
    gap_end = F.coalesce(F.date_sub(F.lead("event_date").over(wm), 1),
                         last if explicit else F.col("event_date"))
    gap_start = F.when(F.lag("event_date").over(wm).isNull(), first).otherwise(F.col("event_date")) \
        if explicit else F.col("event_date")
    g = mv.select(K, F.col("event_date").alias("__mv_date"), "received_qty", "approved_qty",
                  gap_start.alias("__g0"), gap_end.alias("__g1"))
    x = g.select(K, "__mv_date", "received_qty", "approved_qty",
                 F.explode(F.sequence("__g0", F.when(
                     F.datediff("__g1", "__g0") <= max_gap_days, F.col("__g1")).otherwise(
                     F.raise_error(F.concat(F.lit("no movement of a SKU between "), F.col("__g0").cast("string"),
                                            F.lit(" and "), F.col("__g1").cast("string"),
                                            F.lit(": check the event times"))).cast("date"))))
                 .alias("event_date"))
    hit = F.col("event_date") == F.col("__mv_date")
    d = x.select(K, "event_date",
                 F.when(hit, F.col("received_qty")).otherwise(F.lit(0)).cast("bigint").alias("received_qty"),
                 F.when(hit, F.col("approved_qty")).otherwise(F.lit(0)).cast("bigint").alias("approved_qty"))
    w = Window.partitionBy(K).orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    eod = F.lit(int(initial_stock)) + F.sum("received_qty").over(w) - F.sum("approved_qty").over(w)
    return d.withColumn("inventory_eod", eod.cast("bigint"))


def eod_negatives(daily: DataFrame) -> DataFrame:
    """Days that end with negative stock."""
    return daily.filter(F.col("inventory_eod") < 0)


# ---------------------------------------------------------------------------
# Event-level ledger
# ---------------------------------------------------------------------------

def ledger_movements(sales: DataFrame, acq: DataFrame) -> DataFrame:
    """Signed stock movements as one union: acquisitions add
    (``kind`` = 0), approved sales subtract (``kind`` = 1).
    Columns: sku_id, event_ts, kind, movement_id, reason, delta."""
    a = acq.select(K, "event_ts", F.lit(0).alias("kind"),
                   F.col("acquisition_id").cast("string").alias("movement_id"),
                   F.col("reason"), F.col("quantity_received").cast("bigint").alias("delta"))
    s = filter_equals(sales, "status", C.STATUS_APPROVED).select(
        K, "event_ts", F.lit(1).alias("kind"), F.col("sales_id").cast("string").alias("movement_id"),
        F.lit("sale").alias("reason"), (-F.col("quantity").cast("bigint")).alias("delta"))
    return a.unionByName(s)


def stock_ledger(sales: DataFrame, acq: DataFrame, initial_stock: int = 0,
                 bucket: str | None = "even") -> DataFrame:
    """Running balance after every movement, per SKU in event order
    (time, then acquisitions before sales, then the id's number). Movements without a
    time come last. ``bucket`` sets the two-level prefix that keeps a hot SKU
    parallel: "even" takes buckets of equal size from the data, so that a busy
    hour is no longer task than others; "hour" and "day" cut by the clock and
    need no pass over the data; None is one window a SKU.

    Columns: sku_id, event_ts, kind, movement_id, reason, delta, balance."""
    m = ledger_movements(sales, acq)
    far = F.lit("9999-12-31 00:00:00").cast(m.schema["event_ts"].dataType)
    order = [F.col("event_ts").asc_nulls_last(), F.col("kind"),
             id_number(m, "movement_id").asc_nulls_first(), F.col("movement_id")]
    if bucket == "even":
        m, name = even_buckets(m, [K], order)
        b = None if name is None else F.col(name)
    else:
        b = None if bucket is None else F.coalesce(F.date_trunc(bucket, "event_ts"), far)
    r = running(m, [K], order, "delta", "__cum", "sum", bucket=b)
    return r.withColumn("balance", (F.lit(int(initial_stock)) + F.col("__cum")).cast("bigint")) \
        .drop("__cum", "__even")


def negative_stock_audit(ledger: DataFrame) -> DataFrame:
    """Ledger rows where the running balance is below zero."""
    return ledger.filter(F.col("balance") < 0)


def stock_conservation(sales: DataFrame, acq: DataFrame, daily: DataFrame,
                       initial_stock: int = 0, zone: str = C.DEFAULT_ZONE) -> DataFrame:
    """Per SKU: initial + sum(received) - sum(approved) must equal the last
    end-of-day stock, and that stock must not be negative.

    Columns: sku_id, total_received, total_approved, final_stock, conserved,
    non_negative."""
    mv = _daily_movements(sales, acq, zone).groupBy(K).agg(
        F.sum("received_qty").alias("total_received"), F.sum("approved_qty").alias("total_approved"))
    last = daily.groupBy(K).agg(F.max_by("inventory_eod", "event_date").alias("final_stock"))
    j = mv.join(last, K, "full")
    expect = F.lit(int(initial_stock)) + F.coalesce("total_received", F.lit(0)) \
        - F.coalesce("total_approved", F.lit(0))
    return j.select(K, "total_received", "total_approved", "final_stock",
                    (expect == F.col("final_stock")).alias("conserved"),
                    (F.col("final_stock") >= 0).alias("non_negative"))


# ---------------------------------------------------------------------------
# Restock rules
# ---------------------------------------------------------------------------

def planned_restock(daily: DataFrame, ranges: DataFrame | None = None,
                    params: C.DemandParams = C.DemandParams()) -> DataFrame:
    """Sunday restock recommendation per SKU, evaluated on observed stock.

    On each Sunday of the range: skip when the stock at the end of the last
    Saturday is above the one of the Saturday before, unless a holiday-window
    date lies in the coming 7 days (Sunday..Saturday); otherwise buy
    max(0, need(Sunday, 7 * weeks) - stock at the start of Sunday). Fewer
    than two recorded Saturdays: always may buy. Rows with quantity > 0.

    ``daily`` is the gap-free daily stock series, so the last Saturday and
    the one before are ``lag`` 1 and 8 of a Sunday in one window (no joins);
    ``ranges`` defaults to the series' own per-SKU first / last day.

    Columns: sku_id, event_date, stock_before, need, increased,
    holiday_ahead, quantity."""
    if ranges is None:
        ranges = sku_ranges(daily)
    days = max(1, int(params.planned_weeks) * 7)
    cal = coverage_need(demand_calendar(ranges, params, lookahead_days=days - 1), days, params)
    # holiday-window dates only exist inside [start, end] (the map is clipped)
    cal = cal.withColumn("__hol", F.col("in_holiday_window").cast("int"))
    w7 = Window.partitionBy(K).orderBy("event_date").rowsBetween(0, 6)
    cal = cal.withColumn("holiday_ahead", F.max("__hol").over(w7) == 1) \
        .filter(F.col("event_date") <= F.col("end"))

    ws = Window.partitionBy(K).orderBy("event_date")
    d = daily.select(K, "event_date",
                     F.lag("inventory_eod", 1).over(ws).alias("stock_before"),
                     F.lag("inventory_eod", 8).over(ws).alias("prev_sat")) \
        .filter(weekday_index("event_date") == 6)
    sun = cal.filter(F.col("weekday") == 6).select(K, "event_date", "need", "holiday_ahead")
    j = sun.join(d, [K, "event_date"], "left")
    increased = F.coalesce(F.col("stock_before") > F.col("prev_sat"), F.lit(False))
    stock = F.coalesce(F.col("stock_before"), F.lit(int(params.initial_stock)))
    qty = F.greatest(F.lit(0), F.col("need") - stock)
    out = j.select(K, "event_date", stock.alias("stock_before"), "need",
                   increased.alias("increased"), "holiday_ahead", qty.cast("bigint").alias("quantity"))
    return out.filter((~F.col("increased") | F.col("holiday_ahead")) & (F.col("quantity") > 0))


def emergency_restock(ledger: DataFrame, ranges: DataFrame,
                      params: C.DemandParams = C.DemandParams()) -> DataFrame:
    """An approved sale that brings the balance to exactly 0 triggers a
    restock 5 minutes later of max(1, need(local day, emergency_days)).

    Columns: sku_id, trigger_id, event_ts, reason, quantity_received."""
    days = max(1, int(params.emergency_days))
    cal = coverage_need(demand_calendar(ranges, params, lookahead_days=days - 1), days, params) \
        .select(K, "event_date", "need")
    z = ledger.filter((F.col("kind") == 1) & (F.col("balance") == 0) & F.col("event_ts").isNotNull())
    z = z.select(K, "movement_id", "event_ts",
                 local_date(z, "event_ts", params.zone).alias("event_date"))
    j = z.join(cal, [K, "event_date"], "left")
    return j.select(K, F.col("movement_id").alias("trigger_id"),
                    (F.col("event_ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(C.EMERGENCY_DELAY_MINUTES)))
                    .alias("event_ts"),
                    F.lit(C.REASON_EMERGENCY).alias("reason"),
                    F.greatest(F.lit(1), F.coalesce("need", F.lit(0))).cast("bigint")
                    .alias("quantity_received"))


def mean_order_qty(sales: DataFrame) -> DataFrame:
    """Mean units of an approved sale per SKU, measured from the events."""
    return filter_equals(sales, "status", C.STATUS_APPROVED).groupBy(K) \
        .agg(F.avg("quantity").alias("mean_qty"))


def fitted_order_qty(sales: DataFrame, xm: int = C.TAIL_START, cap: int = C.TAIL_CAP,
                     least: int = 30) -> DataFrame:
    """Mean units of an approved sale per SKU by a mixture: small sales (below
    ``xm``) and a Pareto tail from ``xm`` on that is cut at ``cap``.

    The tail's index is its maximum-likelihood estimate, sales at the cap
    counting as at least that large. Its mean is alpha xm / (alpha - 1), at most
    nine tenths of the cap, and ten times ``xm`` for an index of 1 or less.
    SKUs with fewer than ``least`` sales have their plain mean. Columns: sku_id,
    n, small_share, tail_index (NULL without a tail), mean_qty."""
    q = F.col("quantity")
    tail, capped = q >= xm, F.least(q, F.lit(cap))
    sums = filter_equals(sales, "status", C.STATUS_APPROVED).where(q.isNotNull()).groupBy(K).agg(
        F.count("*").alias("n"), F.sum(q).alias("all"),
        F.count(F.when(~tail, 1)).alias("small"), F.sum(F.when(~tail, q)).alias("small_sum"),
        F.count(F.when(tail & (q < cap), 1)).alias("open"), F.count(F.when(tail, 1)).alias("large"),
        F.sum(F.when(tail, F.ln(capped / F.lit(float(xm))))).alias("logs"))
    index = F.when((F.col("large") > 0) & (F.col("logs") > 0), F.col("open") / F.col("logs"))
    d = sums.withColumn("tail_index", index)
    mean_tail = F.when(F.col("large") == 0, F.lit(0.0)) \
        .when(F.col("tail_index").isNull(), F.lit(float(xm))) \
        .when(F.col("tail_index") <= 1, F.lit(C.HEAVY_TAIL_FACTOR * xm)) \
        .otherwise(F.least(F.col("tail_index") * xm / (F.col("tail_index") - 1), F.lit(C.TAIL_CAP_SHARE * cap)))
    share = F.col("small") / F.col("n")
    small = F.when(F.col("small") > 0, F.col("small_sum") / F.col("small")).otherwise(F.lit(0.0))
    return d.select(K, "n", share.alias("small_share"), "tail_index",
                    F.when(F.col("n") < least, F.col("all") / F.col("n"))
                    .otherwise(share * small + (F.lit(1.0) - share) * mean_tail).alias("mean_qty"))


def event_ranges(events: DataFrame, zone: str = C.DEFAULT_ZONE) -> DataFrame:
    """(sku_id, start, end): each SKU's first and last local day with an
    event (partial + final min / max aggregate)."""
    d = local_date(events, "event_ts", zone)
    return events.groupBy(K).agg(F.min(d).alias("start"), F.max(d).alias("end"))
