"""Registered queries, part 2: calendar, demand, restock, forecast and event
hygiene. Importing this module registers them in ``registry.QUERIES``."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.cleaning import rename_cast, round_half_up
from ..functions.dates import date_spine
from ..operators import arima as AR
from ..operators import calendar as CAL
from ..operators import events as EV
from ..operators import forecast as FC
from ..operators import inventory as INV
from ..operators.filters import latest_rows
from ..sources import standins as S
from ..sources.tables import read_table
from .registry import (ORACLE, QUERIES, PARAMS,  # noqa: F401 (re-exported)
                       SQL_DAILY, SQL_LEDGER, SQL_RANGES, SQL_SALES, _ld,
                       daily, daily_table, ledger, ranges, register, sales)

K = "sku_id"

# ---------------------------------------------------------------------------
# Holiday calendar over per-part ranges of the order lines (multi-year)
# ---------------------------------------------------------------------------


def sales_range(spark, sf_dir):
    """One row: first and last ship date (UTC) of all order lines."""
    return INV.sku_ranges(INV.event_ranges(
        S.lineitem_sales(read_table(spark, sf_dir, "lineitem")), zone="UTC")
        .select(F.lit(0).alias(K), F.explode(F.array("start", "end")).alias("event_date")))


SQL_SALES_RANGE = """SELECT 0 AS sku_id, min(CAST(l_shipdate AS DATE)) AS "start",
  max(CAST(l_shipdate AS DATE)) AS "end" FROM lineitem WHERE NOT (l_tax > 0.07 AND l_discount > 0.09)"""


def _sql_holidays(ranges_sql: str) -> str:
    bf = ("(last_day(make_date(year, 11, 1)) - CAST((isodow(last_day(make_date(year, 11, 1))) - 5 + 7)"
          " % 7 AS INTEGER))")

    def second_sunday(m):
        first = f"make_date(year, {m}, 1)"
        return f"({first} + CAST((7 - isodow({first})) % 7 AS INTEGER) + 7)"

    rows = [("natal", "make_date(year, 12, 25)"), ("dia_das_criancas", "make_date(year, 10, 12)"),
            ("dia_dos_namorados", "make_date(year, 6, 12)"), ("dia_das_maes", second_sunday(5)),
            ("dia_dos_pais", second_sunday(8)), ("black_friday", bf),
            ("cyber_monday", f"({bf} + CAST(8 - isodow({bf}) AS INTEGER))")]
    y = f"""(SELECT sku_id, "start", "end", unnest(generate_series(year("start"), year("end"))) AS year
            FROM ({ranges_sql}))"""
    return "\nUNION ALL\n".join(
        f"""SELECT sku_id, "start", "end", CAST(year AS INTEGER) AS year, '{n}' AS holiday,
  CAST({e} AS DATE) AS holiday_date FROM {y}""" for n, e in rows)


def _sql_spec(spec) -> str:
    return "VALUES " + ", ".join(f"('{n}', CAST({float(m)} AS DOUBLE), {int(a)}, {int(b)})"
                                 for n, (m, a, b) in spec.items())


def _sql_multiplier(ranges_sql: str, spec) -> str:
    return f"""WITH cal AS ({_sql_holidays(ranges_sql)}),
sp(name, mult, pre, post) AS ({_sql_spec(spec)}),
d AS (SELECT sku_id, "start", "end", mult,
             CAST(holiday_date + CAST(unnest(generate_series(-pre, post)) AS INTEGER) AS DATE) AS event_date
      FROM cal JOIN sp ON cal.holiday = sp.name)
SELECT sku_id, event_date, greatest(CAST(1.0 AS DOUBLE), max(mult)) AS holiday_mult
FROM d WHERE event_date BETWEEN "start" AND "end" GROUP BY sku_id, event_date"""


@register("holiday_calendar", f"""SELECT year, holiday, holiday_date
FROM ({_sql_holidays(SQL_SALES_RANGE)})""")
def q_holiday_calendar(spark, sf_dir):
    """Commercial holidays of every year of sales, one row for each."""
    return CAL.holiday_calendar(sales_range(spark, sf_dir), keys=()).drop("start", "end")


@register("holiday_multiplier", f"""SELECT event_date, holiday_mult
FROM ({_sql_multiplier(SQL_SALES_RANGE, C.NOTEBOOK_HOLIDAYS)})""")
def q_holiday_multiplier(spark, sf_dir):
    """Holiday demand multiplier of every date of sales that has one."""
    return CAL.holiday_multiplier(sales_range(spark, sf_dir), C.NOTEBOOK_HOLIDAYS, keys=())


# ---------------------------------------------------------------------------
# Expected demand and coverage need over per-SKU event ranges
# ---------------------------------------------------------------------------

_WF = "[" + ", ".join(repr(float(x)) for x in PARAMS.weekday_factors) + "]"


def _sql_calendar(ranges_sql: str, lookahead: int) -> str:
    return f"""WITH rg AS ({ranges_sql}),
mult AS ({_sql_multiplier(ranges_sql, PARAMS.holidays)}),
sp AS (SELECT sku_id, "start", "end",
         CAST(unnest(generate_series("start", "end" + {lookahead}, INTERVAL 1 DAY)) AS DATE) AS event_date
       FROM rg)
SELECT sp.sku_id, "start", "end", sp.event_date, CAST(isodow(sp.event_date) - 1 AS INTEGER) AS weekday,
  COALESCE(m.holiday_mult, CAST(1.0 AS DOUBLE)) AS holiday_mult, m.holiday_mult IS NOT NULL AS in_holiday_window,
  {float(PARAMS.base_daily)} * pow({1.0 + PARAMS.monthly_rate}, datediff('day', "start", sp.event_date)
    / {C.DAYS_PER_MONTH}) * {_WF}[isodow(sp.event_date)] * COALESCE(m.holiday_mult, 1.0) AS expected_orders
FROM sp LEFT JOIN mult m ON m.sku_id = sp.sku_id AND m.event_date = sp.event_date"""


def _sql_need(cal_sql: str, n: int) -> str:
    term = (f"CAST(expected_orders * {PARAMS.approval_share} * {PARAMS.mean_qty!r} "
            "AS DECIMAL(28,9))")
    return f"""SELECT *, CAST(greatest(0, ceil(sum({term}) OVER (PARTITION BY sku_id ORDER BY event_date
  ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING))) AS BIGINT) AS need FROM ({cal_sql})"""


@register("expected_demand", f"""SELECT sku_id, "start", "end", event_date, weekday, holiday_mult,
  in_holiday_window, floor(expected_orders * 1000000.0 + 0.5) / 1000000.0 AS expected_orders
FROM ({_sql_calendar(SQL_RANGES, 0)})""")
def q_expected_demand(spark, sf_dir):
    """Expected orders per SKU and day (trend x weekday x holiday)."""
    return CAL.demand_calendar(ranges(spark, sf_dir), PARAMS) \
        .withColumn("expected_orders", round_half_up("expected_orders", 6))


_PW = PARAMS.planned_weeks * 7


@register("coverage_need", f"""SELECT sku_id, event_date, need
FROM ({_sql_need(_sql_calendar(SQL_RANGES, _PW - 1), _PW)}) WHERE event_date <= "end" """)
def q_coverage_need(spark, sf_dir):
    """Units needed to cover the next 21 days, per SKU and day."""
    cal = CAL.demand_calendar(ranges(spark, sf_dir), PARAMS, lookahead_days=_PW - 1)
    return CAL.coverage_need(cal, _PW, PARAMS).filter(F.col("event_date") <= F.col("end")) \
        .select(K, "event_date", "need")


@register("mean_order_qty", f"""SELECT sku_id, floor(avg(quantity) * 1000000.0 + 0.5) / 1000000.0 AS mean_qty
FROM ({SQL_SALES}) WHERE status = 'approved' GROUP BY sku_id""")
def q_mean_order_qty(spark, sf_dir):
    """Observed mean approved quantity per SKU (the demand rules' mean_qty)."""
    return INV.mean_order_qty(sales(spark, sf_dir)) \
        .withColumn("mean_qty", round_half_up("mean_qty", 6))


SQL_LINE_SALES = """SELECT l_partkey AS sku_id, l_orderkey * 10 + l_linenumber AS sales_id,
  CASE WHEN NOT (l_tax > 0.07 AND l_discount > 0.09) THEN l_shipdate END AS event_ts,
  CAST(trunc(l_quantity) AS INTEGER) AS quantity,
  CASE l_returnflag WHEN 'R' THEN NULL ELSE 'approved' END AS status, l_orderkey, l_linenumber
FROM lineitem"""


def line_sales(spark, sf_dir):
    return S.lineitem_sales(read_table(spark, sf_dir, "lineitem"))


@register("fitted_order_qty", f"""WITH s AS (
  SELECT sku_id, count(*) AS n, sum(quantity) AS total, count(*) FILTER (quantity < 4) AS small,
    sum(quantity) FILTER (quantity < 4) AS small_sum, count(*) FILTER (quantity >= 4) AS large,
    count(*) FILTER (quantity >= 4 AND quantity < 50) AS open,
    sum(ln(least(quantity, 50) / 4.0::DOUBLE)) FILTER (quantity >= 4) AS logs
  FROM ({SQL_LINE_SALES}) WHERE status = 'approved' AND quantity IS NOT NULL GROUP BY sku_id),
a AS (SELECT *, CASE WHEN large > 0 AND logs > 0 THEN open / logs END AS alpha, small / n AS share FROM s),
m AS (
  SELECT *, CASE WHEN large = 0 THEN 0.0::DOUBLE WHEN alpha IS NULL THEN 4.0::DOUBLE
    WHEN alpha <= 1 THEN 40.0::DOUBLE ELSE least(alpha * 4 / (alpha - 1), 45.0::DOUBLE) END AS tail,
    CASE WHEN small > 0 THEN small_sum / small ELSE 0.0::DOUBLE END AS few FROM a)
SELECT sku_id, n, share AS small_share, floor(alpha * 1000000.0 + 0.5) / 1000000.0 AS tail_index,
  floor((CASE WHEN n < 15 THEN total / n ELSE share * few + (1.0::DOUBLE - share) * tail END)
    * 1000000.0 + 0.5) / 1000000.0 AS mean_qty FROM m""")
def q_fitted_order_qty(spark, sf_dir):
    """Mean order quantity per part by a mixture of small sales and a tail."""
    return INV.fitted_order_qty(line_sales(spark, sf_dir), least=15) \
        .withColumn("tail_index", round_half_up("tail_index", 6)) \
        .withColumn("mean_qty", round_half_up("mean_qty", 6))


SQL_PLANNED = f"""WITH cal AS ({_sql_need(_sql_calendar(SQL_RANGES, _PW - 1), _PW)}),
c AS (SELECT sku_id, event_date, weekday, need,
        max(CAST(in_holiday_window AS INTEGER)) OVER (PARTITION BY sku_id ORDER BY event_date
            ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) = 1 AS holiday_ahead, "end" FROM cal),
d AS ({SQL_DAILY}),
sat AS (SELECT sku_id, event_date + 1 AS event_date, inventory_eod AS last_sat,
          lag(inventory_eod) OVER (PARTITION BY sku_id ORDER BY event_date) AS prev_sat
        FROM d WHERE isodow(event_date) = 6),
pd AS (SELECT sku_id, event_date + 1 AS event_date, inventory_eod AS stock_before FROM d),
j AS (SELECT c.sku_id, c.event_date,
        COALESCE(pd.stock_before, {PARAMS.initial_stock}) AS stock_before, c.need,
        COALESCE(sat.last_sat > sat.prev_sat, false) AS increased, c.holiday_ahead
      FROM c LEFT JOIN sat ON sat.sku_id = c.sku_id AND sat.event_date = c.event_date
             LEFT JOIN pd ON pd.sku_id = c.sku_id AND pd.event_date = c.event_date
      WHERE c.weekday = 6 AND c.event_date <= c."end")
SELECT sku_id, event_date, stock_before, need, increased, holiday_ahead,
  CAST(greatest(0, need - stock_before) AS BIGINT) AS quantity
FROM j WHERE (NOT increased OR holiday_ahead) AND greatest(0, need - stock_before) > 0"""


@register("planned_restock", SQL_PLANNED)
def q_planned_restock(spark, sf_dir):
    """Sunday restock recommendations per SKU on observed daily stock."""
    return INV.planned_restock(daily_table(spark, sf_dir), None, PARAMS)


_ED = PARAMS.emergency_days


@register("emergency_restock", f"""WITH l AS ({SQL_LEDGER}),
cal AS ({_sql_need(_sql_calendar(SQL_RANGES, _ED - 1), _ED)}),
z AS (SELECT sku_id, movement_id, event_ts, {_ld('event_ts')} AS event_date FROM l
      WHERE kind = 1 AND balance = 0 AND event_ts IS NOT NULL)
SELECT z.sku_id, z.movement_id AS trigger_id, z.event_ts + INTERVAL 5 MINUTE AS event_ts,
  'emergency' AS reason, CAST(greatest(1, COALESCE(cal.need, 0)) AS BIGINT) AS quantity_received
FROM z LEFT JOIN cal ON cal.sku_id = z.sku_id AND cal.event_date = z.event_date""")
def q_emergency_restock(spark, sf_dir):
    """Restock 5 minutes after a sale empties the stock."""
    return INV.emergency_restock(ledger(spark, sf_dir), ranges(spark, sf_dir), PARAMS)


# ---------------------------------------------------------------------------
# Forecast and weekly depletion
# ---------------------------------------------------------------------------

H = 28

SQL_FINE = f"""WITH d AS ({SQL_DAILY}),
h AS (SELECT sku_id, event_date, CAST(approved_qty AS HUGEINT) AS y,
        CAST(datediff('day', DATE '1970-01-01', event_date) AS HUGEINT) AS t,
        isodow(event_date) - 1 AS weekday FROM d),
pos AS (SELECT sku_id, weekday, CAST(count(*) AS HUGEINT) AS c, sum(y) AS sy, sum(t) AS st,
          sum(t * t) AS stt, sum(t * y) AS sty, max(event_date) AS last_k
        FROM h GROUP BY sku_id, weekday),
tot AS (SELECT sku_id, max(last_k) AS last_date, sum(c) AS n, sum(sy) AS sy_all, sum(st) AS st_all,
          sum(stt) AS stt_all, sum(sty) AS sty_all FROM pos GROUP BY sku_id),
fit AS (SELECT sku_id, last_date, n, sy_all, st_all, n * stt_all - st_all * st_all AS dd,
          n * sty_all - st_all * sy_all AS bn FROM tot),
fut AS (SELECT *, CAST(unnest(generate_series(last_date + 1, last_date + {H}, INTERVAL 1 DAY)) AS DATE)
          AS event_date FROM fit),
j AS (SELECT f.sku_id, f.event_date, f.n, f.sy_all, f.st_all, f.dd, f.bn,
        CAST(datediff('day', DATE '1970-01-01', f.event_date) AS HUGEINT) AS t, p.c, p.sy, p.st
      FROM fut f LEFT JOIN pos p ON p.sku_id = f.sku_id AND p.weekday = isodow(f.event_date) - 1),
q AS (SELECT sku_id, event_date,
        greatest(CASE WHEN dd = 0 THEN (CASE WHEN c IS NOT NULL THEN sy ELSE sy_all END)
                      WHEN c IS NOT NULL THEN sy * dd + bn * (t * c - st)
                      ELSE sy_all * dd - bn * st_all + n * bn * t END, 0) AS num,
        CASE WHEN dd = 0 THEN (CASE WHEN c IS NOT NULL THEN c ELSE n END)
             WHEN c IS NOT NULL THEN c * dd ELSE n * dd END AS den
      FROM j)
SELECT sku_id, event_date, (2 * num * 1000000000000 + den) // (2 * den) AS fine FROM q"""

SQL_FORECAST = f"""SELECT sku_id, event_date,
  CAST((fine + 50000000) // 100000000 AS DOUBLE) / 10000.0 AS demand_prediction FROM ({SQL_FINE})"""


def forecast(spark, sf_dir, d=None):
    """Unrounded predictions."""
    return FC.forecast_demand(d if d is not None else daily(spark, sf_dir), horizon=H)


@register("forecast_demand", SQL_FORECAST)
def q_forecast_demand(spark, sf_dir):
    """28-day demand forecast per SKU (native trend + weekday model)."""
    return FC.rounded(forecast(spark, sf_dir))


@register("forecast_demand_grouped", SQL_FORECAST)
def q_forecast_demand_grouped(spark, sf_dir):
    """Same forecast through the pluggable applyInPandas path."""
    return FC.forecast_demand_grouped(daily(spark, sf_dir), horizon=H)


def supplier_months(spark, sf_dir):
    """Monthly units of every supplier's order lines."""
    return AR.monthly_demand(read_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias(K), F.col("l_shipdate").alias("event_ts"),
        F.col("l_quantity").cast("long").alias("quantity")))


@register("monthly_demand", """WITH q AS (
  SELECT l_suppkey AS sku_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS event_date,
    sum(CAST(trunc(l_quantity) AS BIGINT)) AS q FROM lineitem GROUP BY ALL),
spine AS (
  SELECT sku_id, CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 MONTH)) AS DATE)
    AS event_date FROM q GROUP BY sku_id)
SELECT sku_id, event_date, CAST(coalesce(q, 0) AS BIGINT) AS approved_qty
FROM spine LEFT JOIN q USING (sku_id, event_date)""")
def q_monthly_demand(spark, sf_dir):
    """Monthly units per supplier, months without a line included."""
    return supplier_months(spark, sf_dir)


@register("forecast_arima", None)
def q_forecast_arima(spark, sf_dir):
    """Twelve months ahead per supplier by seasonal ARIMA (m = 12), orders
    searched stepwise by AIC."""
    return AR.forecast_arima(supplier_months(spark, sf_dir), horizon=12, months=True)


SQL_NANO = f"""SELECT sku_id, CAST(date_trunc('week', event_date) AS DATE) AS week_monday,
  CAST((sum(fine) + 500) // 1000 AS HUGEINT) AS nano FROM ({SQL_FINE}) GROUP BY ALL"""
SQL_WEEKLY = f"""SELECT sku_id, week_monday, CAST((nano + 999999999) // 1000000000 AS BIGINT) AS weekly_demand
FROM ({SQL_NANO})"""

SQL_CUM = f"""SELECT sku_id, week_monday, weekly_demand,
  CAST(sum(weekly_demand) OVER (PARTITION BY sku_id ORDER BY week_monday
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS weekly_demand_cum
FROM ({SQL_WEEKLY})"""


@register("weekly_demand", SQL_WEEKLY)
def q_weekly_demand(spark, sf_dir):
    """Rounded-up forecast demand per SKU and week."""
    return FC.weekly_demand(forecast(spark, sf_dir))


@register("cumulative_demand", SQL_CUM)
def q_cumulative_demand(spark, sf_dir):
    """Running weekly demand per SKU."""
    return FC.cumulative_demand(FC.weekly_demand(forecast(spark, sf_dir)))


@register("inventory_forecast", f"""WITH d AS ({SQL_DAILY}),
inv AS (SELECT sku_id, inventory_eod AS initial_inventory FROM d
        WHERE (sku_id, event_date) IN (SELECT (sku_id, max(event_date)) FROM d GROUP BY sku_id))
SELECT c.sku_id, week_monday, weekly_demand, weekly_demand_cum,
  initial_inventory - weekly_demand_cum AS remaining_inventory
FROM ({SQL_CUM}) c JOIN inv ON inv.sku_id = c.sku_id""")
def q_inventory_forecast(spark, sf_dir):
    """Latest stock minus cumulative forecast demand per SKU and week."""
    d = daily_table(spark, sf_dir)
    return FC.inventory_forecast(d, forecast(spark, sf_dir, d))


# ---------------------------------------------------------------------------
# Event hygiene
# ---------------------------------------------------------------------------

@register("dedupe_events", f"""SELECT sales_id, sku_id, event_ts, quantity, status FROM (
  SELECT *, row_number() OVER (PARTITION BY sales_id ORDER BY event_ts NULLS LAST,
    status NULLS LAST, quantity, sku_id) AS rn FROM ({SQL_LINE_SALES}))
WHERE rn = 1 OR sales_id IS NULL""")
def q_dedupe_events(spark, sf_dir):
    """One row per sales id (order line ids repeat in the input)."""
    return EV.dedupe_events(line_sales(spark, sf_dir))


@register("event_quality", f"""SELECT sku_id, sales_id, event_ts, quantity, status,
  status IS NULL AS is_null_status, event_ts IS NULL AS is_null_ts,
  COALESCE(event_ts < pm, false) AS is_out_of_order, COALESCE(quantity > 40, false) AS is_outlier,
  CASE WHEN status IS NULL THEN 'null_status' WHEN event_ts IS NULL THEN 'null_event_ts'
       WHEN COALESCE(event_ts < pm, false) THEN 'out_of_order'
       WHEN COALESCE(quantity > 40, false) THEN 'quantity_outlier' ELSE 'valid' END
    AS event_quality_flag
FROM (SELECT *, max(event_ts) OVER (PARTITION BY sku_id
        ORDER BY l_orderkey, l_linenumber, event_ts, quantity, status NULLS FIRST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM ({SQL_LINE_SALES}))""")
def q_event_quality(spark, sf_dir):
    """Null / out-of-order / outlier flags per order-line sale in numeric id
    order; the running max is two-level, over id ranges sized from the data."""
    return EV.event_quality(line_sales(spark, sf_dir), outlier_threshold=40,
                            order=[F.col("sales_id"), F.col("event_ts"), F.col("quantity"),
                                   F.col("status").asc_nulls_first()])


# Lengths of chains that end at each event, by plain search over all pairs; of
# the longest, that which ends last and steps back over the latest events.
SQL_LATE = f"""WITH RECURSIVE e AS (
  SELECT *, row_number() OVER (PARTITION BY sku_id
    ORDER BY sales_id, event_ts, quantity, status NULLS FIRST) AS i
  FROM ({SQL_LINE_SALES}) WHERE event_ts IS NOT NULL),
reach(sku_id, i, t, k) AS (
  SELECT sku_id, i, event_ts, 1 FROM e
  UNION SELECT e.sku_id, e.i, e.event_ts, k + 1 FROM reach r
    JOIN e ON e.sku_id = r.sku_id AND e.i > r.i AND e.event_ts >= r.t),
longest AS (SELECT sku_id, i, max(k) AS k FROM reach GROUP BY ALL),
steps AS (
  SELECT b.sku_id, b.i, max(a.i) AS p FROM longest b
    LEFT JOIN longest a ON a.sku_id = b.sku_id AND a.k = b.k - 1 AND a.i < b.i GROUP BY ALL),
kept(sku_id, i) AS (
  SELECT sku_id, max(i) FROM longest
  WHERE (sku_id, k) IN (SELECT (sku_id, max(k)) FROM longest GROUP BY sku_id) GROUP BY sku_id
  UNION ALL SELECT s.sku_id, s.p FROM kept JOIN steps s ON s.sku_id = kept.sku_id AND s.i = kept.i
    WHERE s.p IS NOT NULL),
marked AS (
  SELECT e.*, kept.i IS NULL AS late,
    max(CASE WHEN kept.i IS NOT NULL THEN event_ts END) OVER (PARTITION BY e.sku_id ORDER BY e.i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a,
    min(CASE WHEN kept.i IS NOT NULL THEN event_ts END) OVER (PARTITION BY e.sku_id ORDER BY e.i
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b
  FROM e LEFT JOIN kept ON kept.sku_id = e.sku_id AND kept.i = e.i),
slips AS (
  SELECT sku_id, sales_id, event_ts, quantity, status, late, CASE WHEN late THEN
    CASE WHEN (coalesce(event_ts - INTERVAL 1 HOUR >= a, true) AND coalesce(event_ts - INTERVAL 1 HOUR <= b, true))
      OR (coalesce(event_ts + INTERVAL 1 HOUR >= a, true) AND coalesce(event_ts + INTERVAL 1 HOUR <= b, true))
      THEN 'hour_slip'
    WHEN coalesce(event_ts + INTERVAL 2 HOUR >= a, true) AND coalesce(event_ts - INTERVAL 2 HOUR <= b, true)
      THEN 'near' ELSE 'far' END END AS late_kind FROM marked
  UNION ALL SELECT sku_id, sales_id, event_ts, quantity, status, false, NULL
    FROM ({SQL_LINE_SALES}) WHERE event_ts IS NULL)
SELECT sku_id, sales_id, event_ts, quantity, status, late_kind, status IS NULL AS is_null_status,
  event_ts IS NULL AS is_null_ts, late AS is_out_of_order, COALESCE(quantity > 40, false) AS is_outlier,
  CASE WHEN status IS NULL THEN 'null_status' WHEN event_ts IS NULL THEN 'null_event_ts'
       WHEN late THEN 'out_of_order' WHEN COALESCE(quantity > 40, false) THEN 'quantity_outlier'
       ELSE 'valid' END AS event_quality_flag
FROM slips"""


@register("event_quality_smallest", SQL_LATE)
def q_event_quality_smallest(spark, sf_dir):
    """The flags with the smallest set of late events of each part instead of
    a running maximum, and the kind of their slip."""
    return EV.event_quality(line_sales(spark, sf_dir), outlier_threshold=40, late="smallest",
                            order=[F.col("sales_id"), F.col("event_ts"), F.col("quantity"),
                                   F.col("status").asc_nulls_first()])


def _sql_merged(rows: str, cap: int) -> str:
    near = "event_ts IS NULL, gap, event_ts NULLS FIRST"

    def first(column, order):
        return f"first({column} ORDER BY {order}) AS {column}"

    return f"""WITH t AS ({rows}),
ids AS (
  SELECT sales_id, count(*) AS n, CASE WHEN min(event_ts) = max(event_ts) THEN min(event_ts) END AS sure,
    min(sku_id) AS sku FROM t WHERE sales_id IS NOT NULL GROUP BY sales_id),
around AS (
  SELECT sales_id, n,
    last_value(sure IGNORE NULLS) OVER (PARTITION BY sku ORDER BY sales_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a,
    first_value(sure IGNORE NULLS) OVER (PARTITION BY sku ORDER BY sales_id
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b FROM ids),
copies AS (
  SELECT t.*, greatest(coalesce(epoch_us(a) - epoch_us(event_ts), 0),
    coalesce(epoch_us(event_ts) - epoch_us(b), 0), 0) AS gap
  FROM t JOIN around USING (sales_id) WHERE n > 1)
SELECT sales_id, sku_id, event_ts, quantity, status FROM t
WHERE sales_id IS NULL OR sales_id IN (SELECT sales_id FROM ids WHERE n = 1)
UNION ALL
SELECT sales_id, {first('sku_id', f'status IS NULL, {near}, sku_id')},
  first(event_ts ORDER BY {near}) AS event_ts,
  {first('quantity', f'NOT coalesce(quantity <= {cap}, false), {near}, quantity NULLS FIRST')},
  {first('status', f'status IS NULL, {near}, status')}
FROM copies GROUP BY sales_id"""


@register("merge_copies", _sql_merged(SQL_LINE_SALES, 40))
def q_merge_copies(spark, sf_dir):
    """One row per sales id of the order lines, each field from the copy that
    can be trusted with it."""
    return EV.merge_copies(line_sales(spark, sf_dir), cap=40)


@register("merge_copies_events", _sql_merged(SQL_SALES, 50))
def q_merge_copies_events(spark, sf_dir):
    """The same over the sales events, whose ids are strings."""
    return EV.merge_copies(sales(spark, sf_dir))


# ---------------------------------------------------------------------------
# Event hygiene end to end: dedupe -> quality flags
# ---------------------------------------------------------------------------

_DEDUPED = f"""SELECT sales_id, sku_id, event_ts, quantity, status FROM (
  SELECT *, row_number() OVER (PARTITION BY sales_id ORDER BY event_ts NULLS LAST,
    status NULLS LAST, quantity, sku_id) AS rn FROM ({SQL_SALES}))
WHERE rn = 1 OR sales_id IS NULL"""


@register("event_hygiene", f"""SELECT sku_id, sales_id, event_ts, quantity, status,
  status IS NULL AS is_null_status, event_ts IS NULL AS is_null_ts,
  COALESCE(event_ts < pm, false) AS is_out_of_order, COALESCE(quantity > 50, false) AS is_outlier,
  CASE WHEN status IS NULL THEN 'null_status' WHEN event_ts IS NULL THEN 'null_event_ts'
       WHEN COALESCE(event_ts < pm, false) THEN 'out_of_order'
       WHEN COALESCE(quantity > 50, false) THEN 'quantity_outlier' ELSE 'valid' END
    AS event_quality_flag
FROM (SELECT *, max(event_ts) OVER (PARTITION BY sku_id ORDER BY CAST(substring(sales_id, 2) AS BIGINT)
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM ({_DEDUPED}))""")
def q_event_hygiene(spark, sf_dir):
    """Sales events de-duplicated by id, then flagged (null status / time,
    out-of-order arrival, quantity above the quantity cap of 50)."""
    return EV.event_quality(EV.dedupe_events(sales(spark, sf_dir)), outlier_threshold=50)


# ---------------------------------------------------------------------------
# Small operators on their own
# ---------------------------------------------------------------------------

@register("latest_stock_rows", f"""WITH d AS ({SQL_DAILY})
SELECT * FROM d WHERE (sku_id, event_date) IN (SELECT (sku_id, max(event_date)) FROM d GROUP BY sku_id)""")
def q_latest_stock_rows(spark, sf_dir):
    """The daily rows of each SKU's last day (equality with a per-SKU max)."""
    return latest_rows(daily_table(spark, sf_dir), [K], "event_date")


@register("order_line_days", """SELECT sku_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS event_date
FROM (SELECT l_suppkey AS sku_id, min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS b
      FROM lineitem GROUP BY l_suppkey)""")
def q_order_line_days(spark, sf_dir):
    """Date spine: every day from a supplier's first to its last order line."""
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias(K),
                                                         F.to_date("l_shipdate").alias("event_date"))
    return date_spine(INV.sku_ranges(lines), "start", "end")


@register("forecast_input", f"""SELECT sku_id, CAST(event_date AS TIMESTAMP) AS ds,
  CAST(approved_qty AS DOUBLE) AS y FROM ({SQL_DAILY})""")
def q_forecast_input(spark, sf_dir):
    """The daily series cast and renamed to a model's shape (ds, y)."""
    return daily(spark, sf_dir).select(K, rename_cast("event_date", "timestamp_ntz", "ds"),
                                       rename_cast("approved_qty", "double", "y"))
