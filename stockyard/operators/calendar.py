"""Commercial holiday calendar, holiday demand multipliers, expected daily
demand and coverage need.

All functions take a ``ranges`` DataFrame with key columns (e.g. ``sku_id``)
plus ``start`` / ``end`` dates. Calendars are keyed by date (a few rows a year)
and built from column expressions; keys look their days up in them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions.dates import last_friday, next_monday_after, second_sunday, weekday_index


def _holiday_dates(year: Column) -> list[tuple[str, Column]]:
    """Fixed and movable commercial holidays of ``year``. Fixed values (must
    equal the source's): Christmas 25 Dec, Children's Day 12 Oct,
    Valentine's Day 12 Jun, Mother's / Father's Day the second Sunday of May /
    August, Black Friday the last Friday of November, Cyber Monday the first
    Monday after it."""
    bf = last_friday(year, 11)
    return [
        ("natal", F.make_date(year, F.lit(12), F.lit(25))),
        ("dia_das_criancas", F.make_date(year, F.lit(10), F.lit(12))),
        ("dia_dos_namorados", F.make_date(year, F.lit(6), F.lit(12))),
        ("dia_das_maes", second_sunday(year, 5)),
        ("dia_dos_pais", second_sunday(year, 8)),
        ("black_friday", bf),
        ("cyber_monday", next_monday_after(bf)),
    ]


def holiday_calendar(ranges: DataFrame, keys: Sequence[str] = ("sku_id",),
                     names: Sequence[str] | None = None) -> DataFrame:
    """(keys, start, end, year, holiday, holiday_date) for every year from
    year(start) to year(end) and every holiday in ``names`` (default all)."""
    keep = set(names) if names is not None else set(C.HOLIDAY_NAMES)
    years = ranges.select(*keys, "start", "end",
                          F.explode(F.sequence(F.year("start"), F.year("end"))).alias("year"))
    y = F.col("year")
    entries = [F.struct(F.lit(n).alias("holiday"), d.alias("holiday_date"))
               for n, d in _holiday_dates(y) if n in keep]
    return years.select(*keys, "start", "end", "year", F.inline(F.array(*entries)))


def _spec(spec) -> dict:
    """Normalise a holiday spec: name -> (multiplier, pre_days, post_days).
    Accepts tuples or dicts with multiplier / pre_days / post_days keys.
    An empty spec means the defaults."""
    if not spec:
        spec = C.DEFAULT_HOLIDAYS
    out = {}
    for name, v in spec.items():
        if not v:
            continue
        if isinstance(v, dict):
            v = (float(v.get("multiplier", 1.0)), int(v.get("pre_days", 0)),
                 int(v.get("post_days", 0)))
        out[name] = (float(v[0]), int(v[1]), int(v[2]))
        if out[name][1] + out[name][2] < 0:  # no day from -pre to +post
            del out[name]
    return out


def holiday_windows(ranges: DataFrame, spec=None) -> DataFrame:
    """The date-keyed calendar of all years that ``ranges`` touch: one row per
    date inside a holiday window, ``event_date`` and ``__windows``, an array of
    (year of the holiday, multiplier). About 25 rows a year, whatever the
    number of keys."""
    sp = _spec(spec)
    years = ranges.agg(F.min(F.year("start")).alias("a"), F.max(F.year("end")).alias("b")) \
        .where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("year"))
    days = F.array(*[F.struct(F.sequence(F.date_sub(d, sp[n][1]), F.date_add(d, sp[n][2])).alias("days"),
                              F.lit(sp[n][0]).alias("m"))
                     for n, d in _holiday_dates(F.col("year")) if n in sp]) \
        .cast("array<struct<days:array<date>,m:double>>")
    return years.select("year", F.inline(days)).select("year", "m", F.explode("days").alias("event_date")) \
        .groupBy("event_date").agg(F.collect_list(F.struct("year", "m")).alias("__windows"))


def _factor() -> Column:
    """Largest multiplier of the windows whose holiday lies in a year of the
    row's own range; NULL outside of all, and outside the range."""
    own = F.filter("__windows", lambda w: w["year"].between(F.year("start"), F.year("end")))
    inside = F.col("event_date").between(F.col("start"), F.col("end"))
    return F.when(inside, F.array_max(F.transform(own, lambda w: w["m"])))


def holiday_multiplier(ranges: DataFrame, spec=None, keys: Sequence[str] = ("sku_id",)) -> DataFrame:
    """(keys, event_date, holiday_mult): every date within ``pre`` days before
    to ``post`` days after a holiday of the years year(start)..year(end) and
    inside [start, end] gets the largest multiplier of the holidays covering
    it, at least 1.0. Names not in the calendar are ignored. With one range
    and ``keys=()`` this is the calendar itself, one row per date."""
    month = lambda c: F.trunc(c, "month")
    # Dates meet ranges month by month: an equi-join, no range join.
    cal = holiday_windows(ranges, spec).withColumn("__month", month("event_date"))
    spans = ranges.select(*keys, "start", "end", F.explode(F.sequence(
        month("start"), month("end"), F.expr("INTERVAL 1 MONTH"))).alias("__month"))
    return spans.join(cal, "__month").withColumn("__m", _factor()).where("__m IS NOT NULL") \
        .select(*keys, "event_date", F.greatest(F.lit(1.0), F.col("__m")).alias("holiday_mult"))


def demand_calendar(ranges: DataFrame, params: C.DemandParams = C.DemandParams(),
                    lookahead_days: int = 0, keys: Sequence[str] = ("sku_id",)) -> DataFrame:
    """Daily expected demand per key from ``start`` to ``end`` + lookahead:

    expected(d) = base * (1 + r) ** (days_since_start / 30.4375)
                  * weekday_factor[weekday(d)] * holiday_mult(d)

    The holiday factor is 1.0 outside [start, end] and counts only holidays
    of the years year(start)..year(end), as :func:`holiday_multiplier`.
    Columns: keys, start, end, event_date, weekday, holiday_mult,
    in_holiday_window, expected_orders.

    Plan: the days of each key are generated and looked up in the date-keyed
    calendar (:func:`holiday_windows`, a few rows a year) by an equi-join on
    the date, which Spark broadcasts below its size threshold."""
    d = ranges.select(*keys, "start", "end", F.explode(F.sequence(
        F.col("start"), F.date_add("end", lookahead_days))).alias("event_date"))
    d = d.join(holiday_windows(ranges, params.holidays), "event_date", "left").withColumn("__m", _factor())
    wd = weekday_index("event_date")
    factors = F.array(*[F.lit(float(x)) for x in params.weekday_factors])
    days = F.datediff("event_date", "start")
    trend = F.lit(1.0) if params.monthly_rate == 0 else \
        F.pow(F.lit(1.0 + params.monthly_rate), days / F.lit(C.DAYS_PER_MONTH))
    hm = F.coalesce(F.greatest(F.lit(1.0), F.col("__m")), F.lit(1.0))
    return d.select(*keys, "start", "end", "event_date", wd.alias("weekday"),
                    hm.alias("holiday_mult"),
                    F.col("__m").isNotNull().alias("in_holiday_window"),
                    (F.lit(float(params.base_daily)) * trend * F.element_at(factors, wd + 1) * hm)
                    .alias("expected_orders"))


def coverage_need(cal: DataFrame, days: int, params: C.DemandParams = C.DemandParams(),
                  out: str = "need", keys: Sequence[str] = ("sku_id",)) -> DataFrame:
    """need(d, n) = max(0, ceil(sum_{i<n} expected(d + i) * approval_share *
    mean_qty)) as a sliding window of ``n`` rows ahead over the daily
    calendar (which must extend n - 1 days past ``end``). Terms are summed
    as decimals so the ceiling does not depend on summation order."""
    n = max(1, int(days))
    term = (F.col("expected_orders") * F.lit(params.approval_share) * F.lit(params.mean_qty)) \
        .cast("decimal(28,9)")
    w = Window.partitionBy(*keys).orderBy("event_date").rowsBetween(0, n - 1)
    return cal.withColumn(out, F.greatest(F.lit(0), F.ceil(F.sum(term).over(w))).cast("bigint"))
