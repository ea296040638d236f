"""Demand forecast per SKU and the weekly inventory depletion report.

``forecast_demand`` is the native model: per SKU a least-squares trend (sums
with partial aggregation) plus a weekday effect (mean residual per weekday), projected on
the ``horizon`` days after the SKU's last day. ``forecast_demand_grouped``
runs any per-SKU model on the daily series with ``applyInPandas``; the
series is one row per day, so a group is bounded by the history length, not
by the number of events.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from ..functions.cleaning import round_half_up
from ..functions.dates import future_spine, week_start, weekday_index
from ..session import ship_package
from .windows import running

K = "sku_id"


EPOCH = "1970-01-01"  # a Thursday: (days since it + 3) mod 7 is the weekday, Monday = 0


def season_index(c, season: int):
    """Position of a date in a cycle of ``season`` days; for 7 it is the
    weekday (Monday = 0)."""
    if season == 7:
        return weekday_index(c)
    return F.pmod(F.datediff(c, F.lit(EPOCH).cast("date")) + 3, F.lit(season))


# Decimals of a prediction inside a job; reports round on output.
FINE = 12


def forecast_demand(daily: DataFrame, horizon: int = 28, value: str = "approved_qty",
                    digits: int = FINE, season: int = 7) -> DataFrame:
    """(sku_id, event_date, demand_prediction) for the ``horizon`` days after
    each SKU's last day: max(0, a + b * t + seasonal_effect), half up to
    ``digits`` decimals. ``a + b * t`` is the least-squares line of the series
    over its day numbers; the seasonal effect is the mean residual per position
    in a ``season``-day cycle (7: per weekday).

    Plan: one aggregate per SKU holds the totals and, for each position of the
    cycle, its count and sums; the future days are generated from that row and
    look their position up in it, so there is one shuffle and no join. For an
    integer series (unit counts) the sums are exact integers and each
    prediction is the exact rational N / M, rounded by integer division: the
    result does not depend on the summation order or on the engine."""
    t = F.datediff("event_date", F.lit(EPOCH).cast("date"))
    exact = isinstance(daily.schema[value].dataType, IntegralType)
    num = "decimal(38,0)" if exact else "double"
    # Rows are added up as longs (a sum past 64 bits fails, it does not wrap);
    # only the one row of each SKU is decimal.
    row = "bigint" if exact else "double"
    h = daily.select(K, "event_date", F.col(value).cast(row).alias("y"), t.cast(row).alias("t"),
                     season_index("event_date", season).alias("at"))
    zero = F.lit(0).cast(num)

    def each(x):
        return [F.coalesce(F.sum(F.when(F.col("at") == k, x)), F.lit(0)).cast(num) for k in range(season)]

    fit = h.groupBy(K).agg(
        F.max("event_date").alias("last_date"), F.count(F.lit(1)).cast(num).alias("n"),
        F.sum("y").cast(num).alias("sy"), F.sum("t").cast(num).alias("st"),
        F.sum(F.col("t") * F.col("t")).cast(num).alias("stt"),
        F.sum(F.col("t") * F.col("y")).cast(num).alias("sty"),
        F.array(*each(F.lit(1).cast(row))).alias("cs"), F.array(*each(F.col("y"))).alias("sys"),
        F.array(*each(F.col("t"))).alias("sts"))
    fit = fit.select(K, "last_date", "n", "sy", "st", "cs", "sys", "sts",
                     (F.col("n") * F.col("stt") - F.col("st") * F.col("st")).cast(num).alias("dd"),
                     (F.col("n") * F.col("sty") - F.col("st") * F.col("sy")).cast(num).alias("bn"))
    j = future_spine(fit, "last_date", horizon)
    at = season_index("event_date", season) + 1
    j = j.select(K, "event_date", "n", "sy", "st", "dd", "bn", t.cast(num).alias("t"),
                 F.element_at("cs", at).alias("c"), F.element_at("sys", at).alias("cy"),
                 F.element_at("sts", at).alias("ct"))
    c, has = F.col("c"), F.col("c") > 0
    flat = F.col("dd") == 0  # one distinct day: no slope
    # prediction = avg_y(pos) + b * (t - avg_t(pos)), or a + b * t without
    # history at that position, with b = bn / dd, a = (sy - b * st) / n
    numer = F.when(flat, F.when(has, F.col("cy")).otherwise(F.col("sy"))) \
        .when(has, F.col("cy") * F.col("dd") + F.col("bn") * (F.col("t") * c - F.col("ct"))) \
        .otherwise(F.col("sy") * F.col("dd") - F.col("bn") * F.col("st")
                   + F.col("n") * F.col("bn") * F.col("t"))
    denom = F.when(flat, F.when(has, c).otherwise(F.col("n"))) \
        .when(has, c * F.col("dd")).otherwise(F.col("n") * F.col("dd"))
    numer = F.greatest(numer, zero)
    if not exact:
        return j.select(K, "event_date", round_half_up(numer / denom, digits).alias("demand_prediction"))
    # Whole part and fraction apart, so that the scaled numerator has room.
    parts = j.select(K, "event_date", numer.cast(num).alias("__n"), denom.cast(num).alias("__m"))
    whole, rest = F.expr("__n div __m").cast("decimal(18,0)"), F.expr("__n % __m").cast("decimal(25,0)")
    pred = parts.select(K, "event_date", whole.alias("__w"), rest.alias("__r"), "__m")
    frac = F.expr(f"CAST((2 * __r * {10 ** digits} + __m) div (2 * __m) AS DECIMAL(20,0))")
    return pred.select(K, "event_date", (F.col("__w") + frac / F.lit(10 ** digits).cast("decimal(20,0)"))
                       .cast(f"decimal(30,{digits})").alias("demand_prediction"))


def rounded(pred: DataFrame, digits: int = 4) -> DataFrame:
    """Predictions as doubles of ``digits`` decimals (half up), for output."""
    p = F.col("demand_prediction")
    p = F.round(p, digits).cast("double") if isinstance(pred.schema["demand_prediction"].dataType, DecimalType) \
        else round_half_up(p, digits)
    return pred.withColumn("demand_prediction", p)


def linear_weekday_model(t: np.ndarray, y: np.ndarray, weekday: np.ndarray,
                         t_new: np.ndarray, weekday_new: np.ndarray) -> np.ndarray:
    """The native model in numpy (least-squares line over the day numbers +
    mean residual per position); the default of ``forecast_demand_grouped``."""
    t, y, t_new = (np.asarray(v, dtype=float) for v in (t, y, t_new))
    spread = t - t.mean()
    slope = float(spread @ (y - y.mean()) / (spread @ spread)) if spread.any() else 0.0
    line = y.mean() + slope * spread
    m = int(max(weekday.max(initial=0), weekday_new.max(initial=0))) + 1
    count = np.bincount(weekday, minlength=m)
    effect = np.bincount(weekday, weights=y - line, minlength=m) / np.maximum(count, 1)
    return np.maximum(0.0, y.mean() + slope * (t_new - t.mean()) + effect[weekday_new])


def holt_winters_model(alpha: float = 0.3, beta: float = 0.05, gamma: float = 0.2):
    """Additive Holt-Winters (level + trend + seasonal) as a model for
    :func:`forecast_demand_grouped`; the seasonal position is the one the
    caller passes (weekday for season 7). Days without a row count as
    missing: the recursion runs over the observed days in order."""
    def model(t, y, season_idx, t_new, season_new):
        y = np.asarray(y, dtype=float)
        m = int(max(season_idx.max(initial=0), season_new.max(initial=0))) + 1
        if len(y) < 2 * m:  # too short for a seasonal start: trend + mean level
            return linear_weekday_model(t, y, season_idx, t_new, season_new)
        level = y[:m].mean()
        trend = (y[m:2 * m].mean() - level) / m
        season = np.zeros(m)
        for k in range(m):
            season[season_idx[k]] = y[k] - level
        last_t = t[0]
        for k in range(len(y)):
            gap = max(1, int(t[k] - last_t)) if k else 1
            prev = level
            s_k = season[season_idx[k]]
            level = alpha * (y[k] - s_k) + (1 - alpha) * (prev + gap * trend)
            trend = beta * (level - prev) / gap + (1 - beta) * trend
            season[season_idx[k]] = gamma * (y[k] - level) + (1 - gamma) * s_k
            last_t = t[k]
        h = np.asarray(t_new, dtype=float) - float(t[-1])
        return np.maximum(0.0, level + h * trend + season[season_new])
    return model


def forecast_demand_grouped(daily: DataFrame, horizon: int = 28, value: str = "approved_qty",
                            model: Callable = linear_weekday_model, digits: int = 4,
                            season: int = 7) -> DataFrame:
    """Same output as :func:`forecast_demand` with a pluggable per-SKU model
    ``model(t, y, weekday, t_new, weekday_new) -> y_new`` run in
    ``groupBy(sku_id).applyInPandas`` (Arrow batches, no driver hop); the
    seasonal position passed to the model is the same as the native one. Days
    are passed as integers (days since 1970-01-01) and turned back into
    dates on the JVM side, so a group costs only numpy work."""
    ship_package(daily.sparkSession)
    key_t = daily.schema[K].dataType.simpleString()
    epoch = F.lit(EPOCH).cast("date")
    y_t = "long" if isinstance(daily.schema[value].dataType, IntegralType) else "double"
    h = daily.select(K, F.datediff("event_date", epoch).alias("day"),
                     F.col(value).cast(y_t).alias("y"))

    def per_sku(pdf: pd.DataFrame) -> pd.DataFrame:
        day = pdf["day"].to_numpy()
        order = np.argsort(day, kind="stable")
        day, y = day[order], pdf["y"].to_numpy()[order]
        t = day - day[0]
        new_day = day[-1] + np.arange(1, horizon + 1)
        wd = (day + 3) % season  # 1970-01-01 was a Thursday (Monday = 0)
        y_new = model(t, y, wd, new_day - day[0], (new_day + 3) % season)
        # A float just beside a tie must not flip it.
        scaled = np.round(np.asarray(y_new, dtype=float) * 10 ** digits, 6)
        pred = np.floor(scaled + 0.5) / 10 ** digits
        return pd.DataFrame({K: np.repeat(pdf[K].iloc[0], horizon), "day": new_day,
                             "demand_prediction": pred})

    out = h.groupBy(K).applyInPandas(per_sku, f"{K} {key_t}, day int, demand_prediction double")
    return out.select(K, F.date_add(epoch, F.col("day")).alias("event_date"), "demand_prediction")


def weekly_demand(pred: DataFrame) -> DataFrame:
    """ceil(sum(prediction)) per SKU and week (Monday), over unrounded
    predictions, summed as decimals; what a sum has beyond nine decimals is
    the predictions' own rounding and is not rounded up. A horizon not starting
    on a Monday gives partial first / last weeks."""
    total = F.sum(F.col("demand_prediction").cast(f"decimal(30,{FINE})"))
    return pred.groupBy(K, week_start("event_date").alias("week_monday")).agg(
        F.ceil(F.round(total, 9)).cast("bigint").alias("weekly_demand"))


def cumulative_demand(weekly: DataFrame) -> DataFrame:
    """Running sum of the (already rounded-up) weekly demand per SKU."""
    return running(weekly, [K], [F.col("week_monday")], "weekly_demand", "weekly_demand_cum") \
        .withColumn("weekly_demand_cum", F.col("weekly_demand_cum").cast("bigint"))


def inventory_forecast(daily: DataFrame, pred: DataFrame) -> DataFrame:
    """Per SKU and forecast week: the stock at the SKU's latest day minus the
    cumulative weekly demand (may go negative). The latest stock is joined
    on ``sku_id`` (one row per SKU), not crossed.

    Columns: sku_id, week_monday, weekly_demand, weekly_demand_cum,
    remaining_inventory."""
    # one row per SKU and day: the latest stock is a max_by aggregate
    # (partial, map-side) rather than a window over the whole series
    inv = daily.groupBy(K).agg(F.max_by("inventory_eod", "event_date").alias("initial_inventory"))
    cum = cumulative_demand(weekly_demand(pred))
    return cum.join(inv, K, "inner").select(
        K, "week_monday", "weekly_demand", "weekly_demand_cum",
        (F.col("initial_inventory") - F.col("weekly_demand_cum")).alias("remaining_inventory"))
