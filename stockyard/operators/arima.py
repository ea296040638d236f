"""Seasonal ARIMA forecasts with a search over orders, many series at a time.

A model (p,d,q)(P,D,Q)m is fitted by conditional least squares: residuals are
taken from a fixed place on, the same for all orders of a search, so that their
AIC compares like with like. Polynomials are kept stationary and invertible by
way of partial autocorrelations, and the sum of squares is minimised with
Levenberg-Marquardt steps. D comes from the strength of the seasonal pattern,
d from KPSS tests, the other orders from a stepwise walk by AIC.

One row holds one series (one number a period, so its length is bounded by the
calendar, not by events); the rows of an Arrow batch are fitted together, all
those that try the same order in one set of arrays.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, ship_package

K = "sku_id"
# 5 % level of the KPSS test for stationarity around a level.
KPSS_LIMIT = 0.463
# Share of the detrended variance from which a pattern counts as seasonal.
SEASONAL_STRENGTH = 0.64
# Fits of one order that go on side by side, in numbers held (fits x parameters
# x length): as much as a core keeps in its cache.
_CELLS = 1 << 17


@dataclass(frozen=True)
class Limits:
    """Highest orders of a search; ``total`` bounds p + q + P + Q. ``beam`` is
    how many of the best orders the walk looks around."""
    p: int = 2
    q: int = 2
    P: int = 1
    Q: int = 1
    d: int = 2
    D: int = 1
    total: int = 5
    beam: int = 6


# An order within a search: p, q, P, Q and whether there is a constant.
Order = tuple[int, int, int, int, int]


def stationary(x: np.ndarray) -> np.ndarray:
    """Coefficients of a stationary autoregression from free numbers (last
    axis), by way of partial autocorrelations."""
    r = np.tanh(x)
    out = r[..., :0]
    for k in range(r.shape[-1]):
        last = r[..., k:k + 1]
        out = np.concatenate([out - last * out[..., ::-1], last], axis=-1)
    return out


def lag_terms(low: np.ndarray, high: np.ndarray, m: int, sign: int) -> list[tuple[int, np.ndarray]]:
    """(lag, coefficient) of the product of an ordinary and a seasonal
    polynomial whose terms all have the given sign, as it stands on the side of
    the past: +1 for autoregression, -1 for moving averages."""
    out = [(i + 1, low[..., i]) for i in range(low.shape[-1])]
    out += [((j + 1) * m, high[..., j]) for j in range(high.shape[-1])]
    out += [(i + 1 + (j + 1) * m, -sign * low[..., i] * high[..., j])
            for i, j in product(range(low.shape[-1]), range(high.shape[-1]))]
    return out


def unpacked(x: np.ndarray, order: Order, m: int):
    """Constant, autoregressive and moving-average terms of a parameter array."""
    p, q, sp, sq, const = order
    at = np.cumsum([0, const, p, sp, q, sq])
    ar, sar, ma, sma = (stationary(x[..., a:b]) for a, b in zip(at[1:-1], at[2:], strict=True))
    mean = x[..., 0] if const else np.zeros(x.shape[:-1])
    return mean, lag_terms(ar, sar, m, 1), lag_terms(-ma, -sma, m, -1)


def residuals(w: np.ndarray, from_: np.ndarray, x: np.ndarray, order: Order, m: int) -> np.ndarray:
    """Residuals of series ``w`` (series x time, ending together) from place
    ``from_`` of each on, zero before, for parameters (series x sets x numbers)."""
    mean, ar, ma = unpacked(x, order, m)
    length = w.shape[1]
    if not ma:
        y = w[:, None, :] - mean[..., None]
        u = y.copy()
        for lag, c in ar:
            if lag < length:
                u[..., lag:] -= c[..., None] * y[..., :-lag]
        u *= np.arange(length) >= from_[:, None, None]
        return u
    # Time comes first: a step reads and writes rows that lie together.
    y = w.T[:, :, None] - mean
    e, first = y.copy(), int(from_.min())
    for lag, c in ar:
        if lag < length:
            e[lag:] -= c * y[:-lag]
    e *= (np.arange(length)[:, None] >= from_)[..., None]
    ma, part = [(lag, np.ascontiguousarray(c)) for lag, c in ma], np.empty(e.shape[1:])
    for t in range(first, length):
        now = e[t]
        for lag, c in ma:
            if t - lag >= first:  # zero before
                np.multiply(c, e[t - lag], out=part)
                np.subtract(now, part, out=now)
    return np.moveaxis(e, 0, -1)


# Series that one task fits.
TASK_SERIES = 2500
# Starting values of autoregressive and moving-average numbers. The sum of
# squares may have several minima; the least of those found counts.
STARTS = ((0.1, -0.05), (-0.5, 0.5))


def fit(w: np.ndarray, from_: np.ndarray, order: Order, m: int, rounds: int = 60) -> tuple:
    """Parameters and sum of squares of every series, at one order.

    The fits of all series and starting values go through one set of places: a
    fit that has ended makes room for the next, so the arrays stay full."""
    p, q, sp, sq, const = order
    n_par, (n, length) = p + q + sp + sq + const, w.shape
    starts = STARTS[:1 + (sum(order) > const)]
    mean = 0.0
    if const:
        live = np.arange(length) >= from_[:, None]
        mean = (w * live).sum(axis=1) / live.sum(axis=1)
    x = np.empty((len(starts), n, n_par))
    for at, (low, high) in zip(x, starts, strict=True):
        at[:], at[:, const + p + sp:] = low, high
        at[:, :const] = np.reshape(mean, (-1, 1))
    x, series = x.reshape(len(starts) * n, n_par), np.tile(np.arange(n), len(starts))
    sse, damp = np.empty(len(x)), np.full(len(x), 1e-2)
    places, h = max(1, _CELLS // (length * (n_par + 1))), 1e-6

    normal, slope = np.empty((len(x), n_par, n_par)), np.empty((len(x), n_par))

    def squares(at, x):
        e = residuals(w[series[at]], from_[series[at]], x[:, None, :], order, m)[:, 0]
        return (e * e).sum(axis=1)

    def slopes(at):
        sets = np.concatenate([x[at][:, None, :], x[at][:, None, :] + h * np.eye(n_par)], axis=1)
        all_e = residuals(w[series[at]], from_[series[at]], sets, order, m)
        base = all_e[:, 0]
        jac = (all_e[:, 1:] - base[:, None, :]) / h
        normal[at], slope[at] = jac @ jac.transpose(0, 2, 1), (jac @ base[..., None])[..., 0]

    todo = np.arange(len(x))
    at, moves, left = todo[:0], np.ones(len(x), dtype=bool), np.full(len(x), rounds if n_par else 0)
    while len(at) or len(todo):
        new, todo = todo[:places - len(at)], todo[places - len(at):]
        if len(new):
            sse[new] = squares(new, x[new])
            at = np.concatenate([at, new])
        at = at[left[at] > 0]
        if not len(at):
            continue
        left[at] -= 1
        if moves[at].any():  # a step that was refused starts from the same place
            slopes(at[moves[at]])
        scale = np.einsum("skk->sk", normal[at]) + 1e-9
        moved = x[at] - np.linalg.solve(normal[at] + (damp[at][:, None] * scale)[:, :, None]
                                        * np.eye(n_par), slope[at][..., None])[..., 0]
        moved[:, const:] = np.clip(moved[:, const:], -4, 4)
        new_sse = squares(at, moved)
        better = new_sse < sse[at]
        small = sse[at] - new_sse < 1e-9 * (sse[at] + 1e-300)
        moves[at] = better
        x[at[better]], gone = moved[better], at[~better]
        sse[at[better]] = new_sse[better]
        damp[at[better]] = np.maximum(damp[at[better]] / 5, 1e-9)
        damp[gone] *= 8
        at = at[~(better & small) & (damp[at] <= 1e9)]
    x, sse = x.reshape(len(starts), n, n_par), sse.reshape(len(starts), n)
    best = np.zeros(n, dtype=int)
    if len(starts) > 1:
        best[sse[1] < sse[0]] = 1
    return x[best, np.arange(n)], sse[best, np.arange(n)]


def aic(sse: np.ndarray, count: np.ndarray, order: Order, level: np.ndarray) -> np.ndarray:
    """Akaike's criterion; ``level`` bounds the variance of a perfect fit."""
    return count * np.log(np.maximum(sse / count, 1e-12 * level)) + 2 * (sum(order) + 1)


def seasonal_difference(y: np.ndarray, m: int) -> bool:
    """Whether the seasonal pattern makes up most of what the trend leaves."""
    if m < 2 or len(y) < 3 * m:
        return False
    kernel = np.ones(m) / m if m % 2 else np.concatenate([[0.5], np.ones(m - 1), [0.5]]) / m
    half = len(kernel) // 2
    loose = y[half:len(y) - half] - np.convolve(y, kernel, "valid")
    place = (np.arange(len(loose)) + half) % m
    means = np.bincount(place, loose, m) / np.maximum(np.bincount(place, minlength=m), 1)
    all_ = loose.var()
    rest = (loose - means[place]).var()
    return bool(all_ > 1e-12 * (1 + np.abs(y).max()) and 1 - rest / all_ > SEASONAL_STRENGTH)


def moves_about(y: np.ndarray) -> bool:
    """Whether the KPSS test rejects that the series keeps around a level."""
    n = len(y)
    e = y - y.mean()
    lags = int(4 * (n / 100) ** 0.25)
    spread = (e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))) / n
    if spread <= 1e-12 * (1 + np.abs(y).max()):
        return False
    walk = np.cumsum(e)
    return bool(walk @ walk / (n * n * spread) > KPSS_LIMIT)


def differences(y: np.ndarray, m: int, limits: Limits) -> tuple[int, int]:
    """(d, D) of a series; enough of it is left to fit on."""
    sd = int(limits.D > 0 and seasonal_difference(y, m))
    w, d = differenced(y, 0, sd, m), 0
    while d < limits.d and len(w) > 10 and moves_about(w):
        w, d = np.diff(w), d + 1
    return d, sd


def differenced(y: np.ndarray, d: int, sd: int, m: int) -> np.ndarray:
    for _ in range(sd):
        y = y[m:] - y[:-m]
    return np.diff(y, d) if d else y


def allowed(order: Order, limits: Limits, many: bool, const: bool) -> bool:
    p, q, sp, sq, c = order
    return (min(order) >= 0 and p <= limits.p and q <= limits.q and sp <= limits.P * many
            and sq <= limits.Q * many and p + q + sp + sq <= limits.total and c <= const)


def around(order: Order) -> list[Order]:
    """The order itself changed by one in p, q, P, Q, in both of a pair, and
    with or without the constant."""
    p, q, sp, sq, c = order
    out = [(p, q, sp, sq, 1 - c)]
    for a, b in ((1, 0), (0, 1), (1, 1), (1, -1)):
        for s in (1, -1):
            out += [(p + s * a, q + s * b, sp, sq, c), (p, q, sp + s * a, sq + s * b, c)]
    return out


class Search:
    """The orders tried for each of a set of series that share d and D."""

    def __init__(self, series: list[np.ndarray], d: int, sd: int, m: int, limits: Limits):
        self.d, self.sd, self.m, self.limits = d, sd, m, limits
        self.const = d + sd <= 1
        works = [differenced(y, d, sd, m) for y in series]
        sizes = np.array([len(w) for w in works])
        length = int(sizes.max())
        self.w = np.zeros((len(works), length))
        for k, w in enumerate(works):
            self.w[k, length - len(w):] = w
        self.scale = np.array([w.std() or 1.0 for w in works])
        self.w /= self.scale[:, None]
        # Seasonal terms need some seasons after those that are conditioned on.
        self.many = sizes >= 4 * m + limits.p if m > 1 else np.zeros(len(works), dtype=bool)
        warm = np.minimum(limits.p + limits.P * m * self.many, sizes // 2)
        self.from_ = length - sizes + warm
        self.count = sizes - warm
        self.level = np.array([(w * w).mean() for w in self.w]) + 1e-300
        self.tried: list[dict[Order, tuple[float, np.ndarray]]] = [{} for _ in works]

    def try_all(self, wanted: list[set[Order]]) -> None:
        """Fit the orders wanted for each series, one order at a time."""
        by: dict[Order, list[int]] = {}
        for k, orders in enumerate(wanted):
            for o in orders:
                # Some residuals more than parameters.
                if o not in self.tried[k] and self.count[k] > sum(o) + 3:
                    by.setdefault(o, []).append(k)
        for o, rows in sorted(by.items()):
            at = np.array(rows)
            x, sse = fit(self.w[at], self.from_[at], o, self.m)
            for k, a, b in zip(rows, aic(sse, self.count[at], o, self.level[at]), x, strict=True):
                self.tried[k][o] = float(a), b

    def ranked(self, k: int) -> list[Order]:
        return sorted(self.tried[k], key=lambda o: (self.tried[k][o][0], o))

    def grid(self, k: int) -> set[Order]:
        lim = self.limits
        return {o for o in product(range(lim.p + 1), range(lim.q + 1), range(lim.P + 1),
                                   range(lim.Q + 1), range(2))
                if allowed(o, lim, self.many[k], self.const)}

    def run(self, stepwise: bool = True) -> None:
        n = len(self.tried)
        if not stepwise:
            self.try_all([self.grid(k) for k in range(n)])
            return
        c = int(self.const)
        first = [(2, 2, sp, sq, c) for sp, sq in product((0, 1), (0, 1))] \
            + [(0, 0, 0, 0, c), (1, 0, 1, 0, c), (0, 1, 0, 1, c)]
        lim = self.limits
        wanted = [{(min(p, lim.p), min(q, lim.q), min(sp, lim.P * int(self.many[k])),
                    min(sq, lim.Q * int(self.many[k])), o) for p, q, sp, sq, o in first}
                  for k in range(n)]
        wanted = [{o for o in w if allowed(o, lim, self.many[k], self.const)} | {(0, 0, 0, 0, c)}
                  for k, w in enumerate(wanted)]
        while any(wanted):
            self.try_all(wanted)
            wanted = [{o for best in self.ranked(k)[:lim.beam] for o in around(best)
                       if o not in self.tried[k] and allowed(o, lim, self.many[k], self.const)
                       and self.count[k] > sum(o) + 3} for k in range(n)]

    def forecast(self, k: int, y: np.ndarray, horizon: int) -> tuple[Order | None, float, np.ndarray]:
        """Best order of series ``k``, its AIC and the next values."""
        ranked = self.ranked(k)
        if not ranked:  # too short for any residual: the mean goes on
            return None, float("nan"), np.full(horizon, y.mean())
        order = ranked[0]
        value, x = self.tried[k][order]
        w = self.w[k:k + 1]
        e = residuals(w, self.from_[k:k + 1], x[None, None, :], order, self.m)[0, 0].tolist()
        mean, ar, ma = unpacked(x, order, self.m)
        past = (w[0] - mean).tolist()
        for _ in range(horizon):
            past.append(sum(float(c) * past[-lag] for lag, c in ar if lag <= len(past))
                        + sum(float(c) * e[-lag] for lag, c in ma if lag <= len(e)))
            e.append(0.0)
        future = (np.array(past[-horizon:]) + float(mean)) * self.scale[k]
        poly = np.array([1.0])
        for _ in range(self.d):
            poly = np.convolve(poly, [1.0, -1.0])
        for _ in range(self.sd):
            poly = np.convolve(poly, np.concatenate([[1.0], np.zeros(self.m - 1), [-1.0]]))
        values = y.tolist()
        for f in future:
            values.append(f - sum(poly[j] * values[-j] for j in range(1, len(poly))))
        return order, value, np.array(values[len(y):])


def forecast_series(series: list[np.ndarray], horizon: int, m: int, limits: Limits = Limits(),
                    stepwise: bool = True) -> list[tuple]:
    """(d, D, best order, AIC, next values) of each series."""
    groups: dict[tuple[int, int], list[int]] = {}
    for k, y in enumerate(series):
        groups.setdefault(differences(y, m, limits), []).append(k)
    out: list[tuple] = [()] * len(series)
    for (d, sd), rows in sorted(groups.items()):
        search = Search([series[k] for k in rows], d, sd, m, limits)
        search.run(stepwise)
        for at, k in enumerate(rows):
            out[k] = (d, sd, *search.forecast(at, series[k], horizon))
    return out


def forecast_arima(series: DataFrame, horizon: int = 28, value: str = "approved_qty", m: int = 12,
                   months: bool = False, limits: Limits = Limits(), stepwise: bool = True) -> DataFrame:
    """(sku_id, event_date, demand_prediction, model, aic) for the ``horizon``
    periods after each SKU's last: seasonal ARIMA with a season of ``m``
    periods, orders searched by AIC (``stepwise``, or all within ``limits``),
    negative predictions set to 0.

    ``series`` has one row a SKU and period (days, or first days of months with
    ``months``), gaps filled; the rows count as successive periods, a NULL value
    as 0. A series too short for a model has its mean as prediction, NULL as
    ``aic`` and ``mean`` as ``model``."""
    rows = series.groupBy(K).agg(F.sort_array(F.collect_list(F.struct(
        F.col("event_date").cast("date").alias("t"),
        F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("y")))).alias("s")) \
        .select(K, F.col("s.t")[F.size("s") - 1].alias("last"), F.col("s.y").alias("y"))
    # The series are small and their fits long: tasks come by number of series,
    # not by bytes.
    path = scratch_path(series.sparkSession, "series")
    rows.write.parquet(path)
    rows = series.sparkSession.read.schema(rows.schema).parquet(path)
    shuffles = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(max(shuffles, -(-rows.count() // TASK_SERIES)), K)
    out = T.StructType([series.schema[K], T.StructField("event_date", T.DateType()),
                        T.StructField("demand_prediction", T.DoubleType()),
                        T.StructField("model", T.StringType()), T.StructField("aic", T.DoubleType())])

    def run(parts):
        for part in parts:
            got = forecast_series([np.array(y, dtype=float) for y in part.column(2).to_pylist()],
                                  horizon, m, limits, stepwise)
            days, names, best = [], [], []
            for last, (d, sd, order, crit, _) in zip(part.column(1).to_pylist(), got, strict=True):
                start = pd.Timestamp(last)
                days += [(start + (pd.DateOffset(months=h) if months else pd.Timedelta(days=h))).date()
                         for h in range(1, horizon + 1)]
                name = "mean" if order is None else \
                    "({},{},{})({},{},{}){}{}".format(order[0], d, order[1], order[2], sd, order[3], m,
                                                      "+c" if order[4] else "")
                names += [name] * horizon
                best += [None if order is None else crit] * horizon
            values = np.concatenate([g[4] for g in got]) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(np.repeat(np.arange(len(got)), horizon))),
                 pa.array(days, pa.date32()), pa.array(np.maximum(values, 0.0)),
                 pa.array(names, pa.string()), pa.array(best, pa.float64())], names=out.names)

    ship_package(series.sparkSession)
    return rows.mapInArrow(run, out)


def monthly_demand(sales: DataFrame, quantity: str = "quantity", when: str = "event_ts") -> DataFrame:
    """(sku_id, event_date, approved_qty): units of each SKU and month from its
    first to its last, months without a sale as 0. Rows without a time are
    left out."""
    sums = sales.where(F.col(when).isNotNull()) \
        .groupBy(K, F.trunc(F.col(when).cast("date"), "month").alias("event_date")) \
        .agg(F.sum(quantity).alias("q"))
    spine = sums.groupBy(K).agg(F.min("event_date").alias("a"), F.max("event_date").alias("b")) \
        .select(K, F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("event_date"))
    return spine.join(sums, [K, "event_date"], "left") \
        .select(K, "event_date", F.coalesce("q", F.lit(0)).cast("long").alias("approved_qty"))
