"""Seasonal ARIMA: residuals, fits and searches against plain versions."""

import datetime as dt
from itertools import product

import numpy as np
from pyspark.sql import functions as F
import pytest

from stockyard.operators import arima as AR
from stockyard.operators.arima import Limits, Search, aic, fit, forecast_series, residuals, unpacked


def poly(low, high, m, sign):
    """Product of 1 + sign * sum low B^i and the seasonal one, by convolution."""
    a = np.concatenate([[1.0], sign * np.asarray(low)])
    b = np.zeros(m * len(high) + 1)
    b[0], b[m::m] = 1.0, sign * np.asarray(high)
    return np.convolve(a, b)


def plain_residuals(w, first, ar, sar, ma, sma, mean, m):
    f, t = poly(ar, sar, m, -1), poly(ma, sma, m, 1)
    e = [0.0] * len(w)
    for k in range(first, len(w)):
        e[k] = sum(c * (w[k - i] - mean) for i, c in enumerate(f) if i <= k) \
            - sum(c * e[k - i] for i, c in enumerate(t) if 0 < i <= k)
    return np.array(e)


@pytest.mark.parametrize("order", [(0, 0, 0, 0, 1), (2, 0, 1, 0, 0), (0, 2, 0, 1, 1), (3, 1, 0, 2, 0),
                                   (2, 2, 1, 1, 1)])
def test_residuals_equal_plain_recursion(order):
    p, q, sp, sq, const = order
    rng, m = np.random.default_rng(sum(order)), 4
    w = rng.normal(size=(3, 40))
    from_ = np.array([9, 12, 9])
    x = rng.normal(size=(3, 2, sum(order)))
    got = residuals(w, from_, x, order, m)
    for s, k in product(range(3), range(2)):
        cut = np.split(x[s, k, const:], np.cumsum([p, sp, q]))
        ar, sar, ma, sma = (AR.stationary(c) for c in cut)
        want = plain_residuals(w[s], from_[s], ar, sar, -ma, -sma, x[s, k, 0] if const else 0.0, m)
        np.testing.assert_allclose(got[s, k], want, atol=1e-9)


def test_coefficients_are_stationary():
    rng = np.random.default_rng(1)
    for k in (1, 2, 5):
        for c in AR.stationary(rng.normal(size=(50, k)) * 2):
            assert np.all(np.abs(np.roots(np.concatenate([[1.0], -c]))) < 1 + 1e-9)


def simulated(n, ar=(), ma=(), seed=0, burn=100):
    rng = np.random.default_rng(seed)
    e, y = rng.normal(size=n + burn), np.zeros(n + burn)
    for t in range(n + burn):
        y[t] = e[t] + sum(a * y[t - i - 1] for i, a in enumerate(ar) if t > i) \
            + sum(b * e[t - i - 1] for i, b in enumerate(ma) if t > i)
    return y[burn:]


def test_fit_finds_the_coefficients():
    y = simulated(4000, ar=(0.5, -0.3), ma=(0.4,), seed=2) + 7
    x, sse = fit(y[None], np.array([2]), (2, 1, 0, 0, 1), 12)
    mean, ar, ma = unpacked(x[0], (2, 1, 0, 0, 1), 12)
    assert abs(mean - 7) < 0.2 and abs(sse[0] / 3998 - 1) < 0.05
    assert abs(ar[0][1] - 0.5) < 0.1 and abs(ar[1][1] + 0.3) < 0.1 and abs(ma[0][1] - 0.4) < 0.1


def test_fit_is_a_minimum():
    rng = np.random.default_rng(3)
    w = np.array([simulated(80, ar=(0.6,), ma=(0.3,), seed=s) for s in range(6)])
    from_, order = np.full(6, 6), (1, 1, 1, 0, 1)
    x, sse = fit(w, from_, order, 4)
    for _ in range(300):  # no neighbour does better
        near = x + rng.normal(size=x.shape) * 10.0 ** rng.uniform(-4, -2)
        e = residuals(w, from_, near[:, None, :], order, 4)[:, 0]
        assert np.all((e * e).sum(axis=1) >= sse * (1 - 1e-6))


def test_fits_do_not_depend_on_company():
    w = np.array([simulated(60, ar=(0.5,), seed=s) for s in range(5)])
    both = fit(w, np.full(5, 3), (1, 1, 0, 0, 1), 12)[1]
    alone = [fit(w[k:k + 1], np.array([3]), (1, 1, 0, 0, 1), 12)[1][0] for k in range(5)]
    np.testing.assert_allclose(both, alone, rtol=1e-6)


def short_series(n=54, m=4):
    out = []
    for k in range(n):
        length = 40 + k % 23
        y = simulated(length, *[((0.7,), ()), ((), (0.6,)), ((0.5, -0.3), (0.4,)), ((), ())][k % 4], seed=k)
        if k % 3 == 1:
            y = y + 6 * np.sin(np.arange(length) * 2 * np.pi / m)
        if k % 5 == 2:
            y = np.cumsum(y)
        out.append(y + 30)
    return out


def test_stepwise_search_equals_all_orders():
    series = short_series()
    walk = forecast_series(series, 4, 4)
    full = forecast_series(series, 4, 4, stepwise=False)
    assert len(series) > 50
    for a, b in zip(walk, full, strict=True):
        assert a[:2] == b[:2] and abs(a[3] - b[3]) < 1e-6
        np.testing.assert_allclose(a[4], b[4], rtol=1e-4, atol=1e-4)


def test_stepwise_search_tries_fewer_orders():
    limits = Limits(p=4, q=4, P=1, Q=1, total=8)
    series = short_series(8)
    walk, full = (Search(series, 0, 0, 4, limits) for _ in range(2))
    walk.run()
    full.run(stepwise=False)
    tried = sum(map(len, walk.tried)), sum(map(len, full.tried))
    assert tried[0] < tried[1]
    for k in range(8):
        best = [s.tried[k][s.ranked(k)[0]][0] for s in (walk, full)]
        assert best[0] - best[1] < 4  # close to the best of all


def test_differences_and_criterion():
    t = np.arange(96)
    season = 10 * np.sin(t * 2 * np.pi / 12)
    noise = np.random.default_rng(5).normal(size=96)
    assert AR.differences(season + noise, 12, Limits()) == (0, 1)
    assert AR.differences(np.cumsum(noise), 12, Limits())[0] == 1
    assert AR.differences(noise, 12, Limits()) == (0, 0)
    assert AR.differences(np.full(50, 3.0), 12, Limits()) == (0, 0)
    assert AR.differences(noise[:20], 12, Limits(D=0, d=0)) == (0, 0)
    got = aic(np.array([50.0]), np.array([100]), (1, 0, 0, 0, 1), np.array([1.0]))
    assert abs(got[0] - (100 * np.log(0.5) + 6)) < 1e-12


def test_forecasts_go_on_with_the_pattern():
    t = np.arange(120)
    noise = 0.05 * np.random.default_rng(6).normal(size=120)
    seasonal = 20 + 0.5 * t + 8 * np.sin(t * 2 * np.pi / 12) + noise
    ahead = np.arange(120, 132)
    got = forecast_series([seasonal, np.full(30, 4.0), np.array([2.0, 4.0])], 12, 12)
    want = 20 + 0.5 * ahead + 8 * np.sin(ahead * 2 * np.pi / 12)
    np.testing.assert_allclose(got[0][4], want, atol=0.5)
    np.testing.assert_allclose(got[1][4], 4.0)
    np.testing.assert_allclose(got[2][4], 3.0)
    assert got[2][2] is None


def test_forecast_of_tables(spark):
    start = dt.date(2020, 1, 1)
    rows = [("a", start + dt.timedelta(days=k), 10 + k % 4) for k in range(60)]
    rows += [("b", start + dt.timedelta(days=k), v) for k, v in enumerate([3, None, 0])]
    rows += [("c", start + dt.timedelta(days=k), 40 - 4 * k) for k in range(11)]
    df = spark.createDataFrame(rows, "sku_id string, event_date date, approved_qty int").repartition(3)
    got = AR.forecast_arima(df, horizon=8, m=4).collect()
    assert len(got) == 24 and all(r.demand_prediction >= 0 for r in got)
    a = sorted((r.event_date, r.demand_prediction) for r in got if r.sku_id == "a")
    assert a[0][0] == start + dt.timedelta(days=60)
    np.testing.assert_allclose([v for _, v in a], [10 + k % 4 for k in range(60, 68)], atol=1e-3)
    b = [r for r in got if r.sku_id == "b"]
    assert {r.model for r in b} == {"mean"} and {r.aic for r in b} == {None}
    assert {r.demand_prediction for r in b} == {1.0}
    assert min(r.demand_prediction for r in got if r.sku_id == "c") == 0.0
    months = AR.forecast_arima(spark.createDataFrame(
        [(1, dt.date(2020, 11, 1), 5), (1, dt.date(2020, 12, 1), 5)], "sku_id int, event_date date, approved_qty int"),
        horizon=2, months=True).collect()
    assert [r.event_date for r in months] == [dt.date(2021, 1, 1), dt.date(2021, 2, 1)]
    assert AR.forecast_arima(df.limit(0), horizon=8).count() == 0


def test_monthly_demand(spark):
    rows = [(1, dt.datetime(2020, 1, 31), 2), (1, dt.datetime(2020, 1, 1), 3), (1, dt.datetime(2020, 4, 1), 1),
            (1, None, 9), (2, None, 4)]
    df = spark.createDataFrame(rows, "sku_id int, event_ts timestamp_ntz, quantity int")
    got = sorted(tuple(r) for r in AR.monthly_demand(df).collect())
    assert got == [(1, dt.date(2020, 1, 1), 5), (1, dt.date(2020, 2, 1), 0), (1, dt.date(2020, 3, 1), 0),
                   (1, dt.date(2020, 4, 1), 1)]


def test_series_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    """Many short series are few bytes, but no task fits more than a share of them."""
    monkeypatch.setattr(AR, "TASK_SERIES", 20)
    df = spark.createDataFrame([(k, dt.date(2020, 1, 1 + d), k % 7 + d) for k in range(400) for d in range(3)],
                               "sku_id int, event_date date, approved_qty int")
    got = AR.forecast_arima(df, horizon=1)
    sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 50 and len(sizes) >= 15


def test_fits_do_not_depend_on_their_company(monkeypatch):
    rng = np.random.default_rng(3)
    w = rng.normal(size=(30, 60)).cumsum(axis=1)
    from_ = rng.integers(2, 20, 30)
    for order in ((0, 0, 0, 0, 0), (0, 0, 0, 0, 1), (2, 0, 0, 0, 1), (1, 1, 0, 0, 0), (1, 2, 1, 1, 0)):
        x, sse = AR.fit(w, from_, order, 12)
        monkeypatch.setattr(AR, "_CELLS", 60 * 6 * 4)
        few, few_sse = AR.fit(w, from_, order, 12)
        monkeypatch.undo()
        np.testing.assert_allclose(few, x, rtol=1e-9)
        np.testing.assert_allclose(few_sse, sse, rtol=1e-9)
