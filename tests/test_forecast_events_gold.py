"""Forecast, weekly depletion, event hygiene and gold product demand."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest

from stockyard import config as C
from stockyard.operators import events as EV
from stockyard.operators import forecast as FC
from stockyard.plans import gold

DAILY_T = "sku_id long, event_date date, received_qty long, approved_qty long, inventory_eod long"


def _daily(spark, fn, days=70, skus=(1, 2)):
    rows = []
    for k in skus:
        for i in range(days):
            d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            rows.append((k, d, 0, int(fn(k, i, d)), 1000 - i))
    return spark.createDataFrame(rows, DAILY_T)


def test_forecast_linear_weekday_exact(spark):
    # a pure trend is reproduced exactly (weekday effects are then 0)
    f = lambda k, i, d: 10 * k + i
    d = _daily(spark, f)
    p = {(r["sku_id"], r["event_date"]): r["demand_prediction"] for r in FC.forecast_demand(d, 28).collect()}
    assert len(p) == 56
    last = dt.date(2024, 1, 1) + dt.timedelta(days=69)
    for k in (1, 2):
        for j in range(1, 29):
            day = last + dt.timedelta(days=j)
            t = 69 + j
            want = 10 * k + t
            assert p[(k, day)] == pytest.approx(want, abs=1e-3)


def test_forecast_grouped_equals_native(spark):
    rng = np.random.default_rng(5)
    noise = rng.integers(0, 9, size=1000)
    d = _daily(spark, lambda k, i, day: noise[i + 100 * k] + k, days=50, skus=(1, 2, 3))
    a = {(r[0], r[1]): r[2] for r in FC.rounded(FC.forecast_demand(d, 14)).collect()}
    b = {(r[0], r[1]): r[2] for r in FC.forecast_demand_grouped(d, 14).collect()}
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=2e-4)


def test_forecast_single_day_history(spark):
    d = spark.createDataFrame([(1, dt.date(2024, 1, 1), 0, 4, 5)], DAILY_T)
    p = FC.forecast_demand(d, 3).collect()
    assert [r["demand_prediction"] for r in p] == [4.0, 4.0, 4.0]


def test_weekly_cumulative_and_depletion(spark):
    pred = spark.createDataFrame(
        [(1, dt.date(2025, 12, 19) + dt.timedelta(days=i), 1.25) for i in range(10)],
        "sku_id long, event_date date, demand_prediction double")
    w = {r["week_monday"]: r["weekly_demand"] for r in FC.weekly_demand(pred).collect()}
    # Fri 19 .. Sun 21 -> week of 15th (3 days), 22..28 (7 days)
    assert w == {dt.date(2025, 12, 15): 4, dt.date(2025, 12, 22): 9}
    daily = spark.createDataFrame([(1, dt.date(2025, 12, 17), 0, 0, 50), (1, dt.date(2025, 12, 18), 0, 0, 40)],
                                  DAILY_T)
    out = sorted(FC.inventory_forecast(daily, pred).collect(), key=lambda r: r["week_monday"])
    assert [(r["weekly_demand_cum"], r["remaining_inventory"]) for r in out] == [(4, 36), (13, 27)]


SALES_T = "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string"


def test_dedupe_picks_earliest(spark):
    t = dt.datetime
    s = spark.createDataFrame([
        (1, "S1", t(2024, 1, 1, 10), 2, "placed"), (1, "S1", t(2024, 1, 1, 9), 3, "canceled"),
        (1, "S1", None, 1, "placed"), (1, "S2", None, 1, None), (1, "S2", None, 1, "placed"),
        (1, "S3", t(2024, 1, 1), 1, "approved")], SALES_T)
    out = {r["sales_id"]: r for r in EV.dedupe_events(s).collect()}
    assert out["S1"]["event_ts"] == t(2024, 1, 1, 9) and out["S1"]["quantity"] == 3
    assert out["S2"]["status"] == "placed"
    assert len(out) == 3


def test_event_quality_flags(spark):
    t = dt.datetime
    s = spark.createDataFrame([
        (1, "S1", t(2024, 1, 1, 10), 2, "placed"), (1, "S2", t(2024, 1, 1, 9), 3, "placed"),
        (1, "S3", None, 1, "placed"), (1, "S4", t(2024, 1, 1, 11), 1, None),
        (1, "S5", t(2024, 1, 1, 12), 500, "canceled"), (2, "S6", t(2024, 1, 1, 1), 1, "approved")], SALES_T)
    flags = {r["sales_id"]: r["event_quality_flag"] for r in EV.event_quality(s).collect()}
    assert flags == {"S1": "valid", "S2": "out_of_order", "S3": "null_event_ts", "S4": "null_status",
                     "S5": "quantity_outlier", "S6": "valid"}


def test_product_demand_semantics(spark):
    t = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame([
        ("o1", "DELIVERED", t), ("o2", " Canceled ", t), ("o3", "unavailable", t), ("o4", "delivered", None),
        ("o5", None, t)], "order_id string, order_status string, order_approved_at timestamp")
    items = spark.createDataFrame([
        ("o1", 1, "pA", Decimal("1.10"), Decimal("0.10")), ("o1", 2, "pB", Decimal("2.00"), Decimal("0.20")),
        ("o1", 3, "pB", Decimal("3.00"), Decimal("0.30")), ("o2", 1, "pA", Decimal("9"), Decimal("9")),
        ("o3", 1, "pA", Decimal("9"), Decimal("9")), ("o4", 1, "pA", Decimal("9"), Decimal("9")),
        ("o5", 1, "pA", Decimal("9"), Decimal("9"))],
        "order_id string, order_item_id int, product_id string, price decimal(10,2), freight_value decimal(10,2)")
    prods = spark.createDataFrame([("pA", "casa", 1, 1, 1, 1, 1, 1), ("pB", "mesa", 2, 2, 2, 2, 2, 2)],
                                  "product_id string, product_category_name string, product_name_lenght int, "
                                  "product_description_lenght int, product_weight_g int, product_length_cm int, "
                                  "product_height_cm int, product_width_cm int")
    out = {r["product_id"]: r for r in gold.product_demand_features(orders, items, prods).collect()}
    assert set(out) == {"pA"} | {"pB"}
    assert out["pB"]["quantity"] == 3 and out["pB"]["line_count"] == 2  # max(order_item_id) caveat
    assert out["pB"]["total_price"] == Decimal("5.00") and out["pB"]["total_freight_value"] == Decimal("0.50")
    assert out["pA"]["total_price"] == Decimal("1.10")
    typed = gold.conform(gold.product_demand_features(orders, items, prods))
    assert [f.dataType.simpleString() for f in typed.schema.fields][-3:] == ["int", "double", "double"]


@pytest.mark.parametrize("season", [7, 12])
def test_forecast_season_native_equals_grouped(spark, season):
    rng = np.random.default_rng(season)
    noise = rng.integers(0, 20, size=400)
    d = _daily(spark, lambda k, i, day: noise[i + 100 * k] + (i % season), days=90, skus=(1, 2))
    a = {(r[0], r[1]): r[2] for r in FC.rounded(FC.forecast_demand(d, 10, season=season)).collect()}
    b = {(r[0], r[1]): r[2] for r in FC.forecast_demand_grouped(d, 10, season=season).collect()}
    assert a.keys() == b.keys() and len(a) == 20
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=2e-4)


def test_dedupe_keeps_rows_without_id(spark):
    t = dt.datetime(2024, 1, 1)
    s = spark.createDataFrame([(1, None, t, 1, "placed"), (1, None, t, 2, "placed"), (1, "S1", t, 1, "placed"),
                               (1, "S1", t, 1, "placed")], SALES_T)
    out = EV.dedupe_events(s).collect()
    assert len(out) == 3 and sum(1 for r in out if r["sales_id"] is None) == 2


def test_holt_winters_model_recovers_seasonal_trend(spark):
    season = [5, 0, 0, 0, 2, 8, 3]
    d = _daily(spark, lambda k, i, day: 20 + i // 7 + season[day.weekday()], days=84, skus=(1,))
    p = {r["event_date"]: r["demand_prediction"]
         for r in FC.forecast_demand_grouped(d, 14, model=FC.holt_winters_model()).collect()}
    assert len(p) == 14
    for day, v in p.items():
        i = (day - dt.date(2024, 1, 1)).days
        assert v == pytest.approx(20 + i / 7 + season[day.weekday()], abs=2.0)
