"""Daily stock carried on from batch to batch against one run over all."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from stockyard.operators import inventory as INV
from stockyard.session import scratch_path
from stockyard.streaming import stock

SALES = "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string"
ACQ = "sku_id long, acquisition_id string, event_ts timestamp_ntz, reason string, quantity_received int"
T0 = dt.datetime(2024, 1, 20)


def events(seed=1, days=75):
    """(arrival, sale) and (arrival, acquisition); some come late."""
    rng = random.Random(seed)
    sales, acq = [], []
    for k in range(600):
        day = rng.randrange(days)
        arrival = min(4, day // 15 + (rng.random() < 0.15) * rng.randint(1, 4))
        sales.append((arrival, (rng.randint(1, 4), f"S{k}", T0 + dt.timedelta(days=day, minutes=rng.randrange(1440)),
                                rng.randint(1, 5), rng.choice(["approved", "approved", "placed", None]))))
    for k in range(60):
        day = rng.randrange(days)
        acq.append((min(4, day // 15), (rng.randint(1, 5), f"A{k}", T0 + dt.timedelta(days=day), "planned", 20)))
    sales += [(3, (9, "S9", T0 + dt.timedelta(days=50), 2, "approved")),   # new late in the series
              (4, (9, "S8", T0 + dt.timedelta(days=3), 2, "approved"))]    # and then from before its first day
    return sales, acq


def frames(spark, sales, acq, zone="UTC"):
    return (spark.createDataFrame([r for _, r in sales], SALES),
            spark.createDataFrame([r for _, r in acq], ACQ))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_five_batches_equal_one(spark):
    sales, acq = events()
    want = rows(INV.inventory_daily(*frames(spark, sales, acq), initial_stock=7, zone="UTC"))
    home = scratch_path(spark, "stock")
    for n in range(5):
        m = INV.ledger_movements(*frames(spark, [e for e in sales if e[0] == n], [e for e in acq if e[0] == n]))
        stock.apply_batch(m, n, home, 7, "UTC")
        seen = INV.inventory_daily(*frames(spark, [e for e in sales if e[0] <= n], [e for e in acq if e[0] <= n]),
                                   initial_stock=7, zone="UTC")
        assert rows(stock.read_daily(spark, home)) == rows(seen)
    assert rows(stock.read_daily(spark, home)) == want


def test_only_changed_months_are_rewritten(spark):
    sales, acq = events()
    home = scratch_path(spark, "stock")
    stock.apply_batch(INV.ledger_movements(*frames(spark, sales, acq)), 0, home, 0, "UTC")

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(f"{home}/daily") for f in fs if f.endswith(".parquet")}

    before = files()
    late = spark.createDataFrame([(1, "S", T0 + dt.timedelta(days=74), 1, "approved")], SALES)
    stock.apply_batch(INV.ledger_movements(late, spark.createDataFrame([], ACQ)), 1, home, 0, "UTC")
    changed = {f.split("month=")[1][:7] for f in files() - before}
    assert changed == {"2024-04"} and len({f.split("month=")[1][:7] for f in before}) == 4


@pytest.mark.parametrize("broken_at", ["staged", "swapped"])
def test_batch_that_runs_again(spark, broken_at):
    sales, acq = events(2)
    home = scratch_path(spark, "stock")
    parts = [INV.ledger_movements(*frames(spark, [e for e in sales if e[0] == n], [e for e in acq if e[0] == n]))
             for n in range(5)]
    for n in range(4):
        stock.apply_batch(parts[n], n, home, 0, "UTC")
    if broken_at == "staged":   # computed, but not yet swapped in
        stock._compute(spark, parts[4], 4, home, f"{home}/stage/v=4", 0, "UTC", INV.MAX_GAP_DAYS)
    else:                       # swapped in, but not yet committed by the stream
        stock.apply_batch(parts[4], 4, home, 0, "UTC")
    stock.apply_batch(parts[4], 4, home, 0, "UTC")
    want = INV.inventory_daily(*frames(spark, sales, acq), zone="UTC")
    assert rows(stock.read_daily(spark, home)) == rows(want)


def test_far_off_days_and_missing_times_are_rejected(spark):
    home = scratch_path(spark, "stock")
    acq = spark.createDataFrame([], ACQ)
    first = spark.createDataFrame([(1, "a", T0, 3, "approved"), (1, "b", None, 9, "approved"),
                                   (2, "c", T0, 1, "approved"), (2, "d", T0.replace(year=2090), 5, "approved")], SALES)
    stock.apply_batch(INV.ledger_movements(first, acq), 0, home, 10, "UTC")
    then = spark.createDataFrame([(1, "e", T0.replace(year=1990), 3, "approved"),
                                  (1, "f", T0 + dt.timedelta(days=2), 1, "approved")], SALES)
    stock.apply_batch(INV.ledger_movements(then, acq), 1, home, 10, "UTC")
    got = {(r.sku_id, r.event_date): r.inventory_eod for r in stock.read_daily(spark, home).collect()}
    d = T0.date()
    assert got == {(1, d): 7, (1, d + dt.timedelta(days=1)): 7, (1, d + dt.timedelta(days=2)): 6, (2, d): 9}
    bad = spark.read.parquet(f"{home}/rejected/v=0").union(spark.read.parquet(f"{home}/rejected/v=1"))
    assert sorted((r.sku_id, r.approved_qty, r.reason) for r in bad.collect()) == \
        [(1, 3, "far_off_day"), (1, 9, "no_time"), (2, 5, "far_off_day")]


def test_stream_of_two_feeds(spark):
    sales, acq = events(3)
    home, ck = scratch_path(spark, "stock"), scratch_path(spark, "stock-ck")
    feeds = scratch_path(spark, "feed-s"), scratch_path(spark, "feed-a")
    for n in range(5):
        for df, path in zip(frames(spark, [e for e in sales if e[0] == n], [e for e in acq if e[0] == n]), feeds,
                            strict=True):
            df.coalesce(1).write.mode("append").parquet(path)
        if n in (1, 4):
            stock.carry_stock(stock.movement_stream(spark, *feeds, max_files_per_trigger=1), home, ck, 0,
                              "UTC").awaitTermination()
    want = INV.inventory_daily(*frames(spark, sales, acq), zone="UTC")
    assert rows(stock.read_daily(spark, home)) == rows(want.select(*[F.col(c) for c in stock.DAILY]))
