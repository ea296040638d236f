"""Late events, copies merged by field, buckets of equal size."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockyard.operators import events as EV
from stockyard.operators import inventory as INV
from stockyard.operators import late as LT
from stockyard.operators import windows as W
from stockyard.session import scratch_count

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "sku_id long, sales_id long, event_ts timestamp_ntz, quantity int, status string"


def plain_longest(t):
    """The kept places, from the lengths of all chains."""
    length = []
    for i, v in enumerate(t):
        length.append(1 + max((length[j] for j in range(i) if t[j] <= v), default=0))
    keep, i = set(), max((k for k in range(len(t)) if length[k] == max(length)), default=-1)
    while i >= 0:
        keep.add(i)
        i = max((j for j in range(i) if length[j] == length[i] - 1), default=-1) if length[i] > 1 else -1
    return keep


def plain_late(rows):
    """(sku, id) of the late events."""
    out = set()
    for sku in {r[0] for r in rows}:
        mine = sorted((r[1], r[2]) for r in rows if r[0] == sku and r[2] is not None)
        keep = plain_longest([t for _, t in mine])
        out |= {(sku, i) for k, (i, _) in enumerate(mine) if k not in keep}
    return out


def minutes(*values):
    return [T0 + dt.timedelta(minutes=v) for v in values]


def found(df):
    return {(r.sku_id, r.sales_id) for r in df.collect() if r.is_late}



def order():
    return [F.col("sales_id")]


def test_longest_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(500):
        t = rng.integers(0, rng.integers(1, 30), rng.integers(0, 25))
        assert set(np.flatnonzero(LT.longest_in_order(t)).tolist()) == plain_longest(t.tolist())


def test_one_event_ahead_flags_itself_only(spark):
    times = minutes(0, 10, 20, 150, 30, 40, 50, 60, 70, 80, 90, 100, 110, 120)
    s = spark.createDataFrame([(1, k, t, 1, "placed") for k, t in enumerate(times)], SCHEMA)
    flags = {r.sales_id: r.event_quality_flag for r in EV.event_quality(s, late="smallest").collect()}
    assert [k for k, f in flags.items() if f != "valid"] == [3]
    running = {r.sales_id: r.event_quality_flag for r in EV.event_quality(s).collect()}
    assert sum(f == "out_of_order" for f in running.values()) == 10
    with pytest.raises(ValueError):
        EV.event_quality(s, late="other")


def test_kinds_of_slips(spark):
    base = [10 * k for k in range(60)]
    slips = {10: 60, 20: -60, 30: 100, 40: 119, 50: 500}
    times = minutes(*[v + slips.get(k, 0) for k, v in enumerate(base)])
    s = spark.createDataFrame([(1, k, t, 1, "placed") for k, t in enumerate(times)], SCHEMA)
    got = {r.sales_id: r.late_kind for r in LT.late_events(s, order()).collect() if r.is_late}
    # +119 minutes leaves it 109 from its neighbour; an hour back is no fit.
    assert got == {10: "hour_slip", 20: "hour_slip", 30: "near", 40: "near", 50: "far"}


def disorder(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        sku = 1 if k % 3 == 0 else rng.randint(2, 6)
        slip = rng.choice([0] * 12 + [rng.randint(-120, 120), -60, 60])
        t = None if rng.random() < 0.03 else T0 + dt.timedelta(minutes=k + slip, seconds=rng.randint(0, 2) * 20)
        rows.append((sku, k, t, rng.randint(1, 60), rng.choice(["placed", None])))
    return rows


@pytest.mark.parametrize("bucket_rows", [500_000, 70])
def test_late_events_equal_plain_search(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(W, "BUCKET_ROWS", bucket_rows)
    rows = disorder(1500, 3)
    got = LT.late_events(spark.createDataFrame(rows, SCHEMA).repartition(4), order())
    assert got.columns == [*[c.split()[0] for c in SCHEMA.split(", ")], "is_late", "late_kind"]
    all_rows = got.collect()
    assert Counter(tuple(r)[:5] for r in all_rows) == Counter(rows)
    assert {(r.sku_id, r.sales_id) for r in all_rows if r.is_late} == plain_late(rows)
    assert all((r.late_kind is None) != r.is_late for r in all_rows)


def test_long_segments_fall_apart(spark, monkeypatch):
    """A few events stamped far ahead or far back join all segments to one;
    they are taken out first, and the flags and kinds are those of one search."""
    rng = random.Random(5)
    slips = {k: rng.choice([-60, 60, 2, -3, 110]) for k in rng.sample(range(1200), 12)}
    slips |= {100: 4000, 400: 3000, 401: 3000, 900: -2500}
    rows = [(1, k, T0 + dt.timedelta(minutes=10 * k + slips.get(k, 0) * (10 if k in (100, 400, 401, 900) else 1)),
             1, "placed") for k in range(1200)]
    want = {tuple(r) for r in LT.late_events(spark.createDataFrame(rows, SCHEMA), order()).collect()}
    assert {(r[0], r[1]) for r in want if r[5]} == plain_late(rows)
    monkeypatch.setattr(W, "BUCKET_ROWS", 100)
    taken = []
    real = LT._displaced
    monkeypatch.setattr(LT, "_displaced", lambda big, when: taken.append(real(big, when)) or taken[-1])
    got = {tuple(r) for r in LT.late_events(spark.createDataFrame(rows, SCHEMA), order(), segment_rows=50).collect()}
    assert got == want
    assert taken and not taken[0].isEmpty()


def test_late_events_edge_cases(spark):
    assert LT.late_events(spark.createDataFrame([], SCHEMA), order()).count() == 0
    rows = [(1, 1, None, 1, None), (1, 2, T0, 1, "x"), (1, 3, T0, 1, "x"), (None, 4, T0, 1, "x"),
            (None, 5, T0 - dt.timedelta(hours=1), 1, "x")]
    got = LT.late_events(spark.createDataFrame(rows, SCHEMA), order()).collect()
    assert sorted((r.sales_id, r.is_late) for r in got) == [(1, False), (2, False), (3, False), (4, True), (5, False)]
    dates = spark.createDataFrame([(1, k, dt.date(2024, 1, d)) for k, d in enumerate([1, 3, 2, 4])],
                                  "sku_id int, n int, day date")
    got = LT.late_events(dates, [F.col("n")], when="day").collect()
    assert [r.n for r in got if r.is_late] == [1]


def test_skus_of_few_events_are_shuffled_once(spark, monkeypatch):
    """However many SKUs there are, no row is written aside and the rows move
    once; a SKU's run may lie in many Arrow batches."""
    monkeypatch.setattr(W, "BUCKET_ROWS", 70)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rng = random.Random(8)
    rows = [(None if k % 40 == 0 else k % 40, k, T0 + dt.timedelta(minutes=k + rng.randint(-200, 200)), 1, None)
            for k in range(2000)]
    known = scratch_count()
    df = LT.late_events(spark.createDataFrame(rows, SCHEMA), order())
    assert scratch_count() == known
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    for size in ("7", "64", before):
        spark.conf.set(key, size)
        try:
            got = LT.late_events(spark.createDataFrame(rows, SCHEMA), order()).collect()
        finally:
            spark.conf.set(key, before)
        assert Counter(tuple(r)[:5] for r in got) == Counter(rows)
        assert {(r.sku_id, r.sales_id) for r in got if r.is_late} == plain_late(rows)


def test_many_events_without_a_sku_stay(spark, monkeypatch):
    rows = [(None if r[0] == 1 else r[0], *r[1:]) for r in disorder(900, 6)]
    want = {tuple(r) for r in LT.late_events(spark.createDataFrame(rows, SCHEMA), order()).collect()}
    monkeypatch.setattr(W, "BUCKET_ROWS", 70)
    got = {tuple(r) for r in LT.late_events(spark.createDataFrame(rows, SCHEMA), order()).collect()}
    assert got == want and len(got) == 900


def test_heavy_keys(spark):
    df = spark.createDataFrame([(str(k),) for k in range(500)] + [("x",)] * 60 + [(None,)] * 40, "k string")
    total, heavy = W.heavy_keys(df, "k", 39)
    assert total == 600 and {r[0] for r in heavy.collect()} == {"x", None}
    assert W.of_keys(df, "k", heavy, "left_semi").count() == 100
    assert W.of_keys(df, "k", heavy, "left_anti").count() == 500
    assert W.heavy_keys(df, "k", 60) == (600, None)


# --- copies ----------------------------------------------------------------

def merged(spark, rows, cap=50):
    return {r.sales_id: tuple(r) for r in EV.merge_copies(spark.createDataFrame(rows, SCHEMA), cap).collect()}


def test_every_fault_of_a_copy_is_mended(spark):
    clean = [(1, k, T0 + dt.timedelta(minutes=30 * k), 2, "placed") for k in range(1, 9)]
    h = dt.timedelta(hours=1)
    faults = [(1, 2, clean[1][2], 2, None),                # status lost
              (1, 3, None, 2, "placed"),                   # time lost
              (1, 4, clean[3][2] - 2 * h, 2, "placed"),    # out of order
              (1, 5, clean[4][2] + h, 2, "placed"),        # zone slip
              (1, 6, clean[5][2], 400, "placed"),          # quantity outlier
              (1, 7, clean[6][2] - 2 * h, 2, None),        # two faults: earlier, and status lost
              (1, 8, clean[7][2] + h, 300, "placed")]
    got = merged(spark, clean + faults)
    assert got == {r[1]: r for r in clean}


def test_copies_that_share_no_field(spark):
    rows = [(1, 1, None, 99, None), (1, 1, None, 70, None), (2, 2, T0, 60, "b"), (2, 2, T0, 60, "a"),
            (3, None, T0, 1, "x"), (3, None, T0, 1, "x"), (4, 3, T0, None, "x"), (4, 3, T0, 7, None)]
    got = EV.merge_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, 1, None, 70, None), (2, 2, T0, 60, "a"), (3, None, T0, 1, "x"), (3, None, T0, 1, "x"),
         (4, 3, T0, 7, "x")], key=str)


def test_merged_copies_do_not_depend_on_buckets(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.randint(1, 3), rng.randint(1, 300), T0 + dt.timedelta(minutes=rng.randint(0, 300)),
             rng.randint(1, 90), rng.choice(["a", "b", None])) for _ in range(700)]
    want = merged(spark, rows)
    monkeypatch.setattr(W, "BUCKET_ROWS", 40)
    assert merged(spark, rows) == want
    assert len(want) == len({r[1] for r in rows})


def test_hot_id_is_reduced_in_each_task(spark):
    rows = [(1, 5, T0 + dt.timedelta(seconds=k), k % 80, None) for k in range(3000)] + [(1, 6, T0, 1, "a")]
    df = EV.merge_copies(spark.createDataFrame(rows, SCHEMA))
    assert df.count() == 2
    assert "partial_min" in df._jdf.queryExecution().toString()


# --- buckets ---------------------------------------------------------------

def test_buckets_are_even_with_a_busy_hour_and_a_far_id(spark):
    rows = [(1, k, T0 + dt.timedelta(milliseconds=k)) for k in range(10_000)]  # a third in one hour of one SKU
    rows += [(2 + k % 50, 20_000 + k, T0 + dt.timedelta(hours=k)) for k in range(20_000)]
    rows += [(1, 10 ** 15, T0 + dt.timedelta(days=9000))]
    df = spark.createDataFrame(rows, "sku_id long, n long, t timestamp_ntz").repartition(8)
    for cols in (["t", "n"], ["n"]):
        got, name = W.even_buckets(df, ["sku_id"], [F.col(c) for c in cols], rows=1000)
        sizes = [r["count"] for r in got.groupBy("sku_id", name).count().collect()]
        mean = len(rows) / got.select(name).distinct().count()
        assert max(sizes) <= 2 * mean
    small, name = W.even_buckets(df, ["sku_id"], ["n"])
    assert name is None and small is df


def test_ledger_with_even_buckets(spark, monkeypatch):
    rng = random.Random(4)
    sales = [(1 if k % 3 == 0 else rng.randint(2, 5), f"S{k:08d}", T0 + dt.timedelta(seconds=rng.randint(0, 9000)),
              rng.randint(1, 9), rng.choice(["approved", "placed"])) for k in range(3000)]
    acq = [(rng.randint(1, 5), f"A{k:08d}", T0 + dt.timedelta(seconds=rng.randint(0, 9000)), "planned", 20)
           for k in range(300)]
    s = spark.createDataFrame(sales, "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string")
    a = spark.createDataFrame(acq, "sku_id long, acquisition_id string, event_ts timestamp_ntz, reason string, "
                                   "quantity_received int")
    want = sorted(map(tuple, INV.stock_ledger(s, a, 5, bucket=None).collect()))
    monkeypatch.setattr(W, "BUCKET_ROWS", 150)
    got = INV.stock_ledger(s, a, 5)
    assert "__bucket" not in got.columns
    assert sorted(map(tuple, got.collect())) == want
