"""Property tests: operators against plain Python rules on arbitrary inputs."""

import datetime as dt
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

spark_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 500),
                                st.one_of(st.none(), st.integers(-20, 20))),
                      min_size=1, max_size=200, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=12, deadline=None, derandomize=True)
@given(spark_rows, st.sampled_from(["sum", "max", "min"]), st.booleans(), st.integers(1, 64))
def test_two_level_running_equals_plain_window(spark, rows_, op, cur, width):
    from pyspark.sql import functions as F

    from stockyard.operators.windows import running
    df = spark.createDataFrame(rows_, "k long, i long, v long")
    a = running(df, ["k"], [F.col("i")], "v", "o", op, include_current=cur)
    b = running(df, ["k"], [F.col("i")], "v", "o", op, bucket=F.floor(F.col("i") / width), include_current=cur)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


holiday_specs = st.dictionaries(
    st.sampled_from(["natal", "dia_das_criancas", "dia_das_maes", "dia_dos_pais", "dia_dos_namorados",
                     "black_friday", "cyber_monday"]),
    st.tuples(st.floats(0.5, 3.0).map(lambda x: round(x, 2)), st.integers(0, 12), st.integers(0, 12)),
    min_size=1)
key_ranges = st.lists(st.tuples(st.dates(min_value=dt.date(2021, 1, 1), max_value=dt.date(2026, 12, 31)),
                                st.integers(0, 900)), min_size=1, max_size=4)


@settings(max_examples=10, deadline=None, derandomize=True)
@given(holiday_specs, key_ranges)
def test_holiday_multiplier_matches_python(spark, spec, rngs):
    from stockyard.operators import calendar as CAL
    from test_calendar import py_multipliers
    ranges = [(k, s, s + dt.timedelta(days=n)) for k, (s, n) in enumerate(rngs)]
    df = spark.createDataFrame(ranges, "sku_id long, start date, end date")
    got = {(r["sku_id"], r["event_date"]): r["holiday_mult"] for r in CAL.holiday_multiplier(df, spec).collect()}
    want = {(k, d): m for k, s, e in ranges for d, m in py_multipliers(s, e, spec).items()}
    assert got == want


sale_rows = st.lists(st.tuples(
    st.integers(1, 3),                                                   # sku
    st.integers(0, 40).map(lambda i: f"S{i:04d}"),                       # id (repeats)
    st.one_of(st.none(), st.integers(0, 5000).map(
        lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=s))),   # time
    st.integers(1, 80),                                                  # quantity
    st.one_of(st.none(), st.sampled_from(["approved", "placed", "canceled"]))), min_size=1, max_size=120)
SALES_T = "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string"


def _key(v):
    return (v is None, v if v is not None else 0)


@settings(max_examples=10, deadline=None, derandomize=True)
@given(sale_rows)
def test_dedupe_matches_python(spark, rows_):
    from stockyard.operators.events import dedupe_events
    got = sorted(map(tuple, dedupe_events(spark.createDataFrame(rows_, SALES_T)).collect()), key=str)
    best = {}
    for r in rows_:
        k = (_key(r[2]), (r[4] is None, r[4] or ""), r[3], r[0])
        if r[1] not in best or k < best[r[1]][0]:
            best[r[1]] = (k, r)
    want = sorted(((r[1], r[0], r[2], r[3], r[4]) for _, r in best.values()), key=str)
    assert got == want


@settings(max_examples=10, deadline=None, derandomize=True)
@given(sale_rows)
def test_event_quality_matches_python(spark, rows_):
    from stockyard.operators.events import event_quality
    rows_ = list({r[1]: r for r in rows_}.values())  # unique ids: a total arrival order
    got = {r["sales_id"]: r["event_quality_flag"]
           for r in event_quality(spark.createDataFrame(rows_, SALES_T), outlier_threshold=50).collect()}
    want = {}
    for sku in {r[0] for r in rows_}:
        prev = None
        for r in sorted((r for r in rows_ if r[0] == sku), key=lambda r: r[1]):
            if r[4] is None:
                f = "null_status"
            elif r[2] is None:
                f = "null_event_ts"
            elif prev is not None and r[2] < prev:
                f = "out_of_order"
            elif r[3] > 50:
                f = "quantity_outlier"
            else:
                f = "valid"
            want[r[1]] = f
            if r[2] is not None:
                prev = r[2] if prev is None else max(prev, r[2])
    assert got == want


movements = st.tuples(
    st.lists(st.tuples(st.integers(1, 2), st.integers(0, 9999).map(lambda i: f"S{i:05d}"),
                       st.one_of(st.none(), st.integers(0, 30 * 24 * 60).map(
                           lambda m: dt.datetime(2024, 2, 20) + dt.timedelta(minutes=m))),
                       st.integers(1, 9), st.sampled_from(["approved", "placed"])),
             min_size=1, max_size=80, unique_by=lambda r: r[1]),
    st.lists(st.tuples(st.integers(1, 2), st.integers(0, 999).map(lambda i: f"A{i:04d}"),
                       st.integers(0, 30 * 24 * 60).map(lambda m: dt.datetime(2024, 2, 20) + dt.timedelta(minutes=m)),
                       st.integers(1, 30)),
             min_size=1, max_size=20, unique_by=lambda r: r[1]))


@settings(max_examples=8, deadline=None, derandomize=True)
@given(movements, st.integers(0, 10))
def test_daily_stock_and_ledger_match_python(spark, mv, init):
    from zoneinfo import ZoneInfo

    from stockyard.operators import inventory as INV
    sales, acq = mv
    sp = ZoneInfo("America/Sao_Paulo")
    s_df = spark.createDataFrame(sales, "sku_id long, sales_id string, event_ts timestamp_ntz, "
                                        "quantity int, status string")
    a_df = spark.createDataFrame([(k, i, t, "planned", q) for k, i, t, q in acq],
                                 "sku_id long, acquisition_id string, event_ts timestamp_ntz, reason string, "
                                 "quantity_received int")
    day = lambda t: t.replace(tzinfo=dt.timezone.utc).astimezone(sp).date()
    # ledger: order by (time NULLs last, acquisitions first, id)
    got = {(r["sku_id"], r["movement_id"]): r["balance"] for r in INV.stock_ledger(s_df, a_df, init).collect()}
    want = {}
    for sku in {r[0] for r in sales} | {r[0] for r in acq}:
        mvs = [(t, 0, i, q) for k, i, t, q in acq if k == sku] + \
              [(t, 1, i, -q) for k, i, t, q, s in sales if k == sku and s == "approved"]
        mvs.sort(key=lambda m: (m[0] is None, m[0] or dt.datetime.min, m[1], m[2]))
        bal = init
        for m in mvs:
            bal += m[3]
            want[(sku, m[2])] = bal
    assert got == want
    # daily stock: every day from the first to the last movement day
    daily = {(r["sku_id"], r["event_date"]): r["inventory_eod"] for r in INV.inventory_daily(s_df, a_df, init).collect()}
    for sku in {k for k, _ in daily}:
        rec, app = {}, {}
        for k, i, t, q in acq:
            if k == sku:
                rec[day(t)] = rec.get(day(t), 0) + q
        for k, i, t, q, s in sales:
            if k == sku and s == "approved" and t is not None:
                app[day(t)] = app.get(day(t), 0) + q
        d, end, stock = min(rec.keys() | app.keys()), max(rec.keys() | app.keys()), init
        while d <= end:
            stock += rec.get(d, 0) - app.get(d, 0)
            assert daily[(sku, d)] == stock
            d += dt.timedelta(days=1)


series = st.lists(st.tuples(st.integers(1, 3), st.integers(1, 60), st.lists(st.integers(0, 40), min_size=60,
                                                                            max_size=60)),
                  min_size=1, max_size=3, unique_by=lambda s: s[0])


def exact_forecast(n, ys, season, horizon):
    first = (dt.date(2024, 3, 1) - dt.date(1970, 1, 1)).days
    t, y = list(range(first, first + n)), ys[:n]
    spot = lambda day: (day + 3) % season
    tm, ym = Fraction(sum(t), n), Fraction(sum(y), n)
    spread = sum((a - tm) ** 2 for a in t)
    b = sum((a - tm) * (c - ym) for a, c in zip(t, y)) / spread if spread else Fraction(0)
    for day in range(first + n, first + n + horizon):
        same = [(a, c) for a, c in zip(t, y) if spot(a) == spot(day)]
        p = ym + b * (day - tm)
        if same:
            k = len(same)
            p = Fraction(sum(c for _, c in same), k) + b * (day - Fraction(sum(a for a, _ in same), k))
        p = Fraction(int(max(p, 0) * 10 ** 12 + Fraction(1, 2)), 10 ** 12)
        yield dt.date(1970, 1, 1) + dt.timedelta(days=day), int(p * 10 ** 4 + Fraction(1, 2)) / 10 ** 4


@settings(max_examples=8, deadline=None, derandomize=True)
@given(series, st.sampled_from([7, 12]))
def test_native_forecast_is_exact(spark, ss, season):
    from stockyard.operators import forecast as FC
    rows = []
    for sku, n, ys in ss:
        for i in range(n):
            rows.append((sku, dt.date(2024, 3, 1) + dt.timedelta(days=i), 0, ys[i], 0))
    d = spark.createDataFrame(rows, "sku_id long, event_date date, received_qty long, approved_qty long, "
                                    "inventory_eod long")
    a = {tuple(r)[:2]: r[2] for r in FC.rounded(FC.forecast_demand(d, 10, season=season)).collect()}
    b = {tuple(r)[:2]: r[2] for r in FC.forecast_demand_grouped(d, 10, season=season).collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1.1e-4 for k in a)
    # the native predictions are the exact rationals
    for sku, n, ys in ss:
        for day, want in exact_forecast(n, ys, season, 10):
            assert a[(sku, day)] == want


demand_input = st.tuples(
    st.lists(st.tuples(st.integers(0, 15).map(lambda i: f"o{i}"),
                       st.one_of(st.none(), st.sampled_from(["DELIVERED", " canceled ", "Unavailable", "shipped", ""])),
                       st.one_of(st.none(), st.just(dt.datetime(2024, 1, 2)))),
             min_size=1, max_size=16, unique_by=lambda r: r[0]),
    st.lists(st.tuples(st.integers(0, 15).map(lambda i: f"o{i}"), st.integers(1, 6),
                       st.integers(0, 4).map(lambda i: f"p{i}"), st.integers(0, 9999), st.integers(0, 999)),
             min_size=1, max_size=60))


@settings(max_examples=8, deadline=None, derandomize=True)
@given(demand_input)
def test_product_demand_matches_python(spark, inp):
    from decimal import Decimal

    from stockyard.operators.aggregates import product_demand
    orders, items = inp
    items = [(o, n, p, Decimal(a) / 100, Decimal(f) / 100) for o, n, p, a, f in items]
    prods = [(f"p{i}", f"cat{i % 2}", i, i, i, i, i, i) for i in range(5)]
    o = spark.createDataFrame(orders, "order_id string, order_status string, order_approved_at timestamp_ntz")
    i = spark.createDataFrame(items, "order_id string, order_item_id int, product_id string, "
                                     "price decimal(10,2), freight_value decimal(10,2)")
    p = spark.createDataFrame(prods, "product_id string, product_category_name string, product_name_lenght int, "
                                     "product_description_lenght int, product_weight_g int, product_length_cm int, "
                                     "product_height_cm int, product_width_cm int")
    got = {(r["order_id"], r["product_id"]): (r["quantity"], r["total_price"], r["total_freight_value"],
                                              r["line_count"]) for r in product_demand(o, i, p).collect()}
    keep = {oid for oid, st_, ap in orders
            if st_ is not None and st_.strip().lower() not in ("unavailable", "canceled") and ap is not None}
    want = {}
    for oid, n, pid, a, f in items:
        if oid in keep:
            q, tp, tf, c = want.get((oid, pid), (0, Decimal(0), Decimal(0), 0))
            want[(oid, pid)] = (max(q, n), tp + a, tf + f, c + 1)
    assert got == want


customer_rows = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(0, 99).map(lambda i: f"c{i}")),
    st.one_of(st.none(), st.text("0123456789 ", max_size=7)),
    st.one_of(st.none(), st.sampled_from(["SP", "sp", " RJ", "ZZ", "MG", "", "Sp"])),
    st.one_of(st.none(), st.text("aB ", max_size=6))), max_size=40)


@settings(max_examples=10, deadline=None, derandomize=True)
@given(customer_rows)
def test_customer_flags_match_rules(spark, rows_):
    from stockyard import config as C
    from stockyard.plans import silver
    df = spark.createDataFrame([(cid, "u", z, city, s) for cid, z, s, city in rows_],
                               "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                               "customer_city string, customer_state string")
    order = lambda r: tuple((x is None, x or "") for x in r)
    got = sorted(((r["customer_id"], r["customer_state"], r["customer_city"], r["data_quality_flag"])
                  for r in silver.customers(df).collect()), key=order)

    def flag(z, s):
        if s is not None and s not in C.STATE_CODES:
            return "invalid_state"
        if z is not None and len(z.strip(" ")) < 4:
            return "invalid_zipcode"
        return "valid"

    want = sorted(((cid, None if s is None else s.strip(" ").upper(),
                    None if city is None else city.strip(" ").lower(), flag(z, s))
                   for cid, z, s, city in rows_ if cid is not None), key=order)
    assert got == want
