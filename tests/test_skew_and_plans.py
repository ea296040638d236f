"""Hot keys (one key holding a third of the rows) give exact results, and
the plans keep the properties the scale design relies on."""

import datetime as dt
import random
import re
from decimal import Decimal

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockyard.operators import events as EV
from stockyard.operators import windows as W
from stockyard.operators.aggregates import product_demand
from stockyard.plans.sql_jobs import product_demand_sql

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_product_demand_hot_product_and_order(spark):
    rnd = random.Random(1)
    items = []
    for i in range(3000):
        hot = i % 3 == 0
        items.append(("o0" if hot and i % 2 == 0 else f"o{rnd.randint(1, 300)}", i % 7 + 1,
                      "pHOT" if hot else f"p{rnd.randint(1, 50)}", Decimal(rnd.randint(1, 999)) / 100,
                      Decimal(rnd.randint(0, 99)) / 100))
    orders = [(f"o{k}", "DELIVERED" if k % 5 else "canceled", dt.datetime(2024, 1, 1 + k % 28)) for k in range(301)]
    prods = [("pHOT", "hot", 1, 1, 1, 1, 1, 1)] + [(f"p{k}", "c", k, k, k, k, k, k) for k in range(1, 51)]
    o = spark.createDataFrame(orders, "order_id string, order_status string, order_approved_at timestamp_ntz")
    i = spark.createDataFrame(items, "order_id string, order_item_id int, product_id string, "
                                     "price decimal(10,2), freight_value decimal(10,2)")
    p = spark.createDataFrame(prods, "product_id string, product_category_name string, product_name_lenght int, "
                                     "product_description_lenght int, product_weight_g int, "
                                     "product_length_cm int, product_height_cm int, product_width_cm int")
    got = {(r["order_id"], r["product_id"]): (r["quantity"], r["total_price"], r["line_count"])
           for r in product_demand(o, i, p).collect()}
    io = pd.DataFrame(items, columns=["order_id", "order_item_id", "product_id", "price", "freight"])
    ok = {oid for oid, st, _ in orders if st.lower() not in ("canceled", "unavailable")}
    io = io[io.order_id.isin(ok)]
    want = {k: (g.order_item_id.max(), sum(g.price), len(g)) for k, g in io.groupby(["order_id", "product_id"])}
    assert got == want


@pytest.mark.parametrize("all_keys", ["true", "false"])
@pytest.mark.parametrize("job", ["operator", "sql"])
def test_product_demand_deals_by_number_of_rows(spark, monkeypatch, job, all_keys):
    """With fewer rows a task than the session's shuffles give, no task of the
    joins holds more; a product and an order with very many lines are whole."""
    rnd = random.Random(2)
    items = [("o1" if k % 9 == 0 else f"o{rnd.randint(1, 800)}", k % 7 + 1, "p1" if k % 4 == 0 else
              f"p{rnd.randint(1, 300)}", Decimal(rnd.randint(1, 999)) / 100, Decimal(rnd.randint(0, 99)) / 100)
             for k in range(4000)] + [(None, 1, "p2", Decimal(1), Decimal(1)), ("o2", 1, None, Decimal(1), Decimal(1))]
    orders = [(f"o{k}", "DELIVERED" if k % 5 else "CANCELED", dt.datetime(2024, 1, 1 + k % 28) if k % 11 else None)
              for k in range(1, 801)] + [("o7", "DELIVERED", dt.datetime(2024, 5, 1)), (None, "DELIVERED", None)]
    prods = [(f"p{k}", "c", k, k, k, k, k, k) for k in range(1, 301)] + [("p3", "c", 3, 3, 3, 3, 3, 3), ("p4", "d", *[4] * 6)]
    tables = (spark.createDataFrame(orders, "order_id string, order_status string, order_approved_at timestamp_ntz"),
              spark.createDataFrame(items, "order_id string, order_item_id int, product_id string, "
                                           "price decimal(10,2), freight_value decimal(10,2)"),
              spark.createDataFrame(prods, "product_id string, product_category_name string, product_name_lenght int, "
                                           "product_description_lenght int, product_weight_g int, "
                                           "product_length_cm int, product_height_cm int, product_width_cm int"))

    def run():
        return product_demand_sql(spark, *tables) if job == "sql" else product_demand(*tables)

    want = sorted(map(tuple, run().collect()), key=str)
    keys = {"spark.sql.requireAllClusterKeysForDistribution": all_keys, "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    monkeypatch.setattr(W, "TASK_ROWS", 200)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = run()
        assert sorted(map(tuple, got.collect()), key=str) == want
        assert got.schema == run().schema
        dealt = re.findall(r"hashpartitioning\((order_id|product_id)#\d+L?, (\d+)\), REPARTITION_BY_NUM",
                           got._jdf.queryExecution().executedPlan().toString())
        assert {k for k, _ in dealt} == {"order_id", "product_id"} and all(int(n) >= 20 for _, n in dealt)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("job", ["operator", "sql"])
def test_product_demand_deals_where_tasks_are_merged(spark, monkeypatch, job):
    """A session with partitions enough, which adaptive execution merges by bytes
    to fewer tasks than the rows need, deals the rows all the same; one that
    merges none is left as it is."""
    items = spark.createDataFrame([(k % 900, k % 7 + 1, k % 301, Decimal(k % 50), Decimal(1)) for k in range(4000)],
                                  "order_id long, order_item_id int, product_id long, "
                                  "price decimal(10,2), freight_value decimal(10,2)")
    orders = spark.createDataFrame([(k, "DELIVERED" if k % 5 else "CANCELED", dt.datetime(2024, 1, 1 + k % 28))
                                    for k in range(800)], "order_id long, order_status string, order_approved_at timestamp_ntz")
    prods = spark.createDataFrame([(k, "c", *[k] * 6) for k in range(300)],
                                  "product_id long, product_category_name string, product_name_lenght int, "
                                  "product_description_lenght int, product_weight_g int, "
                                  "product_length_cm int, product_height_cm int, product_width_cm int")

    def run():
        return (product_demand_sql if job == "sql" else lambda _, *t: product_demand(*t))(spark, orders, items, prods)

    want = sorted(map(tuple, run().collect()), key=str)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    keys = {"spark.sql.shuffle.partitions": "200", "spark.sql.autoBroadcastJoinThreshold": "-1", merge: "true"}
    before = {k: spark.conf.get(k) for k in keys}
    monkeypatch.setattr(W, "TASK_ROWS", 200)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = run()
        assert sorted(map(tuple, got.collect()), key=str) == want
        dealt = re.findall(r"hashpartitioning\((order_id|product_id)#\d+L?, (\d+)\), REPARTITION_BY_NUM", _plan(got))
        assert {k for k, _ in dealt} == {"order_id", "product_id"} and all(int(n) >= 20 for _, n in dealt)
        rows = W.dealt(items, items.count(), "order_id").groupBy(F.spark_partition_id()).count()
        assert rows.agg(F.max("count")).first()[0] <= 400
        spark.conf.set(merge, "false")
        assert "REPARTITION_BY_NUM" not in _plan(run())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_dedupe_hot_id_and_partial_aggregate(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, "HOT", t + dt.timedelta(seconds=i * 7 % 1000), i % 5 + 1, "placed") for i in range(2000)]
    rows += [(2, f"S{i}", t, 1, "placed") for i in range(4000)]
    s = spark.createDataFrame(rows, "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string")
    d = EV.dedupe_events(s)
    out = {r["sales_id"]: r for r in d.collect()}
    assert len(out) == 4001
    assert out["HOT"]["event_ts"] == t and out["HOT"]["quantity"] == 1
    plan = _plan(d)
    # map-side combine: the hot id is reduced before the shuffle
    assert "partial_min" in plan or "partial_min" in d._jdf.queryExecution().toString()


def test_dedupe_deals_by_number_of_rows(spark, monkeypatch):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, "HOT", t + dt.timedelta(seconds=i * 7 % 900), i % 5 + 1, "placed") for i in range(700)]
    rows += [(2, f"S{i % 2500}", t + dt.timedelta(seconds=i % 11), 1, None) for i in range(3000)]
    rows += [(3, None, t, 1, "placed")] * 300
    s = spark.createDataFrame(rows, "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string")
    want = sorted(map(tuple, EV.dedupe_events(s).collect()), key=str)
    monkeypatch.setattr(W, "TASK_ROWS", 100)
    d = EV.dedupe_events(s)
    assert sorted(map(tuple, d.collect()), key=str) == want and len(want) == 2801
    plan = d._jdf.queryExecution().toString()
    assert "hashpartitioning(sales_id" in plan and "REPARTITION_BY_NUM" in plan and "SortMergeJoin" not in plan
    most = d.where("sales_id LIKE 'S%'").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 200


def test_event_quality_bucketed_equals_plain(spark):
    rnd = random.Random(9)
    t = dt.datetime(2024, 1, 1)
    rows = [(1 if i % 3 == 0 else rnd.randint(2, 9), f"S{i:08d}", t + dt.timedelta(minutes=rnd.randint(0, 5000)),
             rnd.randint(1, 80), rnd.choice(["placed", None, "approved"])) for i in range(5000)]
    s = spark.createDataFrame(rows, "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string")
    a = EV.event_quality(s, bucket=None)
    b = EV.event_quality(s, bucket=F.floor(F.substring("sales_id", 2, 8).cast("long") / 500))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables not present")


@needs_data
def test_product_demand_plan_pushdown(spark):
    import __spark_entry__ as E
    df = E.queries()["product_demand"](spark, SF)
    q = df._jdf.queryExecution().executedPlan().toString()
    df.write.format("noop").mode("overwrite").save()
    assert "PushedFilters: [" in q
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double," \
        "o_orderdate:timestamp_ntz,o_orderpriority:string>" in df._jdf.queryExecution().toString() \
        or "o_custkey" not in q
    assert "BatchEvalPython" not in q and "ArrowEvalPython" not in q  # no Python in the hot path


@needs_data
def test_no_python_in_sql_expressible_queries(spark):
    import __spark_entry__ as E
    from stockyard.plans.registry_io import QUERIES
    in_tasks = ("forecast_demand_grouped", "forecast_arima", "event_quality_smallest")
    python_nodes = re.compile("InPandas|InArrow|ArrowEval|BatchEval")
    for name, fn in QUERIES.items():
        if name.startswith(("bronze_", "gold_", "stream_")):
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert bool(python_nodes.search(plan)) == (name in in_tasks), name


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)


@needs_data
def test_exchange_counts_without_broadcast(spark, no_broadcast):
    from stockyard.plans import registry as R
    daily = R.daily_table(spark, SF)
    from stockyard.operators import forecast as FC
    assert len(exchanges(FC.forecast_demand(daily))) == 1
    # events by (bucket, key), the totals by bucket and by key: the events
    # themselves are shuffled once
    assert len(exchanges(R.ledger(spark, SF))) <= 4
    wide = [x for x in exchanges(R.QUERIES["product_demand"](spark, SF)) if x.count("#") > 9]
    assert len(wide) <= 1  # the products themselves


def test_event_quality_auto_bucket_numeric_ids(spark):
    rnd = random.Random(4)
    t = dt.datetime(2024, 1, 1)
    rows = [(1 if i % 2 else 2, i * 37, t + dt.timedelta(seconds=rnd.randint(0, 10 ** 6)), 1, "placed")
            for i in range(4000)]
    s = spark.createDataFrame(rows, "sku_id long, sales_id long, event_ts timestamp_ntz, quantity int, status string")
    a = EV.event_quality(s, bucket=None)
    b = EV.event_quality(s)  # auto: id ranges
    assert "__bucket" not in b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
