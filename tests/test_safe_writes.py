"""Overwrites that cannot lose a table, and publishing by changed keys."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from stockyard import sinks
from stockyard.session import scratch_path


def name(prefix="safe"):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def failing(spark, n=100):
    return spark.range(n).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(
        F.raise_error(F.lit("broken row")).cast("long")).alias("id"))


@pytest.mark.parametrize("with_path", [False, True])
def test_failed_overwrite_keeps_the_rows(spark, with_path):
    t = name()
    path = scratch_path(spark, t) if with_path else None
    sinks.write_overwrite_schema(spark.range(5), t, path=path)
    with pytest.raises(Exception, match="broken row"):
        sinks.write_overwrite_schema(failing(spark), t, path=path)
    assert spark.read.table(t).count() == 5
    sinks.write_overwrite_schema(spark.range(7), t, path=path)  # what broke off is no obstacle
    assert spark.read.table(t).count() == 7
    assert not spark.catalog.tableExists(f"{t}__new") and not spark.catalog.tableExists(f"{t}__old")


def test_table_rebuilt_from_itself(spark):
    t = name()
    sinks.save_table(spark.range(6), t)
    for _ in range(3):
        sinks.save_table(spark.read.table(t).select((F.col("id") + 1).alias("id")), t)
    assert sorted(r.id for r in spark.read.table(t).collect()) == [3, 4, 5, 6, 7, 8]


def test_readers_keep_the_version_they_began_with(spark):
    t = name()
    sinks.save_table(spark.range(3), t)
    begun = spark.read.table(t)
    sinks.save_table(spark.range(9), t)
    assert spark.read.table(t).count() == 9
    old = sinks.table_location(spark, t)
    previous = spark.sql(f"SHOW TBLPROPERTIES {t}").where(f"key = '{sinks.PREVIOUS}'").first()["value"]
    assert spark.read.parquet(previous).count() == 3 and begun.columns == ["id"]
    sinks.save_table(spark.range(2), t)
    assert not os.path.exists(previous.replace("file:", ""))   # two versions at most
    assert os.path.exists(old.replace("file:", ""))


def test_schema_partitions_and_buckets_may_change(spark):
    t = name()
    df = spark.range(20).select("id", (F.col("id") % 3).alias("p"))
    sinks.write_overwrite_schema(df, t, partition_by=["p"])
    assert spark.read.table(t).where("p = 1").count() == 7
    sinks.write_overwrite_schema(df.withColumn("w", F.lit("x")), t, bucket_by=["id"], buckets=2)
    assert spark.read.table(t).columns == ["id", "p", "w"]
    sinks.write_overwrite_schema(df.limit(4), t, partition_by=["p"])
    assert spark.read.table(t).count() == 4
    sinks.save_table(df, t, "append")
    assert spark.read.table(t).count() == 24


def test_managed_table_is_replaced_and_kept(spark):
    t = name("managed")
    spark.range(3).write.saveAsTable(t)
    sinks.write_overwrite_schema(spark.range(8), t)
    assert spark.read.table(t).count() == 8 and spark.read.table(f"{t}__old").count() == 3
    sinks.write_overwrite_schema(spark.range(2), t)
    assert spark.read.table(t).count() == 2 and not spark.catalog.tableExists(f"{t}__old")


def test_broken_off_switch_is_recovered(spark):
    t = name()
    sinks.save_table(spark.range(4), t)
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}__old")   # as if the job had died here
    assert sinks.recover_table(spark, t) and spark.read.table(t).count() == 4
    assert not sinks.recover_table(spark, t)
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}__old")
    sinks.save_table(spark.range(1), t)
    assert spark.read.table(t).count() == 1


def test_views_follow_the_table(spark):
    t, v = name(), name("view")
    sinks.save_table(spark.range(3), t)
    sinks.create_view(spark, v, f"SELECT * FROM {t}")
    sinks.save_table(spark.range(5), t)
    assert spark.read.table(v).count() == 5


# --- changed keys ------------------------------------------------------------

def files_of(spark, t):
    root = sinks.table_location(spark, t).replace("file:", "")
    return {os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root)
            for f in fs if f.endswith(".parquet")}


def test_only_partitions_of_changed_keys_are_rewritten(spark):
    t = name("bykey")
    df = spark.range(400).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    sinks.publish_by_key(spark, df, t, "k", parts=16, properties={"quality": "gold"})
    before = files_of(spark, t)
    keys = spark.createDataFrame([("3",), ("50",), ("50",), ("9999",), (None,)], "k string")
    rows = spark.createDataFrame([("3", 100), ("3", 101), ("9999", 7), ("77", 5)], "k string, v long")
    parts = sinks.publish_changes(spark, rows, keys, t)
    assert 1 <= len(parts) <= 3
    after = files_of(spark, t)
    untouched = {f for f in before if int(f.split("=")[1].split("/")[0]) not in parts}
    assert untouched and untouched <= after and not (before - untouched) & after
    got = sorted((r.k, r.v) for r in spark.read.table(t).collect())
    want = [(str(k), k % 7) for k in range(400) if k not in (3, 50)] + [("3", 100), ("3", 101), ("9999", 7)]
    assert got == sorted(want)   # key 77 was not named as changed, key 50 is gone
    assert sinks.publish_changes(spark, rows, keys.where("k = 'none'"), t) == []


def test_partition_without_rows_is_dropped(spark):
    t = name("bykey")
    df = spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    sinks.publish_by_key(spark, df, t, "k", parts=64, path=scratch_path(spark, t))
    sinks.publish_changes(spark, df.limit(0), df.where("k < 2").select("k"), t)
    assert [r.k for r in spark.read.table(t).collect()] == [2]
    assert len(files_of(spark, t)) == 1
    sinks.save_table(spark.range(3), name("plain"))
    with pytest.raises(ValueError):
        plain = name("plain")
        sinks.save_table(df, plain)
        sinks.publish_changes(spark, df, df.select("k"), plain)


def test_failed_refresh_leaves_the_table(spark):
    t = name("bykey")
    sinks.publish_by_key(spark, spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("v")), t, "k")
    bad = failing(spark, 20).select(F.col("id").alias("k"), F.col("id").alias("v"))
    with pytest.raises(Exception, match="broken row"):
        sinks.publish_changes(spark, bad, spark.range(20).select(F.col("id").alias("k")), t)
    assert sorted(r.v for r in spark.read.table(t).collect()) == list(range(50))


def test_product_demand_refresh_equals_full_run(spark):
    from stockyard.plans import gold
    orders = [(f"o{k}", "DELIVERED") for k in range(40)]
    items = [(f"o{k % 40}", k // 40 + 1, f"p{k % 9}", 1.5 * k, 0.5) for k in range(120)]
    products = [(f"p{k}", "cat", k, k, k, k, k, k) for k in range(9)]

    def tables(o, i, p):
        return (spark.createDataFrame(o, "order_id string, order_status string")
                .withColumn("order_approved_at", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")),
                spark.createDataFrame(i, "order_id string, order_item_id int, product_id string, price double, "
                                         "freight_value double").withColumn("price", F.col("price").cast("decimal(10,2)"))
                .withColumn("freight_value", F.col("freight_value").cast("decimal(10,2)")),
                spark.createDataFrame(p, "product_id string, product_category_name string, product_name_lenght int, "
                                         "product_description_lenght int, product_weight_g int, "
                                         "product_length_cm int, product_height_cm int, product_width_cm int"))

    t = name("demand")
    old = tables(orders, items, products)
    sinks.publish_by_key(spark, gold.conform(gold.product_demand_features(*old)), t, "order_id", parts=8)
    orders[5] = ("o5", "CANCELED")           # gone
    items[7] = ("o7", 1, "p7", 999.0, 1.0)   # changed
    items.append(("o40", 1, "p1", 3.0, 1.0))
    orders.append(("o40", "SHIPPED"))        # new
    products[8] = ("p8", "new name", 1, 1, 1, 1, 1, 1)
    now = tables(orders, items, products)
    changed = tables([orders[5], orders[40]], [items[7], items[120]], [products[8]])
    keys = gold.touched_orders(now[1], *changed)
    assert {"o5", "o40", "o7", "o8", "o17"} <= {r.order_id for r in keys.collect()}
    gold.refresh_product_demand(spark, t, keys, *now)
    want = sorted(map(tuple, gold.conform(gold.product_demand_features(*now)).collect()), key=str)
    assert sorted(map(tuple, spark.read.table(t).drop(sinks.KEY_PART).collect()), key=str) == want
    with pytest.raises(ValueError):
        gold.touched_orders(now[1])


def test_changes_are_dealt_by_number_of_rows(spark, monkeypatch):
    """Narrowing to the changed keys deals large tables to more tasks than the
    session's shuffles have; the rows are those of a plain join, NULLs too."""
    from stockyard.operators import windows as W
    rows = spark.createDataFrame([(None if k % 50 == 0 else 1 if k % 3 == 0 else k, k) for k in range(3000)], "k long, v long")
    keys = spark.createDataFrame([(k,) for k in [1, None, *range(2, 3000, 7)]], "k long")
    want = {how: sorted(map(tuple, rows.join(keys, "k", how).collect()), key=str) for how in ("left_semi", "left_anti")}
    monkeypatch.setattr(W, "TASK_ROWS", 100)
    for how, w in want.items():
        got = W.narrowed(rows, keys, "k", how)
        assert sorted(map(tuple, got.collect()), key=str) == w
        assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().toString()


def test_refresh_counts_rows_for_its_tasks(spark, monkeypatch):
    from stockyard.operators import windows as W
    sizes, real = [], W.dealt
    monkeypatch.setattr(W, "dealt", lambda df, rows, *keys: sizes.append((rows, *keys)) or real(df, rows, *keys))
    monkeypatch.setattr(W, "TASK_ROWS", 10)
    rows = spark.range(300).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    table = f"dealt_{uuid.uuid4().hex[:8]}"
    sinks.publish_by_key(spark, rows, table, "k", parts=4)
    changed = rows.where("v % 2 = 0")
    sinks.publish_changes(spark, changed.withColumn("v", F.col("v") + 1000), changed.select("k"), table)
    got = {(r.k, r.v) for r in spark.table(table).collect()}
    assert got == {(str(k), k + 1000 * (k % 2 == 0)) for k in range(300)}
    assert len(sizes) >= 4 and all(s[1:] == ("k",) for s in sizes)


def test_one_large_partition_is_staged_by_several_tasks(spark, monkeypatch):
    """A changed partition of more rows than a task should hold goes to several
    tasks, however many the session's shuffles have."""
    from stockyard.operators import windows as W
    monkeypatch.setattr(W, "TASK_ROWS", 200)
    rows = spark.range(800).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    table = f"one_part_{uuid.uuid4().hex[:8]}"
    sinks.publish_by_key(spark, rows, table, "k", parts=1)
    paths, real = [], sinks.scratch_path
    monkeypatch.setattr(sinks, "scratch_path", lambda s, name: paths.append((name, real(s, name))) or paths[-1][1])
    sinks.publish_changes(spark, rows.where("v < 8").withColumn("v", F.col("v") + 1000), rows.where("v < 8").select("k"), table)
    assert {(r.k, r.v) for r in spark.table(table).collect()} == {(str(k), k + 1000 * (k < 8)) for k in range(800)}
    staged = spark.read.parquet(dict(paths)["changes"])
    assert staged.count() == 800 and staged.select("_metadata.file_path").distinct().count() > 1
