"""File sources, sinks, the medallion run and the streaming refresh."""

import os

import pytest
from pyspark.sql import functions as F

from stockyard import sinks
from stockyard.plans import bronze, medallion
from stockyard.session import scratch_path
from stockyard.sources.files import batch_load, csv_scan, csv_scan_permissive, lineage_columns
from stockyard.sources.tables import list_tables, session_namespace
from stockyard.streaming.ingest import read_refreshed, refresh_silver

RAW = {
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                 "c1,u1,01037,  Sao Paulo ,SP\nc2,u2,999,rio,sp\n,u3,12345,x,SP\n",
    "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
                   "01037,-23.5,-46.6,sao paulo,SP\n01037,-33.76,-46.6,x,sp\n",
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
              "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
              "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,,,\n"
              "o2,c2,canceled,2018-01-02 10:00:00,2018-01-02 11:00:00,,,\n"
              "o3,c2,weird,,2018-01-02 11:00:00,,,\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                   "o1,1,p1,s1,2018-01-05 00:00:00,10.5,1.25\no1,2,p1,s1,2018-01-05 00:00:00,10.5,1.25\n"
                   "o2,1,p1,s1,2018-01-05 00:00:00,3,1\n",
    "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                      "o1,1,credit_card,1,22.0\no2,1,Boleto,1,4\n",
    "order_reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,"
                     "review_creation_date,review_answer_timestamp\n"
                     'r1,o1,5, ok ,"line one\nline two",2018-01-06 00:00:00,2018-01-07 00:00:00\n'
                     "r2,o2,x,,,2018-01-06 00:00:00,\n",
    "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,"
                "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
                "p1,Casa ,10,20,1,500,10,10,10\np2,,,,,,,,\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01037,sp,SP\n",
    "product_category_name_translation": "product_category_name,product_category_name_english\ncasa,home\n",
}


@pytest.fixture(scope="module")
def raw_dir(spark):
    d = scratch_path(spark, "raw-test")
    os.makedirs(d)
    for ds, text in RAW.items():
        with open(os.path.join(d, bronze.FILES[ds]), "w") as f:
            f.write(text)
    return d


def test_csv_inferred_loses_leading_zero(spark, raw_dir):
    df = csv_scan(spark, os.path.join(raw_dir, bronze.FILES["customers"]))
    assert dict(df.dtypes)["customer_zip_code_prefix"] == "int"
    b = bronze.bronze_dataset(spark, raw_dir, "customers")
    assert "01037" in [r[0] for r in b.select("customer_zip_code_prefix").collect()]


def test_lineage_and_multiline(spark, raw_dir):
    b = bronze.bronze_dataset(spark, raw_dir, "order_reviews")
    rows = {r["review_id"]: r for r in b.collect()}
    assert rows["r1"]["review_comment_message"] == "line one\nline two"  # one record
    assert rows["r1"]["_source_file"].endswith(bronze.FILES["order_reviews"])
    assert rows["r1"]["_ingestion_time"] is not None and rows["r1"]["_processed_at"] is not None
    single = csv_scan_permissive(spark, os.path.join(raw_dir, bronze.FILES["order_reviews"]),
                                 bronze.SCHEMAS["order_reviews"])
    assert single.count() == 3  # without multiLine the quoted break splits the record


def test_medallion_end_to_end(spark, raw_dir):
    sfx = os.path.basename(raw_dir).replace("-", "_")
    bdb, sdb, gdb = f"b_{sfx}", f"s_{sfx}", f"g_{sfx}"
    assert len(medallion.run_bronze(spark, raw_dir, bdb)) == 9
    medallion.run_silver(spark, bdb, sdb)
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {sdb}.orders").collect()}
    assert props["quality"] == "silver" and props["domain"] == "orders"
    assert spark.table(f"{sdb}.customers").count() == 2
    t = medallion.run_gold(spark, sdb, gdb)
    g = spark.table(t)
    assert [f.dataType.simpleString() for f in g.schema.fields][-3:] == ["int", "double", "double"]
    rows = g.collect()
    assert len(rows) == 1 and rows[0]["quantity"] == 2 and rows[0]["total_price"] == 21.0
    medallion.run_gold(spark, sdb, gdb)  # idempotent: same content after a second run
    assert spark.table(t).count() == 1
    assert {r["tableName"] for r in list_tables(spark, sdb).collect()} >= {"orders", "sellers"}


def test_sinks_modes(spark, raw_dir):
    df = spark.range(3).withColumn("v", F.col("id") * 2)
    name = "t_" + os.path.basename(raw_dir).replace("-", "_")
    with pytest.raises(ValueError):
        sinks.save_table(df, name, "ignore")
    with pytest.raises(ValueError):
        sinks.write_dataset(spark, df, name, "bogus")
    with pytest.raises(ValueError):
        sinks.write_dataset(spark, df, None, "table")
    assert sinks.write_dataset(spark, df, None, "none") is None
    sinks.write_dataset(spark, df, name, "table")
    sinks.write_dataset(spark, df, name, "table", "append")
    assert spark.table(name).count() == 6
    sinks.write_dataset(spark, df, name + "_v", "view")
    assert spark.table(name + "_v").count() == 3
    sinks.write_overwrite_schema(df.withColumn("w", F.lit("x")), name)
    assert spark.table(name).columns == ["id", "v", "w"]


def test_batch_load(spark, raw_dir):
    items = [(os.path.join(raw_dir, bronze.FILES[d]), f"bl_{d}") for d in ("customers", "sellers")]
    done = batch_load(spark, items, lambda df, t: sinks.write_overwrite_schema(df, t))
    assert done == ["bl_customers", "bl_sellers"]
    assert spark.table("bl_sellers").count() == 1


def test_streaming_refresh_is_incremental(spark, raw_dir):
    src = scratch_path(spark, "stream-src")
    os.makedirs(src)
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    with open(os.path.join(src, "part1.csv"), "w") as f:
        f.write(RAW["customers"])
    refresh_silver(spark, src, "customers", out, ck).awaitTermination()
    assert read_refreshed(spark, out).count() == 2
    with open(os.path.join(src, "part2.csv"), "w") as f:
        f.write("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                "c9,u9,55555,x,RJ\n")
    refresh_silver(spark, src, "customers", out, ck).awaitTermination()
    df = read_refreshed(spark, out)
    assert df.count() == 3  # old file not re-read, no duplicates
    assert {r["customer_id"] for r in df.collect()} == {"c1", "c2", "c9"}


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="benchmark tables not present")
def test_lineage_columns_on_parquet(spark):
    df = lineage_columns(spark.read.parquet("/root/testdata/sf0.001/region.parquet"))
    r = df.first()
    assert r["_source_file"].endswith("region.parquet")


def test_session_namespace(spark):
    cur = spark.catalog.currentDatabase()
    session_namespace(spark, "ns_test_db", "UTC")
    try:
        assert spark.catalog.currentDatabase() == "ns_test_db"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.catalog.setCurrentDatabase(cur)


def test_imperative_flavour(spark, raw_dir):
    sfx = os.path.basename(raw_dir).replace("-", "_")
    t = medallion.run_imperative(spark, raw_dir, f"r_{sfx}", f"rg_{sfx}")
    rows = spark.table(t).collect()
    # raw lower-case 'canceled' is excluded; o1 keeps its two lines of p1
    assert len(rows) == 1 and rows[0]["order_id"] == "o1" and rows[0]["quantity"] == 2
    assert rows[0]["total_price"] == 21.0 and rows[0]["product_category_name"] == "Casa "  # no cleaning
    assert dict(spark.table(f"r_{sfx}.customers").dtypes)["customer_zip_code_prefix"] == "int"


def test_format_resolution(spark):
    assert sinks.format_available(spark, "parquet")
    assert not sinks.format_available(spark, "no_such_format_xyz")
    assert sinks.resolve_format(spark, "auto") in ("delta", "parquet")
    assert sinks.resolve_format(spark, "orc") == "orc"


def test_streaming_bronze_then_silver_chain(spark, raw_dir):
    from stockyard.streaming.ingest import refresh_bronze, refresh_silver_from_bronze
    src = scratch_path(spark, "chain-src")
    os.makedirs(src)
    bz, sv = scratch_path(spark, "chain-bronze"), scratch_path(spark, "chain-silver")
    ckb, cks = scratch_path(spark, "chain-ckb"), scratch_path(spark, "chain-cks")
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(RAW["orders"])
    refresh_bronze(spark, src, "orders", bz, ckb).awaitTermination()
    refresh_silver_from_bronze(spark, bz, "orders", sv, cks).awaitTermination()
    assert read_refreshed(spark, bz).count() == 3
    s = read_refreshed(spark, sv)
    assert s.count() == 3 and "_source_file" in s.columns
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write(RAW["orders"].splitlines()[0] + "\no9,c9,shipped,2018-02-01 10:00:00,,,,\n")
    refresh_bronze(spark, src, "orders", bz, ckb).awaitTermination()
    refresh_silver_from_bronze(spark, bz, "orders", sv, cks).awaitTermination()
    flags = {r["order_id"]: (r["order_status"], r["data_quality_flag"]) for r in read_refreshed(spark, sv).collect()}
    assert len(flags) == 4 and flags["o9"] == ("SHIPPED", "valid") and flags["o3"][1] == "missing_purchase_date"


def test_run_inventory_tables_and_view(spark, raw_dir):
    import datetime as dt
    sfx = os.path.basename(raw_dir).replace("-", "_")
    t = dt.datetime
    sales = spark.createDataFrame(
        [(1, f"S{i:08d}", t(2024, 1, 1 + i % 28, 15), 1 + i % 3, "approved" if i % 4 else "placed")
         for i in range(200)], "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string")
    acq = spark.createDataFrame([(1, "A00000001", t(2024, 1, 1, 10), "planned", 500)],
                                "sku_id long, acquisition_id string, event_ts timestamp_ntz, reason string, "
                                "quantity_received int")
    names = medallion.run_inventory(spark, sales, acq, db=f"inv_{sfx}")
    daily = spark.table(names["daily"])
    assert daily.count() == 28
    assert spark.table(names["forecast"]).count() == 28
    view = spark.table(names["view"]).orderBy("week_monday").collect()
    assert view and view[0]["remaining_inventory"] == daily.orderBy(F.desc("event_date")).first()["inventory_eod"] \
        - view[0]["weekly_demand_cum"]


def test_cli(spark, raw_dir, capsys):
    from stockyard.__main__ import main
    sfx = os.path.basename(raw_dir).replace("-", "_")
    assert main(["medallion", "--raw", raw_dir, "--prefix", f"cli_{sfx}_", "--fmt", "parquet"]) == 0
    assert spark.table(f"cli_{sfx}_gold.product_demand_features_daily").count() == 1
    if os.path.exists("/root/testdata/sf0.001"):
        out = scratch_path(spark, "cli-query")
        assert main(["query", "--name", "silver_sellers", "--data", "/root/testdata/sf0.001", "--out", out]) == 0
        assert read_refreshed(spark, out).count() > 0


def test_typed_table_comments_and_insert_overwrite(spark, raw_dir):
    from stockyard.plans import gold
    name = "typed_" + os.path.basename(raw_dir).replace("-", "_")
    sinks.create_typed_table(spark, name, gold.PRODUCT_DEMAND_DDL, "feature table")
    desc = {r["col_name"]: (r["data_type"], r["comment"]) for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert desc["quantity"] == ("int", "Quantity") and desc["total_price"][0] == "double"
    ext = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert ext.get("Comment") == "feature table"
    row = [("o1", None, "p1", "c", 1, 1, 1, 1, 1, 1, 2, 3.5, 0.5)]
    df = spark.createDataFrame(row, ", ".join(f"{n} {t}" for n, t, _ in gold.PRODUCT_DEMAND_DDL))
    sinks.insert_overwrite(df, name)
    sinks.insert_overwrite(df, name)  # replaces, does not append
    assert spark.table(name).count() == 1


def test_imperative_flavour_explicit_schemas(spark, raw_dir):
    sfx = os.path.basename(raw_dir).replace("-", "_")
    t = medallion.run_imperative(spark, raw_dir, f"rx_{sfx}", f"rxg_{sfx}", infer=False)
    assert spark.table(t).count() == 1
    zips = {r[0] for r in spark.table(f"rx_{sfx}.customers").select("customer_zip_code_prefix").collect()}
    assert "01037" in zips  # explicit string schema keeps the leading zero


def test_bucketed_silver_joins_without_shuffle(spark, raw_dir):
    sfx = os.path.basename(raw_dir).replace("-", "_")
    bdb, sdb = f"bb_{sfx}", f"bs_{sfx}"
    medallion.run_bronze(spark, raw_dir, bdb, "parquet")
    medallion.run_silver(spark, bdb, sdb, "parquet", buckets=4)
    from stockyard.plans import gold
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        o, i = spark.table(f"{sdb}.orders"), spark.table(f"{sdb}.order_items")
        j = o.join(i, "order_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        df = gold.product_demand_features(o, i, spark.table(f"{sdb}.products"))
        assert df.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_streaming_bounded_batches(spark):
    src = scratch_path(spark, "batches-src")
    os.makedirs(src)
    header = RAW["sellers"].splitlines()[0]
    for k in range(3):
        with open(os.path.join(src, f"f{k}.csv"), "w") as f:
            f.write(header + "\n" + "\n".join(f"s{k}{i},1234{i},c,SP" for i in range(5)) + "\n")
    out, ck = scratch_path(spark, "batches-out"), scratch_path(spark, "batches-ck")
    q = refresh_silver(spark, src, "sellers", out, ck, max_files_per_trigger=1)
    q.awaitTermination()
    assert read_refreshed(spark, out).count() == 15
    assert len(q.recentProgress) >= 3  # one micro-batch per file


def test_cli_inventory(spark, raw_dir):
    import datetime as dt
    from stockyard.__main__ import main
    sfx = os.path.basename(raw_dir).replace("-", "_")
    t = dt.datetime
    spark.createDataFrame([(1, f"S{i:08d}", t(2024, 3, 1 + i % 20, 12), 1, "approved") for i in range(60)],
                          "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string") \
        .write.saveAsTable(f"cli_sales_{sfx}")
    spark.createDataFrame([(1, "A00000001", t(2024, 3, 1, 9), "planned", 100)],
                          "sku_id long, acquisition_id string, event_ts timestamp_ntz, reason string, "
                          "quantity_received int").write.saveAsTable(f"cli_acq_{sfx}")
    assert main(["inventory", "--sales", f"cli_sales_{sfx}", "--acquisitions", f"cli_acq_{sfx}",
                 "--db", f"cli_gold_{sfx}"]) == 0
    assert spark.table(f"cli_gold_{sfx}.inventory_daily").count() == 20
    assert spark.table(f"cli_gold_{sfx}.inventory_forecast").count() > 0
