"""Values that a cast or a reader would lose are flagged, not dropped."""

import datetime as dt

import pytest

from stockyard.plans import bronze, registry, silver, sql_jobs
from stockyard.session import ensure_checkpoint_dir, remove_scratch, scratch_count, scratch_path
from stockyard.sources.files import CORRUPT_RECORD, csv_scan_permissive

SF = "/root/testdata/sf0.01"


def flags(df, key):
    return {r[key]: r["data_quality_flag"] for r in df.collect()}


def test_overflow_and_score_labels(spark):
    items = spark.createDataFrame(
        [("a", 250_000_000.0, 1.0), ("b", 1.0, 1e9), ("c", -1e9, 1.0), ("d", 5.0, None)],
        "order_id string, price double, freight_value double").selectExpr(
        "*", "1 order_item_id", "'p' product_id", "'s' seller_id", "null shipping_limit_date")
    assert flags(silver.order_items(items), "order_id") == {
        "a": "overflow_price", "b": "overflow_freight", "c": "negative_price", "d": "valid"}
    pay = spark.createDataFrame([("a", 1e8), ("b", 99999999.99), ("c", None)], "order_id string, payment_value double") \
        .selectExpr("*", "1 payment_sequential", "'boleto' payment_type", "1 payment_installments")
    assert flags(silver.order_payments(pay), "order_id") == {
        "a": "overflow_payment_value", "b": "valid", "c": "valid"}
    rev = spark.createDataFrame([("a", "x"), ("b", "9"), ("c", None), ("d", "5")], "review_id string, review_score string") \
        .selectExpr("*", "'o' order_id", "'t' review_comment_title", "'m' review_comment_message",
                    "null review_creation_date", "null review_answer_timestamp")
    assert flags(silver.order_reviews(rev), "review_id") == {
        "a": "unparsable_score", "b": "invalid_score", "c": "valid", "d": "valid"}


@pytest.mark.parametrize("dataset,least", [(d, 3) for d in registry.SQL_SILVER])
def test_stand_ins_reach_the_rules(spark, dataset, least):
    seen = {r[0] for r in registry.silver_table(spark, SF, dataset).select("data_quality_flag").distinct().collect()}
    assert len(seen) >= least and "valid" in seen


def test_columns_bind_by_header_name(spark, tmp_path):
    (tmp_path / "s.csv").write_text("seller_city,seller_id,extra,seller_state,seller_zip_code_prefix\n"
                                    "Campinas,s1,?,SP,13023\n")
    got = bronze.bronze_dataset(spark, str(tmp_path), "sellers", path=str(tmp_path / "s.csv")).first()
    assert (got["seller_id"], got["seller_zip_code_prefix"], got["seller_city"], got["seller_state"]) == \
        ("s1", "13023", "Campinas", "SP")
    (tmp_path / "m.csv").write_text("seller_id\ns2\n")
    got = bronze.bronze_dataset(spark, str(tmp_path), "sellers", path=str(tmp_path / "m.csv")).first()
    assert (got["seller_id"], got["seller_state"]) == ("s2", None)


def test_unparsable_fields_keep_their_record(spark, tmp_path):
    head = bronze.SCHEMAS["orders"].replace(" timestamp_ntz", "").replace(" string", "")
    names = [c.strip() for c in head.split(",")]
    rows = [["o1", "c", "shipped", "2024-01-01 10:00:00", "soon", "", "", ""],
            ["o2", "c", "shipped", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "", "", ""]]
    (tmp_path / "o.csv").write_text("\n".join(",".join(r) for r in [names, *rows]) + "\n")
    raw = csv_scan_permissive(spark, str(tmp_path / "o.csv"), bronze.SCHEMAS["orders"]).cache()
    kept = {r["order_id"]: r[CORRUPT_RECORD] for r in raw.collect()}
    assert "soon" in kept["o1"] and kept["o2"] is None
    assert flags(silver.orders(raw), "order_id") == {"o1": "malformed_record", "o2": "valid"}


def test_review_text_survives_csv(spark):
    from stockyard.plans.registry_io import QUERIES
    got = {r["review_id"]: r["review_comment_message"]
           for r in QUERIES["bronze_csv_silver_order_reviews"](spark, SF).collect()}
    want = {str(r["doc_id"]): r["text"].strip(" ") for r in
            spark.read.parquet(f"{SF}/documents.parquet").where("source <> 'src7'").collect()}
    assert got == want and any("\n" in t for t in want.values()) and any('"' in t for t in want.values())


def test_utc_day_of_instants_in_both_forms(spark):
    from stockyard.operators import inventory as INV
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        s = spark.sql("SELECT 1L AS sku_id, 'S1' AS sales_id, "
                      "timestamp'2024-01-01 01:00:00+00:00' AS event_ts, 2 AS quantity, 'approved' AS status")
        a, b = INV.daily_approved_utc(s).first(), sql_jobs.daily_approved_utc_sql(spark, s).first()
        assert a["event_date"] == b["event_date"] == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_anti_join_removes_sales(spark):
    s = registry.sales(spark, SF)
    from stockyard.operators import inventory as INV
    kept = INV.daily_approved_utc(s).agg({"approved_qty": "sum"}).first()[0]
    assert kept < s.where("status = 'approved'").agg({"quantity": "sum"}).first()[0]


def test_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_scratch_is_removed(spark):
    before = scratch_count()
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert remove_scratch(spark, before) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_far_off_time_is_rejected(spark):
    from stockyard.operators import inventory as INV
    sales = spark.createDataFrame([(1, "S1", dt.datetime(2024, 1, 1), 1, "approved"),
                                   (1, "S2", dt.datetime(9024, 1, 1), 1, "approved")],
                                  "sku_id long, sales_id string, event_ts timestamp_ntz, quantity int, status string")
    acq = spark.createDataFrame([], "sku_id long, acquisition_id string, event_ts timestamp_ntz, reason string, "
                                    "quantity_received int")
    with pytest.raises(Exception, match="check the event times"):
        INV.inventory_daily(sales, acq).collect()


def test_catalog_namespace(spark):
    from stockyard.sources.tables import session_namespace
    session_namespace(spark, "default", catalog="spark_catalog")
    assert spark.catalog.currentDatabase() == "default"
