"""Silver cleaning and quality flags on dirty fixtures (FIXTURES.md)."""

import datetime as dt
from decimal import Decimal

from conftest import rows

from stockyard.plans import silver


def test_customers(spark):
    df = spark.createDataFrame([
        (None, "u0", "01037", "x", "SP"),
        ("c1", "u1", "01037", "  Sao Paulo ", "SP"),
        ("c2", "u2", "999", "Rio", "RJ"),
        ("c3", "u3", " 14409 ", "Campinas", "sp"),
        ("c4", "u4", "12345", "X", "ZZ"),
        ("c5", "u5", "12345", "X", None),
    ], "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
       "customer_city string, customer_state string")
    out = {r["customer_id"]: r for r in rows(silver.customers(df))}
    assert set(out) == {"c1", "c2", "c3", "c4", "c5"}  # NULL id dropped
    assert out["c1"]["customer_city"] == "sao paulo" and out["c1"]["data_quality_flag"] == "valid"
    assert out["c2"]["data_quality_flag"] == "invalid_zipcode"
    # raw 'sp' is tested, output is cleaned
    assert out["c3"]["data_quality_flag"] == "invalid_state" and out["c3"]["customer_state"] == "SP"
    assert out["c4"]["data_quality_flag"] == "invalid_state"
    assert out["c5"]["data_quality_flag"] == "valid"  # NULL NOT IN (...) is unknown
    norm = {r["customer_id"]: r for r in rows(silver.customers(df, normalize=True))}
    assert norm["c3"]["data_quality_flag"] == "valid"


def test_geolocation_bounds(spark):
    df = spark.createDataFrame([
        ("1", -33.75, -73.99), ("2", -33.76, -50.0), ("3", 5.27, -34.79), ("4", 5.28, -40.0),
        ("5", 0.0, -74.0), ("6", 0.0, -34.78), ("7", None, -40.0), (None, 0.0, -40.0),
    ], "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double") \
        .selectExpr("*", "'  City ' as geolocation_city", "' sp' as geolocation_state")
    out = {r["geolocation_zip_code_prefix"]: r for r in rows(silver.geolocation(df))}
    flags = {k: v["data_quality_flag"] for k, v in out.items()}
    assert flags == {"1": "valid", "2": "invalid_latitude", "3": "valid", "4": "invalid_latitude",
                     "5": "invalid_longitude", "6": "invalid_longitude", "7": "missing_coordinates"}
    assert out["1"]["geolocation_lat"] == Decimal("-33.750000")
    assert out["1"]["geolocation_city"] == "city" and out["1"]["geolocation_state"] == "SP"


def test_orders_status(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([
        ("o1", "delivered", ts), ("o2", " Canceled ", ts), ("o3", "weird", ts),
        ("o4", None, ts), ("o5", "delivered", None), (None, "delivered", ts),
    ], "order_id string, order_status string, order_purchase_timestamp timestamp") \
        .selectExpr("order_id", "'c' as customer_id", "order_status", "order_purchase_timestamp",
                    "order_purchase_timestamp as order_approved_at",
                    "cast(null as timestamp) as order_delivered_carrier_date",
                    "cast(null as timestamp) as order_delivered_customer_date",
                    "cast(null as timestamp) as order_estimated_delivery_date")
    out = {r["order_id"]: r for r in rows(silver.orders(df))}
    assert out["o1"]["order_status"] == "DELIVERED" and out["o1"]["data_quality_flag"] == "valid"
    assert out["o2"]["order_status"] == "CANCELED" and out["o2"]["data_quality_flag"] == "valid"
    assert out["o3"]["data_quality_flag"] == "invalid_status"
    assert out["o4"]["data_quality_flag"] == "valid"
    assert out["o5"]["data_quality_flag"] == "missing_purchase_date"
    assert None not in out


def test_order_items_money(spark):
    df = spark.createDataFrame([
        ("o1", 1, "p1", -1.0, 0.0), ("o1", 2, "p1", 1.0, -0.5), ("o2", 1, None, 1.0, 1.0),
        (None, 1, "p1", 1.0, 1.0), ("o3", 1, "p2", None, 2.345), ("o4", 1, "p2", 1e12, 1.0),
    ], "order_id string, order_item_id int, product_id string, price double, freight_value double") \
        .selectExpr("*", "'s' as seller_id", "cast(null as timestamp) as shipping_limit_date")
    out = {(r["order_id"], r["order_item_id"]): r for r in rows(silver.order_items(df))}
    assert set(out) == {("o1", 1), ("o1", 2), ("o3", 1), ("o4", 1)}
    assert out[("o1", 1)]["data_quality_flag"] == "negative_price"
    assert out[("o1", 2)]["data_quality_flag"] == "negative_freight"
    assert out[("o3", 1)]["data_quality_flag"] == "valid" and out[("o3", 1)]["price"] is None
    assert out[("o3", 1)]["freight_value"] == Decimal("2.35")  # HALF_UP
    assert out[("o4", 1)]["price"] is None  # overflow -> NULL, not a failure


def test_payments_reviews(spark):
    p = spark.createDataFrame([
        ("o1", 1, "credit_card", 1, 10.0), ("o2", 1, "Boleto", 1, 1.0), ("o3", 1, "cash", 1, 1.0),
        ("o4", 1, "voucher", 1, -0.01), ("o5", 1, "voucher", 1, 0.0), (None, 1, "voucher", 1, 0.0),
    ], "order_id string, payment_sequential int, payment_type string, payment_installments int, "
       "payment_value double")
    out = {r["order_id"]: r for r in rows(silver.order_payments(p))}
    assert out["o1"]["data_quality_flag"] == "valid"
    assert out["o2"]["data_quality_flag"] == "invalid_payment_type" and out["o2"]["payment_type"] == "boleto"
    assert out["o3"]["data_quality_flag"] == "invalid_payment_type"
    assert out["o4"]["data_quality_flag"] == "invalid_payment_value"
    assert out["o5"]["data_quality_flag"] == "valid" and len(out) == 5
    r = spark.createDataFrame([
        ("r1", "o1", "1", " t ", " m "), ("r2", "o1", "5", None, None), ("r3", "o1", "0", None, None),
        ("r4", "o1", "6", None, None), ("r5", "o1", "x", None, None), ("r6", None, "3", None, None),
        (None, "o1", "3", None, None), ("r7", "o1", None, None, None),
    ], "review_id string, order_id string, review_score string, review_comment_title string, "
       "review_comment_message string").selectExpr(
        "*", "cast(null as timestamp) as review_creation_date",
        "cast(null as timestamp) as review_answer_timestamp")
    out = {x["review_id"]: x for x in rows(silver.order_reviews(r))}
    assert set(out) == {"r1", "r2", "r3", "r4", "r5", "r6", "r7"}
    assert out["r1"]["review_comment_title"] == "t" and out["r1"]["review_score"] == 1
    assert out["r3"]["data_quality_flag"] == "invalid_score"
    assert out["r4"]["data_quality_flag"] == "invalid_score"
    assert out["r5"]["review_score"] is None and out["r5"]["data_quality_flag"] == "unparsable_score"
    assert out["r6"]["data_quality_flag"] == "invalid_null_order_id"
    assert out["r7"]["data_quality_flag"] == "valid"


def test_products_and_categories(spark):
    p = spark.createDataFrame([
        ("p1", "  Casa ", 1, 2, 3, 4, 5, 6, 7), ("p2", None, 1, 1, 1, 1, 1, 1, 1),
        ("p3", "  ", 1, 1, 1, 1, 1, 1, 1), ("p4", "x", 1, 1, 1, -1, 1, 1, 1),
        ("p5", "x", 1, 1, 1, 1, -1, 1, 1), ("p6", "x", 1, 1, 1, 1, 1, -1, 1),
        ("p7", "x", 1, 1, 1, 1, 1, 1, -1), ("p8", "x", None, None, None, None, None, None, None),
        (None, "x", 1, 1, 1, 1, 1, 1, 1),
    ], "product_id string, product_category_name string, product_name_lenght int, "
       "product_description_lenght int, product_photos_qty int, product_weight_g int, "
       "product_length_cm int, product_height_cm int, product_width_cm int")
    out = {r["product_id"]: r for r in rows(silver.products(p))}
    assert {k: v["data_quality_flag"] for k, v in out.items()} == {
        "p1": "valid", "p2": "missing_category", "p3": "missing_category", "p4": "negative_weight",
        "p5": "negative_length", "p6": "negative_height", "p7": "negative_width", "p8": "valid"}
    assert out["p1"]["product_category_name"] == "casa"
    assert out["p8"]["product_weight_g"] == 0 and out["p8"]["product_photos_qty"] == 0
    c = spark.createDataFrame([("a", "A "), ("  ", "b"), ("c", " "), (None, "x"), ("d", None)],
                              "product_category_name string, product_category_name_english string")
    out = {r["product_category_name"]: r["data_quality_flag"] for r in rows(silver.category_translation(c))}
    assert out == {"a": "valid", "": "invalid_empty_name", "c": "invalid_empty_english"}


def test_sellers(spark):
    s = spark.createDataFrame([("s1", "1234", " X ", "sp"), ("s2", "123", "x", "SP"), (None, "1", "x", "SP")],
                              "seller_id string, seller_zip_code_prefix string, seller_city string, "
                              "seller_state string")
    out = {r["seller_id"]: r for r in rows(silver.sellers(s))}
    assert out["s1"]["data_quality_flag"] == "invalid_state" and out["s1"]["seller_city"] == "x"
    assert out["s2"]["data_quality_flag"] == "invalid_zipcode" and len(out) == 2


def test_flag_labels_partition_rows(spark):
    """Every kept row gets exactly one label: label counts add up."""
    df = spark.range(1000).selectExpr(
        "cast(id as string) as customer_id", "'u' as customer_unique_id",
        "cast(id as string) as customer_zip_code_prefix", "'c' as customer_city",
        "case when id % 3 = 0 then 'SP' when id % 3 = 1 then 'zz' else null end as customer_state")
    out = silver.customers(df)
    counts = {r["data_quality_flag"]: r["n"] for r in out.groupBy("data_quality_flag").count()
              .withColumnRenamed("count", "n").collect()}
    assert sum(counts.values()) == 1000


def test_latest_rows_ties_and_null_keys(spark):
    from stockyard.operators.filters import latest_rows
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 3, "c"), (None, 2, "d"), (None, 1, "e"), (2, 5, "f")],
                               "k long, d long, v string")
    want = {("b",), ("c",), ("d",), ("f",)}
    assert {(r["v"],) for r in latest_rows(df, ["k"], "d").collect()} == want
    assert latest_rows(df, ["k"], "d").columns == ["k", "d", "v"]
