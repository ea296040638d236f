"""Column functions: dates, ids, cleaning."""

import datetime as dt

from pyspark.sql import functions as F

from stockyard.functions import cleaning as CL
from stockyard.functions import dates as D
from stockyard.functions.ids import format_id, id_number


def test_local_date_ntz_and_instant(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 2, 30),)], "ts timestamp_ntz")
    assert df.select(D.local_date(df, "ts", "America/Sao_Paulo")).first()[0] == dt.date(2024, 1, 9)
    assert df.select(D.utc_date(df, "ts")).first()[0] == dt.date(2024, 1, 10)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        # the same instant as a timestamp (LTZ) value, read in a Tokyo session
        ltz = spark.sql("SELECT timestamp'2024-01-10 02:30:00+00:00' AS ts")
        got = ltz.select(D.local_date(ltz, "ts", "America/Sao_Paulo"), D.utc_date(ltz, "ts")).first()
        assert got[0] == dt.date(2024, 1, 9) and got[1] == dt.date(2024, 1, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_week_start_weekday_and_nth_weekday(spark):
    r = spark.sql("SELECT date'2025-12-21' AS d, 2024 AS y").select(
        D.week_start("d").alias("w"), D.weekday_index("d").alias("wd"),
        D.second_sunday(F.col("y"), 5).alias("maes"), D.last_friday(F.col("y"), 11).alias("bf"),
        D.next_monday_after(D.last_friday(F.col("y"), 11)).alias("cm")).first()
    assert r["w"] == dt.date(2025, 12, 15) and r["wd"] == 6
    assert (r["maes"], r["bf"], r["cm"]) == (dt.date(2024, 5, 12), dt.date(2024, 11, 29), dt.date(2024, 12, 2))


def test_spines(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 2, 27), dt.date(2024, 3, 1))], "k int, s date, e date")
    assert D.date_spine(df, "s", "e").count() == 4  # leap day included
    f = D.future_spine(spark.createDataFrame([(1, dt.date(2025, 12, 20))], "k int, last date"), "last", 28)
    days = sorted(r["event_date"] for r in f.collect())
    assert days[0] == dt.date(2025, 12, 21) and days[-1] == dt.date(2026, 1, 17) and len(days) == 28


def test_format_id_and_cleaning(spark):
    df = spark.createDataFrame([(1, "  Sao Paulo ", "x", None)], "n long, c string, s string, m int")
    r = df.select(format_id("S", "n").alias("id"), CL.clean_lower("c").alias("l"),
                  CL.clean_upper("c").alias("u"), CL.cast_score("s").alias("sc"),
                  CL.default_zero("m").alias("z"), CL.rename_cast("n", "double", "y")).first()
    assert (r["id"], r["l"], r["u"], r["sc"], r["z"], r["y"]) == ("S00000001", "sao paulo", "SAO PAULO", None, 0, 1.0)


def test_id_order_across_widths(spark):
    df = spark.createDataFrame([(99_999_999,), (100_000_000,), (7,)], "n long") \
        .select("n", format_id("S", "n").alias("id"))
    got = [r["n"] for r in df.orderBy(id_number(df, "id")).collect()]
    assert got == [7, 99_999_999, 100_000_000]
    odd = spark.createDataFrame([("no digits",), (None,)], "id string")
    assert [r[0] for r in odd.select(id_number(odd, "id")).collect()] == [None, None]
