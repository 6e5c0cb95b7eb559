"""Scalar rules on the FIXTURES.md edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import exprs as X


def one(spark, col, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_weather_labels(spark):
    codes = [(0,), (3,), (4,), (19,), (20,), (99,), (100,), (-1,), (None,)]
    got = one(spark, X.weather_category("c"), codes, "c int")
    assert got == ["clear", "partly_cloudy", "cloudy", "fog", "drizzle", "severe_thunderstorm",
                   "unknown", "unknown", "unknown"]


def test_payment_channel(spark):
    rows = [("WeChat_Pay",), (None,), ("cash",), (" credit_card ",), ("bank_transfer",)]
    assert one(spark, X.payment_channel("m"), rows, "m string") == ["e_wallet", "other", "other", "card",
                                                                   "bank_transfer"]


def test_rating_tier_and_null_default(spark):
    rows = [(4.5,), (4.4999,), (4.0,), (3.0,), (None,)]
    got = one(spark, X.tier("r", X.RATING_TIERS, X.RATING_DEFAULT), rows, "r double")
    assert got == ["platinum", "gold", "gold", "silver", "bronze"]


def test_phone_first_blank_only(spark):
    rows = [("0755 268 1234",), (None,), ("a\tb c",)]
    assert one(spark, X.remove_first_blank("p"), rows, "p string") == ["0755268 1234", "", "ab c"]


def test_round_money_half_up(spark):
    rows = [(2.675,), (1.005,), (-2.675,)]
    assert one(spark, X.round_money("x", 2), rows, "x double") == [2.68, 1.01, -2.68]


def test_number_to_text(spark):
    rows = [(38.0,), (38.5,), (40.0,)]
    assert one(spark, X.number_to_text("t"), rows, "t double") == ["38", "38.5", "40"]


def test_report_text_cut_then_escape(spark):
    msg = "a|b\n" + "x" * 90
    got = one(spark, X.clean_report_text("m"), [(msg,)], "m string")[0]
    assert got.startswith("a\\|b x")
    assert got == "a\\|b " + "x" * 76


def test_pct_change_guards(spark):
    rows = [(10, 0), (10, None), (15, 10)]
    got = one(spark, X.pct_change("c", "p"), rows, "c long, p long")
    assert got == [None, None, 50.0]


def test_abs_pct_change_zero_baseline(spark):
    rows = [(0, 0), (5, 0), (130, 100), (69, 100)]
    assert one(spark, X.abs_pct_change("t", "y"), rows, "t long, y long") == [0.0, 100.0, 30.0, 31.0]


def test_elapsed_days_vs_midnights(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 5, 1, 0))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    r = df.select(X.elapsed_days("b", "a").alias("d"), F.datediff(F.col("b").cast("date"), F.col("a").cast("date"))
                  .alias("m")).first()
    assert (r["d"], r["m"]) == (3, 4)


def test_trunc_stays_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 13, 45),)], "t timestamp_ntz")
    r = df.select(X.trunc_ts("t", "day").alias("d"), X.trunc_ts("t", "hour").alias("h")).first()
    assert r["d"] == dt.datetime(2024, 1, 2) and r["h"] == dt.datetime(2024, 1, 2, 13)
    assert dict(df.select(X.trunc_ts("t", "day").alias("d")).dtypes)["d"] == "timestamp_ntz"


def test_iso_to_ts_forms(spark):
    rows = [("2024-01-02T03:04:05Z",), ("2024-01-02T03:04",), ("2024-01-02T03:04:05.123456",)]
    got = one(spark, X.iso_to_ts("s"), rows, "s string")
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4),
                   dt.datetime(2024, 1, 2, 3, 4, 5, 123456)]
    local = one(spark, X.iso_to_ts("s", tz="Asia/Shanghai"), [("2024-01-02T08:00",)], "s string")
    assert local == [dt.datetime(2024, 1, 2, 0, 0)]
