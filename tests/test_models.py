"""Model cleaning rules on hand-made edge rows (FIXTURES.md section 2)."""

import datetime as dt

from strata.plans import ads, dwd, dws, ods
from strata.sources.ingest import load_seed

T0 = dt.datetime(2024, 1, 1)


def test_orders_clean(spark):
    raw = spark.createDataFrame([
        (1, 10, T0, " Completed ", "WeChat_Pay", 5.0, None, "s", T0),
        (2, 10, T0, "x", None, -1.0, " usd ", "s", T0),
        (3, 10, T0, "x", "cash", 0.0, " usd ", "s", T0),
        (4, 10, None, "x", "cash", 1.0, None, "s", T0),
        (None, 10, T0, "x", "cash", 1.0, None, "s", T0),
    ], "order_id long, customer_id long, order_date timestamp_ntz, order_status string, payment_method string, "
       "total_amount double, currency string, source_system string, _ingested_at timestamp_ntz")
    out = {r["order_id"]: r for r in dwd.dwd_business_orders(ods.ods_business_orders(raw), as_of=T0).collect()}
    assert set(out) == {1, 3}
    assert out[1]["order_status"] == "completed" and out[1]["payment_channel"] == "e_wallet"
    assert out[1]["currency"] == "CNY" and out[3]["currency"] == "USD"
    assert out[3]["payment_method"] == "cash" and out[3]["payment_channel"] == "other"


def test_customers_name_filter_sees_untrimmed(spark):
    raw = spark.createDataFrame([
        (1, "", "E", "0755 268 1234", "c", None, "T", "s", T0),
        (2, "  ", "E", "0755 268 1234", "c", None, "T", "s", T0),
        (3, None, "E", None, "c", None, "T", "s", T0),
    ], "customer_id long, customer_name string, email string, phone string, city string, register_date date, "
       "customer_type string, source_system string, _ingested_at timestamp_ntz")
    out = dwd.dwd_business_customers(ods.ods_business_customers(raw), as_of=T0).collect()
    assert [(r["customer_id"], r["customer_name"], r["phone"]) for r in out] == [(2, "", "0755268 1234")]


def test_dedup_newest_then_tiebreak(spark):
    raw = spark.createDataFrame([
        (1, 1, "a", 1, 1.0, None, "s", T0),
        (1, 1, "b", 1, 1.0, None, "s", T0 + dt.timedelta(hours=2)),
        (1, 1, "c", 1, 1.0, None, "s", T0 + dt.timedelta(hours=1)),
        (2, 1, "z", 1, 1.0, None, "s", T0),
        (2, 1, "y", 1, 1.0, None, "s", T0),
        (3, 1, "q", 0, 1.0, None, "s", T0),
    ], "item_id long, order_id long, product_name string, quantity int, unit_price double, discount_pct double, "
       "source_system string, _ingested_at timestamp_ntz")
    out = {r["item_id"]: r for r in dwd.dwd_business_order_items(ods.ods_business_order_items(raw), as_of=T0).collect()}
    assert out[1]["product_name"] == "b"          # newest load wins
    assert out[2]["product_name"] == "y"          # same load time: tie-break on the other columns
    assert 3 not in out                           # quantity 0 dropped
    assert out[1]["discount_pct"] == 0.0


def test_events_split_and_like(spark):
    raw = spark.createDataFrame([
        ("1", " PushEvent", "u", 1, "a/b/c", 1, T0, True, "s", T0),
        ("2", "x", "u", 1, "nobody", 1, T0, True, "s", T0),
        ("3", "x", "u", 1, "/x", 1, T0, True, "s", T0),
    ], "id string, type string, actor_login string, actor_id long, repo_name string, repo_id long, "
       "created_at timestamp_ntz, is_public boolean, source_system string, _ingested_at timestamp_ntz")
    out = {r["event_id"]: r for r in dwd.dwd_github_events(ods.ods_github_events(raw), as_of=T0).collect()}
    assert set(out) == {"1", "3"}
    assert (out["1"]["repo_owner"], out["1"]["repo_name_short"], out["1"]["event_type"]) == ("a", "b", "PUSHEVENT")
    assert out["3"]["repo_owner"] == ""


def test_category_join_case_and_bool_counts(spark):
    ev = spark.createDataFrame([
        ("1", "PUSHEVENT", 1, 1, T0, True), ("2", "PUSHEVENT", 2, 1, T0, False),
        ("3", "PUSHEVENT", 3, 1, T0, None), ("4", "OTHEREVENT", 3, 1, T0, True),
    ], "event_id string, event_type string, actor_id long, repo_id long, event_date timestamp_ntz, is_public boolean")
    seed = load_seed(spark)
    got = {r["event_type"]: r for r in dws.dws_github_daily_activity(ev, seed, as_of=T0).collect()}
    assert got["PushEvent"]["category"] == "code"
    assert (got["PushEvent"]["public_events"], got["PushEvent"]["private_events"]) == (1, 1)
    assert got["OTHEREVENT"]["category"] == "uncategorized"
    ref = {r["event_type"]: r for r in dws.dws_github_daily_activity(ev, seed, as_of=T0, case_sensitive=True).collect()}
    assert ref["PUSHEVENT"]["category"] == "uncategorized"   # the reference's join never matches


def test_weather_alert_edges(spark):
    now = dt.datetime(2024, 1, 15)
    rows = [
        (now, 37.9, 79), (now + dt.timedelta(hours=1), 38.0, 80), (now + dt.timedelta(hours=2), 40.0, 90),
        (now + dt.timedelta(hours=3), 38.0, 95), (now + dt.timedelta(hours=24), 45.0, 95),
        (now - dt.timedelta(hours=1), 45.0, 95),
    ]
    df = spark.createDataFrame(rows, "forecast_time timestamp_ntz, temperature_2m double, weather_code int")
    df = df.withColumn("weather_category", df.weather_code.cast("string"))
    out = {r["forecast_time"].hour: r for r in ads.ads_weather_alert(df, now=now, as_of=now, alert_kind=True).collect()}
    assert sorted(out) == [1, 2, 3]
    assert out[1]["alert_type"] == "warning" and out[1]["alert_message"] == "Temperature 38C - Extreme heat"
    assert out[2]["severity"] == "critical"
    assert out[3]["alert_type"] == "warning" and out[3]["severity"] == "critical"   # G6
    assert out[3]["alert_kind"] == "heat"


def test_category_tier(spark):
    rows = [(f"c{i}", float(100 - i), 4.0 if i != 4 else 3.9) for i in range(12)]
    df = spark.createDataFrame(rows, "category string, total_inventory_value double, avg_rating double")
    for c in ["product_count", "brand_count", "total_stock", "platinum_products", "gold_products",
              "discounted_products"]:
        df = df.withColumn(c, df.total_inventory_value.cast("long"))
    for c in ["avg_price", "min_price", "max_price"]:
        df = df.withColumn(c, df.total_inventory_value)
    out = {r["revenue_rank"]: r["category_tier"] for r in ads.ads_ecommerce_kpi(df, as_of=T0).collect()}
    assert out[1] == "star" and out[5] == "core" and out[10] == "core" and out[11] == "niche"


def test_trend_row_lag_vs_calendar(spark):
    """Lags are rows in each type's series; a missing day shifts them. Calendar mode looks up real days."""
    day = lambda d: dt.datetime(2024, 1, d)
    # type A: 8 full days (23..30); type B: day 26 missing
    rows = [(day(d), "A", "x", 10 + d, 1, 1) for d in range(23, 31)]
    rows += [(day(d), "B", "y", 5, 1, 1) for d in range(23, 31) if d != 26]
    df = spark.createDataFrame(rows, "event_date timestamp_ntz, event_type string, category string, "
                                     "event_count long, unique_actors long, unique_repos long")
    out = {(r["event_type"], r["event_date"].day): r
           for r in ads.ads_github_trending(df, today=dt.date(2024, 1, 30), as_of=T0).collect()}
    assert out[("A", 30)]["week_over_week_pct"] == round((40 - 33) / 33 * 100, 2)   # 8 dates: week value on day 8
    assert out[("A", 29)]["week_over_week_pct"] is None
    assert out[("B", 27)]["day_over_day_pct"] == 0.0                               # row lag skips the gap
    assert out[("B", 30)]["week_over_week_pct"] is None                            # only 7 rows for B
    cal = {(r["event_type"], r["event_date"].day): r
           for r in ads.ads_github_trending(df, today=dt.date(2024, 1, 30), as_of=T0, calendar=True).collect()}
    assert cal[("B", 27)]["day_over_day_pct"] is None                              # no row on the 26th
    assert cal[("A", 30)]["week_over_week_pct"] == out[("A", 30)]["week_over_week_pct"]


def test_shares_null_when_no_channel_orders(spark):
    from strata.functions import exprs as X
    df = spark.createDataFrame([(0, 0, 0), (1, 3, 0)], "c long, e long, b long")
    got = [r[0] for r in df.select(X.share_pct("c", df.c + df.e + df.b, 1)).collect()]
    assert got == [None, 25.0]


def test_products_brand_default_and_items_zero_price(spark):
    raw = spark.createDataFrame([
        (1, " t ", "d", 9.999, None, 4.5, 3, None, " c ", "u", "s", T0),
    ], "id long, title string, description string, price double, discount_percentage double, rating double, "
       "stock int, brand string, category string, thumbnail string, source_system string, _ingested_at timestamp_ntz")
    p = dwd.dwd_ecommerce_products(ods.ods_ecommerce_products(raw), as_of=T0).first()
    assert (p["brand"], p["product_title"], p["category"], p["price"], p["discount_pct"], p["rating_tier"]) == \
        ("Unknown", "t", "c", 10.0, 0.0, "platinum")
    items = spark.createDataFrame([(1, 1, "p", 2, 0.0, None, "s", T0)],
                                  "item_id long, order_id long, product_name string, quantity int, unit_price double, "
                                  "discount_pct double, source_system string, _ingested_at timestamp_ntz")
    i = dwd.dwd_business_order_items(ods.ods_business_order_items(items), as_of=T0).first()
    assert (i["unit_price"], i["line_total"]) == (0.0, 0.0)
