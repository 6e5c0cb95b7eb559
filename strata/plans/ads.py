"""ADS layer (M18-M21): ranked and trended reports, rebuilt in full."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators.joins import attach_latest, attach_one_row
from strata.operators.ranking import attach_ranks_many, plain_rank, top_k_rank


def _stamp(df: DataFrame, as_of) -> DataFrame:
    return df.withColumn("_ads_generated_at", X.ts_literal(as_of))


def _date(value) -> _dt.date | None:
    if value is None:
        return None
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    return value.date() if isinstance(value, _dt.datetime) else value


def ads_github_trending(
    dws_activity: DataFrame,
    today=None,
    as_of=None,
    calendar: bool = False,
    days: int = 7,
) -> DataFrame:
    """Last ``days`` days, rank within each day, day-over-day and week-over-week change.

    Default (reference): the lags are ROWS back in each type's series inside
    the window, so "week ago" needs all 8 dates (SURVEY G5). ``calendar=True``
    looks up the same type exactly 1 and 7 calendar days earlier instead.
    The window is one row per (day, type, category) over ``days + 1`` dates,
    a size that does not grow with the event volume.
    """
    d = _date(today)
    start = (F.lit(d) if d else F.current_date()) - F.expr(f"INTERVAL {days} DAYS")
    daily = dws_activity.where(F.col("event_date") >= start.cast("timestamp_ntz")).select(
        "event_date", "event_type", "category", "event_count", "unique_actors", "unique_repos"
    )
    by_type = Window.partitionBy("event_type").orderBy("event_date")
    if calendar:
        prev = daily.select(
            F.col("event_type").alias("_t"),
            F.col("event_date").alias("_d"),
            F.col("event_count").alias("_c"),
        )
        prev = prev.groupBy("_t", "_d").agg(F.sum("_c").alias("_c"))

        def back(n: int, name: str) -> DataFrame:
            p = prev.select(F.col("_t"), (F.col("_d") + F.expr(f"INTERVAL {n} DAYS")).alias("_d"), F.col("_c").alias(name))
            return p

        ranked = (
            daily.join(back(1, "prev_day_count"), (F.col("event_type") == F.col("_t")) & (F.col("event_date") == F.col("_d")), "left")
            .drop("_t", "_d")
            .join(back(days, "week_ago_count"), (F.col("event_type") == F.col("_t")) & (F.col("event_date") == F.col("_d")), "left")
            .drop("_t", "_d")
        )
    else:
        ranked = daily.withColumn("prev_day_count", F.lag("event_count", 1).over(by_type)).withColumn(
            "week_ago_count", F.lag("event_count", days).over(by_type)
        )
    by_day = Window.partitionBy("event_date").orderBy(F.col("event_count").desc_nulls_first())
    ranked = ranked.withColumn("daily_rank", F.rank().over(by_day).cast("long"))
    out = ranked.select(
        "event_date",
        "event_type",
        F.coalesce(F.col("category"), F.lit("uncategorized")).alias("category"),
        "event_count",
        "unique_actors",
        "unique_repos",
        "daily_rank",
        X.pct_change("event_count", "prev_day_count", 2).alias("day_over_day_pct"),
        X.pct_change("event_count", "week_ago_count", 2).alias("week_over_week_pct"),
    )
    return _stamp(out, as_of)


def ads_weather_alert(dwd_weather: DataFrame, now=None, as_of=None, alert_kind: bool = False) -> DataFrame:
    """Heat and storm alerts in the next 24 hours ``[now, now + 24h)``.

    ``alert_type`` holds the severity word of the heat alert, else of the
    storm alert, as in the reference (SURVEY G6); ``alert_kind=True`` adds a
    ``heat``/``storm`` column that names which rule fired first.
    """
    start = X.ts_literal(now)
    hourly = dwd_weather.where(
        (F.col("forecast_time") >= start) & (F.col("forecast_time") < start + F.expr("INTERVAL 24 HOURS"))
    )
    alerts = hourly.select(
        "forecast_time",
        "temperature_2m",
        "weather_code",
        "weather_category",
        X.heat_alert("temperature_2m").alias("heat_alert"),
        X.storm_alert("weather_code").alias("storm_alert"),
    ).where(F.col("heat_alert").isNotNull() | F.col("storm_alert").isNotNull())
    heat, storm = F.col("heat_alert"), F.col("storm_alert")
    cols = [
        "forecast_time",
        "temperature_2m",
        "weather_category",
        F.coalesce(heat, storm).alias("alert_type"),
        F.when((heat == "critical") | (storm == "critical"), "critical").otherwise("warning").alias("severity"),
        F.when(
            heat.isNotNull(),
            F.concat(F.lit("Temperature "), X.number_to_text("temperature_2m"), F.lit("C - Extreme heat")),
        ).when(
            storm.isNotNull(),
            F.concat(F.lit("Weather code "), F.col("weather_code").cast("string"), F.lit(" - Thunderstorm")),
        ).alias("alert_message"),
    ]
    if alert_kind:
        cols.append(F.when(heat.isNotNull(), "heat").otherwise("storm").alias("alert_kind"))
    return _stamp(alerts.select(*cols), as_of).orderBy("forecast_time")


def ads_ecommerce_kpi(dws_category: DataFrame, as_of=None) -> DataFrame:
    """Category ranks by inventory value and rating; star / core / niche.

    One row per category: a bounded frame, so the whole-frame ranks run in
    one task after the aggregation.
    """
    base = dws_category.select(
        "category", "product_count", "brand_count", "avg_price", "min_price", "max_price", "avg_rating",
        "total_stock", "total_inventory_value", "platinum_products", "gold_products", "discounted_products",
    )
    ranked = plain_rank(base, "total_inventory_value", "revenue_rank")
    ranked = plain_rank(ranked, "avg_rating", "rating_rank")
    rr = F.col("revenue_rank")
    out = ranked.withColumn(
        "category_tier",
        F.when((rr <= 5) & (F.col("avg_rating") >= 4.0), "star").when(rr <= 10, "core").otherwise("niche"),
    )
    return _stamp(out, as_of).orderBy("revenue_rank")


def daily_revenue(dws_daily: DataFrame) -> DataFrame:
    """Re-aggregate the (day, status) summary to one row per day.

    The daily average is the unweighted average of the per-status averages,
    as in the reference (SURVEY G8).
    """
    return dws_daily.groupBy("order_date_key").agg(
        X.exact_sum("total_revenue").alias("daily_revenue"),
        F.sum("order_count").cast("long").alias("daily_orders"),
        X.round_money(X.exact_avg("avg_order_value"), 2).alias("daily_avg_order_value"),
    )


def daily_trend(dws_daily: DataFrame) -> DataFrame:
    """W4 + F14: previous day's revenue and the change in percent.

    One row per calendar day: the unpartitioned window sees a few thousand
    rows at any data volume.
    """
    w = Window.orderBy("order_date_key")
    d = daily_revenue(dws_daily)
    prev = F.lag("daily_revenue", 1).over(w)
    return d.withColumn("prev_day_revenue", prev).withColumn(
        "revenue_dod_pct", X.pct_change("daily_revenue", "prev_day_revenue", 2)
    )


def payment_summary(dws_daily: DataFrame) -> DataFrame:
    """A10: one row with the channel totals."""
    return dws_daily.agg(
        F.sum("card_orders").cast("long").alias("total_card_orders"),
        F.sum("ewallet_orders").cast("long").alias("total_ewallet_orders"),
        F.sum("bank_transfer_orders").cast("long").alias("total_bank_transfer_orders"),
    )


def ads_business_kpi(dws_customers: DataFrame, dws_daily: DataFrame, as_of=None, k: int = 10) -> DataFrame:
    """Top-k customers by revenue (ties kept) with three ranks, the latest day's
    revenue and change, and the card / e-wallet shares of all orders.

    * revenue rank: the values that make the top k filter the rows, so ties stay spread out;
    * loyalty and average-value ranks of those rows among ALL customers: the
      distributed rank of ``strata.operators.ranking`` (no single-task window
      over the customer table), both columns in one pass;
    * channel shares: one-row aggregate cross joined (J3);
    * latest day: top-1 row of the daily trend attached to every row (J4).
    """
    cols = [
        "customer_id", "customer_name", "city", "customer_type", "total_orders", "total_revenue",
        "avg_order_value", "last_order_date", "customer_lifespan_days", "payment_channels_used", "customer_tier",
    ]
    customers = dws_customers.select(*cols)
    top = top_k_rank(customers, "total_revenue", "revenue_rank", k)
    top = attach_ranks_many(top, customers.select("total_orders", "avg_order_value"), [
        ("total_orders", "loyalty_rank"), ("avg_order_value", "avg_value_rank"),
    ])
    trend = daily_trend(dws_daily).select(
        F.col("order_date_key").alias("latest_trade_date"),
        F.col("daily_revenue").alias("latest_daily_revenue"),
        "revenue_dod_pct",
    )
    with_latest = attach_latest(top, trend, "latest_trade_date")
    pay = payment_summary(dws_daily)
    total = F.col("total_card_orders") + F.col("total_ewallet_orders") + F.col("total_bank_transfer_orders")
    out = attach_one_row(with_latest, pay).select(
        *cols,
        "revenue_rank",
        "loyalty_rank",
        "avg_value_rank",
        "latest_trade_date",
        "latest_daily_revenue",
        "revenue_dod_pct",
        X.share_pct("total_card_orders", total, 1).alias("card_payment_pct"),
        X.share_pct("total_ewallet_orders", total, 1).alias("ewallet_payment_pct"),
    )
    return _stamp(out, as_of).orderBy("revenue_rank")
