"""DWD layer (M7-M12): clean, keep the newest row per key, upsert.

Each model reads its ODS frame, optionally only the rows newer than the
target's high-watermark (I1), cleans and filters, keeps the latest row per
key (W5) and, given the current target, returns the upserted table (I4).
``merge=False`` returns only the batch, for the partition-rewriting sink
(``strata.sources.ingest.upsert_partitions``); ``since`` passes a recorded
watermark instead of reading the target's max.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators.dedup import latest_by_key
from strata.operators.incremental import newer_than, upsert


#: As ``merge``: the cleaned rows before the newest one per key is picked.
CLEANED = "cleaned"
KEYS = {
    "github_events": "event_id", "weather_forecast": "forecast_time", "ecommerce_products": "product_id",
    "business_customers": "customer_id", "business_orders": "order_id", "business_order_items": "item_id",
}


def valid_keys(domain: str, ods: DataFrame) -> DataFrame:
    """key, _ingested_at of the rows that a DWD model accepts: as many distinct keys as the model has rows."""
    rows = globals()[f"dwd_{domain}"](ods, merge=CLEANED)
    return rows.select(F.col(KEYS[domain]).alias("key"), "_ingested_at")


def _finish(cleaned: DataFrame, key: str, as_of, target: DataFrame | None, merge: bool | str = True,
            policy: str = "sync_all_columns") -> DataFrame:
    if merge == CLEANED:
        return cleaned
    latest = latest_by_key(cleaned, [key])
    out = latest.withColumn("_dwd_processed_at", X.ts_literal(as_of))
    return upsert(target, out, [key], policy=policy) if merge else out


def _source(ods: DataFrame, target: DataFrame | None, since=None) -> DataFrame:
    """Rows newer than ``since`` (a recorded watermark) or than the target's max."""
    if since is not None:
        return ods.where(F.col("_ingested_at") > F.lit(since).cast("timestamp_ntz"))
    return newer_than(ods, target, "_ingested_at")


def dwd_github_events(
    ods: DataFrame, as_of=None, target: DataFrame | None = None, since=None, merge: bool = True
) -> DataFrame:
    """M7: upper type, owner/repo split, day and hour buckets, ``/`` required."""
    src = _source(ods, target, since)
    cleaned = src.where(
        F.col("event_id").isNotNull()
        & F.col("event_type").isNotNull()
        & F.col("repo_name").isNotNull()
        & F.col("repo_name").like("%/%")
    ).select(
        "event_id",
        F.upper(F.trim("event_type")).alias("event_type"),
        F.trim("actor_login").alias("actor_login"),
        "actor_id",
        F.split_part(F.col("repo_name"), F.lit("/"), F.lit(1)).alias("repo_owner"),
        F.split_part(F.col("repo_name"), F.lit("/"), F.lit(2)).alias("repo_name_short"),
        "repo_id",
        "event_created_at",
        X.trunc_ts("event_created_at", "day").alias("event_date"),
        X.trunc_ts("event_created_at", "hour").alias("event_hour"),
        "is_public",
        "source_system",
        "_ingested_at",
    )
    return _finish(cleaned, "event_id", as_of, target, merge)


def dwd_weather_forecast(
    ods: DataFrame, as_of=None, target: DataFrame | None = None, since=None, merge: bool = True
) -> DataFrame:
    """M8: day bucket and weather label (twelve ranges + unknown)."""
    src = _source(ods, target, since)
    cleaned = src.where(F.col("forecast_time").isNotNull()).select(
        "forecast_time",
        "temperature_2m",
        "humidity",
        "precipitation",
        "weather_code",
        X.trunc_ts("forecast_time", "day").alias("forecast_date"),
        X.weather_category("weather_code").alias("weather_category"),
        "source_system",
        "_ingested_at",
    )
    return _finish(cleaned, "forecast_time", as_of, target, merge)


def dwd_ecommerce_products(
    ods: DataFrame, as_of=None, target: DataFrame | None = None, since=None, merge: bool = True
) -> DataFrame:
    """M9: rounded price and rating, rating tier on the unrounded rating, brand default."""
    src = _source(ods, target, since)
    cleaned = src.where(
        F.col("product_id").isNotNull() & F.col("product_title").isNotNull() & F.col("price").isNotNull()
    ).select(
        "product_id",
        F.trim("product_title").alias("product_title"),
        "product_description",
        X.round_money("price", 2).alias("price"),
        F.coalesce(F.col("discount_pct"), F.lit(0.0)).alias("discount_pct"),
        X.round_money("rating", 2).alias("rating"),
        X.tier("rating", X.RATING_TIERS, X.RATING_DEFAULT).alias("rating_tier"),
        "stock",
        F.trim(F.coalesce(F.col("brand"), F.lit("Unknown"))).alias("brand"),
        F.trim("category").alias("category"),
        "thumbnail_url",
        "source_system",
        "_ingested_at",
    )
    return _finish(cleaned, "product_id", as_of, target, merge)


def dwd_business_customers(
    ods: DataFrame, as_of=None, target: DataFrame | None = None, since=None, merge: bool = True
) -> DataFrame:
    """Trims, lower email/type, first blank removed from phone, name required.

    The name filter sees the untrimmed name, so ``'  '`` passes and becomes ``''``.
    """
    src = _source(ods, target, since)
    cleaned = src.where(
        F.col("customer_id").isNotNull() & F.col("customer_name").isNotNull() & (F.col("customer_name") != "")
    ).select(
        "customer_id",
        F.trim("customer_name").alias("customer_name"),
        F.lower(F.trim("email")).alias("email"),
        X.remove_first_blank("phone").alias("phone"),
        F.trim("city").alias("city"),
        "register_date",
        F.lower(F.trim("customer_type")).alias("customer_type"),
        "source_system",
        "_ingested_at",
    )
    return _finish(cleaned, "customer_id", as_of, target, merge)


def dwd_business_orders(
    ods: DataFrame, as_of=None, target: DataFrame | None = None, since=None, merge: bool = True
) -> DataFrame:
    """Day key, status, payment channel and method, currency default, amount >= 0."""
    src = _source(ods, target, since)
    cleaned = src.where(
        F.col("order_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("order_date").isNotNull()
        & (F.col("total_amount") >= 0)
    ).select(
        "order_id",
        "customer_id",
        "order_date",
        X.trunc_ts("order_date", "day").alias("order_date_key"),
        F.lower(F.trim("order_status")).alias("order_status"),
        X.payment_channel("payment_method").alias("payment_channel"),
        F.lower(F.trim(F.coalesce(F.col("payment_method"), F.lit("unknown")))).alias("payment_method"),
        X.round_money("total_amount", 2).alias("total_amount"),
        F.upper(F.trim(F.coalesce(F.col("currency"), F.lit("CNY")))).alias("currency"),
        "source_system",
        "_ingested_at",
    )
    return _finish(cleaned, "order_id", as_of, target, merge)


def dwd_business_order_items(
    ods: DataFrame, as_of=None, target: DataFrame | None = None, since=None, merge: bool = True
) -> DataFrame:
    """Line total from the unrounded price, positive quantity, discount default 0."""
    src = _source(ods, target, since)
    cleaned = src.where(
        F.col("item_id").isNotNull()
        & F.col("order_id").isNotNull()
        & F.col("product_name").isNotNull()
        & (F.col("quantity") > 0)
        & (F.col("unit_price") >= 0)
    ).select(
        "item_id",
        "order_id",
        F.trim("product_name").alias("product_name"),
        "quantity",
        X.round_money("unit_price", 2).alias("unit_price"),
        F.coalesce(F.col("discount_pct"), F.lit(0.0)).alias("discount_pct"),
        X.line_total("quantity", "unit_price", "discount_pct").alias("line_total"),
        "source_system",
        "_ingested_at",
    )
    return _finish(cleaned, "item_id", as_of, target, merge)
