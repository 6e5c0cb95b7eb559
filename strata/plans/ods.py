"""ODS layer (M1-M6): typed, renamed views over the raw landing tables.

Lazy frames, never materialised: Catalyst folds the casts into whatever reads
them and pushes the key filter into the raw scan. Keys are BIGINT (the source
declares INTEGER, which overflows long before 100 TB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.exprs import iso_to_ts

# (raw column, type, ODS column) per model.
GITHUB_EVENTS = [
    ("id", "string", "event_id"),
    ("type", "string", "event_type"),
    ("actor_login", "string", "actor_login"),
    ("actor_id", "bigint", "actor_id"),
    ("repo_name", "string", "repo_name"),
    ("repo_id", "bigint", "repo_id"),
    ("created_at", "timestamp_ntz", "event_created_at"),
    ("is_public", "boolean", "is_public"),
    ("source_system", "string", "source_system"),
    ("_ingested_at", "timestamp_ntz", "_ingested_at"),
]
WEATHER_FORECAST = [
    ("time", "timestamp_ntz", "forecast_time"),
    ("temperature_2m", "double", "temperature_2m"),
    ("humidity", "int", "humidity"),
    ("precipitation", "double", "precipitation"),
    ("weather_code", "int", "weather_code"),
    ("source_system", "string", "source_system"),
    ("_ingested_at", "timestamp_ntz", "_ingested_at"),
]
ECOMMERCE_PRODUCTS = [
    ("id", "bigint", "product_id"),
    ("title", "string", "product_title"),
    ("description", "string", "product_description"),
    ("price", "double", "price"),
    ("discount_percentage", "double", "discount_pct"),
    ("rating", "double", "rating"),
    ("stock", "int", "stock"),
    ("brand", "string", "brand"),
    ("category", "string", "category"),
    ("thumbnail", "string", "thumbnail_url"),
    ("source_system", "string", "source_system"),
    ("_ingested_at", "timestamp_ntz", "_ingested_at"),
]
BUSINESS_CUSTOMERS = [
    ("customer_id", "bigint", "customer_id"),
    ("customer_name", "string", "customer_name"),
    ("email", "string", "email"),
    ("phone", "string", "phone"),
    ("city", "string", "city"),
    ("register_date", "date", "register_date"),
    ("customer_type", "string", "customer_type"),
    ("source_system", "string", "source_system"),
    ("_ingested_at", "timestamp_ntz", "_ingested_at"),
]
BUSINESS_ORDERS = [
    ("order_id", "bigint", "order_id"),
    ("customer_id", "bigint", "customer_id"),
    ("order_date", "timestamp_ntz", "order_date"),
    ("order_status", "string", "order_status"),
    ("payment_method", "string", "payment_method"),
    ("total_amount", "double", "total_amount"),
    ("currency", "string", "currency"),
    ("source_system", "string", "source_system"),
    ("_ingested_at", "timestamp_ntz", "_ingested_at"),
]
BUSINESS_ORDER_ITEMS = [
    ("item_id", "bigint", "item_id"),
    ("order_id", "bigint", "order_id"),
    ("product_name", "string", "product_name"),
    ("quantity", "int", "quantity"),
    ("unit_price", "double", "unit_price"),
    ("discount_pct", "double", "discount_pct"),
    ("source_system", "string", "source_system"),
    ("_ingested_at", "timestamp_ntz", "_ingested_at"),
]

SPECS = {
    "ods_github_events": (GITHUB_EVENTS, "id"),
    "ods_weather_forecast": (WEATHER_FORECAST, "time"),
    "ods_ecommerce_products": (ECOMMERCE_PRODUCTS, "id"),
    "ods_business_customers": (BUSINESS_CUSTOMERS, "customer_id"),
    "ods_business_orders": (BUSINESS_ORDERS, "order_id"),
    "ods_business_order_items": (BUSINESS_ORDER_ITEMS, "item_id"),
}


def typed_view(raw: DataFrame, spec, key: str) -> DataFrame:
    """Cast + rename + drop null keys. ISO text becomes a UTC timestamp."""
    cols = []
    for src, typ, out in spec:
        c = F.col(src)
        if typ == "timestamp_ntz" and isinstance(raw.schema[src].dataType, T.StringType):
            c = iso_to_ts(c)
        cols.append(c.cast(typ).alias(out))
    return raw.where(F.col(key).isNotNull()).select(*cols)


def ods_github_events(raw: DataFrame) -> DataFrame:
    return typed_view(raw, *SPECS["ods_github_events"])


def ods_weather_forecast(raw: DataFrame) -> DataFrame:
    return typed_view(raw, *SPECS["ods_weather_forecast"])


def ods_ecommerce_products(raw: DataFrame) -> DataFrame:
    return typed_view(raw, *SPECS["ods_ecommerce_products"])


def ods_business_customers(raw: DataFrame) -> DataFrame:
    return typed_view(raw, *SPECS["ods_business_customers"])


def ods_business_orders(raw: DataFrame) -> DataFrame:
    return typed_view(raw, *SPECS["ods_business_orders"])


def ods_business_order_items(raw: DataFrame) -> DataFrame:
    return typed_view(raw, *SPECS["ods_business_order_items"])
