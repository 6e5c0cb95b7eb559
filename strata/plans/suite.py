"""The declared check suite per model, and source freshness limits.

Fixed values: the column tests, severities and freshness hours declared for
the reference warehouse's models and sources. ODS uniqueness runs with
severity warn because raw is append-only and repeats keys (SURVEY G2).
"""

from __future__ import annotations

from strata.operators.quality import accepted_values as av
from strata.operators.quality import assert_rows, not_null_multicol, reasonable_range
from strata.operators.quality import not_null as nn
from strata.operators.quality import unique as uq
from strata.sources.ingest import EVENT_TYPE_CATEGORIES

GITHUB_EVENT_TYPES = [event_type for event_type, _, _ in EVENT_TYPE_CATEGORIES]

# Checks declared on the raw sources; uniqueness warns there as on ODS, since raw repeats keys.
RAW_SUITE = {
    "raw_github_events": [nn("id"), uq("id", "warn"), nn("type"), nn("created_at"), nn("repo_name")],
    "raw_weather_forecast": [nn("time"), nn("temperature_2m")],
    "raw_ecommerce_products": [nn("id"), uq("id", "warn"), nn("title"), nn("price")],
    "raw_business_customers": [nn("customer_id"), uq("customer_id", "warn"), nn("customer_name")],
    "raw_business_orders": [nn("order_id"), uq("order_id", "warn"), nn("order_date"), nn("total_amount")],
    "raw_business_order_items": [nn("item_id"), uq("item_id", "warn"), nn("order_id")],
}

ODS_SUITE = {
    "ods_github_events": [nn("event_id"), uq("event_id", "warn"), nn("event_type"), nn("repo_name"), nn("_ingested_at")],
    "ods_weather_forecast": [nn("forecast_time"), nn("temperature_2m"), nn("_ingested_at")],
    "ods_ecommerce_products": [nn("product_id"), uq("product_id", "warn"), nn("product_title"), nn("price"),
                               nn("_ingested_at")],
    "ods_business_customers": [nn("customer_id"), uq("customer_id", "warn"), nn("customer_name"), nn("_ingested_at")],
    "ods_business_orders": [nn("order_id"), uq("order_id", "warn"), nn("order_date"), nn("total_amount"),
                            nn("_ingested_at")],
    "ods_business_order_items": [nn("item_id"), uq("item_id", "warn"), nn("order_id"), nn("_ingested_at")],
}

DWD_SUITE = {
    "dwd_github_events": [uq("event_id"), nn("event_id"), nn("event_type"),
                          av("event_type", GITHUB_EVENT_TYPES, "warn"), nn("event_date"), nn("repo_owner"),
                          nn("repo_name_short")],
    "dwd_weather_forecast": [uq("forecast_time"), nn("forecast_time"), nn("temperature_2m"), nn("weather_category")],
    "dwd_ecommerce_products": [uq("product_id"), nn("product_id"), nn("product_title"), nn("price"),
                               nn("rating_tier"), av("rating_tier", ["platinum", "gold", "silver", "bronze"])],
    "dwd_business_customers": [uq("customer_id"), nn("customer_id"), nn("customer_name"), nn("customer_type"),
                               av("customer_type", ["individual", "corporate"])],
    "dwd_business_orders": [uq("order_id"), nn("order_id"), nn("customer_id"), nn("order_status"),
                            av("order_status", ["completed", "processing", "cancelled", "refunded"]),
                            nn("total_amount"), nn("order_date_key")],
    "dwd_business_order_items": [uq("item_id"), nn("item_id"), nn("order_id"), nn("product_name"), nn("quantity"),
                                 nn("line_total")],
}

DWS_SUITE = {
    "dws_github_daily_activity": [nn("event_date"), nn("event_type"), nn("event_count"), nn("unique_actors"),
                                  nn("unique_repos"),
                                  assert_rows("dws_positive_counts",
                                              "event_count < 0 OR unique_actors < 0 OR unique_repos < 0")],
    "dws_weather_daily_summary": [nn("forecast_date"), uq("forecast_date"), nn("avg_temperature"),
                                  nn("record_count")],
    "dws_ecommerce_category_daily": [nn("category"), nn("product_count"), nn("avg_price"), nn("avg_rating")],
    "dws_order_daily_summary": [nn("order_date_key"), nn("order_status"), nn("order_count"), nn("total_revenue"),
                                nn("avg_order_value")],
    "dws_customer_order_summary": [nn("customer_id"), uq("customer_id"), nn("customer_name"), nn("total_orders"),
                                   nn("total_revenue"), nn("customer_tier")],
}

ADS_SUITE = {
    "ads_github_trending": [nn("event_date"), nn("event_type"), nn("event_count"), nn("daily_rank"),
                            reasonable_range("day_over_day_pct", -100, 1000)],
    "ads_weather_alert": [nn("forecast_time"), nn("alert_type"), nn("severity"),
                          av("severity", ["warning", "critical"])],
    "ads_ecommerce_kpi": [nn("category"), uq("category"), nn("total_inventory_value"), nn("revenue_rank")],
    "ads_business_kpi": [nn("customer_id"), uq("customer_id"), nn("customer_name"), nn("total_revenue"),
                         nn("revenue_rank"), nn("customer_tier"),
                         av("customer_tier", ["vip", "premium", "standard", "basic"])],
}

# Row assertions that stand alone (Q7) and the multi-column rule (Q5, declared but unused upstream).
ODS_NO_EMPTY = assert_rows(
    "ods_github_no_empty_events", "event_id IS NULL OR event_id = '' OR event_type IS NULL OR event_type = ''"
)
ORDERS_MULTICOL = not_null_multicol(["payment_method", "currency"])

# Source freshness: (warn after hours, error after hours).
FRESHNESS_HOURS = {
    "github_events": (6, 12),
    "weather_forecast": (2, 4),
    "ecommerce_products": (24, 48),
    "business_customers": (24, 48),
    "business_orders": (24, 48),
    "business_order_items": (24, 48),
}

FULL_SUITE = {**RAW_SUITE, **ODS_SUITE, **DWD_SUITE, **DWS_SUITE, **ADS_SUITE}
FULL_SUITE["ods_github_events"] = [*ODS_SUITE["ods_github_events"], ODS_NO_EMPTY]
