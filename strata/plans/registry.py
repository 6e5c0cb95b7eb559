"""Registered queries (one per model and operator) and their oracle SQL twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.plans import oracle as O
from strata.plans.catalog import Warehouse
from strata.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MODELS = [
    "ods_github_events", "ods_weather_forecast", "ods_ecommerce_products",
    "ods_business_customers", "ods_business_orders", "ods_business_order_items",
    "dwd_github_events", "dwd_weather_forecast", "dwd_ecommerce_products",
    "dwd_business_customers", "dwd_business_orders", "dwd_business_order_items",
    "dws_github_daily_activity", "dws_weather_daily_summary", "dws_ecommerce_category_daily",
    "dws_order_daily_summary", "dws_customer_order_summary",
    "ads_github_trending", "ads_weather_alert", "ads_ecommerce_kpi", "ads_business_kpi",
]


def register(name: str, oracle_sql: str | None = None):
    """Register a query; it runs with the warehouse's runtime settings (UTC, ANSI, AQE)
    on whatever session the caller passes."""
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Warehouse(spark, sf_dir).model(name)
    run.__name__ = name
    return run


for _m in MODELS:
    register(_m, O.sql(_m))(_model_query(_m))

# --- switch variants ------------------------------------------


@register("dws_github_daily_activity_case_sensitive", O.sql("dws_github_daily_activity_case_sensitive"))
def _q_case_sensitive(spark, sf_dir):
    return Warehouse(spark, sf_dir).dws_github_daily_activity(case_sensitive=True)


@register("ads_github_trending_calendar", O.sql("ads_github_trending_calendar"))
def _q_calendar(spark, sf_dir):
    return Warehouse(spark, sf_dir).ads_github_trending(calendar=True)


@register("ads_weather_alert_kind", O.sql("ads_weather_alert_kind"))
def _q_alert_kind(spark, sf_dir):
    return Warehouse(spark, sf_dir).ads_weather_alert(alert_kind=True)


# Operator-level queries register themselves on import.
from strata.plans import operator_queries  # noqa: E402,F401
