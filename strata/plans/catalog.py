"""Wiring of the models over one set of raw tables.

``Warehouse(spark, sf_dir)`` exposes every model as a lazy frame. Layers are
built on demand in dependency order; nothing is computed until an action.
In a scheduled job each layer is written once (``strata.plans.jobs``) and
read back by the next, so a lost executor only re-runs the current layer.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from strata.plans import ads, dwd, dws, ods
from strata.session import configure
from strata.sources import adapters
from strata.sources.ingest import load_seed

# Fixed clocks used by registered queries so results are reproducible.
AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)        # processing stamp of every layer
TRENDS_TODAY = _dt.date(2024, 1, 30)               # "CURRENT_DATE" for the trending report
ALERTS_NOW = _dt.datetime(2024, 1, 15, 0, 0, 0)    # "CURRENT_TIMESTAMP" for weather alerts

# Category seed for the test event types ('error' left out on purpose).
TEST_SEED = [
    ("click", "engagement", None),
    ("view", "engagement", None),
    ("purchase", "commerce", None),
    ("signup", "team", None),
]


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of=AS_OF, seed: DataFrame | None = None):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.as_of = as_of
        self._seed = seed

    # --- raw and ODS ---------------------------------------------------------
    def raw(self, domain: str) -> DataFrame:
        return adapters.raw(self.spark, self.sf_dir, domain)

    def ods(self, domain: str) -> DataFrame:
        return getattr(ods, f"ods_{domain}")(self.raw(domain))

    def seed(self) -> DataFrame:
        return self._seed if self._seed is not None else load_seed(self.spark, rows=TEST_SEED)

    # --- DWD -----------------------------------------------------------------
    def dwd(self, domain: str) -> DataFrame:
        return getattr(dwd, f"dwd_{domain}")(self.ods(domain), as_of=self.as_of)

    # --- DWS -----------------------------------------------------------------
    def dws_github_daily_activity(self, case_sensitive: bool = False) -> DataFrame:
        return dws.dws_github_daily_activity(
            self.dwd("github_events"), self.seed(), as_of=self.as_of, case_sensitive=case_sensitive
        )

    def dws_weather_daily_summary(self) -> DataFrame:
        return dws.dws_weather_daily_summary(self.dwd("weather_forecast"), as_of=self.as_of)

    def dws_ecommerce_category_daily(self) -> DataFrame:
        return dws.dws_ecommerce_category_daily(self.dwd("ecommerce_products"), as_of=self.as_of)

    def dws_order_daily_summary(self) -> DataFrame:
        return dws.dws_order_daily_summary(self.dwd("business_orders"), as_of=self.as_of)

    def dws_customer_order_summary(self) -> DataFrame:
        return dws.dws_customer_order_summary(
            self.dwd("business_orders"), self.dwd("business_customers"), as_of=self.as_of
        )

    # --- ADS -----------------------------------------------------------------
    def ads_github_trending(self, calendar: bool = False) -> DataFrame:
        return ads.ads_github_trending(
            self.dws_github_daily_activity(), today=TRENDS_TODAY, as_of=self.as_of, calendar=calendar
        )

    def ads_weather_alert(self, alert_kind: bool = False) -> DataFrame:
        return ads.ads_weather_alert(self.dwd("weather_forecast"), now=ALERTS_NOW, as_of=self.as_of, alert_kind=alert_kind)

    def ads_ecommerce_kpi(self) -> DataFrame:
        return ads.ads_ecommerce_kpi(self.dws_ecommerce_category_daily(), as_of=self.as_of)

    def ads_business_kpi(self) -> DataFrame:
        return ads.ads_business_kpi(self.dws_customer_order_summary(), self.dws_order_daily_summary(), as_of=self.as_of)

    def model(self, name: str) -> DataFrame:
        layer, _, domain = name.partition("_")
        if layer == "raw":
            return adapters.raw(self.spark, self.sf_dir, domain)
        if layer == "ods":
            return self.ods(domain)
        if layer == "dwd":
            return self.dwd(domain)
        return getattr(self, name)()
