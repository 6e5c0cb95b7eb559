"""Raw landing frames in the four domain shapes, derived from the test tables.

The warehouse reads six raw tables (code-host events, weather readings,
product catalogue, customers, orders, order items). The driver's test data is
TPC-H-like, so each raw table is a projection of one test table, with
deliberately dirty values (padding, mixed case, nulls, repeated keys) that the
cleaning rules must handle. Every frame scales with its input table.

The mapping is stated as SQL in FIXTURES.md section 4; the oracle SQL in
``strata.plans.oracle`` repeats it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import trunc_ts
from strata.sources.ingest import with_ingest_meta
from strata.sources.tables import read_table

# Fixed source-system names stamped at ingestion, one per upstream system.
SOURCE_EVENTS = "github"
SOURCE_WEATHER = "open_meteo"
SOURCE_PRODUCTS = "dummyjson"
SOURCE_BUSINESS = "source_db"

# Fixed load times for domains whose test table has no time column.
CUSTOMER_LOAD_TIME = "2024-01-01 06:00:00"
PRODUCT_LOAD_BASE = "2024-01-01 00:00:00"


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def raw_github_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    repo = F.when(eid % 50 == 0, F.lit("nobody")).otherwise(
        F.concat(F.lit("owner"), _s(uid % 20), F.lit("/repo"), _s(eid % 100))
    )
    df = e.select(
        _s("event_id").alias("id"),
        F.concat(F.lit(" "), F.col("event_type")).alias("type"),
        F.concat(F.lit("user"), _s("user_id")).alias("actor_login"),
        uid.alias("actor_id"),
        repo.alias("repo_name"),
        (eid % 100).alias("repo_id"),
        F.col("ts").alias("created_at"),
        F.when(uid % 11 == 0, F.lit(None).cast("boolean")).otherwise(uid % 5 != 0).alias("is_public"),
        F.col("ts").alias("_ingested_at"),
    )
    return with_ingest_meta(df, SOURCE_EVENTS, ingested_at="_ingested_at")


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several readings per hour; the newest load wins downstream."""
    e = read_table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    df = e.select(
        trunc_ts("ts", "hour").alias("time"),
        ((eid % 450).cast("double") / F.lit(10.0)).alias("temperature_2m"),
        (uid % 101).cast("int").alias("humidity"),
        ((eid % 7).cast("double") / F.lit(2.0)).alias("precipitation"),
        (eid % 100).cast("int").alias("weather_code"),
        F.col("ts").alias("_ingested_at"),
    )
    return with_ingest_meta(df, SOURCE_WEATHER, ingested_at="_ingested_at")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    df = p.select(
        key.alias("id"),
        F.concat(F.col("p_name"), F.lit(" ")).alias("title"),
        F.col("p_type").alias("description"),
        F.col("p_retailprice").alias("price"),
        F.when(key % 4 == 0, F.lit(None).cast("long")).otherwise(key % 30).alias("discount_percentage"),
        ((F.col("p_size") % 41 + 10).cast("double") / F.lit(10.0)).alias("rating"),
        (F.col("p_size") * 3).alias("stock"),
        F.when(key % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("brand"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("/img/"), _s("p_partkey"), F.lit(".jpg")).alias("thumbnail"),
        (F.lit(PRODUCT_LOAD_BASE).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("p_size")))
        .alias("_ingested_at"),
    )
    return with_ingest_meta(df, SOURCE_PRODUCTS, ingested_at="_ingested_at")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    df = joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), F.col("c_name")).alias("customer_name"),
        F.concat(F.lit("C"), _s("c_custkey"), F.lit("@X.COM ")).alias("email"),
        F.lit("0755 268 1234").alias("phone"),
        F.col("n_name").alias("city"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")).alias("register_date"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("Corporate"))
        .otherwise(F.lit("individual ")).alias("customer_type"),
        F.lit(CUSTOMER_LOAD_TIME).cast("timestamp_ntz").alias("_ingested_at"),
    )
    return with_ingest_meta(df, SOURCE_BUSINESS, ingested_at="_ingested_at")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit(" Completed "))
        .when(F.col("o_orderstatus") == "O", F.lit("PROCESSING"))
        .otherwise(F.lit("cancelled"))
    )
    pr = F.col("o_orderpriority")
    method = (
        F.when(pr == "1-URGENT", F.lit("credit_card"))
        .when(pr == "2-HIGH", F.lit("Alipay"))
        .when(pr == "3-MEDIUM", F.lit("bank_transfer"))
        .when(pr == "5-LOW", F.lit("WeChat_Pay "))
    )
    df = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        status.alias("order_status"),
        method.alias("payment_method"),
        (F.col("o_totalprice") / 100).alias("total_amount"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("string")).otherwise(F.lit("cny")).alias("currency"),
        F.col("o_orderdate").alias("_ingested_at"),
    )
    return with_ingest_meta(df, SOURCE_BUSINESS, ingested_at="_ingested_at")


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (order, line) keys: the newest ship date wins downstream."""
    li = read_table(spark, sf_dir, "lineitem")
    df = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.concat(F.lit("part"), _s("l_partkey")).alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_discount") * 100).alias("discount_pct"),
        F.col("l_shipdate").alias("_ingested_at"),
    )
    return with_ingest_meta(df, SOURCE_BUSINESS, ingested_at="_ingested_at")


RAW = {
    "github_events": raw_github_events,
    "weather_forecast": raw_weather,
    "ecommerce_products": raw_products,
    "business_customers": raw_customers,
    "business_orders": raw_orders,
    "business_order_items": raw_order_items,
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW[name](spark, sf_dir)
