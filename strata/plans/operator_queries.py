"""Operator-level queries, each with its oracle SQL twin.

Every query reads the driver's tables in full and runs one operator (or a
short chain) of ``strata`` on them; the SQL states the same result for DuckDB.
Incremental operators are checked by splitting an input by load time:
the target is built from the first part, the operator applies the whole
input, and the oracle states the final content.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import exprs as X
from strata.operators import monitor, quality, report, sketches
from strata.operators.dedup import latest_by_key
from strata.operators.incremental import newer_than, recompute_changed
from strata.operators.joins import attach_latest, attach_one_row, lookup_join, orphans
from strata.operators.ranking import global_rank, top_k_rank
from strata.plans import ads, dwd, dws, jobs
from strata.plans import oracle as O
from strata.plans import suite as S
from strata.plans.catalog import AS_OF, TRENDS_TODAY, Warehouse
from strata.plans.registry import register
from strata.session import ensure_checkpoint_dir
from strata.sources.ingest import load_seed, read_partitioned, upsert_partitions, with_ingest_meta, with_layer
from strata.sources.json_records import json_path, quarantine, read_json_columnar, read_json_records
from strata.sources.tables import read_table

# Fixed split points (load time) between "yesterday's" and "today's" data per domain.
CUTS = {
    "github_events": _dt.datetime(2024, 1, 20, 12, 0, 0),
    "weather_forecast": _dt.datetime(2024, 1, 20, 12, 0, 0),
    "ecommerce_products": _dt.datetime(2024, 1, 2, 0, 0, 0),
    "business_customers": _dt.datetime(2024, 1, 1, 6, 0, 0),
    "business_orders": _dt.datetime(1998, 8, 1, 0, 0, 0),
    "business_order_items": _dt.datetime(1998, 8, 1, 0, 0, 0),
}
AS_OF_FIRST = _dt.datetime(2024, 1, 30, 0, 0, 0)
FRESHNESS_AS_OF = _dt.datetime(2024, 1, 31, 3, 0, 0)
SNAPSHOT_DAY = _dt.date(2024, 1, 31)
LOAD_TIME = _dt.datetime(2024, 1, 31, 7, 0, 0)


def _sql_ts(v: _dt.datetime) -> str:
    return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"


def _first(w: Warehouse, domain: str) -> DataFrame:
    ods = w.ods(domain)
    return ods.where(F.col("_ingested_at") <= F.lit(CUTS[domain]).cast("timestamp_ntz"))


def _first_rel(domain: str) -> str:
    name = f"ods_{domain}_first"
    if name not in O.REL:
        O.rel(name, f"SELECT * FROM ods_{domain} WHERE _ingested_at <= {_sql_ts(CUTS[domain])}", [f"ods_{domain}"])
        O.rel(f"dwd_{domain}_first", O.dwd_body(f"dwd_{domain}", name), [name])
    return name


for _d in CUTS:
    _first_rel(_d)

# =====================================================================================
# Sources: JSON payloads, ingest metadata, layer column, seed join
# =====================================================================================

EVENT_DOC = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor", T.StructType([T.StructField("login", T.StringType()), T.StructField("id", T.LongType())])),
    T.StructField("repo", T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.LongType())])),
    T.StructField("created_at", T.StringType()),
    T.StructField("public", T.BooleanType()),
])


@register("json_props_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text
FROM events""")
def q_json_props_extract(spark, sf_dir):
    """Typed parse of the JSON ``props`` column and a schema-less path lookup."""
    e = read_table(spark, sf_dir, "events")
    parsed = F.from_json(F.col("props"), T.StructType([T.StructField("k", T.LongType())]))
    return e.select("event_id", parsed.getField("k").alias("k"), json_path("props", "$.k").alias("k_text"))


@register("json_records_nested", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS type, concat('user', CAST(user_id AS VARCHAR)) AS actor_login,
       user_id AS actor_id, CAST(event_id % 100 AS BIGINT) AS repo_id, value > 20 AS is_public
FROM events""")
def q_json_records_nested(spark, sf_dir):
    """Pages of API records (arrays of objects, 100 per page) to rows by nested paths.

    The pages are built by Spark from ``events`` (bounded groups of 100 ids),
    written as JSON text, and read back with the declared element schema.
    """
    e = read_table(spark, sf_dir, "events")
    rec = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login"),
                 F.col("user_id").alias("id")).alias("actor"),
        F.struct(F.lit("o/r").alias("name"), (F.col("event_id") % 100).alias("id")).alias("repo"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        (F.col("value") > 20).alias("public"),
    )
    pages = e.groupBy(F.floor(F.col("event_id") / 100).alias("page")).agg(F.to_json(F.collect_list(rec)).alias("doc"))
    return read_json_records(
        pages, "doc", EVENT_DOC,
        {"id": "id", "type": "type", "actor_login": "actor.login", "actor_id": "actor.id", "repo_id": "repo.id",
         "is_public": "public"},
    )


@register("json_products_root", """
SELECT p_partkey AS product_id, p_name AS title, p_retailprice AS price, CAST(p_size AS DOUBLE) AS discount_percentage
FROM part""")
def q_json_products_root(spark, sf_dir):
    """Records under a root key (``{"products": [...]}``), renamed on the way out."""
    p = read_table(spark, sf_dir, "part")
    rec = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("double").alias("discountPercentage"),
    )
    pages = p.groupBy(F.floor(F.col("p_partkey") / 100).alias("page")).agg(
        F.to_json(F.struct(F.collect_list(rec).alias("products"))).alias("doc")
    )
    element = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
        T.StructField("price", T.DoubleType()), T.StructField("discountPercentage", T.DoubleType()),
    ])
    return read_json_records(
        pages, "doc", element,
        {"product_id": "id", "title": "title", "price": "price", "discount_percentage": "discountPercentage"},
        root="products",
    )


@register("json_quarantine", """
SELECT CAST(event_id % 50 = 7 AS BOOLEAN) AS broken, CAST(count(*) AS BIGINT) AS documents,
       CAST(sum(CASE WHEN event_id % 50 = 7 THEN 0 ELSE event_id END) AS BIGINT) AS id_sum
FROM events GROUP BY 1""")
def q_json_quarantine(spark, sf_dir):
    """S1 with broken documents: they are split off and counted, the others are read in full."""
    e = read_table(spark, sf_dir, "events")
    whole = F.to_json(F.array(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type"))))
    doc = F.when(F.col("event_id") % 50 == 7, F.concat(whole, F.lit(",{"))).otherwise(whole)
    good, bad = quarantine(e.select(doc.alias("doc")), "doc", "array")
    rows = read_json_records(good, "doc", EVENT_DOC, {"id": "id"})
    read = rows.agg(F.lit(False).alias("broken"), F.count(F.lit(1)).alias("documents"), F.sum(F.col("id").cast("long")).alias("id_sum"))
    return read.unionByName(bad.agg(F.lit(True).alias("broken"), F.count(F.lit(1)).alias("documents"), F.lit(0).cast("long").alias("id_sum")))


@register("json_columnar_zip", """
SELECT event_id, ts AS time, value AS temperature_2m, CAST(user_id % 101 AS INTEGER) AS humidity FROM events""")
def q_json_columnar_zip(spark, sf_dir):
    """S3: documents of parallel arrays (``{"hourly": {"time": [...], ...}}``) zipped back into rows.

    Documents hold 100 consecutive event ids each (a bounded group).
    """
    e = read_table(spark, sf_dir, "events")
    rows = F.sort_array(F.collect_list(F.struct("event_id", "ts", "value", (F.col("user_id") % 101).cast("int").alias("h"))))
    pages = e.groupBy(F.floor(F.col("event_id") / 100).alias("page")).agg(rows.alias("r"))
    doc = F.to_json(F.struct(F.struct(
        F.transform("r", lambda x: x["event_id"]).alias("event_id"),
        F.transform("r", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("time"),
        F.transform("r", lambda x: x["value"]).alias("temperature_2m"),
        F.transform("r", lambda x: x["h"]).alias("relative_humidity_2m"),
    ).alias("hourly")))
    zipped = read_json_columnar(
        pages.select(doc.alias("doc")), "doc", "hourly",
        {"event_id": ("event_id", T.LongType()), "time": ("time", T.StringType()),
         "temperature_2m": ("temperature_2m", T.DoubleType()), "humidity": ("relative_humidity_2m", T.IntegerType())},
    )
    return zipped.select("event_id", X.iso_to_ts("time").alias("time"), "temperature_2m", "humidity")


@register("ingest_meta", f"""
SELECT o_orderkey AS order_id, o_totalprice AS total_amount, 'source_db' AS source_system,
       {_sql_ts(LOAD_TIME)} AS _ingested_at, 'ODS' AS _layer
FROM orders""")
def q_ingest_meta(spark, sf_dir):
    """S5 + S12: source system and a fixed load time stamped at ingestion, plus the layer column."""
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total_amount")
    )
    return with_layer(with_ingest_meta(o, "source_db", LOAD_TIME), "ods")


@register("seed_join_default", f"""
SELECT e.event_id, upper(trim(e.event_type)) AS event_type, coalesce(c.category, 'uncategorized') AS category
FROM events e LEFT JOIN {O.seed_values()}
  ON upper(trim(e.event_type)) = upper(c.event_type)""")
def q_seed_join_default(spark, sf_dir):
    """S7 + J2: left join to the category seed on an expression key, default on miss."""
    w = Warehouse(spark, sf_dir)
    e = read_table(spark, sf_dir, "events")
    seed = w.seed().select(F.upper("event_type").alias("_k"), "category")
    key = F.upper(F.trim(F.col("event_type")))
    joined = lookup_join(e, seed, key, "_k", defaults={"category": F.lit("uncategorized")})
    return joined.select("event_id", key.alias("event_type"), "category")


@register("seed_from_csv", """
SELECT n_name AS event_type, r_name AS category, concat(n_name, ', "', r_name, '"') AS description, count(c_custkey) AS customers
FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""")
def q_seed_from_csv(spark, sf_dir):
    """S7 from a file: a CSV of the nations (quotes and commas in it) is written, loaded with the declared
    schema and joined to every customer."""
    path = _scratch(spark, "seed-csv")
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    text = F.concat(F.col("n_name"), F.lit(', "'), F.col("r_name"), F.lit('"'))
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows.select(F.col("n_name").alias("event_type"), F.col("r_name").alias("category"), text.alias("description")).write.option(
        "header", True).option("escape", '"').csv(path)
    seed = load_seed(spark, path)
    named = read_table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    counts = named.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))
    joined = lookup_join(seed, counts, F.col("event_type"), "n_name", defaults={"customers": F.lit(0)})
    return joined.select("event_type", "category", "description", "customers")


# =====================================================================================
# Dedup, incremental load and merge
# =====================================================================================

@register("dedup_latest_lineitem", """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS FIRST, l_partkey ASC NULLS FIRST,
                                        l_suppkey ASC NULLS FIRST) AS _rn
  FROM lineitem) WHERE _rn = 1""")
def q_dedup_latest_lineitem(spark, sf_dir):
    """W5 on real duplicates: newest ship date per (order, line), then part, then supplier."""
    li = read_table(spark, sf_dir, "lineitem")
    return latest_by_key(
        li, ["l_orderkey", "l_linenumber"],
        order_by=[F.col("l_shipdate").desc_nulls_first()],
        tiebreak=[F.col("l_partkey").asc_nulls_first(), F.col("l_suppkey").asc_nulls_first()],
    )


@register("watermark_filter", O.sql(
    "SELECT * FROM ods_business_orders WHERE _ingested_at > "
    "(SELECT coalesce(max(_ingested_at), TIMESTAMP '1970-01-01 00:00:00') FROM dwd_business_orders_first)",
    ["ods_business_orders", "dwd_business_orders_first"]))
def q_watermark_filter(spark, sf_dir):
    """Source rows strictly newer than the target's max load time (pushed as a literal)."""
    w = Warehouse(spark, sf_dir)
    target = dwd.dwd_business_orders(_first(w, "business_orders"), as_of=AS_OF)
    return newer_than(w.ods("business_orders"), target, "_ingested_at")


@register("upsert_orders", O.sql("dwd_business_orders"))
def q_upsert_orders(spark, sf_dir):
    """I1 + I4: incremental DWD run over a target built from the first part equals a full build."""
    w = Warehouse(spark, sf_dir)
    target = dwd.dwd_business_orders(_first(w, "business_orders"), as_of=AS_OF)
    return dwd.dwd_business_orders(w.ods("business_orders"), as_of=AS_OF, target=target)


@register("upsert_items_latest", O.sql("dwd_business_order_items"))
def q_upsert_items_latest(spark, sf_dir):
    """I1 + I4 + W5 with repeated keys: a newer load of an item replaces the older row."""
    w = Warehouse(spark, sf_dir)
    target = dwd.dwd_business_order_items(_first(w, "business_order_items"), as_of=AS_OF)
    return dwd.dwd_business_order_items(w.ods("business_order_items"), as_of=AS_OF, target=target)


O.rel("dws_github_daily_activity_first",
      O.REL["dws_github_daily_activity"][0].replace("FROM dwd_github_events e", "FROM dwd_github_events_first e"),
      ["dwd_github_events_first", "seed"])
O.rel("dws_order_daily_summary_first", O.ORDER_DAILY_AGG.format(src="dwd_business_orders_first"),
      ["dwd_business_orders_first"])


@register("reopen_last_period", O.sql(
    "SELECT * FROM dwd_business_orders WHERE order_date_key >= "
    "(SELECT coalesce(max(order_date_key), TIMESTAMP '1970-01-01 00:00:00') FROM dws_order_daily_summary_first)",
    ["dwd_business_orders", "dws_order_daily_summary_first"]))
def q_reopen_last_period(spark, sf_dir):
    """Inclusive watermark, the last stored day is redone."""
    w = Warehouse(spark, sf_dir)
    first = dws.dws_order_daily_summary(dwd.dwd_business_orders(_first(w, "business_orders"), as_of=AS_OF), as_of=AS_OF)
    return newer_than(w.dwd("business_orders"), first, "order_date_key", inclusive=True)


@register("replace_partial_key", O.sql("dws_order_daily_summary"))
def q_replace_partial_key(spark, sf_dir):
    """I2 + I5: day summary re-opened and replaced by day (key coarser than the grain)."""
    w = Warehouse(spark, sf_dir)
    first = dws.dws_order_daily_summary(dwd.dwd_business_orders(_first(w, "business_orders"), as_of=AS_OF), as_of=AS_OF)
    return dws.dws_order_daily_summary(w.dwd("business_orders"), as_of=AS_OF, target=first)


@register("upsert_composite", O.sql("dws_github_daily_activity"))
def q_upsert_composite(spark, sf_dir):
    """I2 + I4 with a composite key (date, type, category); the cut falls mid-day."""
    w = Warehouse(spark, sf_dir)
    first = dws.dws_github_daily_activity(
        dwd.dwd_github_events(_first(w, "github_events"), as_of=AS_OF), w.seed(), as_of=AS_OF
    )
    return dws.dws_github_daily_activity(w.dwd("github_events"), w.seed(), as_of=AS_OF, target=first)


@register("full_recompute_merge", O.sql("dws_customer_order_summary"))
def q_full_recompute_merge(spark, sf_dir):
    """Full recompute merged by customer over a summary built from the first part."""
    w = Warehouse(spark, sf_dir)
    first = dws.dws_customer_order_summary(
        dwd.dwd_business_orders(_first(w, "business_orders"), as_of=AS_OF), w.dwd("business_customers"), as_of=AS_OF
    )
    return dws.dws_customer_order_summary(w.dwd("business_orders"), w.dwd("business_customers"), as_of=AS_OF,
                                          target=first)


O.rel("dwd_orders_1", O.dwd_body("dwd_business_orders", "ods_business_orders_first", _sql_ts(AS_OF_FIRST)),
      ["ods_business_orders_first"])
O.rel("dwd_orders_2", O.dwd_body(
    "dwd_business_orders",
    "(SELECT * FROM ods_business_orders WHERE _ingested_at > (SELECT max(_ingested_at) FROM dwd_orders_1))"),
    ["ods_business_orders", "dwd_orders_1"])
O.rel("dwd_customers_1", O.dwd_body("dwd_business_customers", "ods_business_customers", _sql_ts(AS_OF_FIRST)),
      ["ods_business_customers"])
O.rel("dws_customers_1", O.CUSTOMER_AGG.format(orders="dwd_orders_1", customers="dwd_customers_1")
      .replace(O.AS_OF + " AS _dws_processed_at", _sql_ts(AS_OF_FIRST) + " AS _dws_processed_at"),
      ["dwd_orders_1", "dwd_customers_1"])
O.rel("dwd_orders_all", "SELECT * FROM dwd_orders_1 UNION ALL SELECT * FROM dwd_orders_2",
      ["dwd_orders_1", "dwd_orders_2"])
O.rel("touched_customers", "SELECT DISTINCT customer_id FROM dwd_orders_2", ["dwd_orders_2"])


@register("changed_customers_merge", O.sql(
    "SELECT * FROM dws_customers_1 WHERE customer_id NOT IN (SELECT customer_id FROM touched_customers) UNION ALL "
    + O.CUSTOMER_AGG.format(
        orders="(SELECT * FROM dwd_orders_all WHERE customer_id IN (SELECT customer_id FROM touched_customers))",
        customers="dwd_customers_1"),
    ["dws_customers_1", "touched_customers", "dwd_orders_all", "dwd_customers_1"]))
def q_changed_customers_merge(spark, sf_dir):
    """I9 incrementally: only customers with new orders are re-aggregated (over all their orders)."""
    w = Warehouse(spark, sf_dir)
    o1 = dwd.dwd_business_orders(_first(w, "business_orders"), as_of=AS_OF_FIRST)
    c1 = dwd.dwd_business_customers(w.ods("business_customers"), as_of=AS_OF_FIRST)
    s1 = dws.dws_customer_order_summary(o1, c1, as_of=AS_OF_FIRST)
    o_all = dwd.dwd_business_orders(w.ods("business_orders"), as_of=AS_OF, target=o1)
    return dws.dws_customer_order_summary_changed(o_all, c1, s1, as_of=AS_OF)


# --- I3 / G4: changed categories ----------------------------------------------------
_A1, _A2 = _sql_ts(AS_OF_FIRST), O.AS_OF
O.rel("dwd_products_1", O.dwd_body("dwd_ecommerce_products", "ods_ecommerce_products_first", _A1),
      ["ods_ecommerce_products_first"])
O.rel("dwd_products_2", O.dwd_body(
    "dwd_ecommerce_products",
    "(SELECT * FROM ods_ecommerce_products WHERE _ingested_at > (SELECT max(_ingested_at) FROM dwd_products_1))", _A2),
    ["ods_ecommerce_products", "dwd_products_1"])
O.rel("dwd_products_all", "SELECT * FROM dwd_products_1 WHERE product_id NOT IN (SELECT product_id FROM dwd_products_2) "
      "UNION ALL SELECT * FROM dwd_products_2", ["dwd_products_1", "dwd_products_2"])
O.rel("dws_category_1", O.CATEGORY_AGG.format(src="dwd_products_1", stamp=_A1), ["dwd_products_1"])
O.rel("changed_category_keys",
      f"SELECT DISTINCT category FROM dwd_products_all WHERE _dwd_processed_at > {_A1}", ["dwd_products_all"])


def _changed_categories(spark, sf_dir, partial: bool) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    ods = w.ods("ecommerce_products")
    d1 = dwd.dwd_ecommerce_products(_first(w, "ecommerce_products"), as_of=AS_OF_FIRST)
    s1 = dws.dws_ecommerce_category_daily(d1, as_of=AS_OF_FIRST)
    d_all = dwd.dwd_ecommerce_products(ods, as_of=AS_OF, target=d1)
    return dws.dws_ecommerce_category_daily(d_all, as_of=AS_OF, target=s1, partial=partial)


@register("changed_categories", O.sql(
    "SELECT * FROM dws_category_1 WHERE category NOT IN (SELECT category FROM changed_category_keys) UNION ALL "
    + O.CATEGORY_AGG.format(
        src="(SELECT * FROM dwd_products_all WHERE category IN (SELECT category FROM changed_category_keys))",
        stamp=_A2),
    ["dws_category_1", "changed_category_keys", "dwd_products_all"]))
def q_changed_categories(spark, sf_dir):
    """I3 + G4: categories touched since the last run are rebuilt over ALL their products."""
    return _changed_categories(spark, sf_dir, partial=False)


@register("changed_categories_partial", O.sql(
    "SELECT * FROM dws_category_1 WHERE category NOT IN (SELECT category FROM changed_category_keys) UNION ALL "
    + O.CATEGORY_AGG.format(src=f"(SELECT * FROM dwd_products_all WHERE _dwd_processed_at > {_A1})", stamp=_A2),
    ["dws_category_1", "changed_category_keys", "dwd_products_all"]))
def q_changed_categories_partial(spark, sf_dir):
    """I3 as the reference does it: only the changed rows are aggregated."""
    return _changed_categories(spark, sf_dir, partial=True)


@register("changed_categories_moved", """
SELECT CASE WHEN p_brand = 'Brand#55' THEN 'Brand#12' WHEN p_partkey % 5 = 0 THEN 'Brand#11' ELSE p_brand END AS category,
       CAST(count(*) AS BIGINT) AS product_count, CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS price_cents
FROM part GROUP BY 1""")
def q_changed_categories_moved(spark, sf_dir):
    """Products change category and one category empties; the rebuilt table equals the full build."""
    p = read_table(spark, sf_dir, "part")
    old, stamp = F.col("p_brand"), lambda t: F.lit(t).cast("timestamp_ntz")
    moved = (old == "Brand#55") | (F.col("p_partkey") % 5 == 0)
    new = F.when(old == "Brand#55", F.lit("Brand#12")).when(F.col("p_partkey") % 5 == 0, F.lit("Brand#11")).otherwise(old)

    def build(at):
        return lambda frame: frame.groupBy("category").agg(
            F.count(F.lit(1)).alias("product_count"), F.sum(F.round(F.col("price") * 100).cast("long")).alias("price_cents")
        ).withColumn("_dws_processed_at", stamp(at))

    first = p.select(old.alias("category"), F.col("p_retailprice").alias("price"))
    second = p.select(
        new.alias("category"), F.col("p_retailprice").alias("price"),
        F.when(moved, stamp("2024-01-02 00:00:00")).otherwise(stamp("2024-01-01 00:00:00")).alias("_dwd_processed_at"),
    )
    out = recompute_changed(second, build("2024-01-01 00:00:00")(first), "_dwd_processed_at", "_dws_processed_at",
                            ["category"], build("2024-01-02 00:00:00"), count_column="product_count")
    return out.select("category", "product_count", "price_cents")


@register("upsert_partitions_moved", """
WITH f AS (SELECT min(date_trunc('month', o_orderdate)) AS m FROM orders),
     o AS (SELECT *, (o_orderkey % 3 = 0 OR date_trunc('month', o_orderdate) = f.m) AS moved FROM orders, f)
SELECT o_orderkey AS order_id, CASE WHEN moved THEN o_totalprice + 1 ELSE o_totalprice END AS total_amount,
       CAST(date_trunc('month', CASE WHEN moved THEN o_orderdate + INTERVAL 1 YEAR ELSE o_orderdate END) AS DATE) AS order_month
FROM o""")
def q_upsert_partitions_moved(spark, sf_dir):
    """I4 on disk: two loads of orders into month partitions; a third of the keys move to another
    partition and the first one empties. Written to and read back from the shared folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/upsert-moved-{uuid.uuid4().hex[:12]}"
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total_amount"), F.to_date("o_orderdate").alias("day"))
    month = lambda c: F.trunc(c, "MM").alias("_part_date")
    first_month = o.agg(F.min(F.trunc("day", "MM"))).first()[0]
    upsert_partitions(None, o.select("order_id", "total_amount", month(F.col("day"))), ["order_id"], base, "dwd", "orders", "_part_date")
    moved = o.where((F.col("order_id") % 3 == 0) | (F.trunc("day", "MM") == F.lit(first_month)))
    batch = moved.select("order_id", (F.col("total_amount") + 1).alias("total_amount"), month(F.add_months("day", 12)))
    target = read_partitioned(spark, base, "dwd", "orders", "_part_date")
    upsert_partitions(target, batch, ["order_id"], base, "dwd", "orders", "_part_date")
    out = read_partitioned(spark, base, "dwd", "orders", "_part_date")
    return out.select("order_id", "total_amount", F.col("_part_date").alias("order_month"))


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@register("watermark_pruned", O.sql(
    f"SELECT * FROM ods_github_events WHERE _ingested_at > {_sql_ts(CUTS['github_events'])}", ["ods_github_events"]))
def q_watermark_pruned(spark, sf_dir):
    """S6 + I1: events landed by load day; the read after a watermark opens only the days since then."""
    job = jobs.Job(spark, _scratch(spark, "watermark"), as_of=AS_OF)
    job.land("github_events", Warehouse(spark, sf_dir).raw("github_events"))
    return job.ods("github_events", since=CUTS["github_events"])


LATE_LOAD = _dt.datetime(2024, 2, 1, 6, 0, 0)


@register("late_rows_reach_dws", O.sql("dws_github_daily_activity"))
def q_late_rows_reach_dws(spark, sf_dir):
    """I2 with late rows (G3): a tenth of the events of all days is loaded after the day summary was
    built; the change log names their days, and the refreshed summary equals the full build."""
    w = Warehouse(spark, sf_dir)
    job = jobs.Job(spark, _scratch(spark, "late-rows"), as_of=AS_OF, seed=w.seed())
    raw, late = w.raw("github_events"), F.col("id").cast("long") % 10 == 3
    job.land("github_events", raw.where(~late))
    job.refresh_dwd("github_events")
    job.refresh_dws("dws_github_daily_activity")
    job.land("github_events", raw.where(late).withColumn("_ingested_at", F.lit(LATE_LOAD).cast("timestamp_ntz")))
    job.refresh_dwd("github_events")
    return job.refresh_dws("dws_github_daily_activity")


O.rel("orders_given_away", """
SELECT * REPLACE (CASE WHEN order_id % 9 = 4 THEN customer_id % 7 + 1 ELSE customer_id END AS customer_id)
FROM dwd_business_orders""", ["dwd_business_orders"])


@register("moved_orders_reach_customers", O.sql(
    O.CUSTOMER_AGG.format(orders="orders_given_away", customers="dwd_business_customers"),
    ["orders_given_away", "dwd_business_customers"]))
def q_moved_orders_reach_customers(spark, sf_dir):
    """I9 from the change log: a ninth of the orders goes to other customers in a second load; those
    they left and those they came to are re-aggregated, and the table equals the full build."""
    w = Warehouse(spark, sf_dir)
    job = jobs.Job(spark, _scratch(spark, "moved-orders"), as_of=AS_OF, grain="month")
    raw, moved = w.raw("business_orders"), F.col("order_id") % 9 == 4
    job.land("business_orders", raw)
    job.land("business_customers", w.raw("business_customers"))
    for domain in ("business_orders", "business_customers"):
        job.refresh_dwd(domain)
    job.refresh_dws("dws_customer_order_summary")
    job.land("business_orders", raw.where(moved).withColumns({
        "customer_id": F.col("customer_id") % 7 + 1, "_ingested_at": F.lit(LATE_LOAD).cast("timestamp_ntz")}))
    job.refresh_dwd("business_orders")
    return job.refresh_dws("dws_customer_order_summary")


O.rel("products_regrouped", """
SELECT * REPLACE (CASE WHEN product_id % 6 = 1 THEN 'second hand' ELSE category END AS category) FROM dwd_ecommerce_products""",
      ["dwd_ecommerce_products"])


@register("moved_products_reach_categories", O.sql(
    O.CATEGORY_AGG.format(src="products_regrouped", stamp=O.AS_OF), ["products_regrouped"]))
def q_moved_products_reach_categories(spark, sf_dir):
    """I3 from the change log: a sixth of the products moves to a new category in a second load."""
    w = Warehouse(spark, sf_dir)
    job = jobs.Job(spark, _scratch(spark, "moved-products"), as_of=AS_OF)
    raw, moved = w.raw("ecommerce_products"), F.col("id") % 6 == 1
    job.land("ecommerce_products", raw)
    job.refresh_dwd("ecommerce_products")
    job.refresh_dws("dws_ecommerce_category_daily")
    job.land("ecommerce_products", raw.where(moved).withColumns({
        "category": F.lit("second hand "), "_ingested_at": F.lit(LATE_LOAD).cast("timestamp_ntz")}))
    job.refresh_dwd("ecommerce_products")
    return job.refresh_dws("dws_ecommerce_category_daily")


# =====================================================================================
# Joins, windows, aggregates, scalar functions
# =====================================================================================

@register("anti_join_orphans", O.sql("""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM dwd_business_order_items i
        WHERE i.order_id IS NOT NULL
          AND i.order_id NOT IN (SELECT order_id FROM dwd_business_orders WHERE order_id % 11 <> 0)) AS orphan_items,
       (SELECT CAST(count(*) AS BIGINT) FROM dwd_business_orders o
        WHERE o.customer_id IS NOT NULL
          AND o.customer_id NOT IN (SELECT customer_id FROM dwd_business_customers WHERE customer_id % 7 <> 0)) AS orphan_orders""",
    ["dwd_business_order_items", "dwd_business_orders", "dwd_business_customers"]))
def q_anti_join_orphans(spark, sf_dir):
    """Referential integrity of items to orders and orders to customers, with parents taken out."""
    w = Warehouse(spark, sf_dir)
    items, orders = w.dwd("business_order_items"), w.dwd("business_orders")
    customers = w.dwd("business_customers").where(F.col("customer_id") % 7 != 0)
    orders, all_orders = orders.where(F.col("order_id") % 11 != 0), orders
    a = orphans(items, orders, "order_id").agg(F.count(F.lit(1)).cast("long").alias("orphan_items"))
    b = orphans(all_orders, customers, "customer_id").agg(F.count(F.lit(1)).cast("long").alias("orphan_orders"))
    return attach_one_row(a, b)


@register("cross_join_totals", O.sql(f"""
SELECT order_date_key, daily_revenue,
       {O.r2('daily_revenue / nullif(t.total, 0) * 100', 3)} AS revenue_share_pct
FROM daily_trend CROSS JOIN (SELECT {O.exact_sum('daily_revenue')} AS total FROM daily_trend) t""", ["daily_trend"]))
def q_cross_join_totals(spark, sf_dir):
    """J3 + F7 + F15: every day against the one-row grand total."""
    w = Warehouse(spark, sf_dir)
    daily = ads.daily_revenue(w.dws_order_daily_summary())
    total = daily.agg(X.exact_sum("daily_revenue").alias("_total"))
    return attach_one_row(daily, total).select(
        "order_date_key", "daily_revenue", X.share_pct("daily_revenue", "_total", 3).alias("revenue_share_pct")
    )


@register("latest_row_attach", O.sql("""
SELECT c.customer_id, c.total_revenue, dt.order_date_key AS latest_trade_date, dt.daily_revenue AS latest_daily_revenue
FROM dws_customer_order_summary c
LEFT JOIN daily_trend dt ON dt.order_date_key = (SELECT max(order_date_key) FROM daily_trend)""",
    ["dws_customer_order_summary", "daily_trend"]))
def q_latest_row_attach(spark, sf_dir):
    """The latest day's row attached to every customer row."""
    w = Warehouse(spark, sf_dir)
    trend = ads.daily_trend(w.dws_order_daily_summary()).select(
        F.col("order_date_key").alias("latest_trade_date"), F.col("daily_revenue").alias("latest_daily_revenue")
    )
    cust = w.dws_customer_order_summary().select("customer_id", "total_revenue")
    return attach_latest(cust, trend, "latest_trade_date")


@register("rank_ties_topk", O.sql("""
SELECT customer_id, total_orders, loyalty_rank FROM (
  SELECT customer_id, total_orders,
         CAST(rank() OVER (ORDER BY total_orders DESC NULLS FIRST) AS BIGINT) AS loyalty_rank
  FROM dws_customer_order_summary) WHERE loyalty_rank <= 10""", ["dws_customer_order_summary"]))
def q_rank_ties_topk(spark, sf_dir):
    """W1 + T2: top-10 customers by order count, all ties kept."""
    w = Warehouse(spark, sf_dir)
    cust = w.dws_customer_order_summary().select("customer_id", "total_orders")
    return top_k_rank(cust, "total_orders", "loyalty_rank", 10)


@register("rank_global_distributed", O.sql("""
SELECT customer_id, avg_order_value,
       CAST(rank() OVER (ORDER BY avg_order_value DESC NULLS FIRST) AS BIGINT) AS avg_value_rank
FROM dws_customer_order_summary""", ["dws_customer_order_summary"]))
def q_rank_global_distributed(spark, sf_dir):
    """W1 over every customer without a single-task window (distributed prefix-sum rank)."""
    w = Warehouse(spark, sf_dir)
    cust = w.dws_customer_order_summary().select("customer_id", "avg_order_value")
    return global_rank(cust, "avg_order_value", "avg_value_rank")


@register("lag_dod_wow", O.sql(f"""
SELECT *, CASE WHEN prev_day_count > 0 THEN {O.r2('100.0 * (event_count - prev_day_count) / prev_day_count')} END AS day_over_day_pct,
       CASE WHEN week_ago_count > 0 THEN {O.r2('100.0 * (event_count - week_ago_count) / week_ago_count')} END AS week_over_week_pct
FROM (SELECT event_date, event_type, event_count, lag(event_count) OVER days AS prev_day_count,
             lag(event_count, 7) OVER days AS week_ago_count
      FROM dws_github_daily_activity WINDOW days AS (PARTITION BY event_type ORDER BY event_date))""", ["dws_github_daily_activity"]))
def q_lag_dod_wow(spark, sf_dir):
    """W3 + F14: LAG 1 and 7 within each event type over all days, percent changes."""
    w = Warehouse(spark, sf_dir)
    d = w.dws_github_daily_activity().select("event_date", "event_type", "event_count")
    by_type = Window.partitionBy("event_type").orderBy("event_date")
    d = d.withColumn("prev_day_count", F.lag("event_count", 1).over(by_type)).withColumn(
        "week_ago_count", F.lag("event_count", 7).over(by_type))
    return d.select(
        "event_date", "event_type", "event_count", "prev_day_count", "week_ago_count",
        X.pct_change("event_count", "prev_day_count").alias("day_over_day_pct"),
        X.pct_change("event_count", "week_ago_count").alias("week_over_week_pct"),
    )


@register("listagg_distinct", """
SELECT CAST(ts AS DATE) AS event_day, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
FROM events GROUP BY 1""")
def q_listagg_distinct(spark, sf_dir):
    """Ordered distinct string aggregation per day."""
    e = read_table(spark, sf_dir, "events")
    return e.groupBy(F.col("ts").cast("date").alias("event_day")).agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("event_types")
    )


@register("filter_counts", O.sql("""
SELECT upper(trim(type)) AS event_type,
       count(*) FILTER (WHERE is_public) AS public_events,
       count(*) FILTER (WHERE NOT is_public) AS private_events,
       count(*) AS all_events
FROM raw_github_events GROUP BY 1""", ["raw_github_events"]))
def q_filter_counts(spark, sf_dir):
    """A4: conditional counts; a null flag counts in neither branch."""
    w = Warehouse(spark, sf_dir)
    r = w.raw("github_events")
    return r.groupBy(F.upper(F.trim("type")).alias("event_type")).agg(
        F.count_if(F.col("is_public")).alias("public_events"),
        F.count_if(~F.col("is_public")).alias("private_events"),
        F.count(F.lit(1)).alias("all_events"),
    )


@register("reaggregate_daily", O.sql(
    "SELECT order_date_key, daily_revenue, daily_orders, daily_avg_order_value FROM daily_trend", ["daily_trend"]))
def q_reaggregate_daily(spark, sf_dir):
    """(day, status) summary re-aggregated per day; average of averages kept."""
    return ads.daily_revenue(Warehouse(spark, sf_dir).dws_order_daily_summary())


@register("global_totals", O.sql("""
SELECT CAST(sum(card_orders) AS BIGINT) AS total_card_orders, CAST(sum(ewallet_orders) AS BIGINT) AS total_ewallet_orders,
       CAST(sum(bank_transfer_orders) AS BIGINT) AS total_bank_transfer_orders,
       coalesce(max(order_date_key), TIMESTAMP '1970-01-01 00:00:00') AS max_order_date_key
FROM dws_order_daily_summary""", ["dws_order_daily_summary"]))
def q_global_totals(spark, sf_dir):
    """A10 + A11: one-row totals and a max with an epoch default."""
    d = Warehouse(spark, sf_dir).dws_order_daily_summary()
    return d.agg(
        F.sum("card_orders").cast("long").alias("total_card_orders"),
        F.sum("ewallet_orders").cast("long").alias("total_ewallet_orders"),
        F.sum("bank_transfer_orders").cast("long").alias("total_bank_transfer_orders"),
        F.coalesce(F.max("order_date_key"), F.lit(X.EPOCH).cast("timestamp_ntz")).alias("max_order_date_key"),
    )


@register("rows_by_source", O.sql("""
SELECT source_system, CAST(count(*) AS BIGINT) AS row_count FROM (
  SELECT source_system FROM ods_github_events UNION ALL SELECT source_system FROM ods_weather_forecast
  UNION ALL SELECT source_system FROM ods_ecommerce_products UNION ALL SELECT source_system FROM ods_business_customers
  UNION ALL SELECT source_system FROM ods_business_orders UNION ALL SELECT source_system FROM ods_business_order_items)
GROUP BY 1""", [f"ods_{d}" for d in CUTS]))
def q_rows_by_source(spark, sf_dir):
    """Row count by source system over all ODS tables."""
    w = Warehouse(spark, sf_dir)
    return monitor.rows_by_source([w.ods(d) for d in CUTS])


@register("first_match_replace", r"""
SELECT c_custkey, c_name, regexp_replace(c_name, '0', '') AS first_zero_removed,
       regexp_replace(c_name, '0', '', 'g') AS all_zeros_removed
FROM customer""")
def q_first_match_replace(spark, sf_dir):
    """PostgreSQL-style first-match replace next to Spark's replace-all."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", "c_name",
        X.first_match_replace("c_name", "0", "").alias("first_zero_removed"),
        F.regexp_replace("c_name", "0", "").alias("all_zeros_removed"),
    )


@register("split_part_like", O.sql("""
SELECT id AS event_id, repo_name, repo_name LIKE '%/%' AS has_slash,
       split_part(repo_name, '/', 1) AS repo_owner, split_part(repo_name, '/', 2) AS repo_name_short,
       split_part(repo_name, '/', 3) AS third_part
FROM raw_github_events""", ["raw_github_events"]))
def q_split_part_like(spark, sf_dir):
    """F4 + P5: split parts (missing part is '') and the ``LIKE '%/%'`` test."""
    r = Warehouse(spark, sf_dir).raw("github_events")
    sp = lambda n: F.split_part(F.col("repo_name"), F.lit("/"), F.lit(n))
    return r.select(
        F.col("id").alias("event_id"), "repo_name", F.col("repo_name").like("%/%").alias("has_slash"),
        sp(1).alias("repo_owner"), sp(2).alias("repo_name_short"), sp(3).alias("third_part"),
    )


@register("elapsed_days", """
SELECT o_custkey AS customer_id, CAST(extract(day FROM (max(o_orderdate) - min(o_orderdate))) AS BIGINT) AS lifespan_days,
       CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS BIGINT) AS midnights_crossed
FROM orders GROUP BY 1""")
def q_elapsed_days(spark, sf_dir):
    """whole elapsed days of an interval, next to the count of midnights crossed."""
    o = read_table(spark, sf_dir, "orders")
    g = o.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.max("o_orderdate").alias("_last"), F.min("o_orderdate").alias("_first"))
    return g.select(
        "customer_id",
        X.elapsed_days("_last", "_first").alias("lifespan_days"),
        F.datediff(F.col("_last").cast("date"), F.col("_first").cast("date")).cast("long").alias("midnights_crossed"),
    )


@register("number_to_text", r"""
SELECT DISTINCT CAST(event_id % 450 AS DOUBLE) / 10.0 AS temperature,
       regexp_replace(CAST(CAST(event_id % 450 AS DOUBLE) / 10.0 AS VARCHAR), '\.0$', '') AS temperature_text
FROM events""")
def q_number_to_text(spark, sf_dir):
    """doubles printed as PostgreSQL prints them (38 for 38.0)."""
    e = read_table(spark, sf_dir, "events")
    t = ((F.col("event_id") % 450).cast("double") / F.lit(10.0)).alias("temperature")
    return e.select(t).distinct().select("temperature", X.number_to_text("temperature").alias("temperature_text"))


# =====================================================================================
# Quality checks, freshness, summaries, drift
# =====================================================================================

def check_sql(model: str, c: quality.Check) -> str:
    col = c.column
    if c.kind == "unique":
        return (f"SELECT '{c.label}' AS test_name, '{model}' AS model, '{col}' AS column_name, "
                f"'{c.severity}' AS severity, CAST(count(*) AS BIGINT) AS failures FROM "
                f"(SELECT {col} FROM {model} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")
    if c.kind == "not_null":
        cnt = f"count(*) FILTER (WHERE {col} IS NULL)"
    elif c.kind == "reasonable_range":
        cnt = f"count(*) FILTER (WHERE {col} IS NOT NULL AND ({col} < {c.lo} OR {col} > {c.hi}))"
    elif c.kind == "not_null_multicol":
        joiner = " AND " if c.mode == "all" else " OR "
        cnt = f"count(*) FILTER (WHERE {joiner.join(f'{x} IS NULL' for x in c.columns)})"
    elif c.kind == "assert_rows":
        cnt = f"count(*) FILTER (WHERE coalesce({c.predicate}, false))"
    elif c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.values)
        cnt = f"count(DISTINCT {col}) FILTER (WHERE {col} NOT IN ({vals}))"
    else:
        raise ValueError(c.kind)
    return (f"SELECT '{c.label}' AS test_name, '{model}' AS model, '{col}' AS column_name, "
            f"'{c.severity}' AS severity, CAST({cnt} AS BIGINT) AS failures FROM {model}")


def suite_sql(suite: dict) -> str:
    parts = [check_sql(m, c) for m, checks in suite.items() for c in checks]
    return ("SELECT test_name, model, column_name, severity, failures, "
            "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status, "
            "concat_ws('.', 'test', 'strata', model, concat(test_name, '__', column_name)) AS unique_id, "
            "concat('Got ', CAST(failures AS VARCHAR), ' results, configured to fail if != 0') AS message FROM ("
            + " UNION ALL ".join(parts) + ")")


# Rows as they look before cleaning: made from the given tables, with faults that the checks must count.
_ITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
DIRTY_SQL = {
    "dirty_events": """
SELECT CASE WHEN event_id % 29 = 0 THEN '' WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN event_id % 37 = 0 THEN NULL ELSE event_type END AS event_type FROM events""",
    "dirty_orders": """
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       CASE WHEN o_orderkey % 19 = 0 THEN 'lost' WHEN o_orderkey % 21 = 0 THEN 'unknown' ELSE 'completed' END AS order_status,
       CASE WHEN o_orderkey % 23 = 0 THEN -150.0 WHEN o_orderkey % 29 = 0 THEN 2000.0 ELSE 5.0 END AS change_pct,
       CASE WHEN o_orderkey % 17 = 0 THEN -1 ELSE 1 END AS line_count FROM orders""",
    "dirty_items": "SELECT " + ", ".join(
        f"CASE WHEN l_orderkey % {k} = 0 THEN NULL ELSE {c} END AS {c}" for k, c in enumerate(_ITEM_COLUMNS, 3)
    ) + " FROM lineitem",
}
for _name, _body in DIRTY_SQL.items():
    O.rel(_name, _body)


def _dirty(spark, sf_dir, name: str) -> DataFrame:
    if name == "dirty_events":
        e, key = read_table(spark, sf_dir, "events"), F.col("event_id")
        return e.select(
            F.when(key % 29 == 0, F.lit("")).when(key % 31 != 0, key.cast("string")).alias("event_id"),
            F.when(key % 37 != 0, F.col("event_type")).alias("event_type"),
        )
    if name == "dirty_orders":
        o, key = read_table(spark, sf_dir, "orders"), F.col("o_orderkey")
        return o.select(
            key.alias("order_id"), F.when(key % 13 != 0, F.col("o_custkey")).alias("customer_id"),
            F.when(key % 19 == 0, F.lit("lost")).when(key % 21 == 0, F.lit("unknown")).otherwise(F.lit("completed"))
            .alias("order_status"),
            F.when(key % 23 == 0, F.lit(-150.0)).when(key % 29 == 0, F.lit(2000.0)).otherwise(F.lit(5.0)).alias("change_pct"),
            F.when(key % 17 == 0, F.lit(-1)).otherwise(F.lit(1)).alias("line_count"),
        )
    i = read_table(spark, sf_dir, "lineitem")
    return i.select(*[F.when(F.col("l_orderkey") % k != 0, F.col(c)).alias(c) for k, c in enumerate(_ITEM_COLUMNS, 3)])


# The rule values stand here as literals of their own.
DIRTY_SUITE = {
    "dirty_events": [quality.assert_rows("no_empty", "event_id IS NULL OR event_id = '' OR event_type IS NULL OR event_type = ''"),
                     quality.unique("event_id")],
    "dirty_orders": [quality.not_null("customer_id"),
                     quality.accepted_values("order_status", ["completed", "processing", "cancelled", "refunded"]),
                     quality.reasonable_range("change_pct", -100, 1000),
                     quality.assert_rows("positive_counts", "line_count < 0")],
    "dirty_items": [c for x in _ITEM_COLUMNS for c in (quality.not_null(x), quality.unique(x))],
}


def _frame(spark, sf_dir, w: Warehouse, name: str) -> DataFrame:
    return _dirty(spark, sf_dir, name) if name in DIRTY_SQL else w.model(name)


def _select(suite: dict, kinds: set[str]) -> dict:
    out = {m: [c for c in checks if c.kind in kinds] for m, checks in suite.items()}
    return {m: cs for m, cs in out.items() if cs}


def _suite_query(suite: dict):
    def run(spark, sf_dir):
        w = Warehouse(spark, sf_dir)
        return quality.run_suite({m: _frame(spark, sf_dir, w, m) for m in suite}, suite)
    return run


_LAYERS = {**S.ODS_SUITE, **S.DWD_SUITE}
DQ = {
    "dq_not_null": _select({**S.DWD_SUITE, **DIRTY_SUITE}, {"not_null"}),
    "dq_unique": _select(_LAYERS, {"unique"}),
    "dq_accepted_values": _select({**S.DWD_SUITE, **S.ADS_SUITE}, {"accepted_values"}),
    "dq_range": _select({**S.ADS_SUITE, **DIRTY_SUITE}, {"reasonable_range"}),
    "dq_multicol": {"ods_business_orders": [S.ORDERS_MULTICOL]},
    "dq_positive": {**_select(S.DWS_SUITE, {"assert_rows"}), "dirty_orders": [DIRTY_SUITE["dirty_orders"][-1]]},
    "dq_no_empty": {"ods_github_events": [S.ODS_NO_EMPTY], "dirty_events": [DIRTY_SUITE["dirty_events"][0]]},
    "dq_raw_sources": S.RAW_SUITE,
}
for _name, _suite in DQ.items():
    register(_name, O.sql(suite_sql(_suite), list(_suite)))(_suite_query(_suite))

O.rel("full_suite", suite_sql(S.FULL_SUITE), list(S.FULL_SUITE))


def _full_results(spark, sf_dir) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    return quality.run_suite({m: w.model(m) for m in S.FULL_SUITE}, S.FULL_SUITE)


_REPORTED = {**S.DWD_SUITE, **DIRTY_SUITE}
O.rel("reported_suite", suite_sql(_REPORTED), list(_REPORTED))


@register("dq_suite_summary", O.sql("""
SELECT CAST(count(*) FILTER (WHERE status = 'pass') AS BIGINT) AS pass_count,
       CAST(count(*) FILTER (WHERE status = 'fail') AS BIGINT) AS fail_count,
       CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS error_count,
       CAST(count(*) FILTER (WHERE status = 'warn') AS BIGINT) AS warn_count,
       CAST(count(*) AS BIGINT) AS total,
       CASE WHEN count(*) FILTER (WHERE status IN ('fail', 'error')) > 0 THEN 'FAILED' ELSE 'PASSED' END AS overall_status
FROM full_suite""", ["full_suite"]))
def q_dq_suite_summary(spark, sf_dir):
    """Counts by status over the whole declared suite."""
    return report.summarize(_full_results(spark, sf_dir))


@register("dq_failures_top20", O.sql(r"""
SELECT test, model, column_name, message, CAST(greatest(n - 20, 0) AS BIGINT) AS more_failures FROM (
  SELECT unique_id,
         string_split(unique_id, '.')[-1] AS test,
         CASE WHEN len(string_split(unique_id, '.')) > 2 THEN string_split(unique_id, '.')[-2] ELSE unique_id END AS model,
         coalesce(column_name, '-') AS column_name,
         replace(replace(substring(coalesce(message, ''), 1, 80), chr(10), ' '), '|', '\|') AS message,
         count(*) OVER () AS n
  FROM reported_suite WHERE status IN ('fail', 'error'))
ORDER BY unique_id LIMIT 20""", ["reported_suite"]))
def q_dq_failures_top20(spark, sf_dir):
    """T4 + F20 + F21: the capped failure table, over the clean models and the uncleaned inputs."""
    return report.failure_report(_suite_query(_REPORTED)(spark, sf_dir), 20)


_FRESH_PARTS = " UNION ALL ".join(
    f"SELECT '{d}' AS source, max(_ingested_at) AS max_loaded_at, {float(wh)} AS wh, {float(eh)} AS eh FROM ods_{d}"
    for d, (wh, eh) in S.FRESHNESS_HOURS.items()
)
_AGE = f"(CAST(epoch_us({_sql_ts(FRESHNESS_AS_OF)}) - epoch_us(max_loaded_at) AS DOUBLE) / 3.6e9)"
O.rel("freshness", f"""
SELECT source, max_loaded_at, {O.r2(_AGE)} AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN {_AGE} > eh THEN 'error' WHEN {_AGE} > wh THEN 'warn'
            ELSE 'pass' END AS status
FROM ({_FRESH_PARTS})""", [f"ods_{d}" for d in S.FRESHNESS_HOURS])


def _freshness(spark, sf_dir) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    return quality.freshness({d: w.ods(d) for d in S.FRESHNESS_HOURS}, S.FRESHNESS_HOURS, FRESHNESS_AS_OF)


@register("dq_freshness", O.sql("freshness"))
def q_dq_freshness(spark, sf_dir):
    """Q8: source freshness against warn / error hours at a fixed clock."""
    return _freshness(spark, sf_dir)


@register("dq_freshness_log", O.sql("""
SELECT source, status, concat('FRESHNESS ', upper(status), ': ', source, ' - loaded_at: ',
       coalesce(strftime(max_loaded_at, '%Y-%m-%d %H:%M:%S'), 'never')) AS line
FROM freshness WHERE status IN ('warn', 'error')""", ["freshness"]))
def q_dq_freshness_log(spark, sf_dir):
    """Q13: log lines for warn and error sources."""
    return quality.freshness_log(_freshness(spark, sf_dir))


# --- Q10 / I8: counts, snapshot upsert and drift ---------------------------------------
_COUNTED = [("ods", f"ods_{d}") for d in CUTS] + [("dwd", f"dwd_{d}") for d in CUTS]


def _counts_sql(suffix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS schema_name, '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count "
        f"FROM {name}{suffix}" for layer, name in _COUNTED
    )


O.rel("counts_today", _counts_sql(""), [n for _, n in _COUNTED])
O.rel("counts_yesterday", _counts_sql("_first"),
      [f"ods_{d}_first" for d in CUTS] + [f"dwd_{d}_first" for d in CUTS])


def _counts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(today's, yesterday's) row counts of the ODS and DWD tables, each domain counted in one pass.

    A DWD table has a row for every key with a valid row, so it is counted from
    its keys, without building it; yesterday's are the keys loaded up to the cut.
    """
    w = Warehouse(spark, sf_dir)
    out = None
    for d, cut in CUTS.items():
        before = F.col("_ingested_at") <= F.lit(cut).cast("timestamp_ntz")
        ods_rows = w.ods(d).agg(F.count(F.lit(1)).alias("today"), F.count_if(before).alias("yesterday"))
        keys = dwd.valid_keys(d, w.ods(d)).groupBy("key").agg(F.bool_or(before).alias("early"))
        dwd_rows = keys.agg(F.count(F.lit(1)).alias("today"), F.count_if("early").alias("yesterday"))
        for layer, part in (("ods", ods_rows), ("dwd", dwd_rows)):
            part = part.select(F.lit(layer).alias("schema_name"), F.lit(f"{layer}_{d}").alias("table_name"), "today", "yesterday")
            out = part if out is None else out.unionByName(part)
    rows = out.collect()  # one row per table
    frame = lambda c: spark.createDataFrame(
        [(r["schema_name"], r["table_name"], r[c]) for r in rows], "schema_name string, table_name string, row_count long")
    return frame("today"), frame("yesterday")


_DAY = f"DATE '{SNAPSHOT_DAY:%Y-%m-%d}'"
_PREV = f"DATE '{SNAPSHOT_DAY - _dt.timedelta(days=1):%Y-%m-%d}'"


@register("snapshot_upsert", O.sql(f"""
SELECT {_PREV} AS snapshot_date, schema_name, table_name, row_count FROM counts_yesterday
UNION ALL SELECT {_DAY} AS snapshot_date, schema_name, table_name, row_count FROM counts_today""",
    ["counts_yesterday", "counts_today"]))
def q_snapshot_upsert(spark, sf_dir):
    """I8: today's counts replace a stale same-day snapshot; yesterday's rows stay."""
    today, yesterday = _counts(spark, sf_dir)
    snap = monitor.as_snapshot(yesterday, SNAPSHOT_DAY - _dt.timedelta(days=1)).unionByName(
        monitor.as_snapshot(yesterday, SNAPSHOT_DAY))  # stale values for today, to be replaced
    return monitor.snapshot_upsert(snap, today, SNAPSHOT_DAY)


@register("row_count_drift", O.sql(f"""
SELECT t.schema_name, t.table_name, y.row_count AS yesterday_count, t.row_count AS today_count,
       {O.r2('CASE WHEN y.row_count = 0 THEN (CASE WHEN t.row_count > 0 THEN 100.0 ELSE 0.0 END) '
             'ELSE abs(CAST(t.row_count AS DOUBLE) - y.row_count) / y.row_count * 100 END', 1)} AS change_pct,
       CASE WHEN t.row_count > y.row_count THEN '+' ELSE '-' END AS direction,
       true AS alert
FROM counts_today t JOIN counts_yesterday y USING (schema_name, table_name)
WHERE CASE WHEN y.row_count = 0 THEN (CASE WHEN t.row_count > 0 THEN 100.0 ELSE 0.0 END)
           ELSE abs(CAST(t.row_count AS DOUBLE) - y.row_count) / y.row_count * 100 END > 30.0""",
    ["counts_today", "counts_yesterday"]))
def q_row_count_drift(spark, sf_dir):
    """Q10: tables that moved more than 30 percent since yesterday's snapshot."""
    today, yesterday = _counts(spark, sf_dir)
    before = monitor.as_snapshot(yesterday, SNAPSHOT_DAY - _dt.timedelta(days=1))
    return monitor.row_count_drift(today, before, SNAPSHOT_DAY)


O.rel("events_trending_first", O.trending("dws_github_daily_activity_first"), ["dws_github_daily_activity_first"])
_EVENT_TABLES = {"ods_github_events": "ods_github_events_first", "dwd_github_events": "dwd_github_events_first",
                 "dws_github_daily_activity": "dws_github_daily_activity_first", "ads_github_trending": "events_trending_first"}


@register("drift_from_record", O.sql(
    "SELECT schema_name, table_name, yesterday_count, today_count, " + O.r2("pct", 1) + " AS change_pct, "
    "CASE WHEN today_count > yesterday_count THEN '+' ELSE '-' END AS direction, pct > 30.0 AS alert FROM ("
    "SELECT *, CASE WHEN yesterday_count > 0 THEN abs(today_count - yesterday_count) * 100.0 / yesterday_count "
    "WHEN today_count > 0 THEN 100.0 ELSE 0.0 END AS pct FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t[:3]}' AS schema_name, '{t}' AS table_name, (SELECT CAST(count(*) AS BIGINT) FROM {first}) AS yesterday_count, "
        f"(SELECT CAST(count(*) AS BIGINT) FROM {t}) AS today_count" for t, first in _EVENT_TABLES.items()) + "))",
    [*_EVENT_TABLES, *_EVENT_TABLES.values()]))
def q_drift_from_record(spark, sf_dir):
    """A12 + Q10 + I8 on stored tables: the events of two loads go through all layers; counts and drift come
    from what the writes recorded, no table is read for them."""
    w = Warehouse(spark, sf_dir)
    job = jobs.Job(spark, _scratch(spark, "drift"), as_of=AS_OF, seed=w.seed(), today=TRENDS_TODAY)
    raw, early = w.raw("github_events"), F.col("_ingested_at") <= F.lit(CUTS["github_events"]).cast("timestamp_ntz")
    out = None
    for day, load in ((TRENDS_TODAY, early), (TRENDS_TODAY + _dt.timedelta(days=1), ~early)):
        job.land("github_events", raw.where(load))
        job.refresh_dwd("github_events")
        job.refresh_dws("dws_github_daily_activity")
        job.refresh_ads("ads_github_trending")
        counts = job.counts()
        out = counts if out is None else monitor.row_count_drift(counts, monitor.as_snapshot(out, TRENDS_TODAY), day, alerts_only=False)
    return out


@register("weekly_actors_from_sketches", O.sql("""
SELECT CAST(date_trunc('week', event_date) AS TIMESTAMP) AS week, event_type, count(DISTINCT actor_id) AS unique_actors,
       count(*) AS event_count, true AS within_bound
FROM dwd_github_events GROUP BY 1, 2""", ["dwd_github_events"]))
def q_weekly_actors_from_sketches(spark, sf_dir):
    """A3 approximate + A9: distinct actors per week and type, merged from daily sketches without the
    events; held against the exact counts and the stated bound."""
    events = Warehouse(spark, sf_dir).dwd("github_events")
    daily = sketches.daily_sketches(events, ["event_date", "event_type"], ["actor_id"])
    week = F.date_trunc("week", F.col("event_date").cast("timestamp")).cast("timestamp_ntz").alias("week")
    weekly = sketches.merge_sketches(daily.withColumn("week", week), ["week", "event_type"], ["actor_id"])
    exact = events.groupBy(week, "event_type").agg(F.countDistinct("actor_id").alias("unique_actors"))
    bound = F.abs(F.col("approx_actor_id") - F.col("unique_actors")) <= sketches.error_bound() * F.col("unique_actors") + 0.5
    return weekly.join(exact, ["week", "event_type"]).select("week", "event_type", "unique_actors", "event_count", bound.alias("within_bound"))
