"""Landing reader (S11), JSON readers, hot-key dedup, and upsert properties."""

import datetime as dt
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from strata.operators.dedup import latest_by_key
from strata.operators.incremental import upsert
from strata.sources.ingest import load_seed, read_landing
from strata.sources.json_records import read_json_columnar, read_json_records
from strata.sources.tables import read_table


def test_read_landing_products_document(spark, scratch):
    """S11 + S2: API documents dropped as files, read with a declared schema, exploded by root key."""
    part = read_table(spark, SF001, "part")
    docs = part.groupBy(F.floor(F.col("p_partkey") / 100).alias("page")).agg(
        F.collect_list(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
                                F.col("p_retailprice").alias("price"))).alias("products"))
    landing = os.path.join(scratch, "landing")
    docs.select("products").write.json(landing)
    element = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
                            T.StructField("price", T.DoubleType())])
    schema = T.StructType([T.StructField("products", T.ArrayType(element))])
    landed = read_landing(spark, landing, schema, multiline=False)
    rows = read_json_records(landed.select(F.to_json(F.struct("products")).alias("doc")), "doc", element,
                             {"product_id": "id", "title": "title", "price": "price"}, root="products")
    want = part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"),
                       F.col("p_retailprice").alias("price"))
    assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0


def test_columnar_unequal_arrays_pad_with_nulls(spark):
    doc = '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5]}}'
    df = spark.createDataFrame([(doc,)], "doc string")
    out = read_json_columnar(df, "doc", "hourly", {"time": ("time", T.StringType()),
                                                   "temperature_2m": ("temperature_2m", T.DoubleType())}).collect()
    assert [(r["time"], r["temperature_2m"]) for r in out] == [("2024-01-01T00:00", 1.5), ("2024-01-01T01:00", None)]


def test_hot_key_dedup(spark):
    """One key holds a third of all rows: the newest row wins, and the plan keeps the partial limit."""
    t0 = dt.datetime(2024, 1, 1)
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.lit(t0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id"))).alias(
            "_ingested_at"),
        F.col("id").alias("v"),
    ).repartition(8)
    out = latest_by_key(df, ["k"])
    hot = out.where("k = 0").collect()
    assert len(hot) == 1 and hot[0]["v"] == 29997
    assert out.count() == df.select("k").distinct().count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


keys = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=8)


@settings(max_examples=12, deadline=None)
@given(target=keys, incoming=keys)
def test_upsert_matches_model(spark, target, incoming):
    """result = target rows whose key is not incoming, plus all incoming rows; idempotent."""
    schema = "k int, v int"
    t = spark.createDataFrame(target, schema)
    i = spark.createDataFrame(incoming, schema)
    got = sorted(tuple(r) for r in upsert(t, i, ["k"]).collect())
    inc_keys = {k for k, _ in incoming}
    want = sorted([r for r in target if r[0] not in inc_keys] + list(incoming))
    assert got == want
    again = sorted(tuple(r) for r in upsert(upsert(t, i, ["k"]), i, ["k"]).collect())
    assert again == want


def test_seed_from_csv_checks_header_and_rows(spark, scratch):
    """RFC 4180 quoting, an empty field is null, a wrong header or a short row raises."""
    def load(name, text):
        path = os.path.join(scratch, name)
        with open(path, "w") as f:
            f.write(text)
        return [tuple(r) for r in load_seed(spark, path).collect()]

    good = 'event_type,category,description\nPushEvent,code,"a, ""quoted"" text\nover two lines"\nForkEvent,,\n'
    assert load("good.csv", good) == [("PushEvent", "code", 'a, "quoted" text\nover two lines'), ("ForkEvent", None, None)]
    for name, text in (("header.csv", "kind,category,description\nA,b,c\n"), ("row.csv", "event_type,category,description\nA,b\n")):
        with pytest.raises(Exception):
            load(name, text)
