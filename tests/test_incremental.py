"""Upsert, watermark and schema alignment (I1-I9) plus properties."""

import datetime as dt
import os

import pytest

from strata.operators.incremental import align, newer_than, upsert
from strata.plans import dwd, ods
from strata.plans.catalog import Warehouse
from conftest import SF001

T0 = dt.datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_kept_added_replaced(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k long, v string")
    incoming = spark.createDataFrame([(2, "new"), (3, "new")], "k long, v string")
    assert rows(upsert(target, incoming, ["k"]), "k", "v") == [(1, "old"), (2, "new"), (3, "new")]


def test_upsert_coarse_key_replaces_whole_group(spark):
    target = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 2), ("d2", "a", 3)], "d string, s string, n long")
    incoming = spark.createDataFrame([("d1", "a", 9)], "d string, s string, n long")
    assert rows(upsert(target, incoming, ["d"]), "d", "s", "n") == [("d1", "a", 9), ("d2", "a", 3)]


def test_upsert_first_run_and_idempotent(spark):
    incoming = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    once = upsert(None, incoming, ["k"])
    twice = upsert(once, incoming, ["k"])
    assert rows(once, "k", "v") == rows(twice, "k", "v") == [(1, "a"), (2, "b")]


def test_watermark_strict_inclusive_empty(spark):
    src = spark.createDataFrame([(T0,), (T0 + dt.timedelta(hours=1),)], "t timestamp_ntz")
    target = spark.createDataFrame([(T0,)], "t timestamp_ntz")
    assert newer_than(src, target, "t").count() == 1
    assert newer_than(src, target, "t", inclusive=True).count() == 2
    assert newer_than(src, target.limit(0), "t").count() == 2
    assert newer_than(src, None, "t").count() == 2
    assert newer_than(src, target, "t", lookback=dt.timedelta(hours=1)).count() == 2


def test_align_policies(spark):
    t = spark.createDataFrame([(1, "x")], "k long, old string")
    i = spark.createDataFrame([(2, 5)], "k long, new int")
    a, b = align(t, i, "append_new_columns")
    assert a.columns == b.columns == ["k", "old", "new"]
    a, b = align(t, i, "sync_all_columns")
    assert a.columns == b.columns == ["k", "new"]
    with pytest.raises(ValueError):
        align(t, i, "fail")
    assert upsert(t, i, ["k"], policy="append_new_columns").count() == 2


def test_incremental_equals_full_build(spark):
    w = Warehouse(spark, SF001)
    o = w.ods("business_orders")
    cut = dt.datetime(1998, 1, 1)
    first = dwd.dwd_business_orders(o.where(o._ingested_at <= cut), as_of=T0)
    inc = dwd.dwd_business_orders(o, as_of=T0, target=first)
    full = dwd.dwd_business_orders(o, as_of=T0)
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_dedup_leaves_unique_keys(spark):
    w = Warehouse(spark, SF001)
    items = w.dwd("business_order_items")
    assert items.count() == items.select("item_id").distinct().count()
    assert w.ods("business_order_items").count() > items.count()


def test_failed_write_keeps_last_good_version(spark, scratch):
    """A version counts only once it is complete; a failing job leaves the old version readable."""
    from pyspark.sql import functions as F

    from strata.sources.ingest import read_current, table_root, write_table

    base = os.path.join(scratch, "wh")
    good = spark.createDataFrame([(1, "a")], "k long, v string")
    write_table(good, base, "ads", "t")
    bad = spark.createDataFrame([(2, "not a number")], "k long, v string").select(
        "k", F.col("v").cast("int").alias("v"))          # ANSI cast fails inside the job
    with pytest.raises(Exception):
        write_table(bad, base, "ads", "t")
    assert [tuple(r) for r in read_current(spark, table_root(base, "ads", "t")).collect()] == [(1, "a")]


def test_partition_upsert_schema_change(spark, scratch):
    """I6 on disk: a batch with a new column; untouched partitions read it as null."""
    from strata.sources.ingest import read_partitioned, upsert_partitions

    base = os.path.join(scratch, "wh")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = spark.createDataFrame([(1, "a", d1), (2, "b", d2)], "k long, v string, p date")
    upsert_partitions(None, first, ["k"], base, "dwd", "t", "p")
    target = read_partitioned(spark, base, "dwd", "t", "p")
    batch = spark.createDataFrame([(2, "B", 7, d2)], "k long, v string, extra int, p date")
    upsert_partitions(target, batch, ["k"], base, "dwd", "t", "p", policy="append_new_columns")
    out = read_partitioned(spark, base, "dwd", "t", "p")
    assert out.columns == ["k", "v", "p", "extra"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", d1, None), (2, "B", d2, 7)]
