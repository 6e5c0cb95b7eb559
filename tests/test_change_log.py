"""Raw by load period, reads after a watermark, and groups rebuilt from the change log."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from strata.operators.incremental import LITERAL_GROUPS, rebuild_groups, split_groups
from strata.plans import dws, jobs
from strata.plans.catalog import Warehouse
from strata.sources import adapters, changes
from strata.sources.ingest import read_partitioned, upsert_partitions
from strata.sources.raw import append_loads, read_loads

AS_OF = dt.datetime(2024, 1, 31)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_ten_loads_open_only_those_since_the_mark(spark, scratch):
    path = os.path.join(scratch, "raw")
    for day in range(1, 11):
        append_loads(spark.range(20).select(F.col("id"), _ntz(f"2024-03-{day:02d} 06:00:00").alias("_ingested_at")), path)
    assert len(glob.glob(f"{path}/_load_day=*")) == 10
    late = read_loads(spark, path, dt.datetime(2024, 3, 8, 7, 0))
    plan = _plan(late)
    assert re.search(r"PartitionFilters: \[.*_load_day.*2024-03-08", plan)
    assert re.search(r"PushedFilters: \[.*GreaterThan\(_ingested_at", plan)
    # the first of the month stands for a folder of a whole month
    assert {re.search(r"_load_day=([0-9-]+)", f).group(1) for f in late.inputFiles()} == {"2024-03-01", "2024-03-08", "2024-03-09", "2024-03-10"}
    assert late.select("_ingested_at").distinct().count() == 2 and late.count() == 40
    assert read_loads(spark, path).count() == 200
    assert read_loads(spark, path, dt.datetime(2024, 4, 1)).count() == 0
    assert read_loads(spark, path, dt.datetime(2025, 1, 1)).columns == ["id", "_ingested_at"]


def test_raw_by_month_new_columns_and_missing_load_times(spark, scratch):
    path = os.path.join(scratch, "raw")
    append_loads(spark.createDataFrame([(1, dt.datetime(2024, 1, 31, 23, 0)), (2, None)], "id int, _ingested_at timestamp_ntz"), path, "month")
    append_loads(spark.createDataFrame([(3, dt.datetime(2024, 2, 1, 1, 0), "x")], "id long, _ingested_at timestamp_ntz, note string"), path, "month")
    assert sorted((r["id"], r["note"]) for r in read_loads(spark, path).fillna("").collect()) == [(1, ""), (2, ""), (3, "x")]
    assert dict(read_loads(spark, path).dtypes)["id"] == "int"
    assert [r["id"] for r in read_loads(spark, path, dt.datetime(2024, 1, 15)).orderBy("id").collect()] == [1, 3]
    assert [r["id"] for r in read_loads(spark, path, dt.datetime(2024, 2, 1, 1, 0)).collect()] == []


def test_refresh_opens_only_new_loads(spark, scratch, monkeypatch):
    job = jobs.Job(spark, os.path.join(scratch, "wh"), as_of=AS_OF)
    events = adapters.raw_github_events(spark, SF001)
    cut = dt.datetime(2024, 1, 25)
    job.land("github_events", events.where(F.col("_ingested_at") < F.lit(cut)))
    job.refresh_dwd("github_events")
    job.land("github_events", events.where(F.col("_ingested_at") >= F.lit(cut)))
    seen = []
    real = jobs.read_loads
    monkeypatch.setattr(jobs, "read_loads", lambda *a: seen.append(real(*a)) or seen[-1])
    _same(job.refresh_dwd("github_events"), Warehouse(spark, SF001, as_of=AS_OF).dwd("github_events"))
    days = {re.search(r"_load_day=([0-9-]+)", f).group(1) for f in seen[0].inputFiles()}
    assert min(days - {"2024-01-01"}) >= "2024-01-24" and "PartitionFilters: [" in _plan(seen[0])
    assert not glob.glob(f"{spark.sparkContext.getCheckpointDir()[5:]}/batch-*")  # staged batches are deleted


def _events(spark, rows):
    raw = spark.createDataFrame(
        [(str(i), "PushEvent", f"u{i}", i, "o/r", 1, dt.datetime(2024, 1, day), True, "api", loaded) for i, day, loaded in rows],
        "id string, type string, actor_login string, actor_id long, repo_name string, repo_id long, created_at timestamp_ntz, "
        "is_public boolean, source_system string, _ingested_at timestamp_ntz")
    return raw


@pytest.mark.parametrize("late_rows", [True, False])
def test_late_rows_reach_the_day_summary(spark, scratch, late_rows):
    """30 events, then 7 for an older day: the summary has them; with late_rows=False it lacks them, as the reference does."""
    job = jobs.Job(spark, os.path.join(scratch, "wh"), as_of=AS_OF, late_rows=late_rows)
    t1, t2 = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)
    job.land("github_events", _events(spark, [(i, 1 + i % 3, t1) for i in range(30)]))
    job.refresh_dwd("github_events")
    job.refresh_dws("dws_github_daily_activity")
    job.land("github_events", _events(spark, [(100 + i, 1, t2) for i in range(7)]))
    job.refresh_dwd("github_events")
    got = {r["event_date"].day: r["event_count"] for r in job.refresh_dws("dws_github_daily_activity").collect()}
    assert got == {1: 17 if late_rows else 10, 2: 10, 3: 10}


def test_day_summary_reads_touched_partitions_only(spark, scratch, monkeypatch):
    job = jobs.Job(spark, os.path.join(scratch, "wh"), as_of=AS_OF)
    t1, t2 = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)
    job.land("github_events", _events(spark, [(i, 1 + i % 20, t1) for i in range(60)]))
    job.refresh_dwd("github_events")
    job.refresh_dws("dws_github_daily_activity")
    job.land("github_events", _events(spark, [(100, 4, t2)]))
    job.refresh_dwd("github_events")
    plans = []
    real = jobs.Job._daily
    monkeypatch.setattr(jobs.Job, "_daily", lambda self, name, src, target=None: plans.append(_plan(src)) or real(self, name, src, target))
    job.refresh_dws("dws_github_daily_activity")
    assert re.search(r"PartitionFilters: \[.*_part_date.*= 2024-01-04", plans[0])
    # nothing new: the table is left as it is, and read entries are dropped but the last
    job.written.clear()
    job.refresh_dws("dws_github_daily_activity")
    assert not job.written
    assert changes.entries(spark, job.base, "dwd", "dwd_github_events") == [2]


def test_day_that_lost_its_rows_disappears(spark, scratch):
    """Orders change their day: the day they left goes when it is empty, the others are counted anew."""
    job = jobs.Job(spark, os.path.join(scratch, "wh"), as_of=AS_OF, grain="month")
    orders = adapters.raw_orders(spark, SF001)
    day = F.to_date("order_date")
    first = orders.agg(F.min(day)).first()[0]
    job.land("business_orders", orders)
    job.land("business_customers", adapters.raw_customers(spark, SF001))
    for d in ("business_orders", "business_customers"):
        job.refresh_dwd(d)
    for t in ("dws_order_daily_summary", "dws_customer_order_summary"):
        job.refresh_dws(t)
    moved = orders.where((day == F.lit(first)) | (F.col("order_id") % 40 == 1)).withColumns({
        "order_date": F.col("order_date") + F.expr("INTERVAL 40 DAYS"), "customer_id": F.col("customer_id") % 5 + 1,
        "_ingested_at": _ntz("2024-01-02 00:00:00")})
    job.land("business_orders", moved)
    job.refresh_dwd("business_orders")
    got = job.refresh_dws("dws_order_daily_summary")
    assert got.where(F.to_date("order_date_key") == F.lit(first)).count() == 0
    now = job.current("dwd", "dwd_business_orders")
    _same(got, dws.dws_order_daily_summary(now, as_of=AS_OF))
    people = job.current("dwd", "dwd_business_customers")
    _same(job.refresh_dws("dws_customer_order_summary"), dws.dws_customer_order_summary(now, people, as_of=AS_OF))


def test_upsert_records_old_and_new_groups(spark, scratch):
    base = os.path.join(scratch, "wh")
    rows = lambda data: spark.createDataFrame(data, "k long, g string, p int")
    upsert_partitions(None, rows([(1, "a", 0), (2, "b", 0), (3, None, 0), (4, "d", 0)]), ["k"], base, "dwd", "t", "p", track=["g"])
    target = read_partitioned(spark, base, "dwd", "t", "p")
    upsert_partitions(target.withColumn("p", F.col("p").cast("int")), rows([(1, "c", 0), (3, "b", 0)]), ["k"], base, "dwd", "t", "p", stable=True, track=["g"])
    got = lambda after: {r["g"] for r in changes.read_since(spark, base, "dwd", "t", after, ["g"]).collect()}
    assert got(0) == {"a", "b", "c", "d", None} and got(1) == {"a", "b", "c", None}
    assert changes.read_since(spark, base, "dwd", "t", 2, ["g"]) is None
    changes.forget(spark, base, "dwd", "t", 2)
    assert changes.entries(spark, base, "dwd", "t") == [2] and changes.last_entry(spark, base, "dwd", "t") == 2


def test_log_entry_of_a_run_that_died_is_harmless(spark, scratch):
    """The entry is written before the data; a retry records its groups again."""
    job = jobs.Job(spark, os.path.join(scratch, "wh"), as_of=AS_OF)
    t1 = dt.datetime(2024, 1, 5)
    job.land("github_events", _events(spark, [(i, 1 + i % 3, t1) for i in range(12)]))
    job.refresh_dwd("github_events")
    job.refresh_dws("dws_github_daily_activity")
    lost = spark.createDataFrame([(dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 20),)], "event_date timestamp_ntz")
    changes.record(lost, job.base, "dwd", "dwd_github_events")  # recorded, never committed
    got = {r["event_date"].day: r["event_count"] for r in job.refresh_dws("dws_github_daily_activity").collect()}
    assert got == {1: 4, 2: 4, 3: 4}


@pytest.mark.parametrize("many", [False, True])
def test_groups_by_literals_or_by_join(spark, many):
    n = LITERAL_GROUPS + 50 if many else 5
    src = spark.range(4 * n).select(F.when(F.col("id") % (2 * n) != 7, F.col("id") % (2 * n)).alias("g"), F.lit(1).alias("v"))
    build = lambda f: f.groupBy("g").agg(F.sum("v").alias("n"))
    touched = spark.range(n).select((F.col("id") * 2).alias("g")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    inside, outside = split_groups(src, touched, ["g"])
    assert inside.count() + outside.count() == 4 * n and inside.where("g IS NULL").count() == 2
    stale = build(src).withColumn("n", F.when(F.col("g").isNull() | (F.col("g") % 2 == 0), 99).otherwise(F.col("n")))
    _same(rebuild_groups(src, stale, touched, ["g"], build), build(src))


def test_few_customers_reach_the_scan_as_literals(spark, scratch):
    path = os.path.join(scratch, "orders")
    spark.range(1000).select((F.col("id") % 100).alias("customer_id"), F.col("id").alias("v")).write.parquet(path)
    inside, _ = split_groups(spark.read.parquet(path), spark.createDataFrame([(3,), (4,)], "customer_id long"), ["customer_id"])
    assert "In(customer_id, [3,4])" in _plan(inside) and "Join" not in _plan(inside)
