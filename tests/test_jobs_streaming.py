"""End-to-end job (L1, L2) and the streaming path."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from strata.plans import jobs
from strata.plans.jobs import PART
from strata.plans.catalog import Warehouse
from strata.sources import adapters
from strata.sources.ingest import read_current, table_root  # noqa: F401
from strata.streaming import events as S

AS_OF = dt.datetime(2024, 1, 31)


def test_run_all_twice_is_stable(spark, scratch):
    base = os.path.join(scratch, "wh")
    r1 = jobs.run_all(spark, SF001, base, as_of=AS_OF, now=dt.datetime(2024, 1, 15), today=dt.date(2024, 1, 30),
                      grain="month")
    assert r1.summary.first()["total"] > 50
    assert r1.messages and r1.messages[0][0].endswith("checks passed")
    job = jobs.Job(spark, base, grain="month")
    orders1 = job.current("dwd", "dwd_business_orders")
    n1 = orders1.count()
    # second run appends the same load again (raw repeats keys); DWD stays one row per key
    r2 = jobs.run_all(spark, SF001, base, as_of=AS_OF, now=dt.datetime(2024, 1, 15), today=dt.date(2024, 1, 31),
                      grain="month")
    orders2 = job.current("dwd", "dwd_business_orders")
    assert orders2.count() == n1
    assert r2.drift is not None
    ods_unique = r2.checks.where("model = 'ods_business_orders' AND test_name = 'unique'").first()
    assert ods_unique["status"] == "warn"   # raw is append-only (G2)
    full = Warehouse(spark, SF001).dwd("business_orders").drop("_dwd_processed_at")
    assert orders2.drop("_dwd_processed_at").exceptAll(full).count() == 0


def test_run_domain(spark, scratch):
    base = os.path.join(scratch, "wh")
    r = jobs.run_domain(spark, "weather_forecast", SF001, base, as_of=AS_OF, now=dt.datetime(2024, 1, 15),
                       grain="month")
    assert "dws_weather_daily_summary" in r.written and "ads_weather_alert" in r.written


def _land(spark, scratch, parts=2):
    raw = adapters.raw_github_events(spark, SF001).select(
        "id", "type", "actor_login", "actor_id", "repo_name", "repo_id",
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"), "is_public",
        "source_system", F.date_format("_ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingested_at"))
    landing = os.path.join(scratch, "landing")
    raw.repartition(parts).write.json(landing)
    return landing


def test_stream_upsert_equals_batch(spark, scratch):
    landing = _land(spark, scratch)
    base = os.path.join(scratch, "wh")
    q = S.upsert_batches(spark, landing, base, as_of=AS_OF, checkpoint=os.path.join(scratch, "ck1"), grain="month")
    q.awaitTermination()
    streamed = jobs.Job(spark, base).current("dwd", "dwd_github_events")
    batch = Warehouse(spark, SF001, as_of=AS_OF).dwd("github_events")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_land_dedup_and_daily_counts(spark, scratch):
    landing = _land(spark, scratch)
    raw_path = os.path.join(scratch, "raw")
    S.land_stream(spark, landing, raw_path, checkpoint=os.path.join(scratch, "ck2")).awaitTermination()
    assert spark.read.parquet(raw_path).count() == adapters.raw_github_events(spark, SF001).count()

    clean = S.clean_dedup_stream(S.read_landing_stream(spark, landing))
    q = (clean.writeStream.format("memory").queryName("dedup_events").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck3")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("dedup_events")
    assert got.count() == got.select("event_id").distinct().count()

    daily = S.daily_type_counts(S.clean_dedup_stream(S.read_landing_stream(spark, landing),
                                                     event_time="event_created_at", keep_event_ts=True))
    q = (daily.writeStream.format("memory").queryName("daily_counts").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck4")).trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.table("daily_counts")
    # every closed day window is emitted once; the last day stays open under the watermark
    batch = Warehouse(spark, SF001).dwd("github_events").groupBy("event_date", "event_type").count()
    joined = out.join(batch, ["event_date", "event_type"])
    assert out.count() >= 1 and joined.where("event_count != `count`").count() == 0


@pytest.mark.parametrize("late_rows", [False, True])
def test_day_partitions_replace_only_reopened_days(spark, scratch, late_rows):
    """I2 + I5 on disk: the second run rewrites the partitions of re-opened days only (the last stored
    day among them); with the change log only those of days that the load touches."""
    import glob

    from strata.plans import dws

    base = os.path.join(scratch, "wh")
    job = jobs.Job(spark, base, as_of=AS_OF, grain="month", late_rows=late_rows)
    orders = adapters.raw_orders(spark, SF001)
    cut = dt.datetime(1998, 1, 1)
    job.land("business_orders", orders.where(orders._ingested_at < cut))
    job.refresh_dwd("business_orders")
    job.refresh_dws("dws_order_daily_summary")
    root = os.path.join(base, "dws", "dws_order_daily_summary", "data")
    before = {p: os.path.getmtime(p) for p in glob.glob(os.path.join(root, "*", "*.parquet"))}
    job.land("business_orders", orders.where(orders._ingested_at >= cut))
    job.refresh_dwd("business_orders")
    after = job.refresh_dws("dws_order_daily_summary")
    full = dws.dws_order_daily_summary(Warehouse(spark, SF001).dwd("business_orders"), as_of=AS_OF)
    assert after.columns == full.columns
    assert after.exceptAll(full).count() == 0 and full.exceptAll(after).count() == 0
    untouched = [p for p in before if os.path.exists(p) and os.path.getmtime(p) == before[p]]
    assert len(untouched) == len(before) if late_rows else 0 < len(untouched) < len(before)


def test_dwd_partitions_and_retry_after_partial_commit(spark, scratch):
    """I1 + I4 on disk: a batch rewrites only the partitions it touches; a retry without the
    watermark marker (a run that died after its data commit) gives the same table."""
    import glob

    from strata.sources.ingest import read_watermark, write_watermark

    base = os.path.join(scratch, "wh")
    job = jobs.Job(spark, base, as_of=AS_OF, grain="month")
    cut = dt.datetime(1998, 1, 1)
    # events: ids keep their creation time, so older months are not touched by a newer batch
    events = adapters.raw_github_events(spark, SF001)
    split = events.agg(F.expr("percentile_approx(_ingested_at, 0.8)")).first()[0]
    job.land("github_events", events.where(events._ingested_at < split))
    job.refresh_dwd("github_events")
    oroot = os.path.join(base, "dwd", "dwd_github_events", "data")
    month = f"{PART}={split:%Y-%m}-01"
    before = {p: os.path.getmtime(p) for p in glob.glob(os.path.join(oroot, "*", "*.parquet")) if month not in p}
    job.land("github_events", events.where(events._ingested_at >= split))
    job.refresh_dwd("github_events")
    assert all(os.path.exists(p) and os.path.getmtime(p) == t for p, t in before.items())
    # items: repeated keys move between load months; the old row must go wherever it is
    items = adapters.raw_order_items(spark, SF001)
    job.land("business_order_items", items.where(items._ingested_at < cut))
    job.refresh_dwd("business_order_items")
    old_mark = read_watermark(spark, base, "dwd", "dwd_business_order_items")
    job.land("business_order_items", items.where(items._ingested_at >= cut))
    first = job.refresh_dwd("business_order_items")
    full = Warehouse(spark, SF001, as_of=AS_OF).dwd("business_order_items")
    assert first.columns == full.columns
    assert first.exceptAll(full).count() == 0 and full.exceptAll(first).count() == 0
    # a crash between the data commit and the marker leaves the old marker: the batch is redone
    write_watermark(spark, base, "dwd", "dwd_business_order_items", old_mark)
    again = job.refresh_dwd("business_order_items")
    assert again.exceptAll(full).count() == 0 and full.exceptAll(again).count() == 0
    assert read_watermark(spark, base, "dwd", "dwd_business_order_items") > old_mark


def test_land_api_documents_through_pipeline(spark, scratch):
    """S11 + S1-S3: API pages dropped as JSON lines are parsed, landed and refreshed like any load."""
    base = os.path.join(scratch, "wh")
    raw = adapters.raw_github_events(spark, SF001)
    page = F.floor(F.col("id").cast("long") / 30)
    rec = F.struct(
        F.col("id"), F.col("type"),
        F.struct(F.col("actor_login").alias("login"), F.col("actor_id").alias("id")).alias("actor"),
        F.struct(F.col("repo_name").alias("name"), F.col("repo_id").alias("id")).alias("repo"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        F.col("is_public").alias("public"))
    events_dir = os.path.join(scratch, "landing_events")
    raw.groupBy(page.alias("p")).agg(F.to_json(F.collect_list(rec)).alias("doc")).select("doc").write.text(events_dir)

    w = spark.createDataFrame([("2024-01-15T08:00", 39.5, 40, 0.0, 95), ("2024-01-15T09:00", 20.0, 50, 1.5, 3)],
                              "t string, temp double, h int, p double, c int")
    doc = w.agg(F.to_json(F.struct(F.struct(
        F.collect_list("t").alias("time"), F.collect_list("temp").alias("temperature_2m"),
        F.collect_list("h").alias("relative_humidity_2m"), F.collect_list("p").alias("precipitation"),
        F.collect_list("c").alias("weather_code")).alias("hourly"))).alias("doc"))
    weather_dir = os.path.join(scratch, "landing_weather")
    doc.write.text(weather_dir)

    job = jobs.Job(spark, base, as_of=AS_OF, grain="month")
    job.land_documents("github_events", events_dir, "github")
    job.land_documents("weather_forecast", weather_dir, "open_meteo", tz="Asia/Shanghai")
    got = job.refresh_dwd("github_events").drop("_ingested_at", "_dwd_processed_at")
    want = Warehouse(spark, SF001, as_of=AS_OF).dwd("github_events").drop("_ingested_at", "_dwd_processed_at")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    hours = sorted((r["forecast_time"], r["weather_category"]) for r in job.refresh_dwd("weather_forecast").collect())
    assert hours == [(dt.datetime(2024, 1, 15, 0, 0), "severe_thunderstorm"), (dt.datetime(2024, 1, 15, 1, 0),
                                                                                "partly_cloudy")]


def test_run_domain_skips_models_missing_inputs(spark, scratch):
    """L2: orders alone refresh the day summary; the customer summary and KPI wait for customers."""
    base = os.path.join(scratch, "wh")
    r = jobs.run_domain(spark, "business_orders", SF001, base, as_of=AS_OF, grain="month")
    assert "dws_order_daily_summary" in r.written
    assert "dws_customer_order_summary" not in r.written and "ads_business_kpi" not in r.written
    assert r.summary.first()["total"] > 0
