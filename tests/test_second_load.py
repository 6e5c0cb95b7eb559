"""Second loads: moved keys, late rows, restarts, broken input, tables left alone."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from strata.functions import exprs as X
from strata.operators import quality
from strata.operators.incremental import recompute_changed
from strata.plans import dws, jobs
from strata.plans import suite as S
from strata.sources import adapters
from strata.sources.ingest import read_current, read_partitioned, table_root, upsert_partitions, write_table
from strata.sources.json_records import quarantine, read_json_records
from strata.streaming import events as E

AS_OF = dt.datetime(2024, 1, 31)


@pytest.mark.parametrize("grain", ["day", "month"])
def test_customers_landed_again_stay_one_row_each(spark, scratch, grain):
    job = jobs.Job(spark, os.path.join(scratch, "wh"), as_of=AS_OF, grain=grain)
    raw = adapters.raw_customers(spark, SF001)
    n = raw.select("customer_id").distinct().count()
    for stamp in ("2024-01-01 06:00:00", "2024-03-02 06:00:00"):
        job.land("business_customers", raw.withColumn("_ingested_at", F.lit(stamp).cast("timestamp_ntz")))
        job.refresh_dwd("business_customers")
    got = job.current("dwd", "dwd_business_customers")
    assert got.count() == got.select("customer_id").distinct().count() == n
    assert got.select("_ingested_at").distinct().count() == 1


def _days(spark, rows):
    return spark.createDataFrame([(k, v, dt.date(2024, 1, d)) for k, v, d in rows], "k long, v string, p date")


def test_emptied_partition_disappears(spark, scratch):
    base = os.path.join(scratch, "wh")
    upsert_partitions(None, _days(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)]), ["k"], base, "dwd", "t", "p")
    for _ in range(2):  # the same batch again changes nothing
        target = read_partitioned(spark, base, "dwd", "t", "p")
        upsert_partitions(target, _days(spark, [(1, "A", 2), (2, "B", 2)]), ["k"], base, "dwd", "t", "p")
        got = sorted((r["k"], r["v"], r["p"].day) for r in read_partitioned(spark, base, "dwd", "t", "p").collect())
        assert got == [(1, "A", 2), (2, "B", 2), (3, "c", 2), (4, "d", 3)]


def test_upsert_reads_only_touched_partitions(spark, scratch):
    base = os.path.join(scratch, "wh")
    upsert_partitions(None, _days(spark, [(d, "a", d) for d in range(1, 9)]), ["k"], base, "dwd", "t", "p")
    target = read_partitioned(spark, base, "dwd", "t", "p")
    from strata.sources.ingest import _in_partitions, touched_partitions
    batch = _days(spark, [(3, "b", 3)])
    touched = touched_partitions(target, batch, ["k"], "p", stable=True)
    plan = target.where(_in_partitions("p", touched))._jdf.queryExecution().executedPlan().toString()
    assert touched == [dt.date(2024, 1, 3)] and "PartitionFilters: [p" in plan.replace("isnotnull(p", "p")


def test_version_without_success_is_invisible(spark, scratch):
    base = os.path.join(scratch, "wh")
    write_table(spark.range(3), base, "ads", "t")
    path = write_table(spark.range(5), base, "ads", "t")
    os.remove(os.path.join(path, "_SUCCESS"))  # as if the job had died before its commit
    assert read_current(spark, table_root(base, "ads", "t")).count() == 3
    for n in (7, 8, 9):
        write_table(spark.range(n), base, "ads", "t")
    assert read_current(spark, table_root(base, "ads", "t")).count() == 9
    assert len([x for x in os.listdir(os.path.join(base, "ads", "t")) if x.startswith("v-")]) == 2


def _event(i, loaded, kind="PushEvent"):
    return {"id": str(i), "type": kind, "actor_login": "u", "actor_id": i, "repo_name": "o/r", "repo_id": 1,
            "created_at": "2024-01-01T10:00:00Z", "is_public": True, "source_system": "api", "_ingested_at": loaded}


def _drop(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def test_stream_keeps_late_and_equal_stamps(spark, scratch):
    landing, base = os.path.join(scratch, "landing"), os.path.join(scratch, "wh")
    first = [_event(1, "2024-01-02T00:00:00Z")]
    second = [_event(2, "2024-01-01T12:00:00Z"), _event(3, "2024-01-02T00:00:00Z"), _event(4, "2024-01-03T00:00:00Z"),
              _event(1, "2024-01-01T00:00:00Z", "WatchEvent")]
    for name, rows in (("a.json", first), ("b.json", second), ("c.json", second)):  # the last is a replay
        _drop(landing, name, rows)
        E.upsert_batches(spark, landing, base, as_of=AS_OF).awaitTermination()
    got = {r["event_id"]: r["event_type"] for r in jobs.Job(spark, base).current("dwd", "dwd_github_events").collect()}
    assert got == {"1": "PUSHEVENT", "2": "PUSHEVENT", "3": "PUSHEVENT", "4": "PUSHEVENT"}


def test_restarted_stream_lands_each_file_once(spark, scratch):
    landing, raw = os.path.join(scratch, "landing"), os.path.join(scratch, "raw")
    kept = spark.sparkContext.getCheckpointDir()
    try:
        for i in (1, 2, 3):  # each turn as a new application, whose checkpoint folder is another
            spark.sparkContext.setCheckpointDir(os.path.join(scratch, f"app{i}"))
            _drop(landing, f"{i}.json", [_event(i, "2024-01-02T00:00:00Z")])
            E.land_stream(spark, landing, raw).awaitTermination()
    finally:
        spark.sparkContext.setCheckpointDir(os.path.dirname(kept))
    assert sorted(r["id"] for r in spark.read.parquet(raw).collect()) == ["1", "2", "3"]


def test_broken_input_raises_or_is_set_aside(spark):
    from pyspark.sql import types as T

    element = T.StructType([T.StructField("id", T.LongType())])
    docs = spark.createDataFrame([('[{"id": 1}]',), ('[{"id": 2}',), ("{}",), (None,)], "doc string")
    with pytest.raises(Exception):
        read_json_records(docs, "doc", element, {"id": "id"}).collect()
    good, bad = quarantine(docs, "doc", "array")
    assert [r["id"] for r in read_json_records(good, "doc", element, {"id": "id"}).collect()] == [1]
    assert bad.count() == 2 and good.count() == 2
    times = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("soon",)], "t string")
    with pytest.raises(Exception, match="not a time"):
        times.select(X.iso_to_ts("t")).collect()
    assert times.select(X.iso_to_ts("t", on_bad="null").alias("t")).where("t IS NULL").count() == 1


def test_first_match_of_an_alternation(spark):
    df = spark.createDataFrame([("xbya",)], "s string")
    assert df.select(X.first_match_replace("s", "a|b")).first()[0] == "xya"
    assert df.select(X.first_match_replace("s", "a|b", "$1\\")).first()[0] == "x$1\\ya"


def test_group_that_rows_left_is_rebuilt(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    schema = "k long, g string, seen timestamp_ntz"
    before = spark.createDataFrame([(1, "A", t1), (2, "A", t1), (3, "B", t1), (4, "C", t1)], schema)
    after = spark.createDataFrame([(1, "B", t2), (2, "A", t1), (3, "B", t1), (4, "B", t2)], schema)

    def build(at):
        return lambda f: f.groupBy("g").agg(F.count(F.lit(1)).alias("n")).withColumn("done", F.lit(at).cast("timestamp_ntz"))

    out = recompute_changed(after, build(t1)(before), "seen", "done", ["g"], build(t2), count_column="n")
    assert sorted((r["g"], r["n"]) for r in out.collect()) == [("A", 1), ("B", 3)]


def test_order_that_changes_customer(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    orders = "order_id long, customer_id long, total_amount double, order_date timestamp_ntz, order_date_key timestamp_ntz, payment_channel string, _dwd_processed_at timestamp_ntz"
    people = spark.createDataFrame([(c, f"n{c}", "x", "individual", t1) for c in (1, 2, 3)],
                                   "customer_id long, customer_name string, city string, customer_type string, _dwd_processed_at timestamp_ntz")
    row = lambda o, c, t: (o, c, 10.0, t1, t1, "card", t)
    old = spark.createDataFrame([row(1, 1, t1), row(2, 1, t1), row(3, 2, t1), row(4, 3, t1)], orders)
    new = spark.createDataFrame([row(1, 1, t1), row(2, 3, t2), row(3, 3, t2), row(4, 3, t1)], orders)
    first = dws.dws_customer_order_summary(old, people, as_of=t1)
    got = dws.dws_customer_order_summary_changed(new, people, first, as_of=t2)
    assert sorted((r["customer_id"], r["total_orders"]) for r in got.collect()) == [(1, 1), (3, 3)]


def test_every_table_is_checked_and_counted(spark, scratch):
    base = os.path.join(scratch, "wh")
    run = lambda land: jobs.run_all(spark, SF001, base, as_of=AS_OF, now=dt.datetime(2024, 1, 15),
                                    today=dt.date(2024, 1, 30 + (not land)), grain="month", land=land)
    run(True)
    second = run(False)  # nothing new: DWD isn't written, and is checked and counted all the same
    assert "dwd_business_customers" not in second.written
    assert {r["model"] for r in second.checks.select("model").distinct().collect()} == set(S.FULL_SUITE)
    assert second.drift.count() == 21
    quality.require_passed(second.checks)
    with pytest.raises(Exception):
        quality.require_passed(second.checks.withColumn("status", F.lit("fail")))
