"""Counts and checks collected by the writes themselves, and the gate before a layer is replaced."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from strata.operators import quality as Q
from strata.plans import jobs
from strata.plans import suite as S
from strata.sources import adapters
from strata.sources.ingest import read_current, read_partitioned, recorded_measures, table_root, upsert_partitions, write_table
from strata.sources.raw import append_loads, appended_measures

AS_OF = dt.datetime(2024, 1, 31)
CHECKS = [Q.not_null("v"), Q.unique("k"), Q.accepted_values("s", ["a", "b"]), Q.reasonable_range("k", 0, 90),
          Q.not_null_multicol(["v", "s"], mode="any", severity="warn"), Q.assert_rows("odd", "k % 2 = 1")]


def _rows(spark, n=100):
    k = F.col("id")
    return spark.range(n).select((k % 97).alias("k"), F.when(k % 5 != 0, k).alias("v"),
                                 F.when(k % 7 == 0, F.concat(F.lit("z"), (k % 3).cast("string"))).otherwise("a").alias("s"))


def _results(df):
    return sorted((r["unique_id"], r["severity"], r["failures"], r["status"], r["message"]) for r in df.collect())


def test_checks_of_a_version_equal_the_suite(spark, scratch):
    df = _rows(spark)
    write_table(df, scratch, "ads", "t", measures=Q.measures(CHECKS))
    found = recorded_measures(spark, scratch, "ads", "t")
    assert found["rows"] == 100
    assert _results(Q.results_from(df, "t", CHECKS, found)) == _results(Q.run_checks(df, "t", CHECKS))
    write_table(df.limit(0), scratch, "ads", "empty", measures=Q.measures(CHECKS))
    assert recorded_measures(spark, scratch, "ads", "empty")["rows"] == 0
    empty = spark.createDataFrame([], df.schema)
    write_table(empty, scratch, "ads", "none", measures=Q.measures(CHECKS))
    assert recorded_measures(spark, scratch, "ads", "none")["rows"] == 0


def test_row_checks_cost_no_scan(spark):
    """Row-level results come from the record: their plan reads no table."""
    checks = [c for c in CHECKS if c.kind not in ("unique", "accepted_values")]
    out = Q.results_from(_rows(spark), "t", checks, {f"c{i}": 0 for i in range(len(checks))})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "Aggregate" not in plan


def test_counts_of_a_partitioned_table_follow_its_upserts(spark, scratch):
    part = lambda df: df.withColumn("p", (F.col("k") % 4).cast("int"))
    measures = Q.measures(CHECKS)
    upsert = lambda t, b, **kw: upsert_partitions(t, part(b), ["k"], scratch, "dwd", "t", "p", stable=True, measures=measures, **kw)
    check = lambda: (read_partitioned(spark, scratch, "dwd", "t", "p"), recorded_measures(spark, scratch, "dwd", "t"))
    upsert(None, _rows(spark, 60))
    for batch in (_rows(spark, 90).where("k % 4 = 1"), _rows(spark, 200).where("k % 4 = 3").withColumn("v", F.lit(None).cast("long"))):
        upsert(check()[0], batch.dropDuplicates(["k"]))
        table, found = check()
        assert found["rows"] == table.count()
        assert _results(Q.results_from(table, "t", CHECKS, found)) == _results(Q.run_checks(table, "t", CHECKS))
    upsert(check()[0], _rows(spark, 1).limit(0), gone=F.col("p") == 2, gone_partitions=[2])
    table, found = check()
    assert found["rows"] == table.count() and table.where("p = 2").count() == 0


def test_gate_leaves_the_old_version(spark, scratch):
    gate = Q.stop_on_failures("t", CHECKS[:1])
    good = _rows(spark).where("v IS NOT NULL")
    write_table(good, scratch, "ads", "t", measures=Q.measures(CHECKS[:1]), gate=gate)
    with pytest.raises(Q.QualityGateError, match="before t was replaced"):
        write_table(_rows(spark), scratch, "ads", "t", measures=Q.measures(CHECKS[:1]), gate=gate)
    assert read_current(spark, table_root(scratch, "ads", "t")).count() == good.count()
    assert len([x for x in os.listdir(os.path.join(scratch, "ads", "t")) if x.startswith("v-")]) == 1
    part = lambda df: df.dropDuplicates(["k"]).withColumn("p", (F.col("k") % 4).cast("int"))
    kw = dict(measures=Q.measures(CHECKS[:1]), gate=gate, stable=True)
    upsert_partitions(None, part(good), ["k"], scratch, "dwd", "t", "p", **kw)
    before = recorded_measures(spark, scratch, "dwd", "t")
    table = read_partitioned(spark, scratch, "dwd", "t", "p")
    with pytest.raises(Q.QualityGateError):
        upsert_partitions(table, part(_rows(spark)), ["k"], scratch, "dwd", "t", "p", **kw)
    assert read_partitioned(spark, scratch, "dwd", "t", "p").where("v IS NULL").count() == 0
    assert recorded_measures(spark, scratch, "dwd", "t") == before


def test_gate_stops_a_job_before_the_layer(spark, scratch):
    job = jobs.Job(spark, os.path.join(scratch, "wh"), as_of=AS_OF, grain="month", gate=True)
    orders = adapters.raw_orders(spark, SF001)
    job.land("business_orders", orders)
    job.refresh_dwd("business_orders")
    n = job.current("dwd", "dwd_business_orders").count()
    broken = orders.limit(20).withColumns({"order_status": F.lit("lost"), "_ingested_at": F.lit("2024-01-01").cast("timestamp_ntz")})
    job.land("business_orders", broken)
    with pytest.raises(Q.QualityGateError, match="accepted_values"):
        job.refresh_dwd("business_orders")
    assert job.current("dwd", "dwd_business_orders").where("order_status = 'lost'").count() == 0
    assert job.measured("dwd_business_orders")["rows"] == n


def test_appended_counts_and_an_append_that_died(spark, scratch):
    path = os.path.join(scratch, "raw")
    rows = spark.range(10).select(F.when(F.col("id") > 2, F.col("id")).alias("id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("_ingested_at"))
    counted = {"rows": F.count(F.lit(1)), "keyed": F.count("id")}
    for _ in range(3):
        append_loads(rows, path, measures=counted)
    assert appended_measures(spark, path) == {"rows": 30, "keyed": 21}
    open(os.path.join(path, "_PENDING"), "w").close()  # as if a further append had died
    assert appended_measures(spark, path) is None
    append_loads(rows, path, measures=counted)
    assert appended_measures(spark, path) is None


def test_every_table_of_a_run_is_counted_from_its_record(spark, scratch, monkeypatch):
    """21 tables: no job counts them, and the counts and checks equal those of a scan."""
    base = os.path.join(scratch, "wh")
    jobs.run_all(spark, SF001, base, as_of=AS_OF, now=dt.datetime(2024, 1, 15), today=dt.date(2024, 1, 30), grain="month")
    job = jobs.Job(spark, base, as_of=AS_OF, grain="month", today=dt.date(2024, 1, 31))
    counted = []
    monkeypatch.setattr(jobs.monitor, "table_counts", lambda tables: counted.append(tables))
    counts = {r["table_name"]: r["row_count"] for r in job.counts().collect()}
    assert len(counts) == 21 and not counted
    tables = job.tables()
    assert counts == {n: df.count() for n, df in tables.items() if not n.startswith("raw_")}
    assert _results(job.check()) == _results(Q.run_suite(tables, {m: c for m, c in S.FULL_SUITE.items() if m in tables}))
    assert job.monitor().count() == 21
