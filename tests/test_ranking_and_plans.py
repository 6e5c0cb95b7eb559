"""Distributed rank equals the window rank; plans keep pushdown and partial limits."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.joins import attach_one_row
from strata.operators.ranking import attach_ranks_many, global_rank, top_k_rank, value_ranks
from strata.plans.catalog import Warehouse
import pytest
from conftest import SF001


def test_global_rank_matches_window(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([None, 1.0, 2.0, 2.0, 3.5]) if i % 5 else float(rnd.randint(0, 50))) for i in range(400)]
    df = spark.createDataFrame(data, "id long, v double")
    mine = {r["id"]: r["rk"] for r in global_rank(df, "v", "rk").collect()}
    ref = {r["id"]: r["rk"] for r in df.withColumn(
        "rk", F.rank().over(Window.orderBy(F.col("v").desc_nulls_first()))).collect()}
    assert mine == ref


def _reference(df, col, desc):
    o = F.col(col).desc_nulls_first() if desc else F.col(col).asc_nulls_last()
    return {r[col]: r["rk"] for r in df.withColumn("rk", F.rank().over(Window.orderBy(o))).collect()}


@pytest.mark.parametrize("desc", [True, False])
def test_ranks_of_every_kind_of_column(spark, desc):
    """Numbers, infinities, NaN, texts that share a start, days: buckets of the sketch keep the order."""
    rnd = random.Random(3)
    data = [(rnd.choice([None, 1, 2, 2, 5, -(1 << 62), (1 << 62), (1 << 62) + 1]), rnd.choice([0.5, None, 9.0, float("inf"), float("-inf"), float("nan")]),
             rnd.choice([None, "", "prefix-a", "prefix-b", "prefix-bb", "é", "語"]), rnd.choice([None, dt.date(2024, 1, rnd.randint(1, 28))]))
            for _ in range(400)]
    df = spark.createDataFrame(data, "a long, b double, c string, d date")
    for col in "abcd":
        got = {str(r[col]): r["rk"] for r in value_ranks(df, col, "rk", desc, buckets=5).collect()}
        assert got == {str(k): v for k, v in _reference(df, col, desc).items()}


def test_ranks_of_several_columns_from_one_pass(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice([None, 1, 2, 2, 5]), rnd.choice([0.5, 1.5, None, 9.0])) for i in range(300)]
    df = spark.createDataFrame(data, "id long, a long, b double")
    some = df.where("id % 7 = 0").drop("id")
    out = attach_ranks_many(some.union(some), df, [("a", "ra"), ("b", "rb")])
    ra, rb = _reference(df, "a", True), _reference(df, "b", True)
    rows = out.collect()
    assert len(rows) == 2 * some.count() and out.columns == ["a", "b", "ra", "rb"]
    assert all(r["ra"] == ra[r["a"]] and r["rb"] == rb[r["b"]] for r in rows)


def test_nothing_runs_while_a_rank_is_planned(spark):
    """No checkpoint, no job before the result is asked for; no window or task over all rows."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "ranks")
    df = spark.range(1000).select("id", (F.col("id") % 17).alias("v"))
    ranked, top = global_rank(df, "v", "rk"), top_k_rank(df, "v", "rk", 3)
    many = attach_ranks_many(top, df, [("v", "r1"), ("id", "r2")])
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for frame in (ranked, top, many):
        assert "checkpoint" not in plan(frame).lower()


def test_ties_at_the_last_place_stay_spread_out(spark):
    """A third of all rows is tied at the k-th value: they are filtered in place, not brought together."""
    df = spark.range(0, 30_000, 1, 12).select("id", F.when(F.col("id") < 4, F.lit(1000) - F.col("id")).when(
        F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") % 400).alias("v"))
    top = top_k_rank(df, "v", "rk", 5)
    assert top.count() == 4 + df.where("id >= 4 AND v = 500").count() > 9000
    sizes = top.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 12 and max(r["count"] for r in sizes) < 1200
    assert {r["rk"] for r in top.select("rk").distinct().collect()} == {1, 2, 3, 4, 5}


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 4), (5, 3)], "id long, v long")
    got = sorted((r["id"], r["r"]) for r in top_k_rank(df, "v", "r", 1).collect())
    assert got == [(1, 1), (2, 1), (3, 1)]
    got = sorted((r["id"], r["r"]) for r in top_k_rank(df, "v", "r", 4).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (4, 4)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_has_partial_limit_before_shuffle(spark):
    p = plan(Warehouse(spark, SF001).dwd("business_order_items"))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scan_prunes_and_pushes(spark):
    w = Warehouse(spark, SF001)
    p = w.ods("business_orders")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in p
    assert "o_orderpriority" in p and "o_comment" not in p


def test_attach_one_row_checks_its_side(spark):
    assert attach_one_row(spark.range(3), spark.range(1).selectExpr("7 AS x")).where("x = 7").count() == 3
    with pytest.raises(Exception, match="exactly one row"):
        attach_one_row(spark.range(3), spark.range(2).selectExpr("id AS x")).collect()
