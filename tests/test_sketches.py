"""Mergeable distinct counts: error below the stated bound, merges equal one sketch of all rows."""

import pytest
from pyspark.sql import functions as F

from strata.operators.sketches import daily_sketches, error_bound, merge_sketches


@pytest.mark.parametrize("actors", [40, 3000, 60_000])
def test_weekly_counts_from_daily_sketches_keep_the_bound(spark, actors):
    rows = spark.range(4 * actors).select(
        (F.col("id") % 7).alias("day"), (F.col("id") % 3).alias("kind"), (F.xxhash64("id") % actors).alias("actor"))
    daily = daily_sketches(rows, ["day", "kind"], ["actor"])
    merged = merge_sketches(daily, ["kind"], ["actor"])
    exact = {r["kind"]: (r["n"], r["c"]) for r in rows.groupBy("kind").agg(F.countDistinct("actor").alias("n"), F.count(F.lit(1)).alias("c")).collect()}
    for r in merged.collect():
        n, c = exact[r["kind"]]
        assert abs(r["approx_actor"] - n) <= error_bound() * n + 0.5 and r["event_count"] == c
    # merged sketches merge again (months from weeks), within the same bound
    n = rows.select("actor").distinct().count()
    for whole in (merge_sketches(merged, [], ["actor"]), merge_sketches(daily, [], ["actor"])):
        assert abs(whole.first()["approx_actor"] - n) <= error_bound() * n + 0.5


def test_nulls_and_empty_groups(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, 5), (2, 5), (2, 6)], "day int, actor long")
    merged = {r["day"]: (r["event_count"], r["approx_actor"]) for r in merge_sketches(daily_sketches(rows, ["day"], ["actor"]), ["day"], ["actor"]).collect()}
    assert merged == {1: (2, 0), 2: (3, 2)}
    assert daily_sketches(rows.limit(0), ["day"], ["actor"]).count() == 0


def test_error_bound_follows_the_size():
    assert error_bound(12) == pytest.approx(0.04875) and error_bound(14) == pytest.approx(error_bound(12) / 2)
