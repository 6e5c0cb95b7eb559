"""Driver contract: entry runs, and a sample of queries equals its oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans.registry import QUERIES
from conftest import SF001
from strata.sources.tables import TABLES

SAMPLE = ["dwd_business_orders", "dws_order_daily_summary", "ads_business_kpi", "dws_github_daily_activity",
          "ads_github_trending", "upsert_composite", "changed_categories", "dq_unique", "row_count_drift",
          "json_columnar_zip", "rank_global_distributed", "dq_freshness_log"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 1
    assert "revenue_rank" in df.columns


def test_every_query_has_oracle():
    # the corpus operators, present or not, are tested against brute force in their own folder
    assert set(entry.oracle_sql()) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    df = entry.queries()[name](spark, SF001)
    cur = con.execute(entry.oracle_sql()[name])
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)
    order = sorted(df.columns)
    s_rows = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    idx = [o_cols.index(c) for c in order]
    o_rows = sorted(repr(tuple(row[i] for i in idx)) for row in cur.fetchall())
    assert s_rows == o_rows
