"""Keyed stream state: latest row per key and exact distinct counts equal the batch models."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import dwd, dws, jobs
from strata.sources.ingest import load_seed
from strata.streaming import events as E

AS_OF = dt.datetime(2024, 1, 31)


def _event(i, loaded, kind="PushEvent", day=1, actor=None, repo="o/r", public=True):
    return {"id": str(i), "type": kind, "actor_login": "u", "actor_id": i if actor is None else actor, "repo_name": repo, "repo_id": 1,
            "created_at": f"2024-01-{day:02d}T10:00:00Z", "is_public": public, "source_system": "api", "_ingested_at": loaded}


#: Three drops: late, equal and missing load times, a replay, events that change, and rows that M7 leaves out.
DROPS = [
    [_event(i, "2024-01-02T00:00:00Z", day=1 + i % 3, actor=i % 4) for i in range(12)] + [_event(50, None, "ForkEvent")],
    [_event(1, "2024-01-01T00:00:00Z", "WatchEvent"), _event(2, "2024-01-02T00:00:00Z", "AardEvent", day=3, actor=2),
     _event(3, "2024-01-05T00:00:00Z", "WatchEvent", day=1, actor=9), _event(60, "2024-01-01T06:00:00Z", day=2), _event(61, "2024-01-04T00:00:00Z", repo="none")],
    [_event(3, "2024-01-04T00:00:00Z", "ForkEvent"), _event(50, "2024-01-09T00:00:00Z", "PushEvent"), _event(4, "2024-01-02T00:00:00Z", day=2, actor=0, public=None),
     _event(62, "2024-01-02T00:00:00Z", day=2, actor=1), _event(60, "2024-01-01T06:00:00Z", day=2)],
]


def _drop(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def _batch(spark, landing):
    raw = spark.read.schema(E.RAW_EVENT_SCHEMA).json(landing)
    return dwd.dwd_github_events(E.typed_events(raw), as_of=AS_OF)


@pytest.fixture()
def on_disk(spark):
    names = ["spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"]
    E.keep_state_on_disk(spark)
    yield
    for n in names:
        spark.conf.unset(n)


def _run(df, scratch, name, keys, found):
    def take(batch, _):
        for r in batch.collect():
            found[tuple(r[k] for k in keys)] = tuple(r)

    df.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", os.path.join(scratch, name)).trigger(
        availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0, 1]])
def test_latest_row_per_key_equals_the_batch(spark, scratch, on_disk, order):
    landing, found = os.path.join(scratch, "landing"), {}
    for n, i in enumerate(order):  # every drop is a restart of the query from its checkpoint
        _drop(landing, f"{n}.json", DROPS[i])
        _run(E.latest_events(E.read_landing_stream(spark, landing)), scratch, "latest", ["event_id"], found)
    want = _batch(spark, landing).drop("_dwd_processed_at")
    assert sorted(found.values(), key=str) == sorted((tuple(r) for r in want.collect()), key=str)
    state = os.path.join(scratch, "latest", "state")
    assert any(f.endswith((".changelog", ".zip")) for _, _, fs in os.walk(state) for f in fs)  # kept by RocksDB


def test_exact_distinct_counts_equal_the_batch(spark, scratch, on_disk):
    landing, found = os.path.join(scratch, "landing"), {}
    for n, i in enumerate([0, 2, 1]):
        # events as they are for good: only first versions
        _drop(landing, f"{n}.json", [r for r in DROPS[i] if n == 0 or int(r["id"]) >= 60] + [_event(100 + n, "2024-01-03T00:00:00Z", day=2, actor=1)])
        clean = dwd.dwd_github_events(E.typed_events(E.read_landing_stream(spark, landing)), merge=dwd.CLEANED)
        _run(E.exact_daily_distinct(clean, "actor_id"), scratch, "distinct", ["event_date", "event_type"], found)
    want = _batch(spark, landing).groupBy("event_date", "event_type").agg(F.countDistinct("actor_id").alias("n"))
    assert sorted(found.values()) == sorted(tuple(r) for r in want.collect())


def test_daily_summary_follows_the_stream(spark, scratch):
    """X3 + M13: after every drop the day summary equals the batch one, also for events that change day and type."""
    landing, base = os.path.join(scratch, "landing"), os.path.join(scratch, "wh")
    seed = load_seed(spark)
    for n, i in enumerate([1, 0, 2, 2]):
        _drop(landing, f"{n}.json", DROPS[i])
        E.upsert_batches(spark, landing, base, as_of=AS_OF, daily=True, seed=seed).awaitTermination()
        got = jobs.Job(spark, base).current("dws", "dws_github_daily_activity")
        want = dws.dws_github_daily_activity(_batch(spark, landing), seed, as_of=AS_OF)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
