"""Checks, freshness, drift and the failure report (Q1-Q14)."""

import datetime as dt

import pytest

from strata.operators import monitor, quality as Q, report

T0 = dt.datetime(2024, 1, 1)


def test_checks_one_failure_each(spark):
    df = spark.createDataFrame([
        (1, "a", 5, None, None), (1, "b", 50, "x", None), (None, "zz", 7, None, "y"),
    ], "id long, v string, n int, p string, q string")
    checks = [Q.not_null("id"), Q.unique("id"), Q.accepted_values("v", ["a", "b"]),
              Q.reasonable_range("n", 0, 10), Q.not_null_multicol(["p", "q"]),
              Q.not_null_multicol(["p", "q"], mode="any", severity="warn")]
    out = {(r["test_name"], r["severity"]): r for r in Q.run_checks(df, "m", checks).collect()}
    assert out[("not_null", "error")]["failures"] == 1
    assert out[("unique", "error")]["failures"] == 1
    assert out[("accepted_values", "error")]["failures"] == 1
    assert out[("reasonable_range", "error")]["failures"] == 1
    assert out[("not_null_multicol", "error")]["failures"] == 1      # only the all-null row
    assert out[("not_null_multicol", "warn")]["failures"] == 3
    assert out[("not_null_multicol", "warn")]["status"] == "warn"
    assert out[("not_null", "error")]["status"] == "fail"


def test_assert_rows_and_gate(spark):
    df = spark.createDataFrame([(1,), (-1,)], "c long")
    res = Q.run_checks(df, "m", [Q.assert_rows("positive", "c < 0")])
    assert res.first()["failures"] == 1
    with pytest.raises(Q.QualityGateError):
        Q.require_passed(res)
    ok = Q.run_checks(df, "m", [Q.assert_rows("positive", "c < -5")])
    assert Q.require_passed(ok)["fail"] == 0


def test_freshness_levels(spark):
    now = dt.datetime(2024, 1, 2, 0, 0)
    mk = lambda hours: spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "_ingested_at timestamp_ntz")  # noqa
    out = {r["source"]: r["status"] for r in Q.freshness(
        {"a": mk(5.9), "b": mk(6.1), "c": mk(12.1), "d": mk(1).limit(0)},
        {k: (6, 12) for k in "abcd"}, as_of=now).collect()}
    assert out == {"a": "pass", "b": "warn", "c": "error", "d": "error"}


def test_drift_cases(spark):
    day = dt.date(2024, 1, 2)
    snap = spark.createDataFrame([
        (dt.date(2024, 1, 1), "s", t, y) for t, y in
        [("zero", 0), ("grow", 0), ("thirty", 100), ("up", 100), ("down", 100)]
    ], "snapshot_date date, schema_name string, table_name string, row_count long")
    today = spark.createDataFrame([("s", t, c) for t, c in
                                   [("zero", 0), ("grow", 5), ("thirty", 130), ("up", 131), ("down", 69),
                                    ("new", 10)]], "schema_name string, table_name string, row_count long")
    out = {r["table_name"]: r for r in monitor.row_count_drift(today, snap, day, alerts_only=False).collect()}
    assert "new" not in out                          # no baseline: skipped
    assert not out["zero"]["alert"] and not out["thirty"]["alert"]
    assert out["grow"]["change_pct"] == 100.0 and out["grow"]["alert"]
    assert (out["up"]["direction"], out["up"]["change_pct"]) == ("+", 31.0)
    assert (out["down"]["direction"], out["down"]["change_pct"]) == ("-", 31.0)
    upd = monitor.snapshot_upsert(snap, today, day)
    assert upd.count() == 5 + 6
    title, body = monitor.drift_markdown(monitor.row_count_drift(today, snap, day, alerts_only=False), "nightly",
                                         when=dt.datetime(2024, 1, 2, 7, 0))
    assert title == "nightly: row counts drifted"
    assert "`s.up`: 100 rows before, 131 now (+31.0 %)" in body and "`s.down`: 100 rows before, 69 now (-31.0 %)" in body
    assert "s.thirty" not in body and "2024-01-02 07:00 UTC" in body
    calm = monitor.row_count_drift(today.where("table_name = 'zero'"), snap, day, alerts_only=False)
    assert monitor.drift_markdown(calm, "nightly") is None


def test_failure_report_caps_and_text(spark):
    rows = [("not_null", f"m{i:02d}", "c", "error", 1) for i in range(25)]
    res = Q.with_status(spark.createDataFrame(rows, "test_name string, model string, column_name string, "
                                                     "severity string, failures long"))
    top = report.failure_report(res, 20).collect()
    assert len(top) == 20 and top[0]["more_failures"] == 5
    assert top[0]["model"] == "m00" and top[0]["test"] == "not_null__c"
    summary = report.summarize(res).first()
    assert (summary["fail_count"], summary["total"], summary["overall_status"]) == (25, 25, "FAILED")
    title, body = report.markdown(report.summarize(res), report.failure_report(res, 20), "nightly")
    assert title == "nightly: checks failed" and body.endswith("- and 5 more")
    # an id with two parts keeps the whole id as model
    two = spark.createDataFrame([("a.b", "fail", "msg", "c")], "unique_id string, status string, message string, "
                                                             "column_name string")
    assert report.failure_rows(two).first()["model"] == "a.b"
