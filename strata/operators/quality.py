"""Data quality checks.

A check counts offending rows; zero is a pass. ``run_checks`` evaluates all
row-level checks on one table in ONE aggregation (one scan, partial
aggregation per task) and each uniqueness check as one grouped count; the
result is a small frame with one row per check:

    test_name, model, column_name, severity, failures, status, unique_id, message

``status`` is ``pass``, ``warn`` (failures on a warn-severity check) or
``fail``. Failure semantics follow the generic tests they re-state: rows for
``not_null`` / ranges / assertions, duplicated values for ``unique``,
distinct offending values for ``accepted_values``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import round_money, ts_literal


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    severity: str = "error"
    values: tuple = ()
    lo: float | None = None
    hi: float | None = None
    columns: tuple = ()
    predicate: str | None = None
    mode: str = "all"
    name: str | None = field(default=None)

    @property
    def label(self) -> str:
        return self.name or self.kind


def not_null(column: str, severity: str = "error") -> Check:
    """Q1."""
    return Check("not_null", column, severity)


def unique(column: str, severity: str = "error") -> Check:
    """Q2: duplicated non-null values."""
    return Check("unique", column, severity)


def accepted_values(column: str, values: Sequence[str], severity: str = "error") -> Check:
    """Q3: distinct values outside the list; null passes."""
    return Check("accepted_values", column, severity, values=tuple(values))


def reasonable_range(column: str, lo: float, hi: float, severity: str = "error") -> Check:
    """Q4: inclusive bounds; null passes."""
    return Check("reasonable_range", column, severity, lo=lo, hi=hi)


def not_null_multicol(columns: Sequence[str], mode: str = "all", severity: str = "error") -> Check:
    """Q5: fails where ALL columns are null (``mode="any"``: where any is null)."""
    return Check("not_null_multicol", ",".join(columns), severity, columns=tuple(columns), mode=mode)


def assert_rows(name: str, failing: str, severity: str = "error") -> Check:
    """Q6 / Q7: a SQL predicate that is TRUE on offending rows."""
    return Check("assert_rows", "-", severity, predicate=failing, name=name)


def _row_condition(c: Check) -> Column:
    if c.kind == "not_null":
        return F.col(c.column).isNull()
    if c.kind == "reasonable_range":
        v = F.col(c.column)
        return v.isNotNull() & ((v < c.lo) | (v > c.hi))
    if c.kind == "not_null_multicol":
        nulls = [F.col(x).isNull() for x in c.columns]
        cond = nulls[0]
        for n in nulls[1:]:
            cond = (cond & n) if c.mode == "all" else (cond | n)
        return cond
    if c.kind == "assert_rows":
        return F.coalesce(F.expr(c.predicate), F.lit(False))
    raise ValueError(c.kind)


def run_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; one result row per check."""
    parts: list[DataFrame] = []
    row_level = [(i, c) for i, c in enumerate(checks) if c.kind not in ("unique", "accepted_values")]
    value_level = [(i, c) for i, c in enumerate(checks) if c.kind == "accepted_values"]
    if row_level or value_level:
        aggs = [F.count_if(_row_condition(c)).alias(f"c{i}") for i, c in row_level]
        aggs += [
            F.count_distinct(F.when(~F.col(c.column).isin(*c.values), F.col(c.column))).alias(f"c{i}")
            for i, c in value_level
        ]
        one = df.agg(*aggs)
        entries = [
            F.struct(F.lit(checks[i].label).alias("test_name"), F.lit(model).alias("model"),
                     F.lit(checks[i].column).alias("column_name"), F.lit(checks[i].severity).alias("severity"),
                     F.col(f"c{i}").cast("long").alias("failures"))
            for i, _ in row_level + value_level
        ]
        parts.append(one.select(F.inline(F.array(*entries))))
    for i, c in enumerate(checks):
        if c.kind != "unique":
            continue
        dup = (
            df.where(F.col(c.column).isNotNull())
            .groupBy(c.column)
            .agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1)
            .agg(F.count(F.lit(1)).cast("long").alias("failures"))
        )
        parts.append(dup.select(
            F.lit(c.label).alias("test_name"), F.lit(model).alias("model"), F.lit(c.column).alias("column_name"),
            F.lit(c.severity).alias("severity"), "failures",
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return with_status(out)


def with_status(results: DataFrame) -> DataFrame:
    """Status, dotted test id (``test.strata.<model>.<test>__<column>``) and message."""
    failures = F.col("failures")
    status = F.when(failures == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return results.select(
        "test_name", "model", "column_name", "severity", "failures",
        status.alias("status"),
        F.concat_ws(
            ".", F.lit("test"), F.lit("strata"), F.col("model"),
            F.concat(F.col("test_name"), F.lit("__"), F.col("column_name")),
        ).alias("unique_id"),
        F.concat(F.lit("Got "), failures.cast("string"), F.lit(" results, configured to fail if != 0")).alias("message"),
    )


# --- checks inside the write ----------------------------------------------------------

def measures(checks: Sequence[Check]) -> dict[str, Column]:
    """Counts that a write can collect on the way: rows, and the offending rows of every check but ``unique``.

    For ``accepted_values`` they say whether there are any; which distinct values, a scan has to tell.
    """
    out = {"rows": F.count(F.lit(1))}
    for i, c in enumerate(checks):
        if c.kind == "accepted_values":
            out[f"c{i}"] = F.count_if(~F.col(c.column).isin(*c.values))
        elif c.kind != "unique":
            out[f"c{i}"] = F.count_if(_row_condition(c))
    return out


def results_from(df: DataFrame, model: str, checks: Sequence[Check], measured: dict[str, int]) -> DataFrame:
    """What ``run_checks`` gives, from counts collected while the table was written.

    Only uniqueness, and lists of accepted values that were broken, look at the table.
    """
    known, open_ = [], []
    for i, c in enumerate(checks):
        failures = measured.get(f"c{i}")
        if failures is None or (c.kind == "accepted_values" and failures):
            open_.append(c)
        else:
            known.append((c.label, model, c.column, c.severity, int(failures)))
    out = None
    if known:
        schema = "test_name string, model string, column_name string, severity string, failures long"
        out = with_status(df.sparkSession.createDataFrame(known, schema))
    if open_:
        rest = run_checks(df, model, open_)
        out = rest if out is None else out.unionByName(rest)
    return out


def stop_on_failures(model: str, checks: Sequence[Check]):
    """A gate for a write: raises when a measured check of severity error has failures (Q14)."""
    def gate(measured: dict[str, int]) -> None:
        bad = {f"{c.label}({c.column})": measured[f"c{i}"] for i, c in enumerate(checks)
               if c.severity == "error" and measured.get(f"c{i}")}
        if bad:
            raise QualityGateError(f"quality gate failed before {model} was replaced: {bad}")
    return gate


def run_suite(tables: dict[str, DataFrame], suite: dict[str, Sequence[Check]]) -> DataFrame:
    """Checks of several models as one frame (a union of small aggregates)."""
    out = None
    for model, checks in suite.items():
        part = run_checks(tables[model], model, checks)
        out = part if out is None else out.unionByName(part)
    return out


# --- freshness (Q8, Q13) ------------------------------------------------------------

def freshness(
    sources: dict[str, DataFrame],
    thresholds: dict[str, tuple[float, float]],
    as_of: _dt.datetime | None = None,
    loaded_at: str = "_ingested_at",
) -> DataFrame:
    """Age of ``max(loaded_at)`` per source against (warn, error) hours.

    One row per source: source, max_loaded_at, age_hours, status (pass, warn,
    error). A source without rows has no load time and is an error.
    """
    now = ts_literal(as_of)
    out = None
    for name, df in sources.items():
        warn_h, error_h = thresholds[name]
        part = df.agg(F.max(loaded_at).cast("timestamp_ntz").alias("max_loaded_at")).select(
            F.lit(name).alias("source"),
            "max_loaded_at",
            F.lit(float(warn_h)).alias("warn_after_hours"),
            F.lit(float(error_h)).alias("error_after_hours"),
        )
        out = part if out is None else out.unionByName(part)
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3.6e9)
    return out.select(
        "source",
        "max_loaded_at",
        round_money(age, 2).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age > F.col("error_after_hours"), "error")
        .when(age > F.col("warn_after_hours"), "warn")
        .otherwise("pass").alias("status"),
    )


def freshness_log(fresh: DataFrame) -> DataFrame:
    """Q13: report lines for sources in warn or error."""
    return fresh.where(F.col("status").isin("warn", "error")).select(
        "source",
        "status",
        F.concat(
            F.lit("FRESHNESS "), F.upper("status"), F.lit(": "), F.col("source"),
            F.lit(" - loaded_at: "),
            F.coalesce(F.date_format("max_loaded_at", "yyyy-MM-dd HH:mm:ss"), F.lit("never")),
        ).alias("line"),
    )


# --- gate (Q14) -------------------------------------------------------------------

class QualityGateError(RuntimeError):
    pass


def require_passed(results: DataFrame, count_warn: bool = False) -> dict[str, int]:
    """Raise when any check failed or errored (warn counts only if asked).

    One aggregate row crosses to the driver.
    """
    row = results.agg(
        F.count_if(F.col("status") == "fail").alias("fail"),
        F.count_if(F.col("status") == "error").alias("error"),
        F.count_if(F.col("status") == "warn").alias("warn"),
    ).first()
    counts = {k: int(row[k]) for k in ("fail", "error", "warn")}
    bad = counts["fail"] + counts["error"] + (counts["warn"] if count_warn else 0)
    if bad:
        raise QualityGateError(f"quality gate failed: {counts}")
    return counts
