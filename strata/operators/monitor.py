"""Row-count monitoring.

Counts of many tables are one Spark job (a union of one-row aggregates);
the day's counts are compared with the previous snapshot by an inner join on
(schema, table), so a table without a baseline is skipped; the snapshot is
upserted by (date, schema, table).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import abs_pct_change, round_money
from strata.operators.incremental import upsert

THRESHOLD_PCT = 30.0  # fixed value: alert when the change is over 30 percent


def table_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(schema_name, table_name, row_count) for every table, in one job."""
    out = None
    for (schema, table), df in tables.items():
        part = df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
            F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), "row_count"
        )
        out = part if out is None else out.unionByName(part)
    return out


def rows_by_source(frames: list[DataFrame]) -> DataFrame:
    """Row count per ``source_system`` over several tables."""
    union = None
    for df in frames:
        part = df.select("source_system")
        union = part if union is None else union.unionByName(part)
    return union.groupBy("source_system").agg(F.count(F.lit(1)).cast("long").alias("row_count"))


def as_snapshot(counts: DataFrame, day: _dt.date) -> DataFrame:
    return counts.select(F.lit(day).alias("snapshot_date"), "schema_name", "table_name", "row_count")


def snapshot_upsert(snapshot: DataFrame | None, counts: DataFrame, day: _dt.date) -> DataFrame:
    """I8: ``INSERT .. ON CONFLICT (date, schema, table) DO UPDATE`` as a frame upsert."""
    return upsert(snapshot, as_snapshot(counts, day), ["snapshot_date", "schema_name", "table_name"])


def row_count_drift(
    today: DataFrame,
    snapshot: DataFrame,
    day: _dt.date,
    threshold_pct: float = THRESHOLD_PCT,
    alerts_only: bool = True,
) -> DataFrame:
    """Q10: tables whose count moved more than ``threshold_pct`` since the day before.

    Output: schema_name, table_name, yesterday_count, today_count, change_pct
    (1 digit), direction (+/-), alert.
    """
    yesterday = snapshot.where(F.col("snapshot_date") == F.lit(day - _dt.timedelta(days=1))).select(
        "schema_name", "table_name", F.col("row_count").alias("yesterday_count")
    )
    joined = today.select("schema_name", "table_name", F.col("row_count").alias("today_count")).join(
        yesterday, ["schema_name", "table_name"], "inner"
    )
    pct = abs_pct_change("today_count", "yesterday_count")
    out = joined.select(
        "schema_name",
        "table_name",
        "yesterday_count",
        "today_count",
        round_money(pct, 1).alias("change_pct"),
        F.when(F.col("today_count") > F.col("yesterday_count"), "+").otherwise("-").alias("direction"),
        (pct > threshold_pct).alias("alert"),
    )
    return out.where(F.col("alert")) if alerts_only else out


def drift_markdown(drift: DataFrame, pipeline: str, when: _dt.datetime | None = None,
                   threshold_pct: float = THRESHOLD_PCT) -> tuple[str, str] | None:
    """Q12: title and Markdown body of the drift message, or None without alerts.

    At most one row per monitored table reaches the driver (the table list is
    fixed), ordered by schema and table.
    """
    rows = (
        drift.where(F.col("alert"))
        .orderBy("schema_name", "table_name")
        .select("schema_name", "table_name", "yesterday_count", "today_count", "change_pct", "direction")
        .collect()
    )
    if not rows:
        return None
    stamp = (when or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y-%m-%d %H:%M UTC")
    lines = [f"{len(rows)} table(s) of `{pipeline}` changed by more than {threshold_pct:.0f} percent ({stamp}):", ""]
    lines += [
        f"- `{r['schema_name']}.{r['table_name']}`: {r['yesterday_count']} rows before, {r['today_count']} now "
        f"({r['direction']}{r['change_pct']:.1f} %)"
        for r in rows
    ]
    return f"{pipeline}: row counts drifted", "\n".join(lines)
