"""Check result summary and failure report.

The summary and the capped failure table are computed by Spark; only the
final, bounded rows (one summary row, at most ``max_rows`` failures) reach the
driver to be rendered as Markdown text.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import clean_report_text, id_part

STATUSES = ("pass", "fail", "error", "warn")
MAX_ROWS = 20


def summarize(results: DataFrame) -> DataFrame:
    """One row with counts by status, total and overall status."""
    counts = [F.count_if(F.col("status") == s).cast("long").alias(f"{s}_count") for s in STATUSES]
    one = results.agg(*counts, F.count(F.lit(1)).cast("long").alias("total"))
    failed = (F.col("fail_count") + F.col("error_count")) > 0
    return one.withColumn("overall_status", F.when(failed, "FAILED").otherwise("PASSED"))


def failure_rows(results: DataFrame) -> DataFrame:
    """test and model from the dotted id; F20: cleaned message."""
    parts = F.size(F.split(F.col("unique_id"), r"\."))
    return results.where(F.col("status").isin("fail", "error")).select(
        F.col("unique_id"),
        id_part("unique_id", 1).alias("test"),
        F.when(parts > 2, id_part("unique_id", 2)).otherwise(F.col("unique_id")).alias("model"),
        F.coalesce(F.col("column_name"), F.lit("-")).alias("column_name"),
        clean_report_text("message", 80).alias("message"),
    )


def failure_report(results: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """T4: the first ``max_rows`` failures (by id) and how many more there are.

    The cap is the feature (a chat message table); ``more_failures`` keeps the
    remainder visible.
    """
    rows = failure_rows(results)
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    top = rows.orderBy("unique_id").limit(max_rows)
    return top.crossJoin(F.broadcast(total)).select(
        "test", "model", "column_name", "message",
        F.greatest(F.col("_total") - F.lit(max_rows), F.lit(0)).cast("long").alias("more_failures"),
    )


def markdown(summary: DataFrame, failures: DataFrame, pipeline: str,
             when: _dt.datetime | None = None) -> tuple[str, str]:
    """Q12: title and Markdown body from the summary row and the capped failure rows."""
    s = summary.first()
    stamp = (when or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y-%m-%d %H:%M UTC")
    if s["overall_status"] != "FAILED":
        return (f"{pipeline}: checks passed",
                f"All {s['total']} checks ran at {stamp}: {s['pass_count']} passed, {s['warn_count']} with a warning.")
    rows = failures.collect()
    lines = [f"{s['fail_count'] + s['error_count']} of {s['total']} checks failed at {stamp} ({s['pass_count']} passed):", ""]
    lines += [f"- `{r['model']}`, column `{r['column_name']}`, check `{r['test']}`: {r['message']}" for r in rows]
    more = rows[0]["more_failures"] if rows else 0
    if more > 0:
        lines.append(f"- and {more} more")
    return f"{pipeline}: checks failed", "\n".join(lines)
