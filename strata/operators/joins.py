"""Join helpers.

No join is forced to broadcast: the session's threshold and adaptive execution
decide by the sizes they see at run time. The one exception is a side that is
one row by construction, and that is checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: Column,
    dim_key: str,
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Left join to a small dimension on an expression key, with defaults on miss.

    ``defaults`` maps dimension output columns to the value used when no row
    matched (``COALESCE(dim.col, default)``).
    """
    d = dim
    joined = fact.join(d, fact_key == d[dim_key], "left")
    for name, default in (defaults or {}).items():
        joined = joined.withColumn(name, F.coalesce(d[name], default))
    return joined


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Cross join with a frame of one row (a global aggregate).

    The one-row side is broadcast and every row of ``df`` gains its columns
    without a shuffle. A frame of several rows raises instead of multiplying
    ``df``: the side is folded to its first row and its count is checked.
    """
    cols = one_row.columns
    folded = one_row.select(F.struct(*cols).alias("r")).agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("r"))
    checked = F.when(F.col("n") == 1, F.col("r")).otherwise(
        F.raise_error(F.lit("attach_one_row needs exactly one row")).cast(folded.schema["r"].dataType)
    )
    return df.crossJoin(F.broadcast(folded.select(checked.alias("r")).select(*[F.col(f"r.{c}") for c in cols])))


def attach_latest(df: DataFrame, series: DataFrame, order_col: str, prefix_cols: Sequence[str] | None = None) -> DataFrame:
    """Attach the row of ``series`` with the greatest ``order_col`` to every row.

    ``LEFT JOIN t ON t.k = (SELECT MAX(k) FROM t)``: the latest row is found
    with a top-1 (partial top-k per task, one row shuffled per task) and then
    broadcast; an empty series leaves nulls, like the left join.
    """
    latest = series.orderBy(F.col(order_col).desc()).limit(1)
    cols = prefix_cols or series.columns
    latest = latest.select(*cols)
    return df.join(F.broadcast(latest), F.lit(True), "left")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent (``left_anti``); null keys are not orphans."""
    pk = parent_key or child_key
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_pk"), "left_anti")
