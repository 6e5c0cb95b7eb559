"""Latest row per key: ``DISTINCT ON (key) ... ORDER BY key, t DESC``.

Planned as ``row_number() == 1`` over a window partitioned by the key. Spark
inserts a partial ``WindowGroupLimit`` before the shuffle, so each map task
forwards at most one row per key: a key holding a third of all rows costs one
row per task on the wire, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERABLE = (
    T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
    T.TimestampNTZType, T.BinaryType,
)


def rest_tiebreak(df: DataFrame, exclude: Sequence[str]) -> list[Column]:
    """A full order over all remaining (orderable) columns, ascending, nulls first.

    Rows still tied after it are equal in every column that is kept, so the
    choice among them cannot change the output.
    """
    skip = set(exclude)
    return [
        F.col(f.name).asc_nulls_first()
        for f in df.schema.fields
        if f.name not in skip and isinstance(f.dataType, _ORDERABLE)
    ]


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] | None = None,
    tiebreak: Sequence[Column] | str | None = "rest",
) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by`` (default: newest load first).

    ``order_by`` defaults to ``_ingested_at DESC NULLS FIRST`` (PostgreSQL's
    DESC order). ``tiebreak="rest"`` appends every other column so the winner
    is deterministic (SURVEY G10); pass explicit columns or None instead.
    """
    order = list(order_by) if order_by is not None else [F.col("_ingested_at").desc_nulls_first()]
    if tiebreak == "rest":
        order += rest_tiebreak(df, keys)
    elif tiebreak:
        order += list(tiebreak)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
