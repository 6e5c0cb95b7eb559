"""Incremental load and merge.

Parquet has no MERGE, so an upsert is a delete-then-insert expressed as
frames: target rows whose key appears in the incoming batch are dropped
(``left_anti``) and the batch is appended (``unionByName``). The functions are
pure (frame in, frame out); ``strata.sources.ingest.write_table`` persists the
result as a new version.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import EPOCH, in_values

#: Up to this many touched groups are named by literals, which the scan skips row groups by; more meet in a join.
LITERAL_GROUPS = 1000


def max_value(df: DataFrame, column: str, default=EPOCH):
    """One scalar: ``COALESCE(MAX(column), default)``.

    A single value crosses to the driver; it becomes a literal in the source
    filter, which Catalyst pushes into the Parquet scan (row-group skipping).
    """
    row = df.agg(F.max(column).alias("m")).first()
    value = row["m"] if row is not None else None
    return default if value is None else value


def newer_than(
    src: DataFrame,
    target: DataFrame | None,
    column: str,
    target_column: str | None = None,
    inclusive: bool = False,
    lookback: _dt.timedelta | None = None,
    default=EPOCH,
) -> DataFrame:
    """Rows of ``src`` past the target's high-watermark.

    * strict (I1):    ``src.col >  max(target.col)``
    * inclusive (I2): ``src.col >= max(target.col)`` (re-opens the last period)
    * ``lookback`` moves the mark back to also redo late rows (SURVEY G3)
    * no target (first run, I7): everything
    """
    if target is None:
        return src
    mark = max_value(target, target_column or column, default)
    if isinstance(mark, _dt.date) and not isinstance(mark, _dt.datetime):
        mark = _dt.datetime(mark.year, mark.month, mark.day)
    if lookback is not None:
        mark = mark - lookback
    lit = F.lit(mark).cast(src.schema[column].dataType)
    return src.where(F.col(column) >= lit) if inclusive else src.where(F.col(column) > lit)


def align(target: DataFrame, incoming: DataFrame, policy: str = "append_new_columns") -> tuple[DataFrame, DataFrame]:
    """Make target and incoming share columns under a schema-change policy.

    * ``append_new_columns``: keep all target columns, add the new incoming ones
    * ``sync_all_columns``:   columns become exactly the incoming ones
    * ``ignore``:             columns stay exactly the target ones
    * ``fail``:               raise when the column sets differ

    Missing columns are added as typed nulls with ``select`` (no
    ``allowMissingColumns`` on the union; SURVEY §7.5).
    """
    t_cols, i_cols = list(target.columns), list(incoming.columns)
    if policy == "fail" and set(t_cols) != set(i_cols):
        raise ValueError(f"schema changed: target {t_cols} incoming {i_cols}")
    if policy == "append_new_columns":
        cols = t_cols + [c for c in i_cols if c not in t_cols]
    elif policy == "sync_all_columns":
        cols = i_cols
    elif policy in ("ignore", "fail"):
        cols = t_cols
    else:
        raise ValueError(f"unknown policy {policy}")
    types = {f.name: f.dataType for f in incoming.schema.fields}
    types.update({f.name: f.dataType for f in target.schema.fields if f.name not in types})

    def project(df: DataFrame) -> DataFrame:
        return df.select(*[
            F.col(c).cast(types[c]) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in cols
        ])

    return project(target), project(incoming)


def upsert(
    target: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    policy: str = "append_new_columns",
) -> DataFrame:
    """Incoming rows replace every target row sharing the key.

    With a key coarser than the grain (I5) all old rows of that key vanish,
    also those the batch does not repeat (delete+insert, not a row merge). The
    incoming key set is de-duplicated first; the join is left to adaptive execution.
    """
    if target is None:
        return incoming
    t, i = align(target, incoming, policy)
    kept = t.join(i.select(*keys).distinct(), list(keys), "left_anti").select(*t.columns)
    return kept.unionByName(i)


def changed_keys(src: DataFrame, target: DataFrame | None, src_time: str, target_time: str, keys: Sequence[str]) -> DataFrame:
    """Keys with a source row newer than the target's last processing time."""
    fresh = newer_than(src, target, src_time, target_column=target_time)
    return fresh.select(*keys).distinct()


def split_groups(df: DataFrame, touched: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of the touched groups, the other rows); a null key is a group like any other.

    ``touched`` holds distinct keys, as a change log gives them. A few groups of one
    key become literals in the filter of the scan.
    """
    keys = list(keys)
    if len(keys) == 1:
        few = [r[0] for r in touched.select(*keys).limit(LITERAL_GROUPS + 1).collect()]
        if len(few) <= LITERAL_GROUPS:
            inside = in_values(keys[0], few)
            return df.where(inside), df.where(~F.coalesce(inside, F.lit(False)))
    names = touched.select(*[F.col(k).alias(f"_touched_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_touched_{k}"))
    return df.join(names, same, "left_semi"), df.join(names, same, "left_anti")


def rebuild_groups(src: DataFrame, target: DataFrame, touched: DataFrame, keys: Sequence[str], build) -> DataFrame:
    """I3 from a change log: the touched groups are built anew from all their rows, or go when none are left."""
    inside, _ = split_groups(src, touched, keys)
    _, others = split_groups(target, touched, keys)
    kept, new = align(others, build(inside))
    return kept.unionByName(new)


def recompute_changed(
    src: DataFrame,
    target: DataFrame | None,
    src_time: str,
    target_time: str,
    keys: Sequence[str],
    build,
    partial: bool = False,
    count_column: str | None = None,
) -> DataFrame:
    """I3 + G4: rebuild only the groups touched since the last run.

    Default: aggregate ALL source rows of each changed group (correct). With
    ``count_column`` (the target's number of source rows per group) a group that
    rows have left is found as well, by its count: it is rebuilt, or removed
    when nothing is left of it. ``partial=True`` reproduces the reference, which
    aggregates only the changed rows and lets that partial result replace the
    whole group. Where the source keeps a change log, ``rebuild_groups`` needs
    neither the time filter nor the counts.
    """
    if target is None:
        return build(src)
    fresh = newer_than(src, target, src_time, target_column=target_time)
    if partial:
        return upsert(target, build(fresh), keys)
    touched = fresh.select(*keys).distinct()
    if count_column:
        now = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_now"))
        before = target.select(*keys, F.col(count_column).alias("_before"))
        same = F.lit(True)
        for k in keys:
            same = same & now[k].eqNullSafe(before[k])
        left = before.join(now, same, "left").where(F.coalesce("_now", F.lit(0)) != F.col("_before"))
        touched = touched.unionByName(left.select(*[before[k] for k in keys])).distinct()
    rebuilt = build(src.join(touched, list(keys), "left_semi"))
    kept, new = align(target.join(touched, list(keys), "left_anti").select(*target.columns), rebuilt)
    return kept.unionByName(new)
