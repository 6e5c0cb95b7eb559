"""Change log of keyed tables: which groups every upsert touched.

An upsert records the group values (days, customers, categories) of the rows it
brings and of the rows they replace, before it commits its data. Tables
that are aggregated from it rebuild the groups recorded since the entry they read last, so late rows and
rows that left a group are found without looking at the rest of the source. An
entry without a commit, after a crash, only makes a reader rebuild groups that hadn't changed.

Entries are numbered folders; a table has one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.sources.ingest import _fs, _read_text, _write_text, table_root


def _root(base: str, layer: str, name: str) -> str:
    return f"{table_root(base, layer, name)}/changes"


def entries(spark: SparkSession, base: str, layer: str, name: str) -> list[int]:
    fs, root = _fs(spark, _root(base, layer, name))
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    return sorted(int(n[4:]) for n in names if n.startswith("seq="))


def last_entry(spark: SparkSession, base: str, layer: str, name: str) -> int:
    return max(entries(spark, base, layer, name), default=0)


def record(groups: DataFrame, base: str, layer: str, name: str) -> int:
    """Write the distinct group values as the next entry."""
    number = last_entry(groups.sparkSession, base, layer, name) + 1
    groups.distinct().write.parquet(f"{_root(base, layer, name)}/seq={number:012d}")
    return number


def read_since(spark: SparkSession, base: str, layer: str, name: str, after: int, columns: Sequence[str]) -> DataFrame | None:
    """Distinct values of ``columns`` in the entries after number ``after``; None without such entries."""
    root = _root(base, layer, name)
    folders = [f"{root}/seq={n:012d}" for n in entries(spark, base, layer, name) if n > after]
    return spark.read.parquet(*folders).select(*columns).distinct() if folders else None


def forget(spark: SparkSession, base: str, layer: str, name: str, upto: int) -> None:
    """Delete the entries that every reader has read; the last one stays, since it carries the number."""
    known = entries(spark, base, layer, name)
    for n in known[:-1]:
        if n <= upto:
            fs, folder = _fs(spark, f"{_root(base, layer, name)}/seq={n:012d}")
            fs.delete(folder, True)


def read_marks(spark: SparkSession, base: str, layer: str, name: str) -> dict[str, int] | None:
    """The entry of each source that a derived table has read last."""
    text = _read_text(spark, f"{table_root(base, layer, name)}/_CHANGES")
    return json.loads(text) if text else None


def write_marks(spark: SparkSession, base: str, layer: str, name: str, marks: Mapping[str, int]) -> None:
    _write_text(spark, f"{table_root(base, layer, name)}/_CHANGES", json.dumps(dict(marks)))
