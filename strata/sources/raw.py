"""Raw tables laid out by load period, and reads that open only what a watermark leaves.

Every append goes to folders of the rows' load day (or month, ``grain="month"``, where
loads are small). A read after a watermark names the folders from one
listing of the table's root, hands only those to Spark, and repeats the choice as a partition filter with
literals. The columns are recorded beside the data, so no footer is opened to infer
them: the cost of a read follows the loads since the mark, not the history.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.ingest import _fs, _read_text, _write_text, measured_write, path_exists

LOADED = "_ingested_at"
LOAD_DAY = "_load_day"


def load_period(grain: str = "day") -> Column:
    day = F.to_date(F.col(LOADED))
    return F.trunc(day, "MM") if grain == "month" else day


def recorded_columns(spark: SparkSession, path: str) -> T.StructType | None:
    text = _read_text(spark, f"{path}/_SCHEMA")
    return T.StructType.fromJson(json.loads(text)) if text else None


def append_loads(df: DataFrame, path: str, grain: str = "day", measures: Mapping[str, Column] | None = None) -> None:
    """Append rows under their load period; a column keeps the type it came with first, new columns are added.

    Rows without a load time go to a folder of their own, which only a read
    without watermark opens. ``measures`` are counted by the write and added to the table's record. An
    append that dies leaves its pending mark, and the record counts no more.
    """
    spark = df.sparkSession
    known = recorded_columns(spark, path) or T.StructType([])
    types = {f.name: f.dataType for f in known.fields}
    columns = [*known.fields, *[T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name not in types]]
    rows = df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    if len(columns) > len(known.fields):  # recorded first: a column without data reads as null
        _write_text(spark, f"{path}/_SCHEMA", T.StructType(columns).json())
    # rebalance: few files per period, and several writers for a large one
    placed = rows.withColumn(LOAD_DAY, load_period(grain)).hint("rebalance", LOAD_DAY)
    write = lambda frame: frame.write.mode("append").partitionBy(LOAD_DAY).parquet(path)
    before = _read_text(spark, f"{path}/_MEASURES")
    pending = path_exists(spark, f"{path}/_PENDING")
    _write_text(spark, f"{path}/_PENDING", "append")
    found = measured_write(placed, measures or {"rows": F.count(F.lit(1))}, write)
    if not pending and (before or not known.fields):
        total = json.loads(before) if before else {}
        _write_text(spark, f"{path}/_MEASURES", json.dumps({k: v + total.get(k, 0) for k, v in found.items()}))
        fs, mark = _fs(spark, f"{path}/_PENDING")
        fs.delete(mark, False)


def appended_measures(spark: SparkSession, path: str) -> dict[str, int] | None:
    """The sums recorded by all appends; None where one of them died or had no record."""
    if path_exists(spark, f"{path}/_PENDING"):
        return None
    text = _read_text(spark, f"{path}/_MEASURES")
    return json.loads(text) if text else None


def _periods(spark: SparkSession, path: str) -> list[_dt.date]:
    fs, root = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{LOAD_DAY}=")]
    return sorted(_dt.date.fromisoformat(v) for v in values if v[:1].isdigit())


def read_loads(spark: SparkSession, path: str, since: _dt.datetime | None = None) -> DataFrame:
    """The raw table; with ``since`` only the folders that can hold later rows, and of them the later rows."""
    columns = recorded_columns(spark, path)
    after = F.col(LOADED) > F.lit(since).cast("timestamp_ntz")
    if columns is None:  # files landed by other means
        rows = spark.read.parquet(path)
        return rows if since is None else rows.where(after)
    schema = T.StructType([*columns.fields, T.StructField(LOAD_DAY, T.DateType())])
    reader = spark.read.schema(schema).option("basePath", path)
    if since is None:
        return reader.parquet(path).drop(LOAD_DAY)
    day = since.date()
    month = day.replace(day=1)  # a folder of a whole month is named by its first day
    folders = [f"{path}/{LOAD_DAY}={p}" for p in _periods(spark, path) if p >= day or p == month]
    if not folders:
        return spark.createDataFrame([], columns)
    wanted = (F.col(LOAD_DAY) >= F.lit(day)) | (F.col(LOAD_DAY) == F.lit(month))
    return reader.parquet(*folders).where(wanted & after).drop(LOAD_DAY)


def has_loads(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)
