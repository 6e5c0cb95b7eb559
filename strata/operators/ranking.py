"""Ranking over a whole frame.

``RANK() OVER (ORDER BY x DESC)`` with no PARTITION BY puts every row in one
task. That is fine for frames whose size does not grow with the data (one row
per day, per category), and ``plain_rank`` is used there. Frames that
do grow (one row per customer) are ranked by their values:

1. histogram of distinct values (partial aggregation, so a hot value is one
   row per task before the shuffle);
2. splitters from a mergeable quantile sketch of the values: one row, which
   every task holds; a value's bucket is the number of splitters below it;
3. totals per bucket give the rows before each bucket (one row per bucket), a
   window inside each bucket the rows before each value;
4. ``rank = 1 + rows before the bucket + rows before the value``; rows get their
   rank by an equi-join.

Ties get equal ranks and the next rank skips, exactly like ``RANK``. Everything is one
lazy plan: nothing runs while it is built. Nulls are the greatest value in
either direction, as in PostgreSQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets at most; each holds about the same number of distinct values.
MOST_BUCKETS = 512


def order_expr(column: str, descending: bool = True) -> Column:
    """PostgreSQL order: DESC puts nulls first, ASC puts them last."""
    c = F.col(column)
    return c.desc_nulls_first() if descending else c.asc_nulls_last()


def plain_rank(df: DataFrame, column: str, out: str, descending: bool = True) -> DataFrame:
    """W1 on a frame of bounded size (single-task window)."""
    return df.withColumn(out, F.rank().over(Window.orderBy(order_expr(column, descending))).cast("long"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """_rv, _n: the distinct values of a column and their rows."""
    return df.groupBy(F.col(column).alias("_rv")).agg(F.count(F.lit(1)).alias("_n"))


def top_values(hist: DataFrame, k: int, descending: bool = True) -> DataFrame:
    """_rv, _rank of the values with rank up to ``k``: at most k rows, from a partial top-k per task."""
    best = hist.orderBy(order_expr("_rv", descending)).limit(k)
    before = Window.orderBy(order_expr("_rv", descending)).rowsBetween(Window.unboundedPreceding, -1)
    ranked = best.select("_rv", (F.lit(1) + F.coalesce(F.sum("_n").over(before), F.lit(0))).cast("long").alias("_rank"))
    return ranked.where(F.col("_rank") <= k)


def top_k_rank(df: DataFrame, column: str, out: str, k: int, descending: bool = True) -> DataFrame:
    """W1 + T2: rows with ``rank <= k``, ties kept.

    The values that make the cut are found from the histogram and filter the
    rows, so rows tied at the k-th value stay where they are: no task sees them all.
    """
    best = top_values(histogram(df, column), k, descending)
    # at most k rows
    kept = df.join(F.broadcast(best), F.col(column).eqNullSafe(F.col("_rv")))
    return kept.withColumn(out, F.col("_rank")).drop("_rv", "_rank")


def _scale(column: str, kind: T.DataType) -> Column:
    """A number that orders like the column, but for ties; the sketch and the buckets are made of it."""
    c = F.col(column)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        start = F.substring(F.encode(c, "utf-8") if isinstance(kind, T.StringType) else c, 1, 7)
        return F.conv(F.rpad(F.hex(start), 14, "0"), 16, 10).cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def ranks_from_histogram(hist: DataFrame, values: list[str], scale: Column, descending: bool, buckets: int | None = None,
                         by: list[str] | None = None) -> DataFrame:
    """``hist`` with ``_rank``: the rank of each row of values, which ``_n`` rows have, within the groups ``by``."""
    by = by or []
    spark = hist.sparkSession
    n = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200")), MOST_BUCKETS)
    hist = hist.withColumn("_scale", scale)
    cuts = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    # one row per group, of at most MOST_BUCKETS numbers
    sketch = hist.groupBy(*by).agg(F.percentile_approx("_scale", cuts).alias("_cuts"))
    placed = hist.join(F.broadcast(sketch), by, "left") if by else hist.crossJoin(F.broadcast(sketch))
    below = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<double>")), lambda s: s < F.col("_scale")))
    placed = placed.withColumn("_bucket", F.when(F.col("_scale").isNull(), n + 1).otherwise(below)).drop("_cuts")
    order = order_expr("_bucket", descending)
    totals = placed.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_bn"))
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # at most MOST_BUCKETS + 2 rows per group
    offsets = totals.select(*by, "_bucket", F.coalesce(F.sum("_bn").over(earlier), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*[order_expr(v, descending) for v in values]).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    ranks = local.join(F.broadcast(offsets), [*by, "_bucket"])
    rank = (F.lit(1) + F.col("_off") + F.col("_before")).cast("long").alias("_rank")
    return ranks.select(*by, *values, rank)


def value_ranks(df: DataFrame, column: str, out: str, descending: bool = True, buckets: int | None = None) -> DataFrame:
    """Distinct values of ``column`` with their ``RANK`` over all rows of ``df``."""
    hist = histogram(df, column)
    ranks = ranks_from_histogram(hist, ["_rv"], _scale("_rv", df.schema[column].dataType), descending, buckets)
    return ranks.select(F.col("_rv").alias(column), F.col("_rank").alias(out))


def global_rank(df: DataFrame, column: str, out: str, descending: bool = True) -> DataFrame:
    """W1 on a frame of any size: every row gains its ``RANK`` as ``out``."""
    ranks = value_ranks(df, column, out, descending).withColumnRenamed(column, "_rv")
    return df.join(ranks, F.col(column).eqNullSafe(F.col("_rv")), "left").drop("_rv")


def attach_ranks(rows: DataFrame, population: DataFrame, column: str, out: str, descending: bool = True) -> DataFrame:
    """Ranks of ``rows`` (a selection, e.g. a top-k) among all of ``population``."""
    ranks = value_ranks(population, column, out, descending).withColumnRenamed(column, "_rv")
    return rows.join(ranks, F.col(column).eqNullSafe(F.col("_rv"))).drop("_rv")


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _stacked(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Numeric columns one below the other: ``keep``, _spec (place in the list), _vl (whole numbers), _vd (doubles)."""
    parts = []
    for i, c in enumerate(columns):
        whole = isinstance(df.schema[c].dataType, _WHOLE)
        parts.append(F.struct(
            F.lit(i).alias("_spec"), (F.col(c) if whole else F.lit(None)).cast("long").alias("_vl"),
            (F.lit(None) if whole else F.col(c)).cast("double").alias("_vd"),
        ))
    return df.select(*keep, F.inline(F.array(*parts)))


def attach_ranks_many(rows: DataFrame, population: DataFrame, specs: list[tuple[str, str]], descending: bool = True) -> DataFrame:
    """Several ``attach_ranks`` of numeric columns, (column, output name) each, from ONE pass over ``population``."""
    columns = [c for c, _ in specs]
    hist = _stacked(population, columns, []).groupBy("_spec", "_vl", "_vd").agg(F.count(F.lit(1)).alias("_n"))
    scale = F.coalesce(F.col("_vl").cast("double"), F.col("_vd"))
    ranks = ranks_from_histogram(hist, ["_vl", "_vd"], scale, descending, by=["_spec"]).select(
        F.col("_spec").alias("_s"), F.col("_vl").alias("_l"), F.col("_vd").alias("_d"), "_rank")
    marked = rows.withColumn("_row", F.monotonically_increasing_id())
    asked = _stacked(marked, columns, marked.columns)
    same = (F.col("_spec") == F.col("_s")) & F.col("_vl").eqNullSafe(F.col("_l")) & F.col("_vd").eqNullSafe(F.col("_d"))
    found = asked.join(ranks, same)
    outs = [F.max(F.when(F.col("_spec") == i, F.col("_rank"))).alias(out) for i, (_, out) in enumerate(specs)]
    return found.groupBy(*marked.columns).agg(*outs).drop("_row")
