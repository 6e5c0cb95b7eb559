"""Mergeable distinct counts (A3 approximate, A9): HyperLogLog sketches per period, merged without the source.

A daily table of sketches answers distinct counts of any longer period from one
small binary per day and group, where exact counts need all rows again. Sketches
of ``2 ** LG_K`` registers have a relative standard error of 0.83 / sqrt(2 ** LG_K); merged ones of
1.04 / sqrt(2 ** LG_K). The stated bound is three of these (99.7 percent of the estimates).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 13


def error_bound(lg_k: int = LG_K) -> float:
    """Relative error that a merged estimate stays below, but for 0.3 percent of them."""
    return 3 * 1.04 / math.sqrt(2**lg_k)


def daily_sketches(rows: DataFrame, by: Sequence[str], columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``by``, event_count, and ``<column>_sketch`` of each column; a group without values has an empty sketch."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("event_count"), *[F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"{c}_sketch") for c in columns]
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``by``, event_count, ``<column>_sketch`` over the union, and its estimate ``approx_<column>``."""
    merged = sketches.groupBy(*by).agg(
        F.sum("event_count").alias("event_count"), *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns]
    )
    return merged.withColumns({f"approx_{c}": F.hll_sketch_estimate(f"{c}_sketch") for c in columns})
