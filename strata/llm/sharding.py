"""Sharding by jump consistent hashing, in DataFrame expressions only.

``jump_shard`` maps a stable 64-bit key to one of ``n`` shards without a ring
table: the key drives a linear congruential generator, and each draw names the
next shard count at which the key would move. Growing from n to n + 1 shards
moves about 1 / (n + 1) of the keys, all of them into the new shard.

64-bit wrap-around arithmetic is done on 32-bit halves, so it raises no
overflow under ANSI mode and stays in plain long expressions.

Defined results: a null key hashes as the key 0; equal keys share a shard;
repeated rows get slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import without

# Fixed values of the published generator and of a 64-bit mixing function.
JUMP_MULTIPLIER = 2862933555777941757
MIX_MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_LOW = 0xFFFFFFFF


def _halves(x: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(_LOW))


def _join(high: Column, low: Column) -> Column:
    return F.shiftleft(high, 32).bitwiseOR(low)


def _times(high: Column, low: Column, factor: int, plus: int = 0) -> tuple[Column, Column]:
    """(high, low) of (x * factor + plus) modulo 2**64, by 16-bit pieces of the factor."""
    a0, a1, a2, a3 = ((factor >> s) & 0xFFFF for s in (0, 16, 32, 48))
    mask16 = F.lit(0xFFFF)
    mid = low * F.lit(a1)
    total = low * F.lit(a0) + F.shiftleft(mid.bitwiseAND(mask16), 16) + F.lit(plus)
    upper = (
        F.shiftrightunsigned(total, 32)
        + F.shiftrightunsigned(mid, 16)
        + low * F.lit(a2)
        + F.shiftleft((low * F.lit(a3)).bitwiseAND(mask16), 16)
        + high * F.lit(a0)
        + F.shiftleft((high * F.lit(a1)).bitwiseAND(mask16), 16)
    )
    return upper.bitwiseAND(F.lit(_LOW)), total.bitwiseAND(F.lit(_LOW))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mixed_key(key: Column) -> Column:
    """Spread an integer key over 64 bits, so that runs of ids fall evenly."""
    def folded(x: Column, by: int) -> Column:
        return _let(x, lambda y: y.bitwiseXOR(F.shiftrightunsigned(y, by)))

    def multiplied(x: Column, factor: int) -> Column:
        return _let(x, lambda y: _join(*_times(*_halves(y), factor)))

    z = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    for shift, factor in zip((30, 27), MIX_MULTIPLIERS, strict=True):
        z = multiplied(folded(z, shift), factor)
    return folded(z, 31)


def jump_path(key: Column, most: int) -> Column:
    """Struct (now, before): shard of ``key`` among ``most`` shards and among ``most - 1``.

    The walk visits the shards at which the key settles as the count grows; it
    takes at most ``most`` steps, about ln(most) of which change anything.
    """
    def begin(k: Column) -> Column:
        high, low = _halves(k)
        return F.struct(
            F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), F.lit(0).cast("long").alias("p"),
            high.alias("h"), low.alias("l"),
        )

    def step(s: Column, _: Column) -> Column:
        high, low = _times(s["h"], s["l"], JUMP_MULTIPLIER, 1)

        def moved(drawn: Column) -> Column:
            draw = (F.shiftrightunsigned(drawn["h"], 1) + F.lit(1)).cast("double")
            jump = F.floor((s["j"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / draw)).cast("long")
            return F.struct(
                s["j"].alias("b"), jump.alias("j"), F.when(s["j"] < most - 1, s["j"]).otherwise(s["p"]).alias("p"),
                drawn["h"].alias("h"), drawn["l"].alias("l"),
            )

        return F.when(s["j"] < most, _let(F.struct(high.alias("h"), low.alias("l")), moved)).otherwise(s)

    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(most)), _let(key, begin), step,
        lambda s: F.struct(s["b"].cast("int").alias("now"), s["p"].cast("int").alias("before")),
    )
    return walk


def jump_shard(df: DataFrame, key: Column, n_shards: int, grown: bool = True) -> DataFrame:
    """Add ``shard`` (among ``n_shards``) and, if asked, ``grown_shard`` (among one more).

    ``key`` is a 64-bit integer column; use ``xxhash64`` for other types. Input
    columns named like the results are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    out = df.withColumn("__path", jump_path(mixed_key(key), n_shards + 1))
    out = without(out, "shard", "grown_shard").withColumn("shard", F.col("__path.before"))
    if grown:
        out = out.withColumn("grown_shard", F.col("__path.now"))
    return out.drop("__path")


def number_slots(df: DataFrame, shard: str, order: list[str], buckets: int) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each shard, without gaps.

    No task holds a shard: equal rows are counted before the shuffle, each
    shard is cut into ``buckets`` by a hash of the row, buckets are numbered on
    their own and shifted by the sizes of those before them. Equal rows get
    consecutive slots. Intended for slim frames (ids and sizes, not texts).
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    counted = counted.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = counted.groupBy(shard, "__bucket").agg(F.sum("__n").alias("__size"))
    before = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(
        F.col(shard).alias("__shard"), F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__base"),
    )
    inside = Window.partitionBy(shard, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("__rank", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    joined = ranked.join(base, (ranked[shard] == base["__shard"]) & (ranked["__bucket"] == base["__b"]))
    first = F.col("__base") + F.col("__rank")
    return joined.select(
        *columns, F.explode(F.sequence(first, first + F.col("__n") - 1)).alias("slot")
    )
