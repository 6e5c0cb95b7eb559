"""Exact n-gram Jaccard join in metric space: pivots, Voronoi regions, triangle-inequality windows.

1 - Jaccard is a metric. Two documents link when their distance is at most e = 1 - num / den.

1. Equal sets are one node. With all shingles in one order (of their hashes), linked sets share
   at least l of their first n - ceil(t * n) + l shingles; nodes whose heads hold too few shingles that any
   other node's head holds can't link and stay alone. The others' whole sets are read, and nodes of
   which too many shingles are in no other of these sets fall away as well.
2. Levels: pivots are the central nodes of those that are left: of the nodes that hold a shingle the one whose
   shingles are the most common leads it, and a node that leads half of its shared shingles is a pivot. Two nodes
   that share more than half can't both be, so pivots lie apart and a family of copies meets few of them. All
   nodes within 2e of a pivot are found through the heads for that distance, and their distances
   measured on whole sets. A node within e of a pivot is linked to it and lies in the region of its nearest one.
3. Windows: a link from a node x of the region of p ends within d(x, p) + e of p. So the nodes between e and 2e
   from p are replicated to its region, and meet there those x with d(x, p) >= d(y, p) - e, in blocks of bounded size.
   (Nodes closer to p are linked to p, like all of the region, and need not meet.)
4. Pivots and the nodes of regions are settled: every link that they have is known or
   implied. The rest goes to the next level, where nodes without enough shingles shared with the rest
   fall away again. Every level settles the most central node of each family that is left; after ``LEVELS``
   of them every node is a pivot.

Links are exact: no estimate decides, and no pair within e is left out except where both ends are already
joined through the same pivot, so the components are those of all links.

Defined results: null, blank and empty texts have no shingles and link with nothing; fewer words than a shingle
make one shingle of all; repeated rows share a node; null doc_ids take part, but never name a
component that has another id. Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import doc_blocks, ragged, release, stage, stage_parts
from strata.llm.graph import components
from strata.llm.neardup import BROADCAST_IDS, Settings, common_counts, full_sets, shingle_sets

#: A head is longer by n // EXTRA shingles than one that holds a single common one, and must hold as many more of them.
EXTRA = 8
#: Levels with central pivots, at most; at the one after them every node that is left is a pivot.
LEVELS = 5
#: Up to this many nodes that are left with a shingle meet in a join; more of them in blocks.
SHORT_LIST = 16
#: Nodes and shingles of one side of a block in a region, about.
BLOCK_NODES = 256
BLOCK_SHINGLES = 400_000
#: Heads are counted, and texts beyond BROADCAST_IDS fetched, in so many parts, one after another.
PARTS = 4
#: Sets travel for so many pairs, or in blocks with so many shingles, at once; more where that is half of all sets.
PAIRS_AT_ONCE = 1 << 17
SHINGLES_AT_ONCE = 1 << 24


def _ceil_share(n, num: int, den: int):
    return (n * num + (den - 1)) // den


def heads(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, th, n (shingles), nid (null without words), need, head: see step 1."""

    def run(batches):
        for part, data, offsets in doc_blocks(batches):
            sets = shingle_sets(data, offsets, s.words)
            n = np.array([len(x) for x in sets], np.int64)
            length = np.where(n > 0, n - _ceil_share(n, s.num, s.den) + 1 + n // EXTRA, 0)
            nid = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("th"), pa.array(n), pa.array(nid, pa.int64()), pa.array(1 + n * s.num // (s.den * EXTRA)),
                ragged(np.concatenate([*[x[:k] for x, k in zip(sets, length)], np.empty(0, np.int64)]), np.minimum(length, n), pa.int64()),
            ], names=["doc_id", "th", "n", "nid", "need", "head"])

    slim = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    return slim.mapInArrow(run, "doc_id long, th long, n long, nid long, need long, head array<bigint>")


def sharing(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes (nid, rep) whose heads hold enough shingles of other heads.

    rows: ``heads``; the rows of a node hold equal heads, so each adds what the node has in common.
    """
    values = rows.where("nid IS NOT NULL").select("nid", F.explode("head").alias("v"))

    def counts(part: DataFrame) -> DataFrame:
        several = part.groupBy("v").agg(F.min("nid").alias("a"), F.max("nid").alias("b")).where("a < b").select("v")
        return part.join(several, "v", "left_semi").groupBy("nid").agg(F.count(F.lit(1)).alias("c"))

    # a part of the shingles at a time, so that less than the heads themselves is shuffled at once
    counted = stage_parts((counts(values.where(F.pmod("v", F.lit(PARTS)) == i)) for i in range(PARTS)), "head-counts")
    counted = counted.groupBy("nid").agg(F.sum("c").alias("c"))
    return nodes.join(counted, "nid").where("c >= need * copies").select("nid", "rep")


def whole_sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """nid, n, vals of the wanted nodes (nid, doc_id, th), staged. Where their ids can't be broadcast and texts have
    to meet them in a shuffle, a part of the texts does so at a time."""
    parts = 1 if wanted.count() <= BROADCAST_IDS else PARTS
    mine = lambda f, th, i: f.where(F.pmod(th, F.lit(parts)) == i) if parts > 1 else f
    return stage_parts((
        full_sets(mine(docs, F.xxhash64("text"), i), mine(wanted, F.col("th"), i), s).dropDuplicates(["nid"]) for i in range(parts)
    ), "sets")


def linkable(sets: DataFrame, alive: DataFrame, s: Settings) -> DataFrame:
    """nid, n, u of the alive nodes that could link: u shingles are in no other alive set."""
    mine = sets.join(alive.select("nid"), "nid", "left_semi")
    rows = mine.select("nid", F.explode("vals").alias("v"))
    single = rows.groupBy("v").agg(F.min("nid").alias("nid"), F.max("nid").alias("b")).where("nid = b")
    own = single.groupBy("nid").agg(F.count(F.lit(1)).alias("u"))
    both = mine.select("nid", "n").distinct().join(own, "nid", "left").select("nid", "n", F.coalesce("u", F.lit(0)).alias("u"))
    return both.where((F.col("n") - F.col("u")) * s.den >= F.col("n") * s.num)


def _reaches(inter: Column, a: Column, b: Column, num: int, den: int) -> Column:
    return inter * den >= (a + b - inter) * num


def _prefix(sets: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """nid, n, u, v: the first shingles of each node, of which two nodes with similarity num / den share one."""
    n = F.col("n")
    length = (n - F.floor((n * num + (den - 1)) / den) + 1).cast("int")
    return sets.join(nodes.select("nid", "u"), "nid").select("nid", "n", "u", F.explode(F.slice("vals", 1, length)).alias("v"))


def central(sets: DataFrame, alive: DataFrame, s: Settings) -> DataFrame:
    """nid, n, u of the pivots: the nodes that lead half of the shingles (of their heads) that they share."""
    rows = stage(_prefix(sets, alive, s.num, s.den).select("nid", "v"), "head-rows")
    common = rows.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    score = rows.join(common, "v", "left").groupBy("nid").agg(
        F.avg(F.coalesce("c", F.lit(0))).alias("score"), F.count("c").alias("k")).where("k > 0")
    score = stage(score, "scores")
    leaders = rows.join(score, "nid").groupBy("v").agg(
        F.max(F.struct("score", "k", "nid")).alias("t"), F.count(F.lit(1)).alias("c")).where("c > 1")
    led = leaders.groupBy(F.col("t.nid").alias("nid")).agg(F.count(F.lit(1)).alias("led"), F.max("t.k").alias("k"))
    return stage(alive.join(led.where("2 * led >= k").select("nid"), "nid"), "pivots")


def distances(sets: DataFrame, pivots: DataFrame, alive: DataFrame, num: int, den: int, once: bool) -> DataFrame:
    """p, y, np, ny, inter: the nodes y whose similarity to p is at least num / den (``once``: y < p only). Staged.

    pivots, alive: rows of ``_prefix`` for that similarity.
    """
    named = lambda f, x: f.select(F.col("nid").alias(x), F.col("n").alias(f"n{x}"), F.col("u").alias(f"u{x}"), "v")
    met = named(pivots, "p").join(named(alive, "y"), "v")
    met = met.where(F.col("y") < F.col("p") if once else F.col("y") != F.col("p"))
    most = F.least(F.col("np") - F.col("up"), F.col("ny") - F.col("uy"))  # shingles that others have as well
    counted = met.where(_reaches(most, F.col("np"), F.col("ny"), num, den)).groupBy("p", "y", "np", "ny").agg(F.count(F.lit(1)).alias("c"))
    # what the two share beyond their heads lies after the head that ends first
    rest = F.floor((F.greatest("np", "ny") * num + (den - 1)) / den) - 1
    pairs = stage(counted.where(_reaches(F.col("c") + rest, F.col("np"), F.col("ny"), num, den)).select("p", "y"), "met")
    total = pairs.count()
    # a part of the pairs at a time, so the sets that travel with them stay in proportion to the input
    parts = total // max(PAIRS_AT_ONCE, sets.count() // 2) + 1

    def exact(some: DataFrame) -> DataFrame:
        used = sets
        if total // parts <= BROADCAST_IDS:
            used = sets.join(F.broadcast(some.select(F.col("p").alias("nid")).union(some.select("y")).distinct()), "nid", "left_semi")
        side = lambda x: used.select(F.col("nid").alias(x), F.col("n").alias(f"n{x}"), F.col("vals").alias(f"v{x}"))
        both = some.join(side("p"), "p").join(side("y"), "y").withColumn("inter", F.size(F.array_intersect("vp", "vy")))
        return both.where(_reaches(F.col("inter"), F.col("np"), F.col("ny"), num, den)).select("p", "y", "np", "ny", "inter")

    part = F.pmod(F.xxhash64("p", "y"), F.lit(parts))
    near = stage_parts((exact(pairs.where(part == i) if parts > 1 else pairs) for i in range(parts)), "near")
    release(pairs)
    return near


def met_in_blocks(blocks: DataFrame, keys: list[str], sets: DataFrame, meet) -> DataFrame:
    """a, b: the links that ``meet`` finds in the blocks (keys, nid, size and more) with their sets. Staged.

    size: the shingles of a node. The nodes of a block are there once for each block, and their
    sets are added for a part of the blocks at a time.
    """
    moved, total = (f.agg(F.sum(c)).first()[0] or 0 for f, c in ((blocks, "size"), (sets, "n")))
    parts = moved // max(SHINGLES_AT_ONCE, total // 2) + 1
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    some = lambda i: blocks.where(part == i) if parts > 1 else blocks
    return stage_parts(
        (some(i).drop("size").join(sets, "nid").groupBy(*keys).applyInPandas(meet, "a long, b long") for i in range(parts)), "block-links"
    )


def region_links(sets: DataFrame, alive: DataFrame, inner: DataFrame, outer: DataFrame, s: Settings) -> DataFrame:
    """a, b: links between the nodes of regions (p, x, jx) and the nodes in their windows (p, y, jy).

    Of the links of one y into one block of a region one is given: the region is joined through p. Nodes
    meet only where the windows and the shingles that nobody else has allow a link to some node of the other side.
    """
    e = 1 - s.num / s.den
    known = alive.select("nid", "n", (F.col("n") - F.col("u")).alias("room"))
    inner = inner.select("p", F.col("x").alias("nid"), F.col("jx").alias("j")).join(known, "nid")
    outer = outer.select("p", F.col("y").alias("nid"), F.col("jy").alias("j")).join(known, "nid")

    def possible(side: DataFrame, other: DataFrame, best: Column) -> DataFrame:
        """``best``: the similarity to p of the other side's node whose window reaches the farthest."""
        of = other.groupBy("p").agg(best.alias("reach"), F.max("room").alias("most"), F.min("n").alias("least"))
        gap = F.abs(F.col("j") - F.col("reach")) <= e + 1e-9
        shared = F.least("room", "most")
        fits = shared * s.den >= (F.col("n") + F.greatest("least", shared) - shared) * s.num
        return side.join(of, "p").where(gap & fits).select("p", "nid", "j", "n", "room")

    inner = possible(inner, outer, F.max("j"))
    outer = stage(possible(outer, inner, F.min("j")), "windows")
    inner = stage(inner.join(outer.select("p").distinct(), "p", "left_semi"), "inner")
    sized = lambda f: f.groupBy("p").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("k"))
    grid = sized(inner).withColumnRenamed("k", "rows").join(sized(outer).withColumnRenamed("k", "cols"), "p")
    zero = F.lit(0).cast("long")
    place = lambda k: F.pmod(F.xxhash64("nid"), F.col(k))
    every = lambda k: F.explode(F.sequence(zero, F.col(k) - 1))
    rest = ["nid", "j", "room", F.col("n").alias("size")]
    left = inner.join(grid, "p").select("p", place("rows").alias("i"), every("cols").alias("k"), F.lit(True).alias("is_x"), *rest)
    right = outer.join(grid, "p").select("p", every("rows").alias("i"), place("cols").alias("k"), F.lit(False).alias("is_x"), *rest)
    num, den = s.num, s.den

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        x, y = block[block.is_x], block[~block.is_x]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        both = x.n.to_numpy()[:, None] + y.n.to_numpy()[None, :]
        most = np.minimum(x.room.to_numpy()[:, None], y.room.to_numpy()[None, :])
        maybe = (most * den >= (both - most) * num) & (x.j.to_numpy()[:, None] - y.j.to_numpy()[None, :] <= e + 1e-9)
        xs, ys = maybe.any(axis=1), maybe.any(axis=0)
        x, y, both, maybe = x[xs], y[ys], both[xs][:, ys], maybe[xs][:, ys]
        if not maybe.size:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        inter = common_counts(x.vals, y.vals)
        linked = maybe & (inter * den >= (both - inter) * num)
        some = np.flatnonzero(linked.any(axis=0))
        return pd.DataFrame({"a": x.nid.to_numpy()[linked.argmax(axis=0)[some]], "b": y.nid.to_numpy()[some]})

    return met_in_blocks(left.union(right), ["p", "i", "k"], sets, meet)


def last_links(sets: DataFrame, alive: DataFrame, s: Settings) -> list[DataFrame]:
    """Links between the nodes that no level has settled, every node being a pivot.

    Nodes that share a shingle of their heads meet: in a join where few hold it, else as
    blocks of nodes against each other, of which only the components come out. The lists of many
    shingles hold mostly the same nodes: the nodes that such lists connect meet as one group where
    that puts fewer nodes into blocks than the lists one by one.
    """
    rows = _prefix(sets, alive, s.num, s.den)
    sizes = rows.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rows = stage(rows.join(sizes, "v"), "last-heads")
    short = rows.where(F.col("m") <= SHORT_LIST)
    pairs = distances(sets, short, short, s.num, s.den, once=True).select(F.col("p").alias("a"), F.col("y").alias("b"))
    long = rows.where(F.col("m") > SHORT_LIST)
    if long.isEmpty():
        return [pairs]
    groups = stage(meeting_groups(long), "groups")
    zero, rest = F.lit(0).cast("long"), ["nid", "u", F.col("n").alias("size")]
    long = groups.withColumn("at", F.pmod(F.xxhash64("nid"), F.col("k")))
    left = long.select("whole", "g", F.col("at").alias("i"), F.explode(F.sequence(F.col("at"), F.col("k") - 1)).alias("k"), F.lit(True).alias("is_x"), *rest)
    right = long.select("whole", "g", F.explode(F.sequence(zero, F.col("at"))).alias("i"), F.col("at").alias("k"), F.lit(False).alias("is_x"), *rest)
    num, den = s.num, s.den

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        x, y = block[block.is_x], block[~block.is_x]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        both = x.n.to_numpy()[:, None] + y.n.to_numpy()[None, :]
        most = np.minimum((x.n - x.u).to_numpy()[:, None], (y.n - y.u).to_numpy()[None, :])
        linked = most * den >= (both - most) * num
        if linked.any():
            inter = common_counts(x.vals, y.vals)
            linked &= inter * den >= (both - inter) * num
        xs, ys = x.nid.to_numpy(), y.nid.to_numpy()
        i, j = np.nonzero(linked & (xs[:, None] != ys[None, :]))
        return spanning(xs[i], ys[j])

    links = met_in_blocks(left.union(right), ["whole", "g", "i", "k"], sets, meet)
    release(rows, groups)
    return [pairs, links]


def meeting_groups(long: DataFrame) -> DataFrame:
    """whole, g, nid, n, u, k: groups of nodes that meet in k * k blocks, for the lists (v, nid, n, u, m).

    A group is a list, or all nodes that lists connect (``whole``) where so fewer nodes stand in blocks.
    """
    blocks = lambda m: F.ceil(m / BLOCK_NODES).cast("long")
    lists = long.groupBy("v").agg(F.first("m").alias("m"), F.min("nid").alias("lead"))
    comps = components(long.join(lists.select("v", "lead"), "v"), "nid", "lead")
    comps = stage(comps.withColumnRenamed("node", "nid"), "connected")
    one_by_one = lists.join(comps.withColumnRenamed("nid", "lead"), "lead").groupBy("component").agg(
        F.sum(F.col("m") * (blocks(F.col("m")) + 1)).alias("apart"))
    size = comps.groupBy("component").agg(F.count(F.lit(1)).alias("c")).join(one_by_one, "component")
    named = long.join(comps, "nid").join(size, "component")
    together = F.col("c") * (blocks(F.col("c")) + 1) <= F.col("apart")
    whole = named.where(together).groupBy(F.col("component").alias("g"), "nid").agg(
        F.first("n").alias("n"), F.first("u").alias("u"), F.first("c").alias("m"))
    parted = named.where(~together).select(F.col("v").alias("g"), "nid", "n", "u", "m")
    both = whole.withColumn("whole", F.lit(True)).unionByName(parted.withColumn("whole", F.lit(False)))
    return both.withColumn("k", blocks(F.col("m"))).drop("m")


def spanning(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Each node of the links (a, b) with the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    ends = np.split(at, 2)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[ends[0]], label[ends[1]])
        new = label.copy()
        np.minimum.at(new, ends[0], low)
        np.minimum.at(new, ends[1], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    own = label != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[own], "b": nodes[label[own]]})


def links_of(sets: DataFrame, alive: DataFrame, s: Settings) -> list[DataFrame]:
    """Frames of links (a, b) that give the components of all links between the alive nodes."""
    found: list[DataFrame] = []
    alive = stage(linkable(sets, alive, s), "alive")
    left = alive.count()
    for _ in range(LEVELS):
        if not left:
            break
        pivots = central(sets, alive, s)
        wide = 2 * s.num - s.den
        near = distances(sets, _prefix(sets, pivots, wide, s.den), _prefix(sets, alive, wide, s.den), wide, s.den, once=False)
        j = F.col("inter") / (F.col("np") + F.col("ny") - F.col("inter"))
        close = _reaches(F.col("inter"), F.col("np"), F.col("ny"), s.num, s.den)
        measured = near.select("p", "y", j.alias("j"), close.alias("close"))
        found.append(near.where(close).select(F.col("p").alias("a"), F.col("y").alias("b")))
        plain = measured.join(pivots.select(F.col("nid").alias("y")), "y", "left_anti")  # links of pivots are all known
        regions = stage(plain.where("close").groupBy("y").agg(F.max(F.struct("j", "p")).alias("t")).select(
            F.col("t.p").alias("p"), F.col("y").alias("x"), F.col("t.j").alias("jx")), "regions")
        window = plain.where("NOT close").select("p", "y", F.col("j").alias("jy"))
        found.append(region_links(sets, alive, regions, window, s))
        settled = pivots.select("nid").union(regions.select(F.col("x")))
        last, alive = alive, stage(linkable(sets, alive.join(settled, "nid", "left_anti"), s), "alive")
        release(last, pivots, regions)
        left = alive.count()
    if left:
        found += last_links(sets, alive, s)
    return found


def jaccard_components(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text): the smallest doc_id that links reach."""
    s = s or Settings()
    if 2 * s.num <= s.den:
        raise ValueError("the windows need a similarity of more than one half")
    prepared = stage(heads(docs, s), "heads")
    nodes = stage(prepared.where("nid IS NOT NULL").groupBy("nid").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "th")).alias("rep"),
        F.first("need").alias("need"), F.count(F.lit(1)).alias("copies"),
    ), "nodes")
    wanted = stage(sharing(prepared, nodes).select("nid", "rep.doc_id", "rep.th"), "wanted")
    rows = stage(prepared.select("doc_id", "n", "nid"), "rows")
    release(prepared)  # the heads are used up
    sets = whole_sets(docs, wanted, s)
    ids = wanted.select("nid")
    links = links_of(sets, F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, s)
    spark = docs.sparkSession
    edges = spark.createDataFrame([], "a long, b long")
    for part in links:
        edges = edges.union(part.select("a", "b"))
    comps = stage(components(edges, "a", "b"), "components")
    release(sets)

    named = nodes.select("nid", "first_id").join(comps.withColumnRenamed("node", "nid"), "nid", "left")
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least_id"))
    named = named.join(least, "component", "left").select("nid", F.coalesce("least_id", "first_id").alias("component_id"))
    out = rows.join(named, "nid", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("nid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
