"""Hard negatives from embeddings by searches in an R-tree packed with Sort-Tile-Recursive.

Vectors are whole numbers (floor(256 * x)), so inner products are exact. Spark sorts
the rows into slabs (length, label, first coordinate); inside a slab runs of rows are tiled
coordinate by coordinate, those of greatest spread first, into leaves of ``LEAF_ROWS`` rows. The packed
order is written once; consecutive leaves make the boxes above them.

A search walks the boxes of each run best-first: a box with bounds [lo, hi] holds inner products with q
in the sum of the per-coordinate intervals [min(q*lo, q*hi), max(q*lo, q*hi)]. An anchor leaves a box whose
interval misses all its score windows, or lies strictly below the k-th score it holds for each of them; a
box that every anchor leaves is not opened. Anchors are the stated query set: they meet the rows
block by block, a block being bounded in bytes (``ANCHOR_BYTES``), and each task keeps k rows per
anchor and window, so nothing grows with the number of rows.

Two searches per block: the best rows of the anchor's own label (its positives), then for each
positive the best rows of other labels whose score is in the window of the positive's score.

Defined results: rows with a null vec_id, label or vector, or with a null or non-finite
component, take no part. Equal rows count once. Rows that share the anchor's vec_id are neither its positives nor its
negatives. Vectors of different lengths never meet; empty vectors score 0. Scores that don't fit a
64-bit integer count as the largest (smallest) one; those below 2**63 are exact.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import release, stage

SCALE = 256
LEAF_ROWS = 64
FANOUT = 16
#: Rows per range partition of the index, about.
SLAB_ROWS = 40_000
#: Bytes of anchor vectors that one block of the query set has, about.
ANCHOR_BYTES = 16 << 20
_LAST = np.int64((1 << 63) - 1)


def vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, dim, embedding of the rows that take part; equal rows once."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    return rows.select("vec_id", "label", F.size("embedding").alias("dim"), "embedding").dropDuplicates()


def tile_order(points: np.ndarray, leaf: int = LEAF_ROWS) -> np.ndarray:
    """Sort-Tile-Recursive order of the points: every ``leaf`` consecutive ones share a leaf."""
    axes = np.argsort(-points.std(axis=0), kind="stable") if points.size else np.empty(0, np.int64)

    def tile(rows: np.ndarray, level: int) -> list[np.ndarray]:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or level == len(axes):
            return [rows]
        rows = rows[np.argsort(points[rows, axes[level]], kind="stable")]
        slices = math.ceil(pages ** (1 / (len(axes) - level)))
        width = leaf * -(-pages // slices)
        return [part for a in range(0, len(rows), width) for part in tile(rows[a : a + width], level + 1)]

    return np.concatenate(tile(np.arange(len(points)), 0)) if len(points) else np.empty(0, np.int64)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Bounds of the runs of rows that are equal in every column."""
    change = np.zeros(len(columns[0]) + 1, bool)
    change[[0, -1]] = True
    for c in columns:
        change[1:-1] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def packed(rows: DataFrame) -> DataFrame:
    """vec_id, label, dim, leaf, vec: the rows in the order of the tree's leaves."""
    n = rows.count()
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // SLAB_ROWS + 1)
    order = ["dim", "label", F.col("x"), "vec_id"]
    # try_element_at: empty vectors have no first coordinate
    slabs = rows.withColumn("x", F.try_element_at("embedding", F.lit(1))).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def pack(batches):
        leaf = 0
        for batch in batches:
            dims, labels = batch["dim"].to_numpy(), batch["label"].to_numpy()
            cuts = _runs(dims, labels)
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                points = np.floor(SCALE * _matrix(part["embedding"], int(dims[a])))
                order = tile_order(points)
                leaves = leaf + np.arange(len(order)) // LEAF_ROWS
                leaf = int(leaves[-1]) + 1
                offsets = np.arange(len(order) + 1, dtype=np.int32) * int(dims[a])
                yield pa.RecordBatch.from_arrays([
                    part["vec_id"].take(pa.array(order)), part["label"], part["dim"], pa.array(leaves),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(points[order].ravel())),
                ], names=["vec_id", "label", "dim", "leaf", "vec"])

    return slabs.mapInArrow(pack, "vec_id long, label long, dim int, leaf long, vec array<double>")


class Anchors:
    """A block of anchors of one length, with the score windows of each: (anchor, window) bounds ``low`` and ``high``."""

    def __init__(self, ids, labels, points, low, high):
        self.ids, self.labels, self.points = ids, labels, points
        self.low, self.high = low, high


class Best:
    """The k best (score, smaller vec_id) per anchor and window."""

    def __init__(self, shape, k, kind):
        self.scores = np.full((*shape, k), -np.inf, kind)
        self.ids = np.full((*shape, k), _LAST, np.int64)

    def least(self) -> np.ndarray:
        return self.scores[..., -1]

    def add(self, at: np.ndarray, w: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer rows ``ids`` with ``scores`` (anchor, row; -inf for none) to window w of the anchors ``at``."""
        both = np.concatenate([self.scores[at, w], scores], axis=1)
        names = np.concatenate([self.ids[at, w], np.broadcast_to(ids, scores.shape)], axis=1)
        top = np.lexsort((names, -both), axis=1)[:, : self.scores.shape[2]]
        self.scores[at, w] = np.take_along_axis(both, top, 1)
        self.ids[at, w] = np.take_along_axis(names, top, 1)


def _boxes(points: np.ndarray, labels: np.ndarray, leaves: np.ndarray):
    """Levels from the leaves up: (bounds of children, lo, hi, lowest and highest label)."""
    cuts = _runs(leaves, labels)
    at = cuts[:-1]
    level = (cuts, np.minimum.reduceat(points, at), np.maximum.reduceat(points, at), labels[at], labels[at])
    out = [level]
    while len(level[1]) > FANOUT:
        cuts = np.append(np.arange(0, len(level[1]), FANOUT), len(level[1]))
        at = cuts[:-1]
        level = (cuts, np.minimum.reduceat(level[1], at), np.maximum.reduceat(level[2], at),
                 np.minimum.reduceat(level[3], at), np.maximum.reduceat(level[4], at))
        out.append(level)
    return out


def search_run(anchors: Anchors, best: Best, ids, labels, leaves, points, same: bool) -> int:
    """Offer the rows of one packed run to all anchors, boxes best-first; the number of rows scored."""
    levels = _boxes(points, labels, leaves)
    plus, minus = np.maximum(anchors.points, 0), np.minimum(anchors.points, 0)
    scored = 0

    def bounds(level: int, a: int, b: int, who: np.ndarray):
        _, lo, hi, *_ = levels[level]
        low = plus[who] @ lo[a:b].T + minus[who] @ hi[a:b].T
        high = plus[who] @ hi[a:b].T + minus[who] @ lo[a:b].T
        return np.clip(low, -_LAST, _LAST), np.clip(high, -_LAST, _LAST)

    def interested(low: np.ndarray, high: np.ndarray, who: np.ndarray) -> np.ndarray:
        floor = np.maximum(anchors.low[who], best.least()[who])
        return ((high[:, None] >= floor) & (low[:, None] <= anchors.high[who])).any(axis=1)

    queue: list = []

    def push(level: int, a: int, b: int, who: np.ndarray) -> None:
        if not len(who):
            return
        low, high = bounds(level, a, b, who)
        _, _, _, first, last = levels[level]
        for j in range(b - a):
            fits = (anchors.labels[who] >= first[a + j]) & (anchors.labels[who] <= last[a + j]) if same else (
                (anchors.labels[who] != first[a + j]) | (first[a + j] != last[a + j]))
            fits &= interested(low[:, j], high[:, j], who)
            if fits.any():
                heapq.heappush(queue, (-float(high[fits, j].max()), level, a + j, who[fits], low[fits, j], high[fits, j]))

    top = len(levels) - 1
    push(top, 0, len(levels[top][1]), np.arange(len(anchors.ids)))
    while queue:
        _, level, box, who, low, high = heapq.heappop(queue)
        who = who[interested(low, high, who)]  # the k-th scores may have risen meanwhile
        if not len(who):
            continue
        a, b = levels[level][0][box : box + 2]
        if level:
            push(level - 1, a, b, who)
            continue
        scored += len(who) * (b - a)
        scores = np.clip(anchors.points[who] @ points[a:b].T, -_LAST, _LAST)
        meets = (labels[a] == anchors.labels[who])[:, None] == same
        meets = meets & (ids[a:b] != anchors.ids[who][:, None])
        for w in range(anchors.low.shape[1]):
            floor = np.maximum(anchors.low[who, w], best.least()[who, w])
            ok = meets & (scores >= floor[:, None]) & (scores <= anchors.high[who, w][:, None])
            some = np.flatnonzero(ok.any(axis=1))
            if len(some):
                best.add(who[some], w, np.where(ok[some], scores[some], -np.inf), ids[a:b])
    return scored


def _kind(*points: np.ndarray):
    """float64 where inner products are exact in it, else the 64-bit mantissa of longdouble."""
    most = 1.0
    for p in points:
        most *= float(np.abs(p).max(initial=1))
    return np.float64 if most * max(1, points[0].shape[1]) < 2**53 else np.longdouble


def search(index: DataFrame, anchors: Anchors, same: bool, k: int) -> DataFrame:
    """a, w, score, vec_id, r: the k best rows (r from 1) of each anchor and window over the whole index.

    ``same``: rows of the anchor's label, else rows of other labels.
    """
    dim = anchors.points.shape[1]

    def run(batches):
        best = {kind: Best(anchors.low.shape, k, kind) for kind in (np.float64, np.longdouble)}
        for batch in batches:
            if not len(batch):
                continue
            points = _matrix(batch["vec"], dim)
            kind = _kind(points, anchors.points)
            block = Anchors(anchors.ids, anchors.labels, anchors.points.astype(kind), anchors.low.astype(kind), anchors.high.astype(kind))
            search_run(block, best[kind], *(batch[c].to_numpy() for c in ("vec_id", "label", "leaf")), points.astype(kind), same)
        for found in best.values():
            a, w, j = np.nonzero(found.scores > -np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(w), pa.array(found.scores[a, w, j].astype(np.int64)), pa.array(found.ids[a, w, j])],
                names=["a", "w", "score", "vec_id"],
            )

    found = index.where(F.col("dim") == dim).mapInArrow(run, "a long, w long, score long, vec_id long")
    # each task gives at most k rows per anchor and window
    ranked = Window.partitionBy("a", "w").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k)


def mine(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, label, dim, embedding (``vectors``); ``is_anchor``: a condition on vec_id and label.
    A negative's score is within ``least`` to ``most`` percent of the positive's.
    """
    spark = rows.sparkSession
    rows = stage(rows, "vectors")
    index = stage(packed(rows), "rtree")
    release(rows)
    queries = stage(index.where(is_anchor).select("vec_id", "label", "dim", "vec"), "anchors")
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for dim, count in sorted((r[0], r[1]) for r in queries.groupBy("dim").count().collect()):
        n_blocks = count * max(1, dim) * 8 // ANCHOR_BYTES + 1
        mine_of = queries.where(F.col("dim") == dim).withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vec"), F.lit(n_blocks)))
        for i in range(n_blocks):
            block = mine_of.where(F.col("block") == i).select("vec_id", "label", "vec").toArrow().combine_chunks()
            if not len(block):
                continue
            points = np.floor(np.array(block["vec"].to_pylist(), np.float64).reshape(len(block), dim))
            ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
            every = np.full((len(block), 1), np.inf)
            near = search(index, Anchors(ids, labels, points, -every, every), True, positives).select("a", "score", "vec_id", "r").toArrow()
            a, score, pid, r = (near[c].to_numpy() for c in ("a", "score", "vec_id", "r"))
            kind = np.float64 if len(score) == 0 or np.abs(score).max() < 2**53 else np.longdouble
            low, high = np.full((len(block), positives), np.inf, kind), np.full((len(block), positives), -np.inf, kind)
            high[a, r - 1] = [int(s) * most // 100 for s in score]
            low[a, r - 1] = [-(-int(s) * least // 100) for s in score]
            far = search(index, Anchors(ids, labels, points, low, high), False, negatives)
            names = spark.createDataFrame(
                pa.table({"a": a, "w": r.astype(np.int64) - 1, "anchor_id": ids[a], "positive_id": pid, "positive_score": score})
            ) if len(a) else None
            if names is None:
                continue
            # at most `positives` rows per anchor of the block
            found = far.join(F.broadcast(names), ["a", "w"]).select(
                "anchor_id", "positive_id", F.col("r").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"),
            )
            out = out.unionByName(stage(found, "negatives"))
    return out
