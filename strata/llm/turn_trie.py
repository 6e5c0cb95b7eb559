"""Prefix trie of conversations with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns; its members are the conversations
that start with it. Totals over subtrees (leaves, tokens that sharing saves) come
from the parent-edge forest:

1. Turns are numbered within a conversation by blocks of ``TURN_BLOCK`` turn numbers,
   and a sequence is named by the exclusive or of 128 bits per (position, turn), built
   the same way from blocks of positions. So a conversation that holds a third of
   all turns meets as blocks, never as one group, and the name of a node's parent is known
   on the node's own row.
2. A node's weight is the number of its members; the weight of a subtree is then a
   plain sum over its members (turns left from there on), which needs no rollup.
3. Rounds: of every component with more than ``LOCAL_NODES`` nodes the deepest node with half
   of the weight below it is the centroid. Its total is the sum over what lies below it in the
   component; it is added to the nodes on the path from the centroid to the component's top, whose
   weights shrink by the centroid's. The centroid leaves, its children's sides become
   components of their own. Every round halves the weight of a component, so their
   number is the logarithm of the number of turns, whatever the depth of the trie.
4. Components that are small enough go through the same steps in numpy, many to a task.

Defined results: rows without conv_id belong to no conversation; a null role or text is
empty; a null turn comes first; turns that tie are ordered by the MD5 of role and text;
repeated rows are turns of their own; an empty table has no nodes, not even the root.
Names are 128 bits, so two sequences share one by a chance of about n * n / 2**129.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import release, stage

#: Turn numbers (then positions) that one window group spans at most.
TURN_BLOCK = 4096
#: Components up to this many nodes are finished inside a task; about this many rows share a task's group.
LOCAL_NODES = 10_000
BUCKET_ROWS = 20_000
#: Consecutive conv_ids that one group joins to a string before hashing.
ID_CHUNK = 1024
MAX_HEAD = 5


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), key (digest of role and text), n_chars (code points of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.length(text).cast("long").alias("n_chars"),
    ).withColumn("blk", F.coalesce(F.floor(F.col("turn") / TURN_BLOCK), F.lit(-(1 << 62))).cast("long"))
    inside = Window.partitionBy("conv_id", "blk").orderBy(F.col("turn").asc_nulls_first(), "key", "n_chars")
    before = Window.partitionBy("conv_id").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("conv_id", "blk").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "blk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off")
    )
    placed = rows.withColumn("i", F.row_number().over(inside)).join(offsets, ["conv_id", "blk"])
    return placed.select("conv_id", (F.col("off") + F.col("i") - 1).cast("long").alias("pos"), "key", "n_chars")


def plain(ordered: DataFrame) -> DataFrame:
    """conv_id, pos, key, n_chars, size: the conversations as they are (none without turns)."""
    sizes = ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    return ordered.join(sizes, "conv_id")


def rebuilt(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with the head of another: (turns as ``plain``, conv_id and size of all).

    Conversation c takes the first h turns of conversation c - c % 100 (h is
    crc32(c) % 6) and its own turns after its first h; it may end up without turns.
    """
    sizes = ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    heads = sizes.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = sizes.select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % (MAX_HEAD + 1)).alias("h"),
    ).join(heads, "base", "left")
    taken = F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")
    convs = convs.select("conv_id", "base", "h", "n", taken).withColumn(
        "size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    )
    convs = stage(convs, "conversations")
    own = ordered.join(convs, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "n_chars", "size"
    )
    first = ordered.where((F.col("conv_id") % 100 == 0) & (F.col("pos") < MAX_HEAD)).withColumnRenamed("conv_id", "base")
    head = first.join(convs, "base").where("pos < h").select("conv_id", "pos", "key", "n_chars", "size")
    return own.unionByName(head), convs.select("conv_id", "size")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, size, d, x1, x2 (name of the first d turns), p1, p2 (of one fewer), n_chars (of turn d), from d = 0."""
    rows = turns.select(
        "conv_id", "size", "pos", "n_chars", F.floor(F.col("pos") / TURN_BLOCK).alias("blk"),
        F.xxhash64("key", "pos").alias("z1"), F.xxhash64(F.lit(7), "pos", "key").alias("z2"),
    )
    upto = Window.partitionBy("conv_id", "blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv_id").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "blk").agg(F.bit_xor("z1").alias("b1"), F.bit_xor("z2").alias("b2")).select(
        "conv_id", "blk", *[F.coalesce(F.bit_xor(f"b{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)]
    )
    rows = rows.select("*", *[F.bit_xor(f"z{i}").over(upto).alias(f"i{i}") for i in (1, 2)]).join(blocks, ["conv_id", "blk"])
    named = rows.select(
        "conv_id", "size", (F.col("pos") + 1).alias("d"),
        *[F.col(f"i{i}").bitwiseXOR(F.col(f"o{i}")).alias(f"x{i}") for i in (1, 2)], "z1", "z2", "n_chars",
    )
    named = named.select(
        "conv_id", "size", "d", "x1", "x2", *[F.col(f"x{i}").bitwiseXOR(F.col(f"z{i}")).alias(f"p{i}") for i in (1, 2)], "n_chars"
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select(
        "conv_id", F.col("size").cast("long"), zero.alias("d"), zero.alias("x1"), zero.alias("x2"), none.alias("p1"), none.alias("p2"),
        zero.alias("n_chars"),
    )
    return named.withColumn("size", F.col("size").cast("long")).unionByName(root)


def trie_nodes(paths: DataFrame) -> DataFrame:
    """A row for each node: names, conv_id, depth d, parent_conv_id, n_convs, n_children, w (weight of its subtree)."""
    nodes = stage(paths.groupBy("x1", "x2", "d").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.min("n_chars").alias("n_chars"), F.sum(F.col("size") - F.col("d") + 1).alias("w"),
    ), "trie-nodes")
    kids = nodes.where("d > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(kids, ["x1", "x2"], "left").join(above, ["p1", "p2"], "left")
    return out.withColumn("n_children", F.coalesce("n_children", F.lit(0)))


_KEEP = ["x1", "x2", "p1", "p2", "d", "conv_id", "parent_conv_id", "n_convs", "n_children"]
_STATE = ["t1", "t2", "w", "leaf", "save", "n_leaves", "saved_tokens"]


def _add_up(parent: np.ndarray, weight: np.ndarray, own: np.ndarray, total: np.ndarray) -> None:
    """Adds to ``total`` the sums of ``own`` over the subtrees of a forest of components.

    Nodes are in order of depth; ``parent`` is the node above or -1 at a component's top. All
    components take each step together: centroids, sums below them, sums added on the paths up.
    """
    n = len(parent)
    each = np.arange(n)
    label = np.where(parent < 0, each, parent)
    comp = _roots(label)
    open_ = np.ones(n, bool)
    central, best = np.zeros(n, bool), np.empty(n, np.int64)
    while open_.any():
        live = np.flatnonzero(open_)
        heavy = live[2 * weight[live] >= weight[comp[live]]]
        best[comp[heavy]] = heavy  # of the heavy nodes, which lie on one path, the last one is the deepest
        cents = best[np.unique(comp[live])]
        central[cents] = True
        tops = live[(parent[live] >= 0) & central[parent[live]]]
        label[live] = np.where(parent[live] < 0, live, parent[live])
        label[tops], label[cents] = tops, cents
        comp[live] = _roots(label)[live]
        sums = np.zeros_like(own)
        np.add.at(sums, comp[live], own[live])
        np.add.at(sums, parent[tops], sums[tops])
        total[cents] += sums[cents]
        at, value, less = parent[cents], sums[cents], weight[cents]
        while True:
            on = at >= 0
            if not on.any():
                break
            at, value, less = at[on], value[on], less[on]
            total[at] += value
            weight[at] -= less
            at = parent[at]
        parent[tops] = -1
        open_[cents] = False


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label.copy()
        label = up


def _finish(table: pa.Table) -> pa.Table:
    """Totals of whole small components."""
    table = table.take(pa.array(np.argsort(table["d"].to_numpy(), kind="stable")))
    col = {c: table[c].to_numpy() for c in ("x1", "x2", "t1", "t2", "w", "leaf", "save", "n_leaves", "saved_tokens")}
    index = pd.MultiIndex.from_arrays([col["x1"], col["x2"]])
    above = [table[c].fill_null(0).to_numpy() for c in ("p1", "p2")]
    parent = index.get_indexer(pd.MultiIndex.from_arrays(above)).astype(np.int64)
    parent[(col["x1"] == col["t1"]) & (col["x2"] == col["t2"])] = -1
    total = np.stack([col["n_leaves"], col["saved_tokens"]], 1)
    _add_up(parent, col["w"].copy(), np.stack([col["leaf"], col["save"]], 1), total)
    names = ["x1", "x2", "d", "conv_id", "parent_conv_id", "n_convs", "n_children"]
    return pa.table([*[table[c] for c in names], pa.array(total[:, 0]), pa.array(total[:, 1])], names=[*names, "n_leaves", "saved_tokens"])


_DONE = "x1 long, x2 long, d long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def subtree_totals(nodes: DataFrame, paths: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """Nodes with n_leaves and saved_tokens summed over their subtrees."""
    zero = F.lit(0).cast("long")
    active = stage(nodes.select(
        *_KEEP, zero.alias("t1"), zero.alias("t2"), F.col("w").cast("long").alias("w"),
        (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("save"),
        zero.alias("n_leaves"), zero.alias("saved_tokens"),
    ), "trie")
    done, small = [], []
    while True:
        large = stage(active.groupBy("t1", "t2").agg(
            F.count(F.lit(1)).alias("n"), F.max("w").alias("all_w"), F.min("d").alias("top_d")
        ).where(F.col("n") > local_nodes), "large-components")
        if large.isEmpty():
            small.append(active)
            break
        small.append(active.join(large, ["t1", "t2"], "left_anti").select(*active.columns))
        inside = active.join(large, ["t1", "t2"])
        cents = stage(inside.where(2 * F.col("w") >= F.col("all_w")).groupBy("t1", "t2", "top_d").agg(
            F.max(F.struct("d", "x1", "x2", "conv_id", "w")).alias("c")
        ), "centroids")
        at = cents.select("t1", "t2", "top_d", *[F.col(f"c.{c}").alias(f"c_{c}") for c in ("d", "x1", "x2", "conv_id", "w")])
        below = paths.join(at, (F.col("p1") == F.col("c_x1")) & (F.col("p2") == F.col("c_x2"))).select(
            "t1", "t2", "conv_id", F.col("x1").alias("n1"), F.col("x2").alias("n2"), F.col("d").alias("n_d")
        )
        up = paths.join(at, (F.col("conv_id") == F.col("c_conv_id")) & (F.col("d") < F.col("c_d")) & (F.col("d") >= F.col("top_d"))).select(
            "t1", "t2", "x1", "x2", F.lit(True).alias("on_path")
        )
        marked = active.join(at.drop("top_d"), ["t1", "t2"]).join(below, ["t1", "t2", "conv_id"], "left").join(up, ["t1", "t2", "x1", "x2"], "left")
        is_below = F.col("n_d").isNotNull() & (F.col("d") >= F.col("n_d"))
        marked = stage(marked.select(
            *active.columns, "c_w", ((F.col("x1") == F.col("c_x1")) & (F.col("x2") == F.col("c_x2"))).alias("is_c"),
            F.coalesce(is_below, F.lit(False)).alias("is_below"), F.coalesce("on_path", F.lit(False)).alias("on_path"), "n1", "n2",
        ), "marked")
        sums = marked.where("is_c OR is_below").groupBy("t1", "t2").agg(F.sum("leaf").alias("s_leaf"), F.sum("save").alias("s_save"))
        added = marked.join(sums, ["t1", "t2"])
        got = F.col("is_c") | F.col("on_path")
        added = added.withColumns({
            "n_leaves": F.col("n_leaves") + F.when(got, F.col("s_leaf")).otherwise(0),
            "saved_tokens": F.col("saved_tokens") + F.when(got, F.col("s_save")).otherwise(0),
            "w": F.col("w") - F.when(F.col("on_path"), F.col("c_w")).otherwise(0),
            "t1": F.when(F.col("is_below"), F.col("n1")).otherwise(F.col("t1")),
            "t2": F.when(F.col("is_below"), F.col("n2")).otherwise(F.col("t2")),
        })
        added = stage(added.select(*active.columns, "is_c"), "trie")
        release(marked, cents)
        done.append(added.where("is_c"))
        active = added.where("NOT is_c").select(*active.columns)
    out = small[0]
    for part in small[1:]:
        out = out.unionByName(part)
    parts = out.sparkSession.conf.get("spark.sql.shuffle.partitions")
    buckets = max(int(parts), out.count() // BUCKET_ROWS + 1)
    whole = out.groupBy(F.pmod(F.xxhash64("t1", "t2"), F.lit(buckets)).alias("bucket")).applyInArrow(_finish, _DONE)
    names = whole.columns
    for part in done:
        whole = whole.unionByName(part.select(*names))
    return whole


def _hash_runs(batches):
    """SHA-256 of each node's id strings, fed chunk by chunk in order."""
    node, state = None, None
    for batch in batches:
        out = []
        for x1, x2, ids in zip(batch["x1"].to_pylist(), batch["x2"].to_pylist(), batch["ids"].to_pylist()):
            if (x1, x2) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (x1, x2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digests(out)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows):
    a, b, c = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], names=["x1", "x2", "ends_sha256"])


def ends(paths: DataFrame) -> DataFrame:
    """x1, x2, ends_sha256: digest of the ascending ids of the conversations that end at a node.

    Ids are joined by ranges of ``ID_CHUNK`` ids first, so a node where a third
    of all conversations end is hashed from few rows, in order, with constant memory.
    """
    chunks = paths.where("d = size").groupBy("x1", "x2", F.floor(F.col("conv_id") / ID_CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = chunks.repartition("x1", "x2").sortWithinPartitions("x1", "x2", "chunk")
    return ordered.mapInArrow(_hash_runs, "x1 long, x2 long, ends_sha256 string")


def rollup(turns: DataFrame, convs: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The trie of conversations given as turns (conv_id, pos, key, n_chars, size) and convs (conv_id, size)."""
    paths = stage(prefixes(turns, convs), "paths")
    totals = subtree_totals(trie_nodes(paths), paths, local_nodes)
    nothing = hashlib.sha256(b"").hexdigest()
    out = totals.join(ends(paths), ["x1", "x2"], "left")
    return out.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = stage(plain(ordered_turns(conversations)), "turns")
    return rollup(turns, turns.select("conv_id", "size").distinct(), local_nodes)


def rebuilt_trie(conversations: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The trie of the conversations that ``rebuilt`` makes."""
    turns, convs = rebuilt(stage(ordered_turns(conversations), "turns"))
    return rollup(turns, convs, local_nodes)
