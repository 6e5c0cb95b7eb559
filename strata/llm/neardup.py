"""Near-duplicate documents from bottom-k sketches of one hash function.

A document is the set of its distinct word shingles; two documents are linked
when their Jaccard similarity reaches the threshold, and groups are the
connected components of the links.

1. Each document is hashed once; its set's digest names a node (equal sets, so
   all exact copies, share one) and its k smallest shingle hashes are its sketch.
2. Inverted lists of the retained values generate overlaps. Linked documents
   share at least ``least_shared`` retained values (a smaller share has a chance
   below ``RISK`` per link), so values that nobody else retains are dropped,
   documents with too few shared values too, and each document needs only be
   found through its rarest lists: shared count - needed + 1 of them.
3. Stars: in each list all members are paired with its most central member.
   The sketch of the union estimates each pair's similarity, the full sets
   verify it, and components form. A list with a third of all documents costs
   one row per member.
4. The rest: pairs of a list that are still in different components. Shingles that
   only one document of these lists has bound what it can share with any other;
   pairs below the threshold by that are out. The others meet in a join (short
   lists) or as blocks of a few hundred members against each other; members of one
   family are compared exactly there, by their differences from the family's most
   central member, and what remains is estimated and verified like stars. After that no pair that shares a list is
   unexamined across components, so no link between components is missing, and
   copies never unfold into all pairs.

Defined results: null, blank and empty texts have no shingles and link with
nothing; fewer words than a shingle make one shingle of all; repeated rows share
a node; null doc_ids take part, but never name a component that has another id.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import LOWER, chained, doc_blocks, frugal, ragged, release, stage, word_hashes, word_spans
from strata.llm.graph import components

RISK = 1e-8
#: Lists up to this length meet in a join; longer ones in blocks of up to about BLOCK_ROWS members a side.
BLOCK_MEMBERS = 16
BLOCK_ROWS = 256
#: Up to this many candidate documents (about 40 bytes each) their ids are broadcast to find their texts.
BROADCAST_IDS = 300_000


@dataclass(frozen=True)
class Settings:
    """Words per shingle, threshold as num / den, retained values per document."""

    words: int = 5
    num: int = 80
    den: int = 100
    keep: int = 32

    @property
    def least_shared(self) -> int:
        """Fewest of ``keep`` union values that linked documents share, but for a chance of RISK."""
        t, tail = self.num / self.den, 0.0
        for c in range(self.keep + 1):
            tail += math.comb(self.keep, c) * t**c * (1 - t) ** (self.keep - c)
            if tail > RISK:
                return max(1, c)
        return self.keep

    def needed(self, size: Column) -> Column:
        """Fewest shared retained values of a document with ``size`` shingles."""
        return F.least(F.lit(self.least_shared), F.floor((size * self.num + (self.den - 1)) / self.den)).cast("int")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (as signed 64-bit) of each document of a block."""
    low = LOWER[data]
    starts, ends, docs = word_spans(low, offsets)
    n = len(offsets) - 1
    out = [np.empty(0, np.int64)] * n
    if not len(starts):
        return out
    hashes = word_hashes(low, starts, ends)
    runs = chained(hashes, words).view(np.int64)
    bounds = np.searchsorted(docs, np.arange(n + 1))
    for i in range(n):
        a, b = bounds[i], bounds[i + 1]
        if b - a >= words:
            out[i] = np.unique(runs[a : b - words + 1])
        elif b > a:
            out[i] = chained(hashes[a:b], int(b - a)).view(np.int64)
    return out


def sketches(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, nid (node; null without words), sketch."""

    def run(batches):
        for part, data, offsets in doc_blocks(batches):
            sets = shingle_sets(data, offsets, s.words)
            nid = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) if len(x) else None for x in sets]
            kept = [x[: s.keep] for x in sets]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("th"), pa.array([len(x) for x in sets], pa.int64()), pa.array(nid, pa.int64()),
                ragged(np.concatenate([*kept, np.empty(0, np.int64)]), np.array([len(x) for x in kept], np.int64), pa.int64()),
            ], names=["doc_id", "th", "n_shingles", "nid", "sketch"])

    slim = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    return slim.mapInArrow(frugal(run), "doc_id long, th long, n_shingles long, nid long, sketch array<bigint>")


def inverted_lists(nodes: DataFrame, s: Settings) -> DataFrame:
    """v, nid, n_shared, weight: the lists through which each node must be found."""
    rows = nodes.select("nid", "n_shingles", F.explode("sketch").alias("v"))
    common = rows.groupBy("v").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
    shared = rows.join(common, "v")
    own = Window.partitionBy("nid")
    ranked = shared.select(
        "nid", "v", "cnt", s.needed(F.col("n_shingles")).alias("need"),
        F.count(F.lit(1)).over(own).alias("n_shared"), F.sum("cnt").over(own).alias("weight"),
        F.row_number().over(own.orderBy("cnt", "v")).alias("r"),
    )
    return ranked.where("n_shared >= need AND r <= n_shared - need + 1").select("v", "nid", "n_shared", "weight")


def full_sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """nid, n, vals (all shingle hashes) of the wanted nodes (nid, doc_id, th), from their whole texts."""
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    left = docs.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("t"), "text")
    found = left.join(wanted, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("th"))).select("nid", "text")

    def run(batches):
        for part, data, offsets in doc_blocks(batches):
            sets = shingle_sets(data, offsets, s.words)
            n = np.array([len(x) for x in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("nid"), pa.array(n), ragged(np.concatenate([*sets, np.empty(0, np.int64)]), n, pa.int64())],
                names=["nid", "n", "vals"],
            )

    # repeated rows give a node twice; its sets are equal, and links are a set
    return found.mapInArrow(frugal(run), "nid long, n long, vals array<bigint>")


def similar(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose union sketch allows the threshold and whose full sets reach it."""
    side = lambda x: nodes.select(F.col("nid").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    near = near.where(F.least("na", "nb") * s.den >= F.greatest("na", "nb") * s.num)
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, s.keep)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    enough = F.when(F.size(union) < s.keep, both * s.den >= F.size(union) * s.num).otherwise(both >= s.least_shared)
    near = near.where(enough).select("a", "b")
    full = lambda x: sets.select(F.col("nid").alias(x), F.col("n").alias(f"n{x}"), F.col("vals").alias(f"v{x}"))
    exact = near.join(full("a"), "a").join(full("b"), "b")
    inter = F.size(F.array_intersect("va", "vb"))
    return exact.withColumn("i", inter).where(F.col("i") * s.den >= (F.col("na") + F.col("nb") - F.col("i")) * s.num).select("a", "b").distinct()


def own_shingles(sets: DataFrame, nids: DataFrame) -> DataFrame:
    """nid, u: how many shingles of a node no other of the given nodes has.

    Those can't be shared, so a pair shares at most min(n - u) shingles. A group
    of copies that were each edited on their own is told apart by this alone.
    """
    rows = sets.join(nids, "nid", "left_semi").select("nid", F.explode("vals").alias("s"))
    single = rows.groupBy("s").agg(F.min("nid").alias("nid"), F.max("nid").alias("last")).where("nid = last")
    return single.groupBy("nid").agg(F.count(F.lit(1)).alias("u"))


def _can_link(s: Settings, na: Column, ua: Column, nb: Column, ub: Column) -> Column:
    shared = F.least(na - ua, nb - ub)
    return shared * s.den >= (na + nb - shared) * s.num


def common_counts(left, right, width: int = 8192) -> np.ndarray:
    """How many values each array of ``left`` shares with each array of ``right`` (no repeats within an array)."""
    out = np.zeros((len(left), len(right)), np.int64)
    arrays = [np.asarray(x, np.int64) for x in [*left, *right]]
    flat = np.concatenate([*arrays, np.empty(0, np.int64)])
    if not len(flat):
        return out
    owner = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])
    _, codes, counts = np.unique(flat, return_inverse=True, return_counts=True)
    several = counts[codes] > 1
    owner, codes = owner[several], np.unique(codes[several], return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    for a in range(0, int(codes[-1]) + 1 if len(codes) else 0, width):  # a slice of the values at a time
        s, e = np.searchsorted(codes, [a, a + width])
        grid = np.zeros((len(arrays), width), np.float32)
        grid[owner[s:e], codes[s:e] - a] = 1
        out += (grid[: len(left)] @ grid[len(left) :].T).astype(np.int64)
    return out


def _deltas(nids: DataFrame, sets: DataFrame) -> DataFrame:
    """nid, fam, fam_n, missing, extra: what a node lacks of its family's leader and has beyond it."""
    own = nids.join(sets.select("nid", "vals"), "nid")
    lead = sets.select(F.col("nid").alias("fam"), F.col("n").alias("fam_n"), F.col("vals").alias("lead_vals"))
    both = own.join(lead, "fam")
    return both.select(
        "nid", "fam", "fam_n", F.array_except("lead_vals", "vals").alias("missing"), F.array_except("vals", "lead_vals").alias("extra")
    ).dropDuplicates(["nid"])


def open_pairs(lists: DataFrame, comps: DataFrame, nodes: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs that share a list, lie in different components, haven't met in a star and could be linked."""
    top = F.max(F.struct("lead_shared", "lead_weight", "lead"))
    family = lists.groupBy("nid").agg(top.alias("t")).select("nid", F.col("t.lead").alias("fam"))
    for _ in range(2):  # a leader may follow a more central one
        above = family.select(F.col("nid").alias("lead_nid"), F.col("fam").alias("top_fam"))
        family = family.join(above, F.col("fam") == F.col("lead_nid"), "left").select("nid", F.coalesce("top_fam", "fam").alias("fam"))
    family = stage(family, "families")
    named = lists.where("nid <> lead").join(comps.select(F.col("node").alias("nid"), "component"), "nid", "left")
    named = named.select("v", "nid", F.coalesce("component", "nid").alias("comp"))

    def still_open(members: DataFrame) -> DataFrame:
        per = members.groupBy("v", "comp").agg(F.count(F.lit(1)).alias("k"))
        tops = per.groupBy("v").agg(
            F.count(F.lit(1)).alias("comps"), F.sum("k").alias("m"), F.max(F.struct("k", "comp")).alias("top")
        ).where("comps > 1").select(F.col("v").alias("w"), "m", F.col("top.comp").alias("main"))
        return members.join(tops, F.col("v") == F.col("w")).drop("w")

    first = stage(still_open(named), "open-lists")
    own = own_shingles(sets, first.select("nid").distinct())
    known = stage(
        first.select("nid").distinct().join(nodes.select("nid", F.col("n_shingles").alias("n")), "nid").join(own, "nid", "left")
        .select("nid", "n", F.coalesce("u", F.lit(0)).alias("u")), "own-shingles",
    )
    rest = first.select("v", "nid", "comp").join(known, "nid")
    # the best partner that a list could hold is as small as its smallest member
    least = rest.groupBy("v").agg(F.min("n").alias("lo")).withColumnRenamed("v", "w")
    room = F.col("n") - F.col("u")
    rest = rest.join(least, F.col("v") == F.col("w")).where(
        room * s.den >= (F.greatest("lo", room) + F.col("u")) * s.num
    ).drop("w", "lo")
    rest = stage(still_open(rest), "open-lists")

    short = rest.where(F.col("m") <= BLOCK_MEMBERS).select("v", "nid", "comp", "n", "u")
    other = short.select(*[F.col(c).alias(f"{c}2") for c in short.columns])
    pairs = short.join(other, (F.col("v") == F.col("v2")) & (F.col("nid") < F.col("nid2")) & (F.col("comp") != F.col("comp2")))
    pairs = pairs.where(_can_link(s, F.col("n"), F.col("u"), F.col("n2"), F.col("u2")))
    pairs = pairs.select(F.col("nid").alias("a"), F.col("nid2").alias("b")).distinct()

    long = rest.where(F.col("m") > BLOCK_MEMBERS)
    if long.isEmpty():
        return pairs
    odd = F.col("comp") != F.col("main")
    n_odd = long.where(odd).groupBy("v").agg(F.count(F.lit(1)).alias("o")).withColumnRenamed("v", "w")
    size = F.lit(float(BLOCK_ROWS))
    ids = long.select("nid").distinct()
    deltas = stage(_deltas(ids.join(family, "nid"), sets), "deltas")
    long = long.join(n_odd, F.col("v") == F.col("w")).drop("w").join(nodes.select("nid", "sketch"), "nid").join(deltas, "nid")
    long = long.withColumn("rows", F.ceil(F.col("o") / size)).withColumn("cols", F.ceil(F.col("m") / size))
    zero = F.lit(0).cast("long")
    left = long.where(odd).select(
        "v", F.pmod(F.hash("nid"), F.col("rows")).alias("i"), F.explode(F.sequence(zero, F.col("cols") - 1)).alias("j"),
        F.lit(True).alias("is_left"), "nid", "comp", "n", "u", odd.alias("odd"), "sketch", "fam", "fam_n", "missing", "extra",
    )
    right = long.select(
        "v", F.explode(F.sequence(zero, F.col("rows") - 1)).alias("i"), F.pmod(F.hash("nid"), F.col("cols")).alias("j"),
        F.lit(False).alias("is_left"), "nid", "comp", "n", "u", odd.alias("odd"), "sketch", "fam", "fam_n", "missing", "extra",
    )
    least_shared, num, den = s.least_shared, s.num, s.den

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        """Linked pairs of a left and a right member: exact for members of one family, whose
        sets are known by what they lack of and add to the family's leader; the pairs of
        others that own shingles and sketches allow."""
        l, r = block[block.is_left], block[~block.is_left]
        if not len(l) or not len(r):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        ln, lu, rn, ru = (x.to_numpy(np.int64) for x in (l.n, l.u, r.n, r.u))
        most = np.minimum((ln - lu)[:, None], (rn - ru)[None, :])
        total = ln[:, None] + rn[None, :]
        ok = most * den >= (total - most) * num
        ok &= l.comp.to_numpy()[:, None] != r.comp.to_numpy()[None, :]
        ok &= ~r.odd.to_numpy(bool)[None, :] | (r.nid.to_numpy()[None, :] > l.nid.to_numpy()[:, None])
        if ok.any():
            lens = lambda f, c: np.array([len(x) for x in f[c]], np.int64)
            kin = l.fam.to_numpy()[:, None] == r.fam.to_numpy()[None, :]
            shared = l.fam_n.to_numpy(np.int64)[:, None] - lens(l, "missing")[:, None] - lens(r, "missing")[None, :]
            shared = shared + common_counts(l.missing, r.missing) + common_counts(l.extra, r.extra)
            linked = shared * den >= (total - shared) * num
            ls, rs = lens(l, "sketch"), lens(r, "sketch")
            least = np.minimum(least_shared, np.minimum(ls[:, None], rs[None, :]) * num // den)
            close = common_counts(l.sketch, r.sketch) >= least
            ok &= np.where(kin, linked, close)
        i, j = np.nonzero(ok)
        if len(i):  # of a row's verified links to one component, one connects as well as all
            exact = np.flatnonzero(kin[i, j])
            _, comp = np.unique(r.comp.to_numpy()[j[exact]], return_inverse=True)
            _, first = np.unique(i[exact] * (len(exact) + 1) + comp, return_index=True)
            keep = ~kin[i, j]
            keep[exact[first]] = True
            i, j = i[keep], j[keep]
        return pd.DataFrame({"a": l.nid.to_numpy()[i], "b": r.nid.to_numpy()[j]})

    blocks = left.union(right).groupBy("v", "i", "j").applyInPandas(meet, "a long, b long")
    return pairs.union(blocks.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()


def near_duplicates(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """doc_id, th, n_shingles, group_id, component_id, kept for every row of docs (doc_id, text).

    group_id names the group (null without words), component_id is the smallest
    doc_id among all linked documents and copies; kept marks the rows that carry it.
    """
    s = s or Settings()
    prepared = stage(sketches(docs, s), "sketches")
    nodes = prepared.where("nid IS NOT NULL").groupBy("nid").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "th")).alias("rep"),
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"),
    )
    nodes = stage(nodes, "nodes")
    lists = stage(inverted_lists(nodes, s), "lists")
    # a list's most central member: with most shared values, in the longest lists
    lead = lists.groupBy("v").agg(
        F.count(F.lit(1)).alias("len"), F.max(F.struct("n_shared", "weight", "nid")).alias("top")
    ).where("len > 1").select(
        F.col("v").alias("w"), F.col("top.nid").alias("lead"), F.col("top.n_shared").alias("lead_shared"), F.col("top.weight").alias("lead_weight")
    )
    all_lists = lists
    lists = stage(lists.join(lead, F.col("v") == F.col("w")).drop("w", "n_shared", "weight"), "led-lists")
    release(all_lists)

    wanted = lists.select("nid").distinct().join(nodes.select("nid", "rep.doc_id", "rep.th"), "nid")
    sets = stage(full_sets(docs, stage(wanted, "wanted"), s), "sets")
    stars = lists.where("nid <> lead").select(F.col("lead").alias("a"), F.col("nid").alias("b")).distinct()
    links = stage(similar(stars, nodes, sets, s), "links-1")
    comps = stage(components(links, "a", "b"), "components-1")
    more = stage(similar(open_pairs(lists, comps, nodes, sets, s), nodes, sets, s), "links-2")
    release(lists, sets)
    if not more.isEmpty():
        comps = stage(components(links.union(more), "a", "b"), "components-2")

    named = nodes.select("nid", "first_id").join(comps.withColumnRenamed("node", "nid"), "nid", "left")
    smallest = named.where("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least_id"))
    named = named.join(smallest, "component", "left").select(
        F.col("nid").alias("node"), F.coalesce("component", "nid").alias("group_id"),
        F.coalesce("least_id", "first_id").alias("least_id"),
    )
    out = prepared.select("doc_id", "th", "n_shingles", "nid").join(named, F.col("nid") == F.col("node"), "left")
    out = out.withColumn("component_id", F.when(F.col("nid").isNull(), F.col("doc_id")).otherwise(F.col("least_id")))
    return out.select("doc_id", "th", "n_shingles", "group_id", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_per_group(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """The rows of docs without near duplicates: of each group the row with the smallest
    doc_id (then text hash) stays; rows without words all stay."""
    rows = stage(near_duplicates(docs.select("doc_id", "text"), s), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    best = rows.where("group_id IS NOT NULL").groupBy("group_id").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n"))
    grouped = rows.join(best.where("n > 1").withColumnRenamed("group_id", "g"), F.col("group_id") == F.col("g"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))
    gone = stage(grouped.where(~stays).select(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th")).distinct(), "gone")
    again = stage(
        grouped.where(stays).groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
            F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th")
        ), "repeated",
    )

    def matching(small: DataFrame):
        left = F.broadcast(small) if small.count() <= BROADCAST_IDS else small
        return left, docs["doc_id"].cast("long").eqNullSafe(left["gone_id"]) & (F.xxhash64(docs["text"]) == left["gone_th"])

    left, match = matching(gone)
    kept = docs.join(left, match, "left_anti")
    if not again.isEmpty():  # a row that stands several times stays once
        left, match = matching(again)
        once = docs.join(left, match, "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(left, match, "left_anti").unionByName(once)
    return kept
