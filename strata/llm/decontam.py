"""Benchmark decontamination by q-gram lemma filtering.

A document holds a benchmark item if some part of it is within the item's edit
budget k (``EDIT_RATE`` of its length, at most (m - Q) / Q edits): an item of 38 words
with four words replaced counts, or one that lacks its last tenth; a copy that
lacks more than the budget doesn't. Both are compared in a plain form:
ASCII and Latin-1 letters lower-cased, everything but letters and digits folded
into one space.

1. The item's and the document's character q-grams are compared by hash. By the
   q-gram lemma a region within k edits shares at least T = (m - q + 1) - k q
   q-grams with an item of m characters, so stretches of a document with too few
   shared q-grams of any item are passed over at once.
2. The shared q-grams of the rest are counted per item in overlapping diagonal
   bands: an alignment with k edits stays within k + 1 neighbouring diagonals,
   and bands of twice that width, k + 1 apart, hold it whole. Bands with fewer
   than T are dropped.
3. What remains is verified by banded alignment of the whole item, all
   candidates of an item at once.

The benchmark is the stated query set: it is read in blocks of bounded size and
broadcast block by block; the documents aren't shuffled.

Defined results: null and empty texts and items hold and match nothing; an item without id is matched like
any other, with a null item_id; items shorter than q must occur exactly; repeated rows get equal results; overlapping
matches of one item count once (fewest edits, then first); columns named like
the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from strata.llm.common import (
    BYTE_VALUES,
    LOWER,
    arrow_schema,
    doc_blocks,
    frugal,
    mix64,
    powers,
    prefix_hash,
    stage,
    text_bytes,
    without,
)

Q = 8
EDIT_RATE = 0.11
#: A block of the benchmark holds about this many bytes of item text.
BLOCK_ITEM_BYTES = 4 << 20
_BITS = 22
_COUNTERS = (1 << 21) - 1

MATCH = StructType([
    StructField("item_id", LongType()), StructField("start", LongType()), StructField("end", LongType()),
    StructField("edits", IntegerType()),
])

_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Plain bytes of a block, their document offsets, and where each stood in the text."""
    low = LOWER[data]
    latin = np.flatnonzero(low[:-1] == 0xC3) + 1
    latin = latin[(low[latin] >= 0x80) & (low[latin] <= 0x9E) & (low[latin] != 0x97)]
    low[latin] += 0x20
    letter = _PLAIN[low]
    before = np.zeros(len(low), bool)
    before[1:] = letter[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(low)]] = False
    keep = letter | before
    where = np.flatnonzero(keep)
    out = np.where(letter[where], low[where], np.uint8(0x20))
    return out, np.searchsorted(where, offsets), where


def gram_hashes(data: np.ndarray) -> np.ndarray:
    n = len(data) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    prefix = prefix_hash(BYTE_VALUES[data])
    _, down = powers(len(prefix))
    return mix64((prefix[Q:] - prefix[:-Q]) * down[:n])


@dataclass
class Items:
    """q-gram postings of a block of items."""

    ids: list[int | None]
    texts: list[np.ndarray]
    budgets: np.ndarray
    needed: np.ndarray
    short: list[int]  # items under q characters
    bitmap: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray


def index(rows: list[tuple[int | None, str]]) -> Items:
    ids = [None if i is None else int(i) for i, _ in rows]
    data, offsets = text_bytes(pa.array([t for _, t in rows], pa.string()))
    flat, bounds, _ = plain(data, offsets)
    texts = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        t = flat[a:b]
        texts.append(t[: len(t) - 1] if len(t) and t[-1] == 0x20 else t)
    m = np.array([len(t) for t in texts], np.int64)
    budgets = np.maximum(np.minimum((m * EDIT_RATE).astype(np.int64), (m - Q) // Q), 0)
    hashes = [gram_hashes(t) for t in texts]
    key = np.concatenate([*hashes, np.empty(0, np.uint64)])
    item = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
    place = np.concatenate([*[np.arange(len(h)) for h in hashes], np.empty(0, np.int64)]).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, item, place = key[order], item[order], place[order]
    keys, first = np.unique(key, return_index=True)
    bitmap = np.zeros(1 << _BITS, bool)
    bitmap[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return Items(
        ids, texts, budgets, m - Q + 1 - budgets * Q, [i for i, t in enumerate(texts) if 0 < len(t) < Q],
        bitmap, keys, np.append(first, len(key)), item, place,
    )


def candidates(x: Items, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (doc, item, first diagonal of the band) whose band count reaches the item's bound."""
    none = np.empty((0, 3), np.int64)
    long = np.flatnonzero(x.needed > 0)
    long = long[[len(x.texts[i]) >= Q for i in long]] if len(long) else long
    if not len(long) or len(data) < Q:
        return none
    grams = gram_hashes(data)
    at = np.flatnonzero(x.bitmap[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
    slot = np.searchsorted(x.keys, grams[at])
    ok = x.keys[np.minimum(slot, len(x.keys) - 1)] == grams[at]
    at, slot = at[ok], slot[ok]
    doc = np.searchsorted(offsets, at, "right") - 1
    ok = at + Q <= offsets[doc + 1]
    at, slot, doc = at[ok], slot[ok], doc[ok]
    # a region that any item needs holds at least ``few`` hits within ``wide`` bytes
    few = int(x.needed[long].min())
    wide = int(max(len(x.texts[i]) + x.budgets[i] for i in long))
    if few > 1:
        if len(at) < few:
            return none
        dense = (at[few - 1 :] - at[: len(at) - few + 1] <= wide) & (doc[few - 1 :] == doc[: len(doc) - few + 1])
        edge = np.zeros(len(at) + 1, np.int64)
        first = np.flatnonzero(dense)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + few, -1)
        ok = np.cumsum(edge[:-1]) > 0
        at, slot, doc = at[ok], slot[ok], doc[ok]
    out = []
    # hits unfold into postings in slices, so a very repetitive text can't unfold all at once
    count = x.first[slot + 1] - x.first[slot]
    for a, b in _slices(count, doc):
        n = count[a:b]
        post = np.repeat(x.first[slot[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item = x.item[post]
        hit = np.repeat(np.arange(a, b), n)
        # a region lies in two neighbouring stretches of ``wide`` bytes: counts there bound the band's
        # (stretches that share a counter only raise it)
        code = at[hit] // wide * len(x.ids) + item
        total = np.bincount(code & _COUNTERS, minlength=_COUNTERS + 1)
        here, after, before = (total[(code + d) & _COUNTERS] for d in (0, len(x.ids), -len(x.ids)))
        ok = np.flatnonzero(here + np.maximum(after, before) >= x.needed[item])
        item, post, hit = item[ok], post[ok], hit[ok]
        if not len(hit):
            continue
        step = x.budgets[item] + 1
        diagonal = at[hit] - x.place[post] - offsets[doc[hit]]
        band = diagonal // step
        key = doc[hit] * len(x.ids) + item
        key = np.concatenate([key, key])
        band = np.concatenate([band, band - 1])
        order = np.lexsort((band, key))
        key, band = key[order], band[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (band[1:] != band[:-1])])
        cut = np.flatnonzero(new)
        hits = np.diff(np.append(cut, len(key)))
        key, band = key[cut], band[cut]
        ok = hits >= x.needed[key % len(x.ids)]
        key, band = key[ok], band[ok]
        item = key % len(x.ids)
        out.append(np.stack([key // len(x.ids), item, band * (x.budgets[item] + 1)], axis=1))
    return np.concatenate(out) if out else none


def _slices(count: np.ndarray, doc: np.ndarray, most: int = 1 << 21):
    """Cut the hits between documents so that a slice unfolds to about ``most`` postings."""
    if not len(count):
        return
    ends = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, len(doc))
    total = np.cumsum(count)
    a = 0
    while a < len(doc):
        limit = (total[a - 1] if a else 0) + most
        k = int(np.searchsorted(total[ends - 1], limit, "right")) - 1
        b = int(ends[k]) if k >= 0 and ends[k] > a else int(ends[np.searchsorted(ends, a, "right")])
        yield a, b
        a = b


_FAR = np.int32(1 << 20)


def banded(item: np.ndarray, windows: np.ndarray, diagonals: int, free: bool) -> np.ndarray:
    """Last row of the banded edit distance of ``item`` against each window.

    Cell (i, d) aligns the first i characters of the item with the window up to
    i + d. Entry d of the result is the least edits of the whole item ending
    there; with ``free`` it may begin on any diagonal, else at the window's start.
    """
    d = np.arange(diagonals, dtype=np.int32)
    cost = np.zeros((len(windows), diagonals), np.int32) if free else np.repeat(d[None, :], len(windows), axis=0)
    for i, c in enumerate(item):
        step = cost + (windows[:, i : i + diagonals] != c)
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - d, axis=1) + d
    return cost


def verify(x: Items, data: np.ndarray, offsets: np.ndarray, found: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(doc, item, start, end, edits) of the candidates within budget; places in the document's plain text."""
    out = []
    for item in np.unique(found[:, 1]):
        text, k = x.texts[item], int(x.budgets[item])
        rows = found[found[:, 1] == item]
        m, band = len(text), 2 * (k + 1)
        wide = band + k + 1
        for a in range(0, len(rows), 256):
            part = rows[a : a + 256]
            windows = np.full((len(part), m + wide), 0, np.uint8)
            for r, (doc, _, diagonal) in enumerate(part):
                lo, hi = int(offsets[doc]), int(offsets[doc + 1])
                begin = lo + int(diagonal)
                s, e = max(begin, lo), min(begin + m + wide, hi)
                if e > s:
                    windows[r, s - begin : e - begin] = data[s:e]
            cost = banded(text, windows, wide, True)
            best = cost.argmin(axis=1)
            edits = cost[np.arange(len(part)), best]
            good = np.flatnonzero(edits <= k)
            if not len(good):
                continue
            # the same from the end gives the start
            back = np.full((len(good), m + k + 1), 0, np.uint8)
            for r, g in enumerate(good):
                end = int(best[g]) + m
                piece = windows[g, max(0, end - m - k - 1) : end][::-1]
                back[r, : len(piece)] = piece
            cost = banded(text[::-1], back, k + 1, False)
            for r, g in enumerate(good):
                doc, _, diagonal = part[g]
                end = int(diagonal) + int(best[g]) + m
                ok = np.flatnonzero(cost[r] == cost[r].min())
                length = m + int(ok[0])
                # fewer characters than the item: the shortest piece with the same edits
                start = max(0, end - length)
                out.append((int(doc), int(item), start, min(end, int(offsets[doc + 1] - offsets[doc])), int(edits[g])))
    return out


def passages(x: Items, data: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
    """Matches of each document of a block, in byte places of the original text."""
    flat, bounds, where = plain(data, offsets)
    got = verify(x, flat, bounds, candidates(x, flat, bounds))
    for i in x.short:
        needle = x.texts[i].tobytes()
        for doc in range(len(bounds) - 1):
            hay, at = flat[bounds[doc] : bounds[doc + 1]].tobytes(), -1
            while (at := hay.find(needle, at + 1)) >= 0:
                got.append((doc, i, at, at + len(needle), 0))
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for doc, item, start, end, edits in sorted(got, key=lambda g: (g[0], g[1], g[4], g[2], g[3])):
        spans = taken.setdefault((doc, item), [])
        if any(start < e and s < end for s, e in spans) or end <= start:
            continue
        spans.append((start, end))
        base = bounds[doc]
        out[doc].append({
            "item_id": x.ids[item], "start": int(where[base + start] - offsets[doc]),
            "end": int(where[base + end - 1] + 1 - offsets[doc]), "edits": edits,
        })
    return out


def item_blocks(benchmark: DataFrame, most: int = BLOCK_ITEM_BYTES) -> Iterator[Items]:
    """The benchmark's items with text, cut by a hash of the text into blocks of about ``most`` bytes, one at a time."""
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // most) + 1
    for i in range(n):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i).distinct().collect()
        yield index(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "matches") -> DataFrame:
    """Add the array of (item_id, start, end, edits) of the benchmark items that each text holds."""
    docs = without(docs, out)
    schema = StructType([*docs.schema.fields, StructField(out, ArrayType(MATCH, False))])
    target = arrow_schema(schema)
    kind = target.field(out).type
    marked = None
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # item_blocks bounds it
        source = docs if marked is None else marked
        into = source.schema if marked is not None else schema

        def run(batches, shared=shared, first=marked is None):
            for part, data, offsets in doc_blocks(batches, text):
                found = passages(shared.value, data, offsets)
                if not first:
                    found = [[*old, *new] for old, new in zip(part.column(out).to_pylist(), found, strict=True)]
                columns = [*part.columns[: len(target) - 1], pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)

        marked = source.mapInArrow(frugal(run), into)
    return marked


def holders(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), matches of the rows that hold an item; other columns and rows stay in the JVM.

    The benchmark's blocks are built, broadcast and released one after the other.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    schema = StructType([*slim.schema.fields[:2], StructField("matches", ArrayType(MATCH, False))])
    kind, out = arrow_schema(schema).field("matches").type, None
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # item_blocks bounds it

        def run(batches, shared=shared):
            for part, data, offsets in doc_blocks(batches):
                found = passages(shared.value, data, offsets)
                at = [i for i, f in enumerate(found) if f]
                if at:
                    keys = [part.column(c).take(pa.array(at)) for c in ("doc_id", "th")]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array([found[i] for i in at], kind)], names=["doc_id", "th", "matches"])

        held = stage(slim.mapInArrow(frugal(run), schema), "held")
        shared.unpersist()
        out = held if out is None else out.unionByName(held)
    return out


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark passage it holds."""
    return holders(docs, benchmark).select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
