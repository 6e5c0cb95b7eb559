"""Long repeated byte strings from a logarithmic family of sampled suffix arrays.

``duplicate_spans`` finds every byte covered by a string of ``length`` bytes
that also starts anywhere else, in the same or another document.

* **Sampled suffixes.** An array over every byte would take many times the
  text. Of each string of ``length`` bytes the suffix at its anchor is kept:
  the place of the smallest hash of ``GRAM`` bytes within the string. Equal
  strings have equal anchors, and neighbouring strings mostly share theirs, so
  one suffix stands for about 85 bytes.
* **Index family.** Documents come in batches. A batch's suffixes are sorted by
  the hash of their first ``GRAM`` bytes into its suffix array, merge-scanned
  (a sort-merge join) against every level of the family for suffixes that
  recur, and added as a level; two levels that hold equally many batches merge,
  so the family has logarithmically many.
* **Long matches.** Suffixes that recur are only candidates. The strings of an
  anchor are compared as one run first: where the whole run recurs, all its
  strings do. Runs that don't (the ends of matches) are split at fixed
  distances from the anchor into parts of up to ``PART`` strings, and parts
  whose shared core recurs but that don't recur whole into single strings. Each
  comparison is a count by hash with partial sums, so a passage that a third of
  all documents share costs one row per task, never one group in a task.

Comparisons key on two 64-bit values (suffix and run). Defined results: null
and empty texts have no bytes; repeated rows duplicate each other; texts
shorter than ``length`` never match; null doc_ids take part like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BYTE_VALUES, doc_blocks, frugal, mix64, powers, prefix_hash, ragged, release, span_hash, stage

LENGTH = 200
GRAM = 32
PART = 16
#: Batches in which ``duplicate_spans`` feeds a whole table to the family.
BATCHES = 4
#: Up to this many recurring suffixes (8 bytes each) or candidate documents (16 bytes) are broadcast, more are shuffled.
BROADCAST_ROWS = 1 << 19
_NO_ROW = np.empty(0, np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, prefix: np.ndarray, length: int = LENGTH):
    """Runs of strings with one anchor: doc, first and last start, anchor, hash of the suffix's first bytes.

    All starts are places in the block. The leftmost of equal minima is the
    anchor, so the anchor depends on nothing but the string's own bytes.
    """
    width = length - GRAM + 1
    n = len(data) - GRAM + 1
    if n < width:
        return (_NO_ROW,) * 4 + (np.empty(0, np.uint64),)
    _, down = powers(len(prefix))
    gram = mix64((prefix[GRAM:] - prefix[:-GRAM]) * down[:n])
    # the low 20 bits order equal minima by place; a block longer than that is scanned in pieces
    low = np.uint64((1 << 20) - 1)
    out = []
    piece = (1 << 20) - 1
    for a in range(0, n - width + 1, piece - width + 1):
        b = min(a + piece, n)
        rank = (gram[a:b] & ~low) | np.arange(b - a, dtype=np.uint64)
        m = b - a
        pad = -m % width
        grid = np.concatenate([rank, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        best = np.minimum(behind[: m - width + 1], ahead[width - 1 : m])
        out.append(a + (best & low).astype(np.int64))
    anchor = np.concatenate(out)
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    if not sizes.any():
        return (_NO_ROW,) * 4 + (np.empty(0, np.uint64),)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.arange(len(doc)) + np.repeat(offsets[:-1] - (np.cumsum(sizes) - sizes), sizes)
    anchor = anchor[starts]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return doc[first], starts[first], starts[last], anchor[first], gram[anchor[first]]


class SuffixFamily:
    """Levels of sorted suffix hashes; ``add`` returns those of the batch that recur."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, DataFrame]] = []  # batches held, (suffix, many)
        self.merged: list[DataFrame] = []  # levels that went into larger ones

    def add(self, suffixes: DataFrame) -> DataFrame:
        """``suffixes``: one row per sampled suffix of a new batch (column ``suffix``).

        Returns the distinct suffix hashes that occur twice, within the batch
        or in it and a level, as a lazy frame over written tables.
        """
        array = suffixes.groupBy("suffix").agg((F.count(F.lit(1)) > 1).alias("many")).sortWithinPartitions("suffix")
        array = stage(array, "level")
        recurring = [array.where("many").select("suffix")]
        for _, level in self.levels:
            recurring.append(array.select("suffix").join(level.select("suffix"), "suffix"))
        held = 1
        while self.levels and self.levels[-1][0] == held:
            _, other = self.levels.pop()
            self.merged += [array, other]
            both = array.unionByName(other).groupBy("suffix").agg((F.max("many") | (F.count(F.lit(1)) > 1)).alias("many"))
            array, held = stage(both.sortWithinPartitions("suffix"), "level"), 2 * held
        self.levels.append((held, array))
        out = recurring[0]
        for r in recurring[1:]:
            out = out.union(r)
        return out

    def drop(self) -> None:
        """Remove the files of all levels (a family that is to grow further is kept)."""
        release(*self.merged, *[level for _, level in self.levels])


def sampled_suffixes(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, th, suffixes: each document's distinct sampled suffixes, and ``twice`` for those it holds twice."""

    def run(batches):
        for part, data, offsets in doc_blocks(batches):
            doc, _, _, _, key = anchors(data, offsets, prefix_hash(BYTE_VALUES[data]), length)
            key = key.view(np.int64)
            order = np.lexsort((key, doc))
            d, k = doc[order], key[order]
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]) if len(d) else np.empty(0, bool)
            group = np.cumsum(new) - 1
            many = np.bincount(group, minlength=0) > 1 if len(d) else np.empty(0, bool)
            d, k = d[new], k[new]
            n = len(part)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("th"), ragged(k, np.bincount(d, minlength=n), pa.int64()),
                ragged(k[many], np.bincount(d[many], minlength=n), pa.int64()),
            ], names=["doc_id", "th", "suffixes", "twice"])

    return docs.select("doc_id", "th", "text").mapInArrow(frugal(run), "doc_id long, th long, suffixes array<bigint>, twice array<bigint>")


def candidate_runs(found: DataFrame, length: int) -> DataFrame:
    """The runs of each document whose suffix recurs, with the hash of the run as a whole.

    ``lo`` and ``hi`` are the first and last start before the anchor (as
    distances), so that equal strings of two documents have equal values.
    """

    def run(batches):
        for part, data, offsets in doc_blocks(batches):
            prefix = prefix_hash(BYTE_VALUES[data])
            doc, first, last, anchor, key = anchors(data, offsets, prefix, length)
            wanted = part.column("wanted")
            counts = wanted.value_lengths().to_numpy(zero_copy_only=False)
            flat = wanted.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(part)), counts)
            ok = _pairs_in(doc, key.view(np.int64), owner, flat)
            doc, first, last, anchor, key = doc[ok], first[ok], last[ok], anchor[ok], key[ok]
            whole = span_hash(prefix, first, last + length)
            base = offsets[doc]
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").take(take), part.column("th").take(take), pa.array(key.view(np.int64)),
                pa.array(anchor - base), pa.array(anchor - last), pa.array(anchor - first), pa.array(whole.view(np.int64)),
            ], names=["doc_id", "th", "suffix", "anchor", "lo", "hi", "whole"])

    return found.mapInArrow(frugal(run), "doc_id long, th long, suffix long, anchor long, lo long, hi long, whole long")


def _pairs_in(doc: np.ndarray, key: np.ndarray, owner: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Which (doc, key) stand among (owner, flat)."""
    if not len(doc) or not len(flat):
        return np.zeros(len(doc), bool)
    _, codes = np.unique(np.concatenate([key, flat]), return_inverse=True)
    n = int(codes.max()) + 1
    return np.isin(doc * n + codes[: len(key)], owner * n + codes[len(key) :])


def part_hashes(found: DataFrame, length: int, single: bool) -> DataFrame:
    """Parts of the asked ranges (suffix, anchor, lo, hi) of each document, with whole and core hash.

    A part is [lo, hi] cut at multiples of PART, or one string if ``single``.
    """

    def run(batches):
        for part, data, offsets in doc_blocks(batches):
            prefix = prefix_hash(BYTE_VALUES[data])
            asked = part.column("asked")
            counts = asked.value_lengths().to_numpy(zero_copy_only=False)
            rows = asked.flatten()
            key, anchor, lo, hi = (rows.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            doc = np.repeat(np.arange(len(part)), counts)
            width = 1 if single else PART
            pieces = hi // width - lo // width + 1
            which = np.repeat(np.arange(len(lo)), pieces)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            cell = lo[which] // width + nth
            a, b = np.maximum(lo[which], cell * width), np.minimum(hi[which], cell * width + width - 1)
            base = offsets[doc[which]] + anchor[which]
            whole = span_hash(prefix, base - b, base - a + length)
            # what all strings of the uncut cell share; it lies inside each of them
            core = span_hash(prefix, base - cell * width, base - (cell * width + width - 1) + length)
            take = pa.array(doc[which])
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").take(take), part.column("th").take(take), pa.array(key[which]), pa.array(anchor[which]),
                pa.array(a), pa.array(b), pa.array(whole.view(np.int64)), pa.array(core.view(np.int64)),
            ], names=["doc_id", "th", "suffix", "anchor", "lo", "hi", "whole", "core"])

    return found.mapInArrow(frugal(run), "doc_id long, th long, suffix long, anchor long, lo long, hi long, whole long, core long")


def _same_row(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a written frame of few rows; otherwise leave the join to shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _with_rows(texts: DataFrame, per_row: DataFrame, column: str) -> DataFrame:
    joined = texts.join(per_row, _same_row(texts, per_row))
    return joined.select(texts["doc_id"], texts["th"], texts["text"], per_row[column])


def _groups(runs: DataFrame, keys: list[str], core: list[str], length: int, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(spans of runs that recur whole, one run of each group still to be split); ``runs`` is used up.

    ``keys`` say what makes runs equal, ``core`` what any equal strings of two
    runs must share. Of runs that recur one is kept as a partner for the rest.
    """
    groups = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "anchor")).alias("rep"))
    groups = stage(groups, "groups")
    many = groups.where("n > 1").select(*[F.col(k).alias(f"g_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(f"g_{k}"))
    solved = runs.join(many, match).select(
        "doc_id", "th", (F.col("anchor") - F.col("hi")).alias("start"), (F.col("anchor") - F.col("lo") + length).alias("end")
    )
    solved = stage(solved, "spans")
    release(runs)
    if last:
        release(groups)
        return solved, None
    cores = groups.groupBy(*core).agg(
        F.count(F.lit(1)).alias("g"), F.max((F.col("n") == 1).cast("int")).alias("open")
    ).where("g > 1 AND open = 1").select(*[F.col(k).alias(f"c_{k}") for k in core])
    match = F.lit(True)
    for k in core:
        match = match & (F.col(k) == F.col(f"c_{k}"))
    left = groups.join(cores, match).select("rep.doc_id", "rep.th", "suffix", "rep.anchor", "lo", "hi")
    left = stage(left, "open-runs")
    release(groups)
    return solved, left


def _ask(texts: DataFrame, runs: DataFrame) -> DataFrame:
    asked = runs.groupBy("doc_id", "th").agg(F.collect_list(F.struct("suffix", "anchor", "lo", "hi")).alias("asked"))
    return _with_rows(texts, asked, "asked")


def recurring_suffixes(samples: DataFrame, batches: int) -> DataFrame:
    """Feed the sampled suffixes to an index family in batches; the suffixes that recur."""
    family = SuffixFamily(samples.sparkSession)
    batch = F.pmod(F.hash("doc_id", "th"), F.lit(batches))
    out = None
    for i in range(batches):
        rows = samples.where(batch == i)
        suffixes = rows.select(F.explode("suffixes").alias("suffix")).union(rows.select(F.explode("twice").alias("suffix")))
        found = family.add(suffixes)
        out = found if out is None else out.union(found)
    out = stage(out.distinct(), "recurring")
    family.drop()
    return out


def duplicate_spans(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """For rows of (doc_id, text): the candidate rows (doc_id, th, text) and the spans
    (doc_id, th, start, end) of bytes covered by a string of ``length`` bytes that recurs."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    samples = stage(sampled_suffixes(docs, length), "suffixes")
    recurring = recurring_suffixes(samples, batches)

    rows = samples.select("doc_id", "th", F.explode("suffixes").alias("suffix")).join(_small(recurring), "suffix")
    wanted = stage(rows.groupBy("doc_id", "th").agg(F.collect_set("suffix").alias("wanted")), "wanted")
    release(samples, recurring)
    ids = _small(wanted.select("doc_id", "th"))
    texts = stage(docs.join(ids, _same_row(docs, ids), "left_semi"), "candidate-texts")

    runs = stage(candidate_runs(_with_rows(texts, wanted, "wanted"), length), "runs")
    release(wanted)
    spans, left = _groups(runs, ["suffix", "lo", "hi", "whole"], ["suffix"], length)
    cell = F.floor(F.col("lo") / PART).alias("cell")
    parts = stage(part_hashes(_ask(texts, left), length, single=False).withColumn("cell", cell), "parts")
    release(left)
    more, left = _groups(parts, ["suffix", "lo", "hi", "whole", "cell", "core"], ["suffix", "cell", "core"], length)
    strings = stage(part_hashes(_ask(texts, left), length, single=True).drop("core"), "strings")
    release(left)
    last, _ = _groups(strings, ["suffix", "lo", "hi", "whole"], ["suffix"], length, last=True)
    return texts, spans.union(more).union(last)


def cut(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, th, n_removed, n_spans, kept (bytes left) of every text with spans; overlapping spans are united."""
    per = spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def run(batches):
        for batch in batches:
            removed, runs, kept = [], [], []
            for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                out, at, n, k = [], 0, 0, 0
                united: list[list[int]] = []
                for a, b in sorted((f["start"], f["end"]) for f in found):
                    if united and a <= united[-1][1]:
                        united[-1][1] = max(united[-1][1], b)
                    else:
                        united.append([a, b])
                for a, b in united:
                    out.append(text[at:a])
                    at, n, k = b, n + b - a, k + 1
                out.append(text[at:])
                removed.append(n)
                runs.append(k)
                kept.append(b"".join(out))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("th"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()),
            ], names=["doc_id", "th", "n_removed", "n_spans", "kept"])

    return _with_rows(texts, per, "spans").mapInArrow(frugal(run), "doc_id long, th long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    texts, spans = duplicate_spans(docs.select("doc_id", "text"), length)
    changed = cut(texts, spans).select("doc_id", "th", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    changed = stage(changed.dropDuplicates(["doc_id", "th"]), "cut")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"),
    )
    return base.join(changed, _same_row(base, changed), "left").select(
        base["doc_id"], "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs (doc_id, text, other columns) with every repeated byte cut out of the text.

    A character that a cut would split goes with it. ``n_chars``, if there, is
    counted again for changed texts; rows whose whole text repeats stay, empty.
    """
    texts, spans = duplicate_spans(docs.select("doc_id", "text"), length)
    # written first: two Python steps in one stage would take two workers a task, which keep their memory
    changed = stage(cut(texts, spans).select("doc_id", "th", "kept"), "kept-bytes")

    def whole(batches):
        for batch in batches:
            kept = [x.decode("utf-8", "ignore") for x in batch.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(kept, pa.string())], names=["doc_id", "th", "kept"])

    changed = changed.mapInArrow(frugal(whole), "doc_id long, th long, kept string")
    changed = stage(changed.dropDuplicates(["doc_id", "th"]).withColumnRenamed("doc_id", "cut_id").withColumnRenamed("th", "cut_th"), "changed")
    same = lambda d: d["doc_id"].cast("long").eqNullSafe(F.col("cut_id")) & (d["__th"] == F.col("cut_th"))
    keyed = docs.withColumn("__th", F.xxhash64("text"))
    rest = keyed.join(_small(changed.select("cut_id", "cut_th")), same(keyed), "left_anti").drop("__th")
    slim = keyed.drop("text")
    touched = slim.join(changed, same(slim)).withColumn("text", F.col("kept"))
    if "n_chars" in docs.columns:
        touched = touched.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rest.unionByName(touched.select(*docs.columns))
