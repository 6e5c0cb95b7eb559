"""Quality rules on repetition, from suffix arrays over words.

For each block of documents a suffix array is built by prefix doubling. Words
of different documents count as different, so suffixes only meet within a
document, and a round works only on suffixes that still have an equal. The
ranks of every round are kept: adjacent suffixes get their longest common
prefix by descending through them, and the maximal repeated substrings are the
longest-common-prefix intervals. The rule unions the spans of all repeats of
at least ``min_words`` words and limits the covered share of the words and the
longest repeat.

Defined results: a null, empty or blank text has no words and fails the base
rule; equal rows get equal results; input columns named like the results are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from strata.llm.common import (
    BYTE_VALUES,
    arrow_schema,
    doc_blocks,
    prefix_hash,
    span_hash,
    without,
    word_spans,
)

#: Characters counted as symbols (fixed values of the rule).
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")


@dataclass(frozen=True)
class Limits:
    """Production thresholds. A repeat counts from ``min_words`` words on."""

    min_words: int = 5
    max_covered: float = 0.30
    max_longest: int = 60


def suffix_ranks(words: np.ndarray, docs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks after each doubling (round r compares 2**r words) and the suffix array.

    A rank is the place of the first suffix of its group, so a group that
    splits keeps its place and settled suffixes aren't touched again. A suffix
    that ends with its document has rank 0 beyond the end.
    """
    n = len(words)
    _, inverse = np.unique(words, return_inverse=True)
    key = docs.astype(np.int64) * (n + 1) + inverse
    order = np.argsort(key, kind="stable")
    ranks = [_group_starts(key[order], order, n)]
    last = np.flatnonzero(np.append(docs[1:] != docs[:-1], True))
    end = np.repeat(last + 1, np.diff(np.concatenate([[0], last + 1])))
    step = 1
    while True:
        rank = ranks[-1]
        size = np.bincount(rank, minlength=n + 1)
        todo = np.flatnonzero(size[rank] > 1)
        if not len(todo):
            break
        beyond = todo + step
        after = np.where(beyond < end[todo], rank[np.minimum(beyond, n - 1)], 0)
        inner = np.lexsort((after, rank[todo]))
        pos = todo[inner]
        r, a = rank[pos], after[inner]
        new_group = np.concatenate([[True], r[1:] != r[:-1]])
        new_part = new_group | np.concatenate([[True], a[1:] != a[:-1]])
        at = np.arange(len(pos))
        group_at = np.maximum.accumulate(np.where(new_group, at, 0))
        part_at = np.maximum.accumulate(np.where(new_part, at, 0))
        rank = rank.copy()
        rank[pos] = r + (part_at - group_at)
        ranks.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[ranks[-1] - 1] = np.arange(n)
    return ranks, order


def _group_starts(sorted_keys: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    first = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    return rank


def common_prefixes(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefix, in words, of the suffixes at ``a`` and ``b``."""
    n = len(ranks[0])
    out = np.zeros(len(a), np.int64)
    for r in range(len(ranks) - 1, -1, -1):
        i, j = a + out, b + out
        ok = (i < n) & (j < n)
        same = np.zeros(len(a), bool)
        same[ok] = ranks[r][i[ok]] == ranks[r][j[ok]]
        out[same] += 1 << r
    return out


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions inside any span [start, start + length)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def longest_repeats(words: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each word, the length of the longest repeated substring that starts there."""
    ranks, order = suffix_ranks(words, docs)
    best = np.zeros(len(words), np.int64)
    if len(words) > 1 and len(ranks) > 1:
        twin = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]])
        a, b = order[twin], order[twin + 1]
        lcp = common_prefixes(ranks, a, b)
        np.maximum.at(best, a, lcp)
        np.maximum.at(best, b, lcp)
    return best, ranks


def block_counts(data: np.ndarray, offsets: np.ndarray, min_words: int) -> dict[str, np.ndarray]:
    """The counts of each document of a block."""
    n_docs = len(offsets) - 1
    starts, ends, docs = word_spans(data, offsets)
    per_doc = lambda values: np.bincount(docs, values, n_docs).astype(np.int64)
    out = {"n_words": np.bincount(docs, minlength=n_docs).astype(np.int64)}
    zero = np.zeros(n_docs, np.int64)
    if not len(data):
        return {k: zero for k in COUNTS}
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out["word_chars"] = per_doc(chars[ends] - chars[starts])
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    symbols = np.concatenate([[0], np.cumsum(is_symbol[data])])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]
    prefix = prefix_hash(BYTE_VALUES[data])
    out["n_dup_lines"] = _dup_lines(data, offsets, prefix, starts)
    if not len(starts):
        return out | {k: zero for k in COUNTS if k not in out}
    words = span_hash(prefix, starts, ends)
    best, ranks = longest_repeats(words, docs)
    n = len(words)
    round8 = WINDOW.bit_length() - 1
    twice = np.empty(0, np.int64)
    if len(ranks) > round8:
        size = np.bincount(ranks[round8], minlength=n + 1)
        twice = np.flatnonzero(size[ranks[round8]] > 1)
    out["n_repeat_words"] = per_doc(covered(twice, np.full(len(twice), WINDOW), n))
    long = np.flatnonzero(best >= min_words)
    out["n_covered"] = per_doc(covered(long, best[long], n))
    longest = zero.copy()
    np.maximum.at(longest, docs, best)
    out["longest_repeat"] = longest
    return out


def _dup_lines(data: np.ndarray, offsets: np.ndarray, prefix: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document."""
    n_docs = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    has = np.searchsorted(word_starts, end) > np.searchsorted(word_starts, begin)
    begin, end = begin[has], end[has]
    doc = np.searchsorted(offsets, begin, "right") - 1
    stop = np.where(data[end - 1] == 0x0A, end - 1, end)
    line = span_hash(prefix, begin, stop)
    order = np.lexsort((line, doc))
    d, h = doc[order], line[order]
    again = np.zeros(len(d), bool)
    again[1:] = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    return np.bincount(d[again], minlength=n_docs).astype(np.int64)


def measure(df: DataFrame, text: str = "text", limits: Limits | None = None) -> DataFrame:
    """Add the counts, the covered share and the verdicts ``base_failed`` and ``kept``."""
    limits = limits or Limits()
    df = without(df, *COUNTS, "covered_share", "base_failed", "kept")
    schema = StructType([*df.schema.fields, *[StructField(c, LongType(), False) for c in COUNTS]])
    target, min_words = arrow_schema(schema), limits.min_words

    def run(batches):
        for part, data, offsets in doc_blocks(batches, text):
            counts = block_counts(data, offsets, min_words)
            columns = [*part.columns, *[pa.array(counts[c], pa.int64()) for c in COUNTS]]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, target, strict=True)], schema=target)

    out = df.mapInArrow(run, schema)
    share = F.when(F.col("n_words") > 0, F.col("n_covered") / F.col("n_words")).otherwise(F.lit(0.0)).cast(DoubleType())
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("covered_share", share).withColumn("base_failed", failed).withColumn(
        "kept",
        ~F.col("base_failed") & (F.col("covered_share") <= limits.max_covered)
        & (F.col("longest_repeat") <= limits.max_longest),
    )
