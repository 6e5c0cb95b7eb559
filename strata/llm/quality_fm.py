"""Quality classifier: a factorisation machine over hashed words and text statistics.

Each document becomes a sparse vector: its words hashed to ``WORD_BUCKETS``
(log counts, scaled to length one), its structure statistics cut into bins (one
active bin per statistic), and its length as the one metadata field. The
machine adds linear weights and the low-rank products of all feature pairs;
the pairs cost linear time by the identity
sum over i < j of <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.

Labels, language, source and doc_id are never inputs. The fit uses at most
about ``SAMPLE_ROWS`` labelled rows, picked by a hash of the text; scoring
covers every whole text.

Defined results: null and empty texts are scored from their (empty) statistics;
without any labelled row every score is 0.5; doc_ids with contradicting labels
count as good if at least half of them are; columns named like the results are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strata.llm.common import BYTE_VALUES, arrow_schema, doc_blocks, frugal, prefix_hash, span_hash, without, word_spans

WORD_BUCKETS = 1 << 15
RANK = 8
#: Bound of the labelled rows used for the fit (documented parameter of the operator).
SAMPLE_ROWS = 8192
EPOCHS = 12
STATISTICS = (
    "log_words", "word_length", "distinct_words", "top_word", "upper", "digits", "symbols", "marks",
    "non_ascii", "line_ends", "repeated_pairs", "end_stops", "bare_symbol_words",
)
BINS = 12
#: Weight of a statistic's active bin against the word part of length one.
STATISTIC_VALUE = 0.5


def _class_counts(data: np.ndarray, offsets: np.ndarray, mask: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask[data])])
    return total[offsets[1:]] - total[offsets[:-1]]


def _mask(chars: bytes | range) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_UPPER, _DIGIT = _mask(range(65, 91)), _mask(range(48, 58))
_SYMBOL, _MARK = _mask(b"#*$%&|<>=_~^{}[]@\\"), _mask(b"!?;:()\"'")
_HIGH, _LINE, _STOP = _mask(range(0xC0, 256)), _mask(b"\n"), _mask(b".,")
_BARE = _mask(b"#*$%&|<>=_~^{}[]@\\/+-!?;:()\"'.,")


@dataclass
class Features:
    """Hashed words in row order (row, bucket, value) and the statistics of each row."""

    rows: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    statistics: np.ndarray

    @property
    def size(self) -> int:
        return len(self.statistics)


def features(data: np.ndarray, offsets: np.ndarray) -> Features:
    n = len(offsets) - 1
    starts, ends, docs = word_spans(data, offsets)
    words = np.bincount(docs, minlength=n)
    chars = np.maximum(np.diff(offsets), 1)
    at_least = np.maximum(words, 1)
    stats = np.zeros((n, len(STATISTICS)))
    stats[:, 0] = np.log1p(words)
    for column, mask in ((4, _UPPER), (5, _DIGIT), (6, _SYMBOL), (7, _MARK), (8, _HIGH), (9, _LINE), (11, _STOP)):
        stats[:, column] = _class_counts(data, offsets, mask) / chars
    if not len(starts):
        empty = np.empty(0, np.int64)
        return Features(empty, empty, np.empty(0), stats)
    lengths = ends - starts
    stats[:, 1] = np.bincount(docs, lengths, n) / at_least
    prefix = prefix_hash(BYTE_VALUES[data])
    hashes = span_hash(prefix, starts, ends)
    bare = np.concatenate([[0], np.cumsum(_BARE[data])])
    stats[:, 12] = np.bincount(docs, (bare[ends] - bare[starts]) == lengths, n) / at_least
    # exact word counts per document, for the statistics on repetition
    order = np.lexsort((hashes, docs))
    d, h = docs[order], hashes[order]
    first = np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])
    cut = np.flatnonzero(first)
    counts, owner = np.diff(np.append(cut, len(d))), d[cut]
    stats[:, 2] = np.bincount(owner, minlength=n) / at_least
    top = np.zeros(n)
    np.maximum.at(top, owner, counts)
    stats[:, 3] = top / at_least
    pair = np.flatnonzero(docs[1:] == docs[:-1])
    if len(pair):
        code = hashes[pair] * np.uint64(0x9FB21C651E98DF25) + hashes[pair + 1]
        o = np.lexsort((code, docs[pair]))
        pd, pc = docs[pair][o], code[o]
        again = (pd[1:] == pd[:-1]) & (pc[1:] == pc[:-1])
        stats[:, 10] = np.bincount(pd[1:][again], minlength=n) / at_least
    key = owner * WORD_BUCKETS + (h[cut] >> np.uint64(64 - 15)).astype(np.int64)
    uniq, inverse = np.unique(key, return_inverse=True)
    value = np.log1p(np.bincount(inverse, counts))
    rows = uniq // WORD_BUCKETS
    norm = np.sqrt(np.bincount(rows, value * value, n))
    return Features(rows, uniq % WORD_BUCKETS, value / norm[rows], stats)


@dataclass
class Machine:
    edges: np.ndarray  # statistics x (BINS - 1), the bin edges
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # features x RANK

    def sparse(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value), rows ascending: hashed words, then one bin per statistic."""
        n, m = f.statistics.shape
        bins = np.stack([np.searchsorted(self.edges[j], f.statistics[:, j], "right") for j in range(m)], axis=1)
        column = WORD_BUCKETS + np.arange(m) * BINS + bins
        rows = np.concatenate([f.rows, np.repeat(np.arange(n), m)])
        cols = np.concatenate([f.buckets, column.ravel()])
        vals = np.concatenate([f.values, np.full(n * m, STATISTIC_VALUE)])
        order = np.argsort(rows, kind="stable")
        return rows[order], cols[order], vals[order]

    def raw(self, rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Score before the sigmoid, and sum v_i x_i of each row (used by the gradient)."""
        x = self.factors[cols] * vals[:, None]
        starts = np.searchsorted(rows, np.arange(n))
        total = np.add.reduceat(x, starts, axis=0)
        squares = np.add.reduceat((x * x).sum(axis=1), starts)
        line = np.add.reduceat(self.linear[cols] * vals, starts)
        return self.bias + line + 0.5 * ((total * total).sum(axis=1) - squares), total

    def score(self, f: Features) -> np.ndarray:
        if not f.size:
            return np.empty(0)
        z, _ = self.raw(*self.sparse(f), f.size)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def train(f: Features, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Adagrad over small batches; classes weigh the same, so the score isn't pulled to the larger one."""
    rng = np.random.default_rng(seed)
    m = len(STATISTICS)
    size = WORD_BUCKETS + m * BINS
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.stack([np.quantile(f.statistics[:, j], quantiles) for j in range(m)]) if f.size else np.zeros((m, BINS - 1))
    machine = Machine(edges, 0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK)))
    good = labels.mean() if f.size else 0.0
    if not 0 < good < 1:  # nothing to tell apart: a constant
        machine.bias = 0.0 if not f.size else (4.0 if good == 1 else -4.0)
        machine.factors[:] = 0
        return machine
    weight = np.where(labels == 1, 0.5 / good, 0.5 / (1 - good))
    rows, cols, vals = machine.sparse(f)
    bounds = np.searchsorted(rows, np.arange(f.size + 1))
    g_line, g_fac, g_bias = np.full(size, 1e-3), np.full((size, RANK), 1e-3), 1e-3
    rate, decay = 0.1, 2e-4
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(f.size), max(1, f.size // 64)):
            lens = bounds[part + 1] - bounds[part]
            at = np.repeat(bounds[part] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
            r, c, v = np.repeat(np.arange(len(part)), lens), cols[at], vals[at]
            z, total = machine.raw(r, c, v, len(part))
            error = (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - labels[part]) * weight[part]
            e = error[r] / len(part) * v
            used, inverse = np.unique(c, return_inverse=True)
            line = np.bincount(inverse, e)
            x = machine.factors[c] * v[:, None]
            inner = e[:, None] * (total[r] - x)
            order = np.argsort(inverse, kind="stable")
            cut = np.searchsorted(inverse[order], np.arange(len(used)))
            fac = np.add.reduceat(inner[order], cut, axis=0)
            line += decay * machine.linear[used]
            fac += decay * machine.factors[used]
            g_line[used] += line**2
            g_fac[used] += fac**2
            machine.linear[used] -= rate * line / np.sqrt(g_line[used])
            machine.factors[used] -= rate * fac / np.sqrt(g_fac[used])
            b = error.mean()
            g_bias += b * b
            machine.bias -= rate * b / np.sqrt(g_bias)
    return machine


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """About ``most`` labelled documents at the most, chosen by a hash of the id (their text never decides)."""
    agreed = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg(label) >= 0.5).cast("int").alias("__label")
    )
    n = max(1, agreed.count())
    unit = 1_000_000
    part = min(unit, most * unit // n)
    picked = agreed.where(F.pmod(F.xxhash64("doc_id"), F.lit(unit)) < part)
    # at most about ``most`` rows of 12 bytes: a proven bound for the broadcast
    return docs.join(F.broadcast(picked), "doc_id")


def fit(training: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", most: int = SAMPLE_ROWS) -> Machine:
    """Learn from the rows of ``training`` that ``labels`` (doc_id, label) covers."""
    rows = labelled_sample(training.select("doc_id", text), labels, label, most)

    def run(batches):
        for part, data, offsets in doc_blocks(batches, text):
            f = features(data, offsets)
            bounds = np.searchsorted(f.rows, np.arange(f.size + 1))
            yield pa.RecordBatch.from_pydict({
                "label": part.column("__label").cast(pa.int32()),
                "buckets": pa.array([f.buckets[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                "vals": pa.array([f.values[a:b].astype(np.float32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                "stats": pa.array([s.tobytes() for s in f.statistics], pa.binary()),
            })

    got = rows.mapInArrow(frugal(run), "label int, buckets binary, vals binary, stats binary").collect()
    got.sort(key=lambda r: (bytes(r["stats"]), bytes(r["buckets"]), r["label"]))  # the same fit however rows arrive
    n = len(got)
    lens = [len(r["buckets"]) // 4 for r in got]
    f = Features(
        np.repeat(np.arange(n), lens),
        np.frombuffer(b"".join(r["buckets"] for r in got), np.int32).astype(np.int64),
        np.frombuffer(b"".join(r["vals"] for r in got), np.float32).astype(np.float64),
        np.frombuffer(b"".join(r["stats"] for r in got), np.float64).reshape(n, len(STATISTICS)),
    )
    return train(f, np.array([r["label"] for r in got], np.int64))


def score(df: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Add ``score``, between 0 and 1, higher where a good label is likelier."""
    df = without(df, "score")
    schema = StructType([*df.schema.fields, StructField("score", DoubleType(), False)])
    target = arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast(machine)  # WORD_BUCKETS x (RANK + 1) numbers, whatever the data

    def run(batches):
        for part, data, offsets in doc_blocks(batches, text):
            columns = [*part.columns, pa.array(shared.value.score(features(data, offsets)), pa.float64())]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(frugal(run), schema)


def scores(df: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """doc_id, th (hash of the text), score: nothing but ids and the text goes through Python, the text only in."""
    shared = df.sparkSession.sparkContext.broadcast(machine)  # WORD_BUCKETS x (RANK + 1) numbers, whatever the data
    slim = df.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))

    def run(batches):
        for part, data, offsets in doc_blocks(batches):
            found = pa.array(shared.value.score(features(data, offsets)), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), found], names=["doc_id", "th", "score"])

    return slim.mapInArrow(frugal(run), "doc_id long, th long, score double")
