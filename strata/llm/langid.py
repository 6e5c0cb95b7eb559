"""Language identification by nearest centroid.

A text becomes a hashed vector of byte trigrams (letters lower-cased, other
ASCII as space), weighted by log term frequency and inverse document frequency
and scaled to length one. Document frequencies are counted by Spark over all
training rows; a few centroids per language come from spherical k-means on a
bounded sample of them (``SAMPLE_PER_LANGUAGE``). A text gets the language of
the centroid with the highest cosine; ``rejected`` marks texts farther from
every centroid than almost all training texts are from theirs. The sample holds distinct texts,
so copies of one text neither crowd out a language nor reach the driver.

Defined results: null texts and texts without a letter are ``und`` with score
0; with no training rows every text is ``und``; texts too short for a trigram get the language that sorts first, with score 0; a
language whose training texts are all that short is not learned; ties go to the language that
sorts first; input columns named like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from strata.llm.common import arrow_schema, doc_blocks, mix64, text_bytes, without

DIMENSIONS = 4096
CENTROIDS = 4
#: Bound of the sample that k-means sees, for each language (distinct texts, those with the smallest hashes).
SAMPLE_PER_LANGUAGE = 600
#: Rows of one matrix of trigram counts (DIMENSIONS numbers a row).
BLOCK_ROWS = 1000
#: This share of the sampled training texts lies beyond the distance at which a text is rejected.
REJECT_QUANTILE = 0.005
UNKNOWN = "und"

_LETTER = np.full(256, 0x20, np.uint64)
for _b in [*range(0x61, 0x7B), *range(0x80, 0x100)]:
    _LETTER[_b] = _b


def trigram_counts(column: pa.Array) -> np.ndarray:
    """Documents x DIMENSIONS matrix of hashed trigram counts of the whole texts."""
    low = pc.utf8_lower(column.cast(pa.large_string()))
    data, offsets = text_bytes(low)
    n_docs = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n_docs, DIMENSIONS), np.float32)
    x = _LETTER[data]
    code = (x[:-2] << np.uint64(16)) | (x[1:-1] << np.uint64(8)) | x[2:]
    blank = code == np.uint64(0x202020)
    at = np.arange(len(code))
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))[: len(code)]
    ok = (at + 2 < offsets[doc + 1]) & ~blank
    bucket = (mix64(code[ok]) >> np.uint64(64 - 12)).astype(np.int64)
    flat = np.bincount(doc[ok] * DIMENSIONS + bucket, minlength=n_docs * DIMENSIONS)
    return flat.reshape(n_docs, DIMENSIONS).astype(np.float32)


def row_blocks(batches, text: str):
    """Parts of the batches, bounded by bytes and by rows."""
    for part, _, _ in doc_blocks(batches, text):
        for a in range(0, len(part), BLOCK_ROWS):
            yield part.slice(a, BLOCK_ROWS)


def unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit_rows(np.log1p(counts) * idf)


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    cutoff: float

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best centroid and its cosine."""
        similar = np.clip(weigh(counts, self.idf) @ self.centroids.T, 0.0, 1.0)
        best = similar.argmax(axis=1)
        return best, similar[np.arange(len(best)), best].astype(np.float64)


def document_frequencies(training: DataFrame, text: str) -> np.ndarray:
    """In how many training rows each dimension occurs, and at DIMENSIONS the number of rows.

    Each task sums its own rows, Spark sums the tasks: DIMENSIONS + 1 rows reach the driver.
    """

    def run(batches):
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for part in row_blocks(batches, text):
            counts = trigram_counts(part.column(text))
            total[:DIMENSIONS] += (counts > 0).sum(axis=0)
            total[DIMENSIONS] += len(counts)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"dim": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    rows = training.select(text).mapInArrow(run, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(DIMENSIONS + 1, np.int64)
    for r in rows:
        out[r["dim"]] = r["n"]
    return out


def sample_vectors(training: DataFrame, text: str, label: str) -> dict[str, np.ndarray]:
    """Trigram counts of SAMPLE_PER_LANGUAGE distinct texts per language (all, if fewer), picked by a hash of the text."""
    keyed = training.select(F.col(label).cast("string").alias("label"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    first = Window.partitionBy("label").orderBy("h")
    picked = keyed.select("label", "h").distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= SAMPLE_PER_LANGUAGE)
    # SAMPLE_PER_LANGUAGE rows of a few bytes per language; copies of a text meet in a partial aggregate
    texts = keyed.join(F.broadcast(picked.drop("r")), ["label", "h"]).groupBy("label", "h").agg(F.first("t").alias("t"))

    def run(batches):
        for part in row_blocks(batches, "t"):
            counts = np.minimum(trigram_counts(part.column("t")), 65_535).astype(np.uint16)
            yield pa.RecordBatch.from_pydict({
                "label": part.column("label").cast(pa.string()), "h": part.column("h"), "v": pa.array([c.tobytes() for c in counts], pa.binary()),
            })

    rows = texts.mapInArrow(run, "label string, h long, v binary").collect()
    out: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["label"], r["h"])):
        out.setdefault(r["label"], []).append(np.frombuffer(r["v"], np.uint16).astype(np.float32))
    return {k: np.stack(v) for k, v in out.items()}


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out starting rows; fewer centroids where rows coincide."""
    centres = [unit_rows(x.mean(axis=0, keepdims=True))[0]]
    while len(centres) < min(k, len(x)):
        centres.append(x[(x @ np.stack(centres).T).max(axis=1).argmin()])
    c = np.stack(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = unit_rows(np.stack([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))]))
    return c


def fit(training: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Learn from rows with a label; the caller decides which rows may be learned from."""
    training = training.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    df = document_frequencies(training, text)
    n = max(1, int(df[DIMENSIONS]))
    idf = np.log(1 + n / (1 + df[:DIMENSIONS])).astype(np.float32)  # above zero, also where every text is the same
    names, centres, own = [], [], []
    for name, counts in sample_vectors(training, text, label).items():
        x = weigh(counts, idf)
        x = x[x.any(axis=1)]
        if len(x):
            c = cluster(x, CENTROIDS)
            own.append((x @ c.T).max(axis=1))
            centres.append(c)
            names += [name] * len(c)
    if not names:
        return Model(idf, [], np.zeros((0, DIMENSIONS), np.float32), 0.0)
    return Model(idf, names, np.concatenate(centres), float(np.quantile(np.concatenate(own), REJECT_QUANTILE)))


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (cosine) and ``rejected`` (beyond the distance cutoff)."""
    df = without(df, "lang_pred", "score", "rejected")
    schema = StructType([
        *df.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        StructField("rejected", BooleanType()),
    ])
    target = arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast(model)  # idf and at most CENTROIDS x labels rows

    def run(batches):
        m = shared.value
        names = np.array(m.languages, dtype=object)
        for part in row_blocks(batches, text):
            column = part.column(text).cast(pa.large_string())
            letter = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if len(names):
                best, score = m.predict(trigram_counts(column))
                pred = np.where(letter, names[best], UNKNOWN)
                score = np.where(letter, score, 0.0)
            else:
                pred, score = np.full(len(part), UNKNOWN, dtype=object), np.zeros(len(part))
            columns = [
                *part.columns, pa.array(pred.tolist(), pa.string()), pa.array(score, pa.float64()),
                pa.array((score < m.cutoff) | ~letter | (len(names) == 0), pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(run, schema)
