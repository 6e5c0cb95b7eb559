"""Shared helpers: stage tables in the cluster's folder, and byte-level numpy views of Arrow text.

The numpy helpers work on one block of documents at a time: ``data`` holds the
UTF-8 bytes of the block back to back and ``offsets`` the bounds of each
document, so one vectorised pass serves a whole block. Blocks are bounded by
``BLOCK_BYTES`` (or one document, if that is longer), which bounds memory.
"""

from __future__ import annotations

import ctypes
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import ensure_checkpoint_dir

BLOCK_BYTES = 1 << 20

_U = np.uint64


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's checkpoint folder (shared by all executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex[:12]}"


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write go with its end, as nothing reads them again
    (Spark keeps them else until the driver collects its garbage).
    """
    return stage_parts([df], name)


def stage_parts(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """``stage`` for frames of one schema, written one after another: the shuffle files of one at a time are on disk."""
    path = None
    for df in frames:
        spark = df.sparkSession
        path = path or stage_path(spark, name)
        before = spark.conf.get(_CLEAN, None)
        spark.conf.set(_CLEAN, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_folder = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more (later stages are written)."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.stage_folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id, modulus: int, remainder: int):
    """crc32(doc_id as text) mod ``modulus`` equals ``remainder``; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(True))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of an Arrow string or binary column; null counts as empty."""
    column = column.cast(pa.binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, off, buf = column.buffers()
    if len(column) == 0 or off is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of documents whose bytes stay below ``most`` (a longer document stands alone)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def doc_blocks(batches, column: str = "text", most: int = BLOCK_BYTES):
    """(batch slice, data, offsets) for each block of an iterator of record batches."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        for a, b in blocks(offsets, most):
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def give_back() -> None:
    """Return to the system what this worker's allocators hold beyond its live data (nothing where they can't)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def frugal(run: Callable) -> Callable:
    """A step over record batches whose worker gives memory back, at most once a second and at its end.

    Workers stay with the executor for later stages; without this each keeps the most that it ever took.
    """

    def step(batches):
        last = time.monotonic()
        for out in run(batches):
            yield out
            del out
            if time.monotonic() - last > 1.0:
                give_back()
                last = time.monotonic()
        give_back()

    return step


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: One random 64-bit value for each byte value.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; the long tables of rare huge documents aren't kept."""
    if len(_powers[0]) < n:
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(max(n, BLOCK_BYTES + 4096), base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if n > 4 * BLOCK_BYTES:
            return out[0], out[1]
        _powers[:] = out
    return _powers[0], _powers[1]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of values[t] * BASE**t over i <= t < j (modulo 2**64)."""
    up, _ = powers(len(values) + 1)
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; equal content gives equal values wherever it stands."""
    _, down = powers(len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: Word separators: space and U+0009 to U+000D. They are single bytes, so words can be cut in UTF-8.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word (maximal run without separators, within one document)."""
    n = len(data)
    if n == 0:
        z = np.empty(0, np.int64)
        return z, z, z
    word = ~IS_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(BYTE_VALUES[data]), starts, ends)


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (positions 0 .. len - n)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:m].copy()
    for i in range(1, n):
        out = mix64(out * _U(0x9FB21C651E98DF25) + hashes[i : i + m] + _U(i))
    return out


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names would clash with those an operator adds (case-insensitive)."""
    clash = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])
