"""Byte-level BPE encoding and decoding with numpy matrices.

``ids``: text is split by the tokenizer's pattern; the distinct pieces of a
block go into padded matrices, one per length bucket. Every round finds each
row's leftmost pair of minimum rank, merges it, closes the gap and looks up
the two changed pairs in a hash table; rows without a mergeable pair leave the
matrix. Pieces longer than ``LONG_PIECE`` bytes (runs of one character class)
take the same merges from a heap over a linked list, so their time stays near
linear. The ids equal those of the published tokenizer for the same ranks.

Defined results: null and empty texts encode to no ids and decode to no bytes;
special tokens are ordinary text; input columns named like the results are
replaced.
"""

from __future__ import annotations

import base64
import heapq
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from strata.llm.common import arrow_schema, blocks, frugal, ragged, text_bytes, without

LONG_PIECE = 256
NONE = np.int32(2**31 - 1)
#: Chunks whose ids a worker keeps (about 200 bytes each); the store starts anew when it is full.
CACHE_PIECES = 300_000
_U = np.uint64


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read by the driver and broadcast (a vocabulary has a fixed size)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> list[bytes]:
    """Token bytes by id."""
    ranks = {}
    for line in raw.splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    out = [b""] * (max(ranks) + 1)
    for rank, token in ranks.items():
        out[rank] = token
    return out


#: White space as the tokenizer's pattern sees it (fixed values of the Unicode property).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Chunks that no match of the usual pattern crosses: a word with the space before it, or a run of white space.
CHUNKS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+").findall


class Codes(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class PairTable:
    """(left id, right id) -> id of the merged token: open addressing in three numpy arrays."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: i for i, t in enumerate(tokens) if t}
        left, right, merged = [], [], []
        for token, i in rank.items():
            for cut in range(1, len(token)):
                a = rank.get(token[:cut])
                if a is not None and (b := rank.get(token[cut:])) is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        keys = (np.array(left, np.uint64) << _U(32)) | np.array(right, np.uint64)
        merged = np.array(merged, np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)
        self.vals = np.full(1 << self.bits, NONE, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 1
        while len(todo):
            free = self.keys[slot[todo]] == np.iinfo(np.uint64).max
            take = todo[free]
            _, one = np.unique(slot[take], return_index=True)
            take = take[one]
            self.keys[slot[take]], self.vals[slot[take]] = keys[take], merged[take]
            placed = np.zeros(len(keys), bool)
            placed[take] = True
            todo = todo[~placed[todo]]
            if len(todo):
                slot[todo] = (slot[todo] + 1) & self.mask
                self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE where a pair can't merge; negative ids (padding) never merge."""
        out = np.full(left.shape, NONE, np.int32)
        ok = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left.ravel()[ok].astype(np.uint64) << _U(32)) | right.ravel()[ok].astype(np.uint64)
        slot, flat = self._slot(keys), out.ravel()
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == keys
            flat[ok[hit]] = self.vals[slot[hit]]
            go = ~hit & (there != np.iinfo(np.uint64).max)
            if not go.any():
                break
            ok, keys, slot = ok[go], keys[go], (slot[go] + 1) & self.mask
        return flat.reshape(left.shape)


class Codec:
    def __init__(self, raw: bytes, pattern: str):
        self.tokens = parse_ranks(raw)
        self.split = regex.compile(pattern).findall
        # chunks are cut with the standard library and looked up whole; a pattern that could cross them is applied as it is
        self.chunks = CHUNKS if pattern == public_tokenizers.PATTERN else self.split
        self.pairs = PairTable(self.tokens)
        self.byte_ids = np.zeros(256, np.int32)
        rank = {t: i for i, t in enumerate(self.tokens) if t}
        for b in range(256):
            self.byte_ids[b] = rank[bytes([b])]
        self.rank = rank
        self.known: dict[str, bytes] = {}
        lens = np.array([len(t) for t in self.tokens], np.int64)
        self.lens, self.first = lens, np.concatenate([[0], np.cumsum(lens)[:-1]])
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def merge_matrix(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (int32 as bytes) of pieces of similar length, all rows at once."""
        n, width = len(pieces), max(map(len, pieces))
        ids = np.full((n, width), -1, np.int32)
        lens = np.array([len(p) for p in pieces])
        ids[np.arange(width) < lens[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        out = [b""] * n
        rows = np.arange(n)
        ranks = self.pairs.look(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((n, 1), NONE)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                ready = ids[done]
                real = ready >= 0
                flat, ends = ready[real].tobytes(), (4 * np.cumsum(real.sum(axis=1))).tolist()
                for i, a, b in zip(rows[done].tolist(), [0, *ends], ends, strict=False):
                    out[i] = flat[a:b]
                keep = ~done
                rows, ids, ranks, at, best = rows[keep], ids[keep], ranks[keep], at[keep], best[keep]
                if not len(rows):
                    break
            r = np.arange(len(rows))
            columns = np.arange(ids.shape[1] - 1)
            shift = columns[None, :] + (columns[None, :] > at[:, None])
            ids[r, at] = best
            ids = np.take_along_axis(ids, shift, axis=1)  # the merged pair's right half goes
            if ids.shape[1] == 1:
                ranks = np.full((len(rows), 1), NONE, np.int32)
                continue
            # ranks of unchanged pairs move along; the two beside the new token are looked up
            pair = np.arange(ids.shape[1] - 1)
            ranks = np.take_along_axis(ranks, pair[None, :] + (pair[None, :] >= at[:, None]), axis=1)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs.look(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at < ids.shape[1] - 1)
            ranks[right, at[right]] = self.pairs.look(ids[right, at[right]], ids[right, at[right] + 1])
        return out

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece: heap of (rank, position) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        nxt, prv, tokens, rank = list(range(1, n + 1)), list(range(-1, n - 1)), self.tokens, self.rank
        get = lambda i, j: rank.get(tokens[ids[i]] + tokens[ids[j]])
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two has gone into another token
            ids[i], ids[j] = r, -1
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if (q := get(i, k)) is not None:
                    heapq.heappush(heap, (q, i, r, ids[k]))
            if (h := prv[i]) >= 0 and (q := get(h, i)) is not None:
                heapq.heappush(heap, (q, h, ids[h], r))
        return np.array([x for x in ids if x >= 0], np.int32).tobytes()

    def merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        raw = [p.encode() for p in pieces]
        out = [b""] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(raw):
            if len(p) > LONG_PIECE:
                out[i] = self.merge_long(p)
            else:
                buckets.setdefault((len(p) + 3) // 4 if len(p) <= 16 else 8 + len(p).bit_length(), []).append(i)
        for members in buckets.values():
            for a in range(0, len(members), 8192):
                part = members[a : a + 8192]
                for i, ids in zip(part, self.merge_matrix([raw[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks: split each by the pattern, merge the distinct pieces once."""
        if self.chunks is self.split:
            return self.merge(chunks)
        parts = [self.split(c) for c in chunks]
        pieces = Codes()
        code = pieces.__getitem__
        where = [list(map(code, part)) for part in parts]
        merged = self.merge(list(pieces))
        return [merged[w[0]] if len(w) == 1 else b"".join([merged[i] for i in w]) for w in where]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the number of ids of each."""
        order, codes, counts = Codes(), [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self.chunks(text) if text else ()
            counts[i] = len(found)
            codes.append(np.fromiter(map(order.__getitem__, found), np.int64, len(found)))
        if not order:
            return np.empty(0, np.int32), counts
        which, names = np.concatenate(codes), list(order)
        new = [p for p in names if p not in self.known]
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known.clear()
            new = names
        fresh = dict(zip(new, self.chunk_ids(new), strict=True))
        got = [fresh[p] if p in fresh else self.known[p] for p in names] if fresh else list(map(self.known.__getitem__, names))
        self.known.update((p, x) for p, x in fresh.items() if len(p) < 64)
        lens = np.fromiter(map(len, got), np.int64, len(got)) // 4
        ids = gather(np.frombuffer(b"".join(got), np.int32), np.concatenate([[0], np.cumsum(lens)[:-1]]), lens, which)
        ends = np.concatenate([[0], np.cumsum(lens[which])])
        bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(bounds)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Bytes of each run of ids [bounds[i], bounds[i + 1])."""
        flat = gather(self.bytes, self.first, self.lens, ids).tobytes()
        ends = np.concatenate([[0], np.cumsum(self.lens[ids])])[bounds]
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def gather(values: np.ndarray, first: np.ndarray, lens: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenate the runs values[first[w] : first[w] + lens[w]] for w in ``which``."""
    n = lens[which]
    total = int(n.sum())
    starts = np.cumsum(n) - n
    return values[np.arange(total) + np.repeat(first[which] - starts, n)]


@lru_cache(maxsize=2)
def codec(raw: bytes, pattern: str) -> Codec:
    """One table per Python worker."""
    return Codec(raw, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the array of token ids of the whole text."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    df = without(df, out)
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(IntegerType(), False), True)])
    target = arrow_schema(schema)

    def run(batches):
        c = codec(shared.value, pattern)
        for batch in batches:
            _, offsets = text_bytes(batch.column(text))
            for a, b in blocks(offsets):  # its chunks are Python strings, some 25 times its bytes
                part = batch.slice(a, b - a)
                ids, counts = c.encode(part.column(text).to_pylist())
                columns = [*part.columns, ragged(ids, counts, pa.int32())]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(frugal(run), schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for (null ids: no bytes)."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    df = without(df, out)
    schema = StructType([*df.schema.fields, StructField(out, BinaryType(), True)])
    target = arrow_schema(schema)

    def run(batches):
        c = codec(shared.value, pattern)
        for batch in batches:
            column = batch.column(ids)
            bounds = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in blocks(bounds, 1 << 20):
                part = batch.slice(a, b - a)
                raw = c.decode(flat[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                columns = [*part.columns, pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(frugal(run), schema)


def digests(spark: SparkSession, documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_bytes of each document.

    Encoding and decoding see the text and the ids only through the operators;
    the digests are SQL functions on their outputs.
    """
    coded = decode(encode(documents.select("doc_id", "text"), ranks_path, pattern).drop("text"), ranks_path, pattern)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        F.octet_length("decoded").cast("long").alias("n_bytes"),
    )
