import base64
import hashlib
import random
import zlib

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from strata.llm import bpe, queries, sharding
from tests.llm.helpers import EDGE, docs_frame, prose, write_docs

M = (1 << 64) - 1
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _mix(z):
    z &= M
    for shift, factor in zip((30, 27), sharding.MIX_MULTIPLIERS, strict=True):
        z = ((z ^ (z >> shift)) * factor) & M
    return z ^ (z >> 31)


def _jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * sharding.JUMP_MULTIPLIER + 1) & M
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *[random.Random(1).getrandbits(63) for _ in range(200)]]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 7, 24, 100):
        got = sharding.jump_shard(df, F.col("k"), n).collect()
        for r in got:
            assert (r["shard"], r["grown_shard"]) == (_jump(_mix(r["k"]), n), _jump(_mix(r["k"]), n + 1))


def test_growth_moves_rows_only_into_the_new_shard(spark):
    got = sharding.jump_shard(spark.range(5000), F.col("id"), 24).collect()
    moved = [r for r in got if r["shard"] != r["grown_shard"]]
    assert moved and all(r["grown_shard"] == 24 for r in moved)
    assert len(moved) < 5000 * 2 / 25


def test_query_on_edge_rows(spark, scratch):
    write_docs(spark, scratch, EDGE + [(7, "hot")] * 50)
    rows = queries.op1_sharding(spark, scratch).collect()
    assert len(rows) == len(EDGE) + 50
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[900]["size"] == 8 and by[905]["size"] == len("é ß 語 \U0001f600 mixed".encode()) + 8
    assert by[903]["text_crc32"] == zlib.crc32(b"one")
    assert all(by[k]["shard"] == _jump(_mix(k), 24) for k in by)


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x", 5)], "id long, shard string, grown_shard int")
    row = sharding.jump_shard(df, F.col("id"), 4).first()
    assert isinstance(row["shard"], int) and row["shard"] == _jump(_mix(1), 4)
    assert sharding.number_slots(sharding.jump_shard(df.where("id < 0"), F.col("id"), 4), "shard", ["id"], 4).count() == 0


def _library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library():
    codec, lib = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN), _library()
    rng = random.Random(3)
    texts = [t or "" for _, t in EDGE] + [
        "<|endoftext|> it's  we'll \n\n x", "ab" * 300, "é" * 700, "日本語テキスト" * 60, "a  b   c\t\td 　e",
    ]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 600), rng.randint(0x1F300, 0x1F600), 10, 32])) for _ in range(rng.randint(1, 300))) for _ in range(150)]
    ids, counts = codec.encode(texts)
    at = 0
    for text, n in zip(texts, counts, strict=True):
        assert ids[at : at + n].tolist() == lib.encode_ordinary(text)
        at += n


def test_long_pieces_and_other_patterns_take_the_same_merges():
    raw = bpe.read_ranks(PATH)
    codec = bpe.Codec(raw, public_tokenizers.PATTERN)
    piece = (prose(2, 60)).replace(" ", "").encode()
    assert codec.merge_long(piece) == codec.merge_matrix([piece])[0]
    whole = bpe.Codec(raw, r"\S+|\s+")
    ids, _ = whole.encode(["hello  world"])
    assert b"".join(whole.tokens[i] for i in ids) == b"hello  world"


def test_bpe_query_round_trip(spark, scratch):
    write_docs(spark, scratch, EDGE)
    lib = _library()
    want = sorted(
        (d is None, d or 0, len(lib.encode_ordinary(t or "")),
         hashlib.sha256(" ".join(map(str, lib.encode_ordinary(t or ""))).encode()).hexdigest(),
         hashlib.sha256((t or "").encode()).hexdigest()) for d, t in EDGE
    )
    got = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
        for r in queries.op2_byte_bpe(spark, scratch).collect()
    )
    assert got == want


def test_bpe_keeps_other_columns_and_replaces_clashes(spark):
    df = spark.createDataFrame([(1, "ab cd", "old")], "id int, text string, ids string")
    row = bpe.encode(df, PATH, public_tokenizers.PATTERN).first()
    assert row["id"] == 1 and isinstance(row["ids"], list)
    assert bpe.encode(docs_frame(spark, []), PATH, public_tokenizers.PATTERN).count() == 0
