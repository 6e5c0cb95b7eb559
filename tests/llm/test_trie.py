import collections
import hashlib
import random
import tempfile

from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm import queries, turn_trie
from strata.sources.tables import read_table
from tests.llm.helpers import crc

TURNS = StructType([
    StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
    StructField("text", StringType()), StructField("x1", LongType()), StructField("size", StringType()),
])


def _order(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, key, role, text))
    return {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}


def _rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = crc(c) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def _brute(convs):
    """One row per distinct prefix, totals by walking every node's descendants."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        cost = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += cost
    ended = collections.defaultdict(list)
    for c, turns in convs.items():
        ended[tuple(turns)].append(c)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ended[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def _rows(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def _edge():
    rng = random.Random(3)
    rows = [(None, 0, "user", "no conversation")]
    for c in [x for x in range(420) if x != 300]:  # 301 to 399 have no conversation to start from
        size = rng.randrange(1, 7)
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "語語", None, ""])) for t in range(size)]
    rows += [(500, None, "user", "null turn comes first"), (500, 2, None, None), (500, 2, "user", "tie"), (500, 2, "user", "tie"), (500, 1, "u", "x" * 40_000)]
    rows += [(700 + c, t, "user", "copy") for c in range(60) for t in range(3)]  # equal conversations
    rows += [(900, t, "user", f"t{t % 3}") for t in range(300)] + [(901, t, "user", f"t{t % 3}") for t in range(250)]
    rows += [(-5, 0, "user", "negative"), (1 << 60, 0, "user", "large id")]
    rng.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark):
    rows = _edge()
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], TURNS)
    ours = _order(rows)
    assert _rows(turn_trie.conversation_trie(df)) == _brute(ours)
    # many small Spark rounds instead of whole components in a task
    assert _rows(turn_trie.conversation_trie(df, local_nodes=120)) == _brute(ours)


def test_rebuilt_trie_equals_brute_force(spark):
    rows = _edge()
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], TURNS)
    built = _rebuild({c: v for c, v in _order(rows).items() if c >= 0})
    assert any(not v for v in built.values())  # some end up without turns
    assert _rows(turn_trie.rebuilt_trie(df.where("conv_id IS NULL OR conv_id >= 0"), local_nodes=200)) == _brute(built)


def test_long_conversation_meets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "TURN_BLOCK", 16)
    rows = [(c, t, "user", f"{t * (c if t > 40 else 1) % 5}") for c in (1, 2, 3) for t in range(90)]
    df = spark.createDataFrame([(*r, 1, "") for r in rows], TURNS)
    assert _rows(turn_trie.conversation_trie(df, local_nodes=20)) == _brute(_order(rows))


def test_registered_query_on_a_given_table(spark):
    table = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in read_table(spark, table, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert _rows(queries.op13_conversation_trie(spark, table)) == _brute(_rebuild(_order(rows)))


def test_empty_table_has_no_nodes(spark):
    folder = tempfile.mkdtemp(prefix="strata-test-")
    spark.createDataFrame([], TURNS).write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    assert queries.op13_conversation_trie(spark, folder).count() == 0
