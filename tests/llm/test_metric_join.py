import collections
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import metric_join, neardup, queries
from strata.llm.neardup import Settings
from strata.sources.tables import read_table
from tests.llm.helpers import EDGE, docs_frame, prose, write_docs
from tests.llm.test_copies import _components, _copies, _family


def _found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return collections.Counter(tuple(r) for r in df.collect())


def _borders():
    """Documents around the threshold: chains of small edits, and pairs that share all but a few words."""
    rng = random.Random(11)
    rows, doc = [], 0
    for base in range(12):
        words = prose(300 + base, 60 + 20 * base).split(" ")
        for _ in range(9):  # each edit starts from the last text, so ends of the chain are far apart
            rows.append((doc, " ".join(words)))
            doc += 1
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = f"q{rng.randrange(10**6)}"
    for cut in range(1, 40):  # one and the same text, cut shorter and shorter
        rows.append((doc, " ".join(prose(999, 120).split(" ")[cut:])))
        doc += 1
    return rows


@pytest.mark.parametrize("levels", [0, 5])
def test_components_equal_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(metric_join, "LEVELS", levels)
    monkeypatch.setattr(metric_join, "SHORT_LIST", 4)
    monkeypatch.setattr(metric_join, "BLOCK_NODES", 5)
    rows = _copies() + [(20_000 + d, t) for d, t in _borders()]
    assert _found(metric_join.jaccard_components(docs_frame(spark, rows))) == _components(rows, 5, 80, 100)


@pytest.mark.parametrize("levels", [0, 1])
def test_sets_travel_a_part_at_a_time(spark, monkeypatch, levels):
    """Not all heads, pairs, blocks and texts are shuffled at once, and the components stay the same."""
    for name, value in {"LEVELS": levels, "SHORT_LIST": 4, "BLOCK_NODES": 5, "PAIRS_AT_ONCE": 1, "SHINGLES_AT_ONCE": 1, "BROADCAST_IDS": 0}.items():
        monkeypatch.setattr(metric_join, name, value)
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    parts, real = collections.Counter(), metric_join.stage_parts

    def counted(frames, name):
        frames = list(frames)
        parts[name] = max(parts[name], len(frames))
        return real(frames, name)

    monkeypatch.setattr(metric_join, "stage_parts", counted)
    rows = _borders()[60:] + [(9000, _borders()[70][1]), (None, _borders()[70][1]), (9001, None), (9002, "")]
    assert _found(metric_join.jaccard_components(docs_frame(spark, rows))) == _components(rows, 5, 80, 100)
    assert parts["head-counts"] > 1 and parts["sets"] > 1 and parts["near" if levels else "block-links"] > 1


def test_nodes_of_many_lists_stand_in_few_blocks(spark, monkeypatch):
    """40 nodes in 30 lists meet as one group, not list by list; of a list that shares one node with the next all stay apart."""
    monkeypatch.setattr(metric_join, "BLOCK_NODES", 8)
    long = [(v, nid, 100, 3, 40) for v in range(30) for nid in range(40)]
    long += [(1000 + v, 5000 + 9 * v + i, 100, 3, 10) for v in range(30) for i in range(10)]
    groups = metric_join.meeting_groups(spark.createDataFrame(long, "v long, nid long, n long, u long, m long")).collect()
    assert sorted((r.nid, r.k) for r in groups if r.whole) == [(i, 5) for i in range(40)]
    assert sorted((r.g, r.nid, r.k) for r in groups if not r.whole) == [(v, n, 2) for v, n, *_ in long if v >= 1000]


def test_windows_find_links_that_pivots_do_not_show(spark, monkeypatch):
    """Families spread out to the threshold: many links run between regions."""
    rows = []
    for k in range(8):
        rows += _family(1000 * k, 150, 55, 25, 40 + k)
    seen = []
    real = metric_join.region_links

    def counted(*args):
        out = real(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(metric_join, "region_links", counted)
    assert _found(metric_join.jaccard_components(docs_frame(spark, rows))) == _components(rows, 5, 80, 100)
    assert sum(seen) > 0


def test_hot_copies_common_lines_and_repeated_rows(spark):
    line = prose(7, 40)
    rows = [(i, prose(5, 60)) for i in range(300)] + [(300 + i, f"{line} {prose(800 + i, 30)}") for i in range(120)]
    rows += [(1000, prose(5, 60))] * 5 + [(None, prose(5, 60)), (-4, prose(800, 30))] + EDGE
    assert _found(metric_join.jaccard_components(docs_frame(spark, rows))) == _components(rows, 5, 80, 100)


def test_spanning_links_keep_components():
    rng = np.random.default_rng(5)
    for n, m in ((1, 0), (5, 3), (60, 40), (200, 300)):
        a, b = rng.integers(0, n, m) * 7 - 9, rng.integers(0, n, m) * 7 - 9
        out = metric_join.spanning(a, b)
        parent = {x: x for x in [*a, *b]}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in zip(a, b):
            parent[max(find(x), find(y))] = min(find(x), find(y))
        assert {(x, find(x)) for x in parent if find(x) != x} == set(zip(out.a, out.b))


def test_other_thresholds(spark):
    rows = _borders()
    for words, num in ((2, 60),):
        found = _found(metric_join.jaccard_components(docs_frame(spark, rows), Settings(words=words, num=num, den=100)))
        assert found == _components(rows, words, num, 100)
    with pytest.raises(ValueError):
        metric_join.jaccard_components(docs_frame(spark, rows), Settings(num=1, den=2))


def test_registered_query_equals_the_other_join_on_a_given_table(spark):
    table = "/root/testdata/sf0.01"
    docs = read_table(spark, table, "documents").select("doc_id", "text")
    other = neardup.near_duplicates(docs, Settings(words=5, num=80, den=100)).select("doc_id", "n_shingles", "component_id")
    found = _found(queries.op11_jaccard_join(spark, table))
    assert found == collections.Counter(tuple(r) for r in other.collect())
    assert sum(1 for d, _, c in found if d != c) > 20


def test_empty_table_and_clashing_columns(spark):
    assert metric_join.jaccard_components(docs_frame(spark, [])).count() == 0
    folder = write_docs(spark, tempfile.mkdtemp(prefix="strata-test-"), [(1, "a b"), (2, "A  b"), (3, None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({c: F.lit("x") for c in ("nid", "n", "head", "v", "component_id", "th")})
    assert _found(metric_join.jaccard_components(docs)) == collections.Counter([(1, 1, 1), (2, 1, 1), (3, 0, 3)])
