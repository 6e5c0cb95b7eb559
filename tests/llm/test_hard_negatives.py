import math
import random
import tempfile

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from strata.llm import hard_negatives, queries
from strata.sources.tables import read_table

VECS = StructType([
    StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())), StructField("label", IntegerType()),
    StructField("score", StringType()), StructField("dim", StringType()),
])
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
LONG = (1 << 63) - 1


def _brute(rows):
    """Every anchor against every row, in whole numbers."""
    seen, kept = set(), []
    for vid, vec, label in rows:
        if vid is None or vec is None or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        one = (vid, label, tuple(float(np.float32(x)) for x in vec))
        if one not in seen:
            seen.add(one)
            kept.append((vid, (label + 1) % 10 if vid % 7 == 0 else label, [math.floor(256 * x) for x in one[2]]))
    out = []
    for aid, alabel, avec in kept:
        if aid % 100:
            continue
        scored = [(max(-LONG, min(LONG, sum(a * b for a, b in zip(avec, v)))), vid, lab)
                  for vid, lab, v in kept if vid != aid and len(v) == len(avec)]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for ps, pid, _ in [x for x in scored if x[2] == alabel][:5]:
            near = [x for x in scored if x[2] != alabel and 80 * ps <= 100 * x[0] <= 100 * ps][:5]
            out += [(aid, pid, i + 1, nid, ps, ns) for i, (ns, nid, _) in enumerate(near)]
    return sorted(out)


def _mined(spark, rows):
    folder = tempfile.mkdtemp(prefix="strata-test-")
    spark.createDataFrame([(*r, "clash", None) for r in rows], VECS).repartition(3).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    df = queries.op12_hard_negatives(spark, folder)
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def _random_rows(n, dim, seed, spread=1.0, coarse=False):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    step = (lambda x: float(round(x))) if coarse else (lambda x: x)
    return [(i, [step(c + rng.gauss(0, spread)) for c in centres[rng.randrange(4)]], rng.randrange(10)) for i in range(n)]


def test_mined_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "FANOUT", 3)
    rows = _random_rows(1200, 6, 1)
    found = _brute(rows)
    assert len(found) > 100
    assert _mined(spark, rows) == found


def test_ties_hot_vectors_and_odd_rows(spark):
    rows = _random_rows(700, 3, 2, coarse=True)  # many equal scores
    rows += [(5000 + i, [1.0, 0.0, 2.0], 3 if i % 3 else 4) for i in range(300)]  # one vector in a third of the rows
    rows += [(100, rows[100][1], rows[100][2])] * 3  # equal rows count once
    rows += [(200, [0.5, 0.5, 0.5], 7), (300, [1.0], 1), (301, [2.0], 1), (302, [1.75], 2), (400, [], 5), (401, [], 5), (402, [], 6)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (6000, None, 1), (6001, [1.0, None, 1.0], 1), (6002, [float("nan"), 1.0, 1.0], 1),
             (6003, [float("inf"), 1.0, 1.0], 1), (6100, [1.0, 2.0, 3.0], None), (-100, [1.0, 1.0, 0.5], 2), (-7, [1.0, 1.0, 0.5], 3)]
    rows = [(v, x, abs(y) if y is not None else None) for v, x, y in rows]
    assert _mined(spark, rows) == _brute(rows)


def test_large_scores_are_exact_and_saturate(spark):
    rng = random.Random(4)
    big = [(i, [rng.uniform(1e5, 3e6) for _ in range(4)], i % 3) for i in range(400)]  # scores between 2**53 and 2**63
    assert max(r[4] for r in _brute(big)) > 2**53
    assert _mined(spark, big) == _brute(big)
    huge = [(i, [3e38 * rng.random(), -1e30], i % 2) for i in range(220)]
    assert _mined(spark, huge) == _brute(huge)


def test_blocks_of_anchors_and_empty_table(spark, monkeypatch):
    rows = _random_rows(900, 4, 5)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 128)
    assert _mined(spark, rows) == _brute(rows)
    assert _mined(spark, []) == []
    assert _mined(spark, [(7, [1.0], 2)]) == []


def test_registered_query_on_a_given_table(spark):
    table = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in read_table(spark, table, "embeddings").select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(r) for r in queries.op12_hard_negatives(spark, table).collect()) == _brute(rows)


def test_boxes_are_left_unopened():
    """Clustered points: the best-first walk scores a part of the rows and finds the same as all of them."""
    rng = np.random.default_rng(6)
    points = np.floor(np.repeat(rng.normal(0, 400, (40, 3)), 100, axis=0) + rng.normal(0, 5, (4000, 3)))
    points = points[hard_negatives.tile_order(points)]
    ids, labels = np.arange(4000), np.zeros(4000, np.int64)
    anchors = hard_negatives.Anchors(np.arange(4000, 4005), np.ones(5, np.int64), points[::800].copy(), np.full((5, 1), -np.inf), np.full((5, 1), np.inf))
    best = hard_negatives.Best((5, 1), 5, np.float64)
    scored = hard_negatives.search_run(anchors, best, ids, labels, np.arange(4000) // 64, points, False)
    scores = anchors.points @ points.T
    for a in range(5):
        order = np.lexsort((ids, -scores[a]))[:5]
        assert list(best.ids[a, 0]) == list(ids[order])
    assert scored < 0.5 * 5 * 4000
