import collections
import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from strata.llm import chaining, neardup, queries, suffix_index
from strata.llm.common import BYTE_VALUES, prefix_hash
from tests.llm.helpers import EDGE, WORD, docs_frame, prose, write_docs


def _edited(text, every, seed):
    rng = random.Random(seed)
    return " ".join(w if rng.randrange(every) else f"zz{rng.randrange(10**6)}" for w in text.split(" "))


def _family(base_id, words, every, copies, seed):
    base = prose(seed, words)
    return [(base_id, base), *[(base_id + i, _edited(base, every, seed * 100 + i)) for i in range(1, copies)]]


def _shingles(text, n):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = WORD.findall(low)
    if len(w) >= n:
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def _components(rows, n, num, den):
    """doc_id -> smallest reachable doc_id, by comparing every pair."""
    sets = [(d, _shingles(t, n)) for d, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        r = find(i)
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    return collections.Counter((d, len(s), least[find(i)] if s else d) for i, (d, s) in enumerate(sets))


def _copies():
    rows = list(EDGE)
    rows += _family(1000, 120, 60, 12, 1) + _family(1100, 300, 45, 12, 2) + _family(1200, 40, 30, 10, 3) + _family(1300, 12, 14, 8, 4)
    rows += [(1400 + i, prose(5, 80)) for i in range(30)]  # one hot group of exact copies
    rows += [(1500 + i, prose(6, 90).upper() if i % 2 else prose(6, 90)) for i in range(4)]
    line = prose(7, 25)
    rows += [(1600 + i, f"{prose(50 + i, 60)} {line} {prose(90 + i, 60)}") for i in range(20)]  # a common line links nothing
    rows += [(1700, "a b"), (1701, "A  b"), (1702, "a b c"), (1703, "a b c d e"), (1704, "a b c d f")]
    rows += _family(1800, 200, 25, 90, 8)  # a star: copies near the first, few near each other
    return rows


def test_near_duplicates_equal_all_pairs(spark, scratch):
    rows = _copies()
    write_docs(spark, scratch, rows)
    got = queries.op4_minhash_neardup(spark, scratch).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == _components(rows, 3, 85, 100)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    five = neardup.near_duplicates(docs_frame(spark, rows)).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in five) == _components(rows, 5, 80, 100)


def test_long_open_lists_meet_in_blocks(spark, monkeypatch):
    """Without the short way every open pair goes through the blocks, with the same groups."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 2)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 16)
    rows = _family(0, 200, 22, 60, 8) + _family(100, 60, 20, 30, 9)
    got = neardup.near_duplicates(docs_frame(spark, rows), neardup.Settings(3, 85, 100)).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == _components(rows, 3, 85, 100)


def test_one_row_of_each_group_stays(spark):
    rows = [*_copies(), (1, "same words in both rows"), (1, "same words in both rows"), (None, prose(5, 80))]
    stays = neardup.one_per_group(docs_frame(spark, rows)).collect()
    want = {least for (_, n, least) in _components(rows, 5, 80, 100) if n}
    kept = [r["doc_id"] for r in stays if WORD.search(r["text"] or "")]
    assert sorted(kept, key=str) == sorted(want, key=str)
    assert sum(not WORD.search(r["text"] or "") for r in stays) == sum(not WORD.search(t or "") for _, t in rows)
    assert neardup.one_per_group(docs_frame(spark, [])).count() == 0


def test_least_shared_is_the_binomial_tail():
    s = neardup.Settings(3, 85, 100)
    rng = np.random.default_rng(0)
    assert (rng.binomial(s.keep, 0.85, 10**6) >= s.least_shared).all()


def _cut(rows, length=200):
    seen = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = collections.Counter()
    for d, t in rows:
        b = (t or "").encode()
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        out[(d, len(b), sum(mark), len(re.findall(rb"\x01+", bytes(mark))), hashlib.sha256(kept).hexdigest())] += 1
    return out


def _passages():
    small = [r if r[0] != 908 else (908, prose(5, 600)) for r in EDGE]
    p, q = prose(11, 60), prose(12, 33)
    assert len(q) > 200
    rows = [*small, (1, p), (2, p), (3, f"x {p} y"), (4, f"{prose(13, 50)} {p}{prose(14, 20)}"), (5, prose(15, 200)), (6, (prose(16, 8) + " ") * 30)]
    rows += [(10 + i, f"{prose(100 + i, 40)} {q} {prose(200 + i, 40)}") for i in range(40)]
    rows += [(60 + i, f"{prose(300 + i, 30)}{p[i : 190 + 2 * i]}{prose(400 + i, 30)}") for i in range(20)]
    rows += [(90, p[:199]), (91, p[:200]), (92, "é" * 150), (93, "é" * 101), (94, "ü" * 90 + "é" * 120)]
    return rows + [(95, prose(17, 100)), (95, prose(17, 100)), (96, prose(18, 90)), (96, prose(19, 90))]


def test_repeated_bytes_equal_brute_force(spark, scratch):
    rows = _passages()
    write_docs(spark, scratch, rows)
    got = collections.Counter(
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
        for r in queries.op7_suffix_array_dedup(spark, scratch).collect()
    )
    assert got == _cut(rows)


def test_cut_texts_are_whole_characters(spark):
    rows = _passages()
    got = suffix_index.without_repeats(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    by = {r["doc_id"]: r["text"] for r in got}
    assert by[1] == "" and by[5] == prose(15, 200) and by[900] is None
    assert suffix_index.without_repeats(docs_frame(spark, [])).count() == 0


def test_family_keeps_logarithmically_many_levels(spark):
    family = suffix_index.SuffixFamily(spark)
    found = set()
    for i in range(7):
        batch = spark.createDataFrame([(x,) for x in (i, 100, 200 + i // 2)], "suffix long")
        found |= {r["suffix"] for r in family.add(batch).collect()}
    assert [held for held, _ in family.levels] == [4, 2, 1]
    assert found == {100, 200, 201, 202}


def test_anchor_depends_on_the_string_alone():
    text = prose(21, 400).encode()
    for shift in (0, 1, 57):
        data = np.frombuffer(b"#" * shift + text, np.uint8)
        out = suffix_index.anchors(data, np.array([0, len(data)]), prefix_hash(BYTE_VALUES[data]))
        ranges = [(int(f) - shift, int(l) - shift, int(a) - shift) for _, f, l, a, _ in zip(*out, strict=True)]
        places = {s: a for f, l, a in ranges for s in range(f, l + 1) if s >= 0}
        if shift == 0:
            first = places
        assert places == first


def test_chain_is_the_best_chain():
    """The Fenwick tree finds the same best score as trying every predecessor."""
    rng = np.random.default_rng(4)
    cost = chaining.K / (2.0 * chaining.MAX_GAP)
    for _ in range(40):
        n = int(rng.integers(2, 25))
        a, b = rng.integers(0, 39, n), rng.integers(0, 39, n)
        order = np.lexsort((b, a))
        x, y = a[order], b[order]
        best = [float(chaining.K)] * n
        for j in range(n):
            for i in range(j):
                if x[i] < x[j] and y[i] < y[j]:
                    best[j] = max(best[j], best[i] + chaining.K - cost * ((x[j] - x[i]) + (y[j] - y[i])))
        got = chaining.chain(a, b)
        if max(best) > chaining.K:
            links = got[0]
            score = chaining.K + sum(
                chaining.K - cost * ((a[q] - a[p]) + (b[q] - b[p])) for p, q in zip(links, links[1:], strict=False)
            )
            assert score <= max(best) + 1e-9
            if all(max(a[q] - a[p], b[q] - b[p]) <= chaining.MAX_GAP for p, q in zip(links, links[1:], strict=False)):
                assert score >= max(best) - 1e-9


def test_fuzzy_passages_are_found(spark, scratch):
    p = prose(31, 90)
    rows = [r if r[0] != 908 else (908, prose(5, 3000)) for r in EDGE]
    rows += [(1, f"{prose(32, 150)} {p} {prose(33, 100)}"), (2, f"{prose(34, 30)} {_edited(p, 14, 1)} {prose(35, 200)}")]
    rows += [(3, f"{_edited(p, 16, 2)} {prose(36, 40)}"), (4, prose(37, 300)), (5, prose(38, 300))]
    line = prose(39, 20)
    rows += [(10 + i, f"{prose(500 + i, 80)} {line} {prose(600 + i, 80)}") for i in range(40)]
    rows += [(60 + i, prose(40, 100)) for i in range(25)]
    write_docs(spark, scratch, rows)
    got = queries.op10_substring_dedup(spark, scratch).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["class_id"] == by[2]["class_id"] == by[3]["class_id"] == 1
    assert all(by[i]["n_covered"] >= 70 for i in (1, 2, 3))
    assert all(by[i]["n_links"] == 0 and by[i]["class_id"] == i for i in (4, 5, *range(10, 50)))
    assert {by[i]["class_id"] for i in range(60, 85)} == {60}
    assert all(by[i]["n_covered"] == 100 for i in range(60, 85))
    assert by[900]["n_words"] == 0 and by[None]["class_id"] is None


def test_pairs_beside_a_closer_pair_are_examined(spark):
    """In lists of three a document keeps its only partner, though the partner has a closer one."""
    rows, want = [], {}
    for i in range(24):
        x, own = prose(5000 + i, 100).split(), prose(5100 + i, 60).split()
        cut = [*x[:45], *prose(5200 + i, 10).split(), *x[55:]]
        for k, words in enumerate((x, cut, [*x[:55], *own])):
            rows.append((3 * i + k, " ".join(words)))
            want[3 * i + k] = 3 * i
    got = chaining.summary(docs_frame(spark, rows)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_long_lists_meet_in_full(spark, monkeypatch):
    """Forty pairs, each with a passage of its own around a line that all have."""
    monkeypatch.setattr(chaining, "BLOCK_ROWS", 16)
    line, rows = prose(5300, 12), []
    for i in range(80):
        own = prose(5400 + i // 2, 60).split()
        rows.append((i, f"{prose(5500 + i, 40)} {' '.join(own[:22])} {line} {' '.join(own[22:44])} {prose(5600 + i, 40)}"))
    got = {r["doc_id"]: r for r in chaining.summary(docs_frame(spark, rows)).collect()}
    assert all(got[i]["class_id"] == i - i % 2 for i in range(80))
    assert all(56 <= got[i]["n_covered"] <= 60 for i in range(80))


def test_words_travel_a_part_at_a_time(spark, monkeypatch):
    """Neither the words of all pairs and blocks nor all texts are shuffled at once, and the passages stay the same."""
    line, rows = prose(5300, 12), [(900, None), (901, "one two")]
    for i in range(40):
        own = prose(5400 + i // 2, 60).split()
        rows.append((i, f"{prose(5500 + i, 40)} {' '.join(own[:22])} {line} {' '.join(own[22:44])} {prose(5600 + i, 40)}"))
    rows.append(rows[5])
    docs = docs_frame(spark, rows)
    want = collections.Counter(tuple(r) for r in chaining.summary(docs).collect())
    for name, value in {"PAIRS_AT_ONCE": 1, "BLOCK_ROWS": 8, "MEET_ROWS": 3, "BROADCAST_ROWS": 0}.items():
        monkeypatch.setattr(chaining, name, value)
    parts, real = collections.Counter(), chaining.stage_parts

    def counted(frames, name):
        frames = list(frames)
        parts[name] = max(parts[name], len(frames))
        return real(frames, name)

    monkeypatch.setattr(chaining, "stage_parts", counted)
    assert collections.Counter(tuple(r) for r in chaining.summary(docs).collect()) == want
    assert min(parts[name] for name in ("words", "passages", "met")) > 1


def test_documents_of_a_long_list_meet_once(spark, monkeypatch):
    """Odd documents meet each other and the rest once, and a document stands in one row for each share it meets."""
    monkeypatch.setattr(chaining, "BLOCK_ROWS", 8)
    monkeypatch.setattr(chaining, "MEET_ROWS", 3)
    rows = [(s, rid, rid, True, rid >= even) for s, n, even in ((1, 40, 0), (2, 40, 15), (3, 20, 19), (4, 20, 20), (5, 5, 1)) for rid in range(n)]
    long = spark.createDataFrame(rows, "seed long, rid long, comp long, bare boolean, odd boolean")
    blocks = chaining.long_lists(long).toPandas()
    met = collections.Counter()
    for (seed, _, _), block in blocks.groupby(["seed", "i", "j"]):
        for left, right in chaining.meetings(block):
            own = left.is_left.iat[0] and right.is_left.iat[0]
            met.update((seed, *sorted((a, b))) for a in left.rid for b in right.rid if a < b or not own)
    odd = {(s, rid) for s, rid, _, _, is_odd in rows if is_odd}
    want = {(s, a, b) for s, a, *_ in rows for t, b, *_ in rows if s == t and a < b and ((s, a) in odd or (s, b) in odd)}
    assert set(met) == want and set(met.values()) == {1}
    assert blocks.groupby(["seed", "rid"]).size().loc[1].max() == 5


def _line_and_words(n, seed):
    """Word arrays of texts with one line in common, else the same 150 words in another order; two share a passage too."""
    rng = np.random.default_rng(seed)
    line, own, passage = np.arange(12), np.arange(100, 250), np.arange(500, 560)
    out = [np.concatenate([p[:70], line, p[70:]]) for p in (rng.permutation(own) for _ in range(n))]
    changed = np.where(np.arange(60) % 9 == 4, 900, passage)
    out[1], out[2] = np.concatenate([out[1], passage, rng.permutation(own)]), np.concatenate([out[2], changed])
    return [w.astype(np.int32) for w in out]


def test_pairs_with_one_line_in_common_are_not_aligned(spark):
    """Of a long list only pairs that could hold a passage have their words sent on, however many words they share."""
    texts = _line_and_words(40, 1)
    words = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(texts)], "rid long, words array<int>")
    members = spark.createDataFrame([(7, i, i, True) for i in range(40)], "seed long, rid long, comp long, bare boolean")
    assert [tuple(r) for r in chaining._all_pairs(members, words).collect()] == [(1, 2)]


def test_no_pair_with_a_passage_is_left_out():
    """The block's bounds against the examination of every pair: texts cut and edited from common ones, some periodic."""
    rng = np.random.default_rng(8)
    bases = [rng.integers(0, 60 if k % 2 else 2000, 160) for k in range(3)]

    def text(k):
        if k % 9 == 0:
            return np.tile(bases[k % 3][: 5 + k % 30], 9)
        parts = []
        for base in (bases[k % 3], bases[int(rng.integers(3))]):
            at = int(rng.integers(0, 60))
            part = base[at : at + int(rng.integers(50, 100))].copy()
            part[rng.random(len(part)) < rng.choice([0, 0.08, 0.15, 0.2])] = 5000 + k
            parts += [rng.integers(0, 2000, int(rng.integers(0, 30))), np.delete(part, rng.integers(0, len(part), 2))]
        return np.concatenate(parts)

    texts = [text(k).astype(np.int32) for k in range(70)]
    left, right = texts[:35], texts[35:]
    could, found = chaining.could_share(left, right, np.ones((35, 35), bool)), 0
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            x, y = chaining.common_runs(a, chaining.sorted_runs(b))
            got = [chaining.align(a.tolist(), b.tolist(), x[q].tolist(), y[q].tolist()) for q in chaining.chain(x, y)]
            if any(got):
                found += 1
                assert could[i, j] and chaining.dense_window(a, np.sort(b)) and chaining.dense_window(b, np.sort(a))
    assert found > 50 and not could.all()


def test_empty_tables(spark, scratch):
    write_docs(spark, scratch, [])
    for query in (queries.op4_minhash_neardup, queries.op7_suffix_array_dedup, queries.op10_substring_dedup):
        assert query(spark, scratch).count() == 0


def test_other_columns_are_ignored(spark):
    df = docs_frame(spark, [(1, prose(1, 30)), (2, prose(1, 30))]).withColumns({"nid": F.lit("x"), "th": F.lit("y"), "kept": F.lit(0)})
    assert {r["component_id"] for r in neardup.near_duplicates(df).collect()} == {1}
    assert {r["class_id"] for r in chaining.summary(df).collect()} == {1, 2}
    assert suffix_index.digests(df).count() == 2
