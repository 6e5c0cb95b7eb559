import random

import corpus_pipeline
from pyspark.sql import functions as F

from strata.llm import decontam, queries
from tests.llm.helpers import EDGE, docs_frame, prose, write_docs

ITEMS = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def _plain(text):
    out = []
    for c in text:
        c = c.lower() if c.isascii() or "À" <= c <= "Þ" else c
        letter = (c.isascii() and c.isalnum()) or ord(c) >= 128
        out.append(c if letter else " ")
    return " ".join("".join(out).split()).encode()


def _least_edits(needle, hay):
    row = [0] * (len(hay) + 1)
    for i, c in enumerate(needle):
        new = [i + 1]
        for j, d in enumerate(hay):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def _typos(text, n, seed):
    rng = random.Random(seed)
    chars = list(text)
    for _ in range(n):
        i = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[i] = rng.choice("bcdfg")
        elif kind == 1:
            del chars[i]
        else:
            chars.insert(i, rng.choice("bcdfg"))
    return "".join(chars)


def test_matches_equal_edit_distance(spark, scratch):
    items = [(1, prose(1, 20)), (2, prose(2, 35)), (3, prose(3, 12)), (4, "tiny"), (5, "Élan Vital, où êtes-vous allés ce soir ?"), (6, None), (7, " ! "), (8, prose(1, 20))]
    rows = [(i, t if i != 908 else prose(5, 400)) for i, t in EDGE]
    for i in range(40):
        item = items[i % 3][1]
        rows.append((i, f"{prose(100 + i, 25)} {_typos(item, i // 4, i)} {prose(200 + i, 25)}"))
    rows += [(50, items[0][1].upper().replace(" ", ",\n ")), (51, "a TINY thing"), (52, "élan vital où ÊTES vous allés ce soir"), (53, items[1][1][: len(items[1][1]) // 2])]
    write_docs(spark, scratch, rows, benchmark=(items, ITEMS))
    got = {(r["doc_id"], r["item_id"]) for r in queries.op6_benchmark_decontamination(spark, scratch).collect()}
    want = set()
    for d, t in rows:
        for i, item in items:
            needle, hay = _plain(item or ""), _plain(t or "")
            if not needle:
                continue
            m = len(needle)
            k = max(0, min(int(m * decontam.EDIT_RATE), (m - decontam.Q) // decontam.Q))
            if _least_edits(needle, hay) <= k:
                want.add((d, i))
    assert got == want


def test_spans_hold_the_passage(spark):
    item = prose(9, 30)
    text = f"{prose(10, 50)} {item} {prose(11, 50)} {item}"
    docs = docs_frame(spark, [(1, text)]).withColumn("matches", F.lit("old"))
    found = decontam.mark(docs, spark.createDataFrame([(3, item)], ITEMS)).first()["matches"]
    assert [(m["item_id"], m["edits"]) for m in found] == [(3, 0), (3, 0)]
    assert {text.encode()[m["start"] : m["end"]].decode() for m in found} == {item}


def test_replaced_words_and_cut_ends_are_found(spark):
    """Copies with four of 38 words replaced or without the last tenth count; texts alike in a third don't."""
    items = [(i, prose(700 + i, 38)) for i in range(8)]
    rows = []
    for i, item in items:
        words, rng = item.split(), random.Random(i)
        for at in rng.sample(range(38), 4):
            words[at] = prose(800 + 50 * i + at, 1)[: len(words[at])].ljust(len(words[at]), "x")
        rows.append((100 + i, f"{prose(720 + i, 40)} {' '.join(words)} {prose(740 + i, 40)}"))
        rows.append((200 + i, f"{prose(760 + i, 40)} {item[: len(item) * 9 // 10]}"))
        rows.append((300 + i, f"{prose(780 + i, 40)} {' '.join(item.split()[:13])} {prose(790 + i, 40)}"))
    found = decontam.matches(docs_frame(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    want = {(base + i, i) for i, item in items for base, copy in zip((100, 200), rows[3 * i : 3 * i + 2])
            if _least_edits(_plain(item), _plain(copy[1])) <= len(_plain(item)) * 11 // 100}
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert len(want) >= 14


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    items = [(i, prose(300 + i, 20)) for i in range(12)]
    docs = docs_frame(spark, [(i, f"{prose(400 + i, 30)} {t} {prose(500 + i, 30)}") for i, t in items])
    bench = spark.createDataFrame(items, ITEMS)
    whole = {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK_ITEM_BYTES", 400)
    assert len(list(decontam.item_blocks(bench, 400))) > 2
    assert {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, bench).collect()} == whole == {(i, i) for i, _ in items}


def test_items_without_id_are_found(spark):
    items = [(None, prose(700, 25)), (None, prose(701, 25)), (3, prose(702, 25))]
    docs = docs_frame(spark, [(i, f"{prose(710 + i, 30)} {t} {prose(720 + i, 30)}") for i, (_, t) in enumerate(items)])
    found = decontam.matches(docs, spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r["doc_id"], -1 if r["item_id"] is None else r["item_id"]) for r in found) == [(0, -1), (1, -1), (2, 3)]


def test_empty_tables(spark, scratch):
    write_docs(spark, scratch, [], benchmark=([], ITEMS))
    assert queries.op6_benchmark_decontamination(spark, scratch).count() == 0
    write_docs(spark, scratch, EDGE, benchmark=([], ITEMS))
    assert queries.op6_benchmark_decontamination(spark, scratch).count() == 0


def _corpus():
    rows, labels = [], []
    for i in range(120):
        bad = i % 5 == 0
        rows.append((i, " ".join(f"{w}###" for w in prose(i, 70).split()) if bad else prose(i, 80) + "."))
        labels.append((i, 0 if bad else 1, 0))
    passage, item = prose(900, 60), prose(901, 22)
    rows += [(200, rows[1][1]), (201, rows[1][1] + " more"), (202, f"{prose(902, 90)} {passage}"), (203, f"{passage} {prose(903, 90)}")]
    rows += [(204, f"{prose(904, 40)} {item} {prose(905, 40)}"), (205, rows[2][1]), (205, rows[2][1])]
    return rows, labels, passage, item


def test_pipeline_takes_out_what_was_planted(spark, scratch):
    rows, labels, passage, item = _corpus()
    write_docs(spark, scratch, rows, labels=(labels, LABELS), benchmark=([(1, item)], ITEMS))
    docs, kept = spark.read.parquet(f"{scratch}/documents.parquet"), []
    columns = docs.columns
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.stage(step(spark, docs, scratch), "test")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            kept.append({r["doc_id"]: r["text"] for r in out.collect()})
        docs = out
    clean = {i for i in range(120) if i % 5}
    assert set(kept[0]) == clean | set(range(200, 206))
    assert set(kept[1]) == clean | {202, 203, 204}
    assert passage not in kept[2][202] and passage not in kept[2][203]
    assert kept[2][202].startswith(prose(902, 90)) and all(kept[2][i] == dict(rows)[i] for i in clean)
    assert set(kept[3]) == clean | {202, 203}
    final = docs.collect()
    assert {r["doc_id"] for r in final} == set(kept[3]) and all(r["n_tokens"] == len(r["ids"]) for r in final)


def test_pipeline_on_edge_rows_and_empty_tables(spark, scratch):
    write_docs(spark, scratch, EDGE, labels=([], LABELS), benchmark=([], ITEMS))
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, scratch).collect()]
    assert len(got) == len(EDGE) - 1  # the repeated row leaves once
    write_docs(spark, scratch, [], labels=([], LABELS), benchmark=([], ITEMS))
    assert corpus_pipeline.run(spark, scratch).count() == 0
