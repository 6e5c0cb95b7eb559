import collections

import numpy as np
from pyspark.sql import functions as F

from strata.llm import langid, quality_fm, queries, repetition
from tests.llm.helpers import EDGE, WORD, crc, docs_frame, prose, write_docs

LABELS = "doc_id long, quality int, toxic int"


def _rules(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
        seen.add(line)
    grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    mark = [0] * len(w)
    for i in range(len(w) - 7):
        if grams[tuple(w[i : i + 8])] > 1:
            mark[i : i + 8] = [1] * 8
    failed = len(w) < 20 or 100 * sum(mark) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, sum(mark), failed


def test_rules_equal_brute_force(spark, scratch):
    line = prose(1, 9)
    rows = EDGE + [
        (1, "\n".join([line] * 5 + [prose(2, 30)])), (2, "a b c d e f g h " * 40), (3, prose(3, 300) + " ### $$ a|b <x>"),
        (4, prose(4, 60) + "\n" + prose(4, 60)), (5, "x\n\nx\n x\nx "), (6, "w " * 5000),
    ]
    write_docs(spark, scratch, rows)
    got = collections.Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in queries.op8_quality_rules(spark, scratch).collect()
    )
    assert got == collections.Counter((d, *_rules(t)) for d, t in rows)


def test_longest_repeats_equal_brute_force():
    rng = np.random.default_rng(0)
    for n, kinds in ((1, 1), (40, 2), (120, 5), (200, 30)):
        words = rng.integers(0, kinds, n).astype(np.uint64)
        docs = np.sort(rng.integers(0, 3, n))
        best, _ = repetition.longest_repeats(words, docs)
        for i in range(n):
            want = 0
            for j in range(n):
                if i != j and docs[i] == docs[j]:
                    k = 0
                    while max(i, j) + k < n and docs[i + k] == docs[i] == docs[j + k] and words[i + k] == words[j + k]:
                        k += 1
                    want = max(want, k)
            assert best[i] == want


def test_rules_reject_a_long_repeat_and_keep_clean_text(spark):
    part = prose(8, 70)
    df = docs_frame(spark, [(1, prose(1, 400)), (2, f"{prose(2, 200)} {part} {prose(3, 200)} {part} {prose(4, 100)}")])
    kept = {r["doc_id"]: (r["kept"], r["base_failed"], r["longest_repeat"]) for r in repetition.measure(df.withColumn("kept", F.lit("x"))).collect()}
    assert kept[1][0] and kept[2] == (False, False, 70)
    assert repetition.measure(docs_frame(spark, [])).count() == 0


def test_language_query(spark, scratch):
    samples = {
        "en": "the cat and the dog were walking with their friends through this town when it rained ",
        "de": "der hund und die katze gingen mit ihren freunden durch die stadt als es regnete nicht ",
        "fr": "le chien et le chat se promenaient avec leurs amis dans cette ville quand il pleuvait ",
    }
    rows = []
    for i in range(90):
        lang = sorted(samples)[i % 3]
        w = samples[lang].split()
        rows.append((i, " ".join(w[i % 7 :] + w[: i % 5]), lang))
    rows += [(d, t, None) for d, t in EDGE] + [(990, "123 ... !!", "en")]
    write_docs(spark, scratch, rows)
    got = queries.op9_language_id(spark, scratch).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by[i]["lang_pred"] == sorted(samples)[i % 3] for i in range(90))
    assert all(by[i]["held_out"] == (crc(i) % 3 == 1) for i in by)
    for i in (900, 901, 902, 990):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_without_training_rows(spark):
    model = langid.fit(docs_frame(spark, [(1, "text", None)]))
    row = langid.identify(docs_frame(spark, [(1, "some text")]).withColumn("score", F.lit("x")), model).first()
    assert (row["lang_pred"], row["score"], row["rejected"]) == ("und", 0.0, True)


def _auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_query_held_out(spark, scratch):
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        text = " ".join(w + "###" for w in prose(i, 60).split()) if i % 8 == 0 else ("spam now " * 40 if bad else prose(i, 80) + ".")
        rows.append((i, text))
        labels.append((i, 0 if bad else 1, 0))
    rows += EDGE
    write_docs(spark, scratch, rows, labels=(labels + [(None, 1, 0), (5000, None, 0)], LABELS))
    got = queries.op5_quality_classifier(spark, scratch).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 300 and r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) for r in got if r["doc_id"] is not None)
    label = np.array([labels[r["doc_id"]][1] for r in held])
    assert _auc(np.array([r["score"] for r in held]), label) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    n = quality_fm.WORD_BUCKETS + len(quality_fm.STATISTICS) * quality_fm.BINS
    m = quality_fm.Machine(np.zeros((len(quality_fm.STATISTICS), quality_fm.BINS - 1)), 0.3, rng.normal(size=n), rng.normal(size=(n, quality_fm.RANK)))
    cols, vals = np.array([3, 77, 1000]), np.array([0.5, -1.0, 2.0])
    z, _ = m.raw(np.zeros(3, np.int64), cols, vals, 1)
    want = 0.3 + (m.linear[cols] * vals).sum()
    for i in range(3):
        for j in range(i + 1, 3):
            want += m.factors[cols[i]] @ m.factors[cols[j]] * vals[i] * vals[j]
    assert abs(z[0] - want) < 1e-9


def test_quality_without_labels(spark):
    machine = quality_fm.fit(docs_frame(spark, [(1, "a")]), spark.createDataFrame([], LABELS))
    assert abs(quality_fm.score(docs_frame(spark, EDGE), machine).first()["score"] - 0.5) < 1e-9


def _told(spark, training, texts):
    model = langid.fit(docs_frame(spark, training))
    rows = langid.identify(docs_frame(spark, list(enumerate(texts))), model).orderBy("doc_id").collect()
    return model, [(r["lang_pred"], r["score"]) for r in rows]


def test_one_hot_text_hides_no_language(spark):
    """Many rows of one language, one text that fills another: both are learned, and copies count once."""
    rows = [(i, prose(i, 30), "en") for i in range(300)] + [(1000 + i, "der die das und nicht ein eine mit von", "de") for i in range(2000)]
    model, told = _told(spark, rows, [prose(5000, 40), "und nicht mit der", "das"])
    assert sorted(set(model.languages)) == ["de", "en"]
    assert [t[0] for t in told] == ["en", "de", "de"]
    sampled = langid.sample_vectors(docs_frame(spark, rows), "text", "lang")
    assert len(sampled["de"]) == 1 and len(sampled["en"]) == 300


def test_equal_training_rows_and_one_row_teach_a_language(spark):
    for rows in ([(1, "hello there", "en")] * 2, [(1, "hello there", "en")]):
        _, told = _told(spark, rows, ["hello there", "hi", "x", "12 34", None])
        assert [t[0] for t in told] == ["en", "en", "en", "und", "und"] and told[0][1] > 0.99


def test_many_short_texts_and_counts_beyond_two_bytes(spark, monkeypatch):
    monkeypatch.setattr(langid, "BLOCK_ROWS", 50)
    rows = [(i, ("ab " if i % 2 else "yz ") * (1 + i % 3), "aa" if i % 2 else "zz") for i in range(1500)]
    rows += [(5000, "qrs" * 70_000, "qq")]
    _, told = _told(spark, rows, ["ab ab", "yz yz yz", "qrsqrsqrs"])
    assert [t[0] for t in told] == ["aa", "zz", "qq"]
