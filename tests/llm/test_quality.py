from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import quality_classifier as qc, quality_rules as qr
from ledgerloom.llm.common import QUERIES


def plain_base(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


TEXTS = [None, "", "\n\n", "a b c a b c a", "x x x x", "é é é  ü", "one\r\ntwo\r\n one\r\n one\r\n", "a b c d a b c e b c d",
         "# * $ |<>", "a\x0bb\x0cc\x1fd\x85e", "word " * 3000]


@pytest.mark.parametrize("text", TEXTS)
def test_statistics_are_exact(text):
    counts = qr.statistics((text or "").encode())
    assert (*counts[:5], qr.base_failed(counts[0], counts[4])) == plain_base(text)


def test_rules_query_against_brute_force_and_labels(spark, small_folder):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{small_folder}/documents.parquet").collect()}
    got = QUERIES["op6_quality_rules"](spark, small_folder).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_base(docs[r.doc_id])
        assert r.kept == (not r.base_failed and r.score >= qr.THRESHOLD)


def labelled(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = docs.orderBy("doc_id").collect()
    return [r.text for r in rows], np.array([r.quality for r in rows], float)


def test_trees_hold_out_and_keep_their_constraints(spark):
    texts, y = labelled(spark)
    x = qr.features(np.array([qr.statistics(t.encode()) for t in texts]))
    half, signs = len(y) // 2, list(qr.FEATURES.values())
    forest = qr.fit_forest(x[:half], y[:half], signs)
    assert ((forest.score(x[half:]) > 0.5) == (y[half:] > 0.5)).mean() > 0.98
    for j, sign in enumerate(signs):
        if sign:
            for value in np.linspace(0, 2, 15):
                low, high = x.copy(), x.copy()
                low[:, j], high[:, j] = value, value + 0.1
                assert (forest.score(high) <= forest.score(low) + 1e-12).all()


def test_flat_forest_equals_a_walk_tree_by_tree(spark):
    texts, y = labelled(spark)
    x = qr.features(np.array([qr.statistics(t.encode()) for t in texts]))
    forest = qr.fit_forest(x, y, list(qr.FEATURES.values()), 10)
    for row, score in list(zip(x, forest.score(x)))[:50]:
        total = forest.start
        for at in forest.roots:
            while forest.left[at] != at:
                at = forest.right[at] if row[forest.feature[at]] > forest.threshold[at] else forest.left[at]
            total += forest.value[at]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_em_recovers_accuracies():
    rng = np.random.default_rng(2)
    k, n = len(qc.LABELLERS), 40_000
    right = np.linspace(0.65, 0.95, k)
    truth = rng.random(n) < 0.7
    patterns = Counter()
    for good in truth:
        said = rng.random(k) < right
        patterns["".join("-" if rng.random() < 0.1 else "g" if s == good else "b" for s in said)] += 1
    found = qc.estimate(patterns)
    assert abs(found.prior - 0.7) < 0.03
    assert np.abs(found.accuracy[:, 1, 1] / found.accuracy[:, 1, 1:].sum(1) - right).max() < 0.04


def test_classifier_holds_out(spark):
    texts, y = labelled(spark)
    posterior = qc.estimate(Counter(map(qc.votes, texts))).posterior
    half = len(y) // 2
    x = np.stack([qc.hashed(t) for t in texts])
    scorer = qc.train(x[:half], np.array([posterior[qc.votes(t)] for t in texts[:half]]))
    assert ((scorer.score(texts[half:]) > 0.5) == (y[half:] > 0.5)).mean() > 0.97


def test_classifier_query(spark):
    got = {r.doc_id: r for r in QUERIES["op3_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert sum(got[r.doc_id].kept == bool(r.quality) for r in labels) >= 0.97 * len(labels)
    again = {r.doc_id: r.score for r in QUERIES["op3_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    assert all(abs(again[i] - r.score) < 1e-5 for i, r in got.items())


def test_null_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "w " * 60, "c")], "doc_id bigint, text string, kept string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert qr.fit(docs, labels) is None
    got = {r.doc_id: (r.base_failed, r.kept) for r in qr.judge(docs, None).collect()}
    assert got == {1: (True, False), 2: (True, False), None: (True, False)}
    assert {r.doc_id: r.kept for r in qc.classify(docs, None).collect()} == {1: False, 2: False, None: True}
    empty = docs.limit(0)
    assert qc.fit(empty)[1] is None and qc.classify(empty, None).count() == 0 and qr.judge(empty, None).count() == 0
