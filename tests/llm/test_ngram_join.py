from __future__ import annotations

import random

import numpy as np
import pytest

import oracle
from ledgerloom.llm import ngram_join as nj
from ledgerloom.llm.common import ORACLES, QUERIES

FOUR = nj.Likeness(4, 85, 100)


def plain_set(text: str | None, width: int = 5) -> set[bytes]:
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_groups(docs, like=nj.Likeness()) -> list[tuple]:
    """Id, set size and smallest id reached, comparing all pairs."""
    sets = [plain_set(t, like.width) for _, t in docs]
    label = list(range(len(docs)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and like.whole * len(a & sets[j]) >= like.part * len(a | sets[j]):
                x, y = top(i), top(j)
                label[max(x, y)] = min(x, y)
    least: dict[int, list] = {}
    for i, (k, _) in enumerate(docs):
        least.setdefault(top(i), []).append(k)
    least = {r: min((k for k in ks if k is not None), default=None) for r, ks in least.items()}
    return sorted(((k, len(sets[i]), least[top(i)] if sets[i] else k) for i, (k, _) in enumerate(docs)), key=str)


def planted(seed: int = 3) -> list[tuple[int, str | None]]:
    """Originals with edited, shortened and lengthened copies, chains, common lines, one large group, odd texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    prose = lambda n: rng.choices(words, k=n)
    lines = [prose(30) for _ in range(3)]
    texts = []
    for _ in range(60):
        t = prose(rng.randint(1, 300))
        texts.append(t)
        for _ in range(rng.randint(0, 3)):
            c = list(t)
            for _ in range(rng.randint(0, max(1, len(t) // 30))):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append(c[:rng.randint(len(c) * 3 // 4, len(c))] + prose(rng.randint(0, 3)))
        texts.append(prose(3) + rng.choice(lines) + prose(rng.randint(0, 12)) + rng.choice(lines))
    chain = prose(100)
    for i in range(25):
        texts.append(list(chain))
        chain[4 * i] = f"x{i}"
    base = prose(80)
    for _ in range(60):
        c = list(base)
        for _ in range(rng.randint(0, 3)):
            c[rng.randrange(80)] = rng.choice(words)
        texts.append(c)
    texts += [prose(20000)] * 2
    rng.shuffle(texts)
    texts = [" ".join(t) for t in texts] + [None, "", " \n", "One two", "ONE  two", "One zwei", "éa É b c d"]
    return list(enumerate(texts)) + [(3, "One two"), (None, "one two"), (None, "no other"), (None, None)]


def got(frame):
    return sorted(((r[0], r[1], r[2]) for r in frame.collect()), key=str)


@pytest.mark.parametrize("like,block,nearest", [(nj.Likeness(), nj.BLOCK, nj.NEAREST), (FOUR, 20, 2)])
def test_equals_all_pairs(spark, monkeypatch, like, block, nearest):
    monkeypatch.setattr(nj, "BLOCK", block)
    monkeypatch.setattr(nj, "NEAREST", nearest)
    monkeypatch.setattr(nj, "CHUNK", 7)
    docs = planted()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert got(nj.near_duplicates(frame, like)) == plain_groups(docs, like)


def test_query_equals_sql(spark, small_folder):
    name = "op13_ngram_join"
    problems, rows = oracle.compare(spark, oracle.connect(small_folder), QUERIES[name], ORACLES[name], small_folder)
    assert not problems and rows


def test_unlike_sets_of_one_key_are_all_compared(spark):
    """One shared key, room by size and place, nothing known: blocks and rounds meet every pair exactly once."""
    rng = np.random.default_rng(5)
    wide = bytes([0] + [255] * nj.RANGES)
    rows = [(7, int(x), 100, 0, wide, int(x)) for x in rng.integers(0, 2**62, 300)]
    frame = spark.createDataFrame(rows, "token bigint, node bigint, n int, at int, profile binary, root bigint")
    for block in (4096, 50):
        nj.BLOCK, before = block, nj.BLOCK
        try:
            dealt = nj.blocked(frame)
            found = [tuple(r) for low, high in ((0, 16), (16, 256), (256, 4096)) for r in nj.distant(dealt, FOUR, low, high).collect()]
        finally:
            nj.BLOCK = before
        assert len(found) == len(set(found)) == 300 * 299 // 2


def test_filters_let_every_alike_pair_through():
    rng = random.Random(1)
    for like in (nj.Likeness(), FOUR):
        for _ in range(300):
            base = [rng.randrange(2**64) for _ in range(rng.randint(1, 400))]
            other = [g for g in base if rng.random() > 0.08] + [rng.randrange(2**64) for _ in range(rng.randint(0, len(base) // 12))]
            if not other:
                continue
            a, b = np.unique(np.array(base, np.uint64)), np.unique(np.array(other, np.uint64))
            if not like.alike(a, b):
                continue
            n, m = len(a), len(b)
            keys = set(a[:like.keys(n)].tolist()) & set(b[:like.keys(m)].tolist())
            assert keys
            t = np.uint64(min(keys))
            assert like.room(n, np.searchsorted(a, t), m, np.searchsorted(b, t))
            one, other = (np.frombuffer(nj.profiles(x, np.array([len(x)]))[0], np.uint8)[None] for x in (a, b))
            assert like.agree(n, one, m, other)


def test_profiles_of_huge_sets_round_up():
    gram = np.arange(70_000, dtype=np.uint64)
    row = np.frombuffer(nj.profiles(gram, np.array([70_000]))[0], np.uint8)[None]
    assert 70_000 <= nj.counts_of(row)[0, 0] < 72_000 and nj.counts_of(row)[0, 1:].sum() == 0


def test_shared_keys_stream_over_batches(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(900), rng.randrange(40), 9, 1) for _ in range(5000)]
    rows += [(10**6 + i, 1, 9, 1) for i in range(3000)] + [(10**6 + 7, 1, 9, 1)] * 5
    told = {}
    for t, n, _, _ in rows:
        told.setdefault(t, set()).add(n)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = [(r.token, r.node) for r in nj.shared_keys(spark.createDataFrame(rows, nj._ROW)).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(found) == sorted((t, n) for t, ns in told.items() if len(ns) > 1 for n in ns)


def test_given_pairs_are_verified(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "q r s t u v w")], "doc_id bigint, text string")

    def everything(log):
        return log.selectExpr("node AS u").crossJoin(log.selectExpr("node AS v")).where("u > v")

    assert got(nj.near_duplicates(docs, nj.Likeness(), everything)) == [(1, 4, 1), (2, 5, 1), (3, 3, 3)]


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "x", "a b c d", "p"), (2, "y", "A b c  d", "q")], "doc_id bigint, node string, text string, token string")
    assert got(nj.near_duplicates(docs, FOUR)) == [(1, 1, 1), (2, 1, 1)]
    assert nj.near_duplicates(docs.where("false")).count() == 0
    assert nj.near_duplicates(docs.withColumn("text", nj.F.lit(None).cast("string")), FOUR).count() == 2
