from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import oracle
from ledgerloom.llm import spelling_variants as sv
from ledgerloom.llm.common import ORACLES, QUERIES, Scratch


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(docs, least_length=7, least_count=2, times=10):
    counts: Counter = Counter()
    for ident, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode("utf-8"))
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    v = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [] for w in v}
    for a, b in combinations(v, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, ns in near.items():
        if ns and v[best := min(ns, key=lambda x: (-v[x], x))] >= times * v[w]:
            form[w] = best
    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, n, len(near[w]), form.get(w), v.get(form.get(w)), root(w)) for w, n in v.items())


def got(frame):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect())


def key(rows):
    return sorted(rows, key=lambda r: r[0])


def hard_docs():
    rng = random.Random(2)
    base = ["straßenbahn", "Émigration", "banana" * 2, "aaaaaaaa", "abababab", "Ÿsaÿinglongword", "z" * 5000, "permuting", "gnitumrep"]
    docs = []
    for i in range(250):
        words = []
        for _ in range(rng.randint(0, 30)):
            w = rng.choice(base)
            k = rng.randrange(len(w))
            words.append(rng.choice([w] * 12 + [w[:k] + w[k + 1:], w[:k] + rng.choice("abé") + w[k:], w[:k] + "ü" + w[k + 1:], w.upper()]))
        docs.append((i // 2, rng.choice([" ", ", ", "\n7"]).join(words)))
    # A chain of forms: each ten times as frequent as the one before.
    docs += [(1000, "chainaaa " * 2), (1001, "chainaab " * 40), (1002, "chainabb " * 500), (1003, "chainbbb " * 6000)]
    docs += [(None, "nullified nullified"), (7, None), (8, ""), (9, " \n "), (5, "same same sameword sameword"), (5, "same same sameword sameword")]
    return docs


def test_equals_plain_loops(spark):
    docs = hard_docs()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    told = plain_variants(docs)
    assert got(sv.variants(frame)) == told
    assert max(len(r[0]) for r in told) > 4990 and any(r[3] for r in told) and any(r[5] != (r[3] or r[0]) for r in told)


def test_query_equals_sql(spark, small_folder):
    name = "op11_spelling_variants"
    problems, rows = oracle.compare(spark, oracle.connect(small_folder), QUERIES[name], ORACLES[name], small_folder)
    assert not problems and rows


def test_near_words_share_a_key_whatever_they_are(spark):
    rng = random.Random(9)
    words = {"".join(rng.choices("ab", k=rng.randint(7, 12))) for _ in range(900)}
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    told = {tuple(sorted(p)) for p in combinations(words, 2) if one_edit(*p)}
    assert {(r.a, r.b) for r in sv.near_pairs(frame, Scratch(spark, "t")).collect()} == told


def test_near_words_agree_in_a_choice_of_blocks():
    for a, b in [("letters", "leters"), ("letters", "lettess"), ("aaaaaaa", "aaaaaaaa"), ("abcdefg", "xbcdefg")]:
        x, y = sv.signatures([a, b])
        assert (x == y).any()


def test_empty_table_and_other_columns(spark):
    frame = spark.createDataFrame([(1, "repeated repeated", "x", "y")], "doc_id bigint, text string, word string, n string")
    assert got(sv.variants(frame)) == [("repeated", 2, 0, None, None, "repeated")]
    assert sv.variants(frame.where("false")).count() == 0
