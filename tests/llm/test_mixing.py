from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from decimal import Decimal

import pytest

import oracle
from ledgerloom.llm import mixing
from ledgerloom.llm.common import ORACLES, QUERIES

WEIGHTS = (5.0, 2.0, 1.0)


def plain_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Share, cut what is above, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def plain_mix(rows: list[tuple]) -> dict[int, int]:
    """Copies by id: one loop per source over its documents in order."""
    sizes, docs = defaultdict(int), defaultdict(list)
    for doc_id, source, text in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        docs[source].append((n, hashlib.sha256(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:5], doc_id))
    copies = {}
    for source, target in plain_targets(sizes).items():
        rate = 3.0 if target >= 3 * sizes[source] else target / sizes[source] if sizes[source] else 0.0
        whole, part = math.floor(rate), round(Decimal(rate - math.floor(rate)), 15)
        name = "n" if source is None else "s" + source
        offset = round(Decimal(int(hashlib.sha256(f"mix0:{name}".encode()).hexdigest()[:12], 16) / 16.0**12), 15)
        total = offset
        for _, _, doc_id in sorted(docs[source]):
            copies[doc_id] = whole + math.floor(total + part) - math.floor(total)
            total += part
    return copies


def test_query_equals_sql_and_loop(spark, small_folder):
    problems, _ = oracle.compare(spark, oracle.connect(small_folder), QUERIES["op8_mixing"], ORACLES["op8_mixing"], small_folder)
    assert not problems
    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    told = plain_mix([(r.doc_id, r.source, r.text) for r in docs.collect()])
    assert {r.doc_id: r.copies for r in mixing.mix(docs).collect()} == told


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 1000}, {"a": 1, "b": 1, "c": 10_000, None: 5}, {"a": 0, "b": 7}, {"x": 9},
    {f"s{i:02}": 3**i for i in range(9)},
])
def test_targets_are_the_fixed_point_of_resharing(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_taken_words_come_near_the_targets(spark, small_folder):
    rows = mixing.mix(spark.read.parquet(f"{small_folder}/documents.parquet")).collect()
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in taken)


def test_null_empty_ties_and_extra_columns(spark):
    rows = [(1, None, None, "x"), (2, "a", "", "y"), (3, "a", "one two", "z"), (3, "a", "one two", "z"), (None, "b", "w " * 500, "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, copies string")
    got = mixing.mix(docs)
    assert got.count() == 5
    assert {r.source: r.source_size for r in got.collect()} == {None: 0, "a": 4, "b": 500}
    assert mixing.mixed(docs).columns == docs.columns
    taken = sorted((str(r.doc_id), r.copies) for r in mixing.mixed(docs).collect())
    assert all(c in "xyzq" for _, c in taken)
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = docs.withColumn("text", docs["copies"].substr(5, 1))
    assert [r.taken for r in mixing.mix(blank).collect()] == [0] * 5


def test_plan_has_no_python(spark, small_folder, capsys):
    QUERIES["op8_mixing"](spark, small_folder).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan and "CartesianProduct" not in plan


def test_columns_named_like_working_ones_survive(spark):
    docs = spark.createDataFrame([(1, "a", "x y", "p", 7, "q", "r"), (2, None, "z", "s", 8, "t", "u")],
                                 "doc_id bigint, source string, text string, _size string, _k int, _held_k string, _doc string")
    told = {r.doc_id: (r._size, r._k, r._held_k, r._doc) for r in docs.collect()}
    for made in (mixing.mix(docs), mixing.mixed(docs)):
        assert made.columns[:7] == docs.columns
        rows = made.collect()
        assert rows and all((r._size, r._k, r._held_k, r._doc) == told[r.doc_id] for r in rows)
