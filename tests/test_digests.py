"""Comparison by digests of ranges against netting, and paths doubled against a walk level by level."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import compare, digests, lineage

SCHEMA = "k bigint, s string, d decimal(19,4), x double"


def rows(seed: int, count: int = 3000):
    rng = random.Random(seed)
    made = [(rng.randrange(900), rng.choice(["a", "", None, "é"]), None, rng.choice([0.0, -0.0, 1.5, None])) for _ in range(count)]
    return made + made[:50]


def sided(frame):
    return sorted(((r.k, r.s, r.x, r.side, r.copies) for r in frame.collect()), key=str)


@pytest.mark.parametrize("small", [1, 10_000])
@pytest.mark.parametrize("key", [None, ["k"]])
def test_same_rows_as_netting(spark, monkeypatch, small, key):
    monkeypatch.setattr(digests, "FAN", 3)
    left = rows(1)
    right = left[7:] + [(5, "new", None, None), (5, "new", None, None), (6, None, None, 0.0)]
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).repartition(5)
    told = sided(compare.differing_rows(a, b))
    assert told and sided(digests.differing_rows_by_digest(a, b, key, small)) == told
    assert not digests.same_by_digest(a, b, key).first().equal


def test_equal_tables_whatever_their_order(spark):
    a, b = spark.createDataFrame(rows(2), SCHEMA), spark.createDataFrame(rows(2)[::-1], SCHEMA).repartition(7)
    assert digests.differing_rows_by_digest(a, b).count() == 0
    assert digests.same_by_digest(a, b).first().asDict() == {"left_rows": 3050, "right_rows": 3050, "equal": True}
    none = a.limit(0)
    assert digests.same_by_digest(none, none).first().equal and digests.differing_rows_by_digest(none, none).count() == 0
    assert not digests.same_by_digest(a, none).first().equal


def test_copies_and_nulls_count(spark):
    one = spark.createDataFrame([(1, None, None, None), (None, "1", None, None)], SCHEMA)
    swapped = spark.createDataFrame([(None, "1", None, None), (None, "1", None, None)], SCHEMA)
    assert not digests.same_by_digest(one, swapped).first().equal
    assert not digests.same_by_digest(one, one.union(one.limit(1))).first().equal


def test_descends_to_small_ranges_of_a_large_table(spark):
    left = spark.range(200_000).select("id", (F.col("id") % 97).alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 77_777, 1_000).otherwise(F.col("v")))
    ranges, width, passes = digests.differing_ranges(left, right, ["id"], small=10)
    assert (passes, width, ranges.count()) == (2, 2 * digests.FAN, 1)
    assert {(r.id, r.side) for r in digests.differing_rows_by_digest(left, right, ["id"], 10).collect()} == {(77_777, "left"), (77_777, "right")}


def test_no_row_is_exchanged_for_a_comparison(spark):
    """Every exchange carries sums of ranges, added up before it."""
    frame = spark.range(1000).select("id", F.lit("text").alias("s"))
    text = digests.same_by_digest(frame, frame)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"partial_sum", text)) >= 2
    for line in (x for x in text.splitlines() if "Exchange" in x):
        assert "SinglePartition" in line or "range" in line or "_groupingexpression" in line, line


def walked(pairs):
    up: dict = {}
    for src, dst in pairs:
        up.setdefault(dst, set()).add(src)
    told = {}
    for node in {n for p in pairs for n in p}:
        depth, frontier, seen = 0, {node}, {node}
        while frontier:
            depth += 1
            frontier = {s for n in frontier for s in up.get(n, ())} - seen
            seen |= frontier
            told.update({(node, a): depth for a in frontier})
    return told


@pytest.mark.parametrize("name", ["cycle", "random", "none"])
def test_all_ancestors_equal_a_walk(spark, name):
    rng = random.Random(3)
    pairs = {
        "cycle": [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d"), ("x", "y")],
        "random": [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(90)],
        "none": [],
    }[name]
    links = spark.createDataFrame(pairs, "src string, dst string")
    assert {(r.node, r.ancestor): r.depth for r in lineage.all_ancestors(links).collect()} == walked(pairs)


def test_a_thousand_levels_take_few_rounds(spark, monkeypatch):
    rounds = []
    plain = lineage.cut

    def counted(frame):
        rounds.append(1)
        return plain(frame)

    monkeypatch.setattr(lineage, "cut", counted)
    chain = spark.range(1000).selectExpr("CAST(id AS STRING) AS src", "CAST(id + 1 AS STRING) AS dst")
    found = lineage.all_ancestors(chain)
    # Two writes a round, one at the start and one for the round that finds nothing.
    assert (len(rounds) - 2) // 2 <= 11
    assert found.count() == 1000 * 1001 // 2 and found.agg(F.max("depth")).first()[0] == 1000
