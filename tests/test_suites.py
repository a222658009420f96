"""Suites against the contracts one by one, and their single pass."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import contracts, suites
from ledgerloom.operators.suites import Check, Suite
from ledgerloom.plans.catalog import QUERIES

ROWS = [(1, "a", 5), (1, "a", 5), (2, None, -1), (3, "z", None), (4, "y", -2), (None, "z", 1), (None, "a", 3)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "id int, kind string, n int")


def told(frame):
    return {(r.contract, r.table_name): r.violations for r in frame.collect()}


def checks():
    return [suites.not_null("kind"), suites.not_null("n"), suites.accepted_values("kind", ["a"]), Check("positive", F.col("n") < 0)]


@pytest.mark.parametrize("key", [(), ("id",)])
def test_counts_equal_the_contracts_one_by_one(frame, key):
    got = [(r.contract, r.violations) for r in Suite("t", frame, checks(), key, not_empty=True).violations().collect()]
    one_by_one = [
        ("not_empty", contracts.not_empty({"t": frame}).count()),
        ("not_null", contracts.not_null(frame, "kind").count()), ("not_null", contracts.not_null(frame, "n").count()),
        ("accepted_values", contracts.accepted_values(frame, "kind", ["a"]).count()), ("positive", 2),
    ]
    if key:
        one_by_one.append(("unique", contracts.unique(frame, ["id"]).count()))
    assert sorted(got) == sorted(one_by_one)


def test_sums_and_rows(frame):
    one = Suite("t", frame, key=["id"], sums={"total": F.col("n")}).evaluated().first()
    assert (one.n_rows, one.unique, one.total) == (7, 2, 11)


def test_empty_table(frame):
    suite = Suite("t", frame.limit(0), checks(), ("id",), not_empty=True)
    assert {k[0]: v for k, v in told(suite.violations()).items()} == {
        "unique": 0, "not_empty": 1, "not_null": 0, "accepted_values": 0, "positive": 0}


def test_violating_rows_on_demand(frame):
    suite = Suite("t", frame, checks(), ("id",))
    rows = lambda name: sorted((tuple(r) for r in suite.violating(name).collect()), key=str)
    assert rows("positive") == [(2, None, -1), (4, "y", -2)]
    assert rows("not_null") == [(2, None, -1), (3, "z", None)]
    assert len(rows("unique")) == 4
    with pytest.raises(KeyError):
        suite.violating("none such")
    with pytest.raises(ValueError):
        Suite("t", frame, [Check("odd", F.col("n") > 0, suites.VALUES)])


def scans(frame):
    """Paths of the file scans of the plan that is to run."""
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    files = frame._jdf.queryExecution().sparkPlan().toString()
    assert text
    return re.findall(r"FileScan parquet .*?Location: \S+ ?\(\d+ paths?\)\[([^\]]*)\]", files)


def test_one_scan_for_each_table_of_the_report(spark, small_folder):
    found = scans(QUERIES["dq_10_contract_report"](spark, small_folder))
    names = [f.rstrip("/").rsplit("/", 1)[-1] for f in found]
    raw = [n for n in names if n.startswith("lineitem") or n.startswith("orders")]
    assert len(raw) == len(set(raw)) == 2, names
    built = [re.sub(r"-[0-9a-f]{32}.*", "", n) for n in names if re.search(r"-[0-9a-f]{32}", n)]
    # The small dimension is also the other side of two joins.
    assert all(built.count(n) == 1 for n in set(built) - {"countries"}), built


def test_the_audit_joins_the_facts_once(spark, small_folder):
    found = scans(QUERIES["jn_08_reconcile_join"](spark, small_folder))
    assert sum("lineitem" in f for f in found) == 2
