"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import oracle
from ledgerloom.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small_folder):
    return oracle.connect(small_folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, small_folder, name):
    problems, _ = oracle.compare(spark, con, QUERIES[name], ORACLES[name], small_folder)
    assert not problems, problems


def test_entry_point_offers_the_registry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["fiscal_quarter", "revenue_usd", "cancelled_usd"]


def test_no_query_name_is_taken_twice():
    from ledgerloom.plans.registry import query

    with pytest.raises(KeyError):
        query(next(iter(QUERIES)))(lambda t: None)
