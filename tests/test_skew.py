"""Hot keys: a third of the rows on one key, a third of the rows copies of one row, missing keys."""

from __future__ import annotations

import contextlib

import duckdb
import pytest

import oracle
from ledgerloom import fixtures
from ledgerloom.fixtures import Tables
from ledgerloom.operators import fx, star
from ledgerloom.plans.catalog import ORACLES, QUERIES
from test_plans import plan

HOT = {
    "lineitem": """
        SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey)
        FROM src
        UNION ALL SELECT l.* FROM (SELECT * FROM src ORDER BY ALL LIMIT 1) l, range(2000)""",
    "orders": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 4 WHEN o_orderkey % 5 = 0 THEN NULL
                          ELSE o_custkey END AS o_custkey) FROM src""",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id) FROM src",
    "customer": """
        SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE c_nationkey END AS c_nationkey)
        FROM src""",
    "nation": "SELECT * FROM src",
    "region": "SELECT * FROM src",
    "supplier": "SELECT * FROM src",
    "part": "SELECT * FROM src",
}
CHECKED = """
agg_01_quarter_totals agg_03_daily_revenue agg_04_revenue_summary agg_06_reporting_pack
agg_09_evidence_vs_claim dq_02_country_resolves dq_05_summary_conserves_revenue
dq_08_generic_column_tests flt_01_malformed_quarantine jn_01_identity_resolution jn_03_fx_asof
jn_04_asof_large jn_08_reconcile_join jn_11_star_slice jn_12_build_dim_customer lin_01_moves_to_edges
lin_02_phantom_edges lin_03_upstream_walk lin_05_evidence_split scl_14_explode_lines
set_02_union_findings set_05_differing_rows set_05_order_insensitive_equality
src_03_nested_json_landing str_03_cdc_apply str_04_cdc_stateful win_01_dedupe_redelivery
win_01_latest_by_key win_02_cdc_latest win_03_cdc_history win_04_carry_forward
""".split()


@pytest.fixture(scope="module")
def hot_folder(small_folder, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for table, sql in HOT.items():
        con.execute(f"CREATE OR REPLACE VIEW src AS SELECT * FROM '{small_folder}/{table}.parquet'")
        target = folder / f"{table}.parquet"
        if table not in ("lineitem", "orders"):
            con.execute(f"COPY ({sql}) TO '{target}' (FORMAT parquet)")
            continue
        target.mkdir()
        con.execute(f"CREATE OR REPLACE TABLE made AS SELECT *, row_number() OVER () AS n FROM ({sql})")
        for i in range(6):
            con.execute(
                f"COPY (SELECT * EXCLUDE (n) FROM made WHERE n % 6 = {i}) "
                f"TO '{target}/f{i}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def con(hot_folder):
    return oracle.connect(hot_folder)


@pytest.mark.parametrize("name", CHECKED)
def test_hot_keys_change_no_result(spark, con, hot_folder, name):
    problems, _ = oracle.compare(spark, con, QUERIES[name], ORACLES[name], hot_folder)
    assert not problems, problems


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in names:
            spark.conf.unset(k)


TINY = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "2KB",
}


def test_a_hot_order_is_split_over_tasks(spark, hot_folder):
    with settings(spark, **TINY):
        lines = fixtures.store_sales(Tables(spark, hot_folder))
        rows = lines.collect()
        text = plan(lines, "simple")
    assert "isFinalPlan=true" in text and "skew=true" in text
    assert sum(r["order_key"] == 7 for r in rows) > len(rows) / 4


def test_a_split_order_still_counts_once(spark, con, hot_folder):
    """Folding lines to orders behind a join whose hot partition was split."""
    with settings(spark, **TINY):
        t = Tables(spark, hot_folder)
        products, quotes = fixtures.product_rollup(spark), fixtures.fx_quotes(t)
        lines = star.enrich(fixtures.store_sales(t), products, fx.calendar(quotes))
        daily = star.daily_revenue(lines)
        got = sum(r["orders"] for r in daily.collect())
        assert "skew=true" in plan(daily, "simple")
    want = con.sql("SELECT count(DISTINCT l_orderkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    assert got == want.fetchall()[0][0]
