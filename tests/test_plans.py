"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io
import threading

import pytest

from ledgerloom import fixtures
from ledgerloom.operators import cdc, clean, fx
from ledgerloom.plans import common
from ledgerloom.plans.catalog import QUERIES
from ledgerloom.plans.medallion import Layers
from ledgerloom.session import cut, cut_by, new_folder
from ledgerloom.sources import sinks
from ledgerloom.streaming import delivery

PLANNED = [
    "agg_01_store_quarter_totals", "agg_03_daily_revenue", "agg_04_revenue_summary",
    "agg_06_reporting_pack", "jn_01_identity_resolution", "jn_03_fx_asof", "jn_04_asof_large",
    "jn_08_reconcile_join", "win_01_dedupe_redelivery", "win_02_cdc_latest", "win_03_cdc_history",
    "flt_03_event_rules", "set_02_union_findings", "lin_01_moves_to_edges", "lin_02_phantom_edges",
]


def plan(frame, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", PLANNED)
def test_no_product_and_no_python_in_the_plan(spark, small_folder, name):
    text = plan(QUERIES[name](spark, small_folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert bad not in text


def test_only_used_columns_are_read(tables):
    text = plan(common.summary(tables))
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,"
            "l_extendedprice:double,l_discount:double>") in text
    assert "o_totalprice" not in text and "l_shipdate" not in text and "c_name" not in text


def test_filters_reach_the_scan(tables):
    text = plan(fixtures.web_purchases(tables))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in text


def test_the_two_facts_join_by_shuffle(tables):
    text = plan(fixtures.store_sales(tables), "simple")
    merge = text[text.index("SortMergeJoin [order_key"):]
    assert "LeftOuter" in merge.splitlines()[0]


def test_large_calendar_is_not_broadcast(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines, quotes = fixtures.store_sales(tables), fixtures.fx_quotes(tables)
        small, large = fx.calendar(quotes), fx.calendar(quotes, broadcast_rows=10)
        assert "BroadcastHashJoin" in plan(fx.with_rate(lines, small), "simple")
        assert "BroadcastHashJoin" not in plan(fx.with_rate(lines, large), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_announced_deliveries_alone_are_read(spark, tmp_path, broadcast):
    """The join with the announced ids prunes the landing table's folders, whether they can be broadcast or not."""
    folder, ids = str(tmp_path / "landed"), str(tmp_path / "ids")
    spark.range(40).selectExpr("id", "CAST(id % 8 AS STRING) AS delivery_id").write.partitionBy(
        "delivery_id").parquet(folder)
    spark.createDataFrame([("3",), ("5",), ("",), (None,)], "delivery_id string").write.parquet(ids)
    landed = spark.read.schema("id bigint, delivery_id string").parquet(folder)
    told = spark.read.schema("delivery_id string").parquet(ids)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.set(delivery.PRUNE, "false")
        rows = delivery.announced_rows(landed, told)
        assert "dynamicpruning" in plan(rows, "simple")
        assert {r.delivery_id for r in rows.collect()} == {"3", "5"} and rows.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset(delivery.PRUNE)


def test_a_level_of_the_walk_moves_its_frontier_alone(spark):
    links = spark.range(500).selectExpr("concat('s', id) AS src", "concat('d', id % 50) AS dst")
    up = cut_by(links.select("src", "dst").distinct(), "dst")
    frontier = cut(spark.range(300).selectExpr("concat('d', id) AS dst"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(up.join(frontier, "dst"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 1


def test_latest_rows_combine_before_the_shuffle(tables):
    """A hot key must not travel row by row: a partial aggregate sits below the exchange."""
    for frame in (
        cdc.current_state(cdc.unwrap(fixtures.change_envelopes(tables))),
        clean.latest_delivery(fixtures.redelivered_lines(tables),
                              tables.lineitem.columns, "delivery_no"),
    ):
        text = plan(frame, "simple")
        assert "Window" not in text and "partial_max" in text


def test_rows_with_few_copies_are_dealt_out_first(tables):
    """Pieces grow in number with the rows; behind that one exchange nothing moves again."""
    rows = fixtures.redelivered_lines(tables)
    for n_rows, pieces in ((100_001, 2), (37_000_000, 370)):
        frame = clean.latest_delivery(rows, tables.lineitem.columns, "delivery_no", n_rows=n_rows)
        text = plan(frame, "simple")
        assert text.count("Exchange") == 1 and f", {pieces}), REPARTITION_BY_NUM" in text
        assert "partial_max" not in text[text.index("Exchange"):]


def test_sale_lines_move_to_their_files_while_narrow(spark, tables, monkeypatch):
    """Rates and labels double a line's width; the exchange by fiscal year lies below them."""
    layers, written = Layers(tables, new_folder(spark, "t-narrow")), {}
    save = sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda frame, folder, *args, **kwargs: (
        written.__setitem__(folder.rpartition("/")[2], (frame, kwargs)), save(frame, folder, *args, **kwargs))[1])
    layers.bronze()
    layers.silver()
    frame, kwargs = written["sale_lines"]
    text = plan(frame, "simple")
    moved = text.index("REBALANCE_PARTITIONS_BY_COL")
    assert kwargs["dealt"] and text.count("REBALANCE_PARTITIONS_BY_COL") == 1
    assert "rate_status" in text[:moved] and "rate_status" not in text[moved:]


def test_tables_of_a_layer_are_written_side_by_side(spark, tables, monkeypatch):
    """Nine independent tables: each write waits until all have begun."""
    met, save = threading.Barrier(9, timeout=120), sinks.write_table

    def waiting(frame, folder, *args, **kwargs):
        met.wait()
        return save(frame, folder, *args, **kwargs)

    monkeypatch.setattr(sinks, "write_table", waiting)
    layers = Layers(tables, new_folder(spark, "t-side"))
    layers.bronze()
    assert len(layers.written) == 9 and layers.read("bronze/orders").count() == tables.orders.count()


def test_a_table_that_fails_ends_the_build_after_the_others(spark, tables):
    layers = Layers(tables, new_folder(spark, "t-fails"))
    bad = lambda: tables.orders.selectExpr("raise_error('no') AS x")
    with pytest.raises(Exception, match="no"):
        layers.write_all({"bad": bad, "orders": lambda: tables.orders})
    assert list(layers.written) == ["orders"]


def test_layers_read_the_layer_below_alone(spark, tables):
    """Without the given tables, silver and gold still build; the fact join stands in silver once."""
    layers = Layers(tables, new_folder(spark, "t-layers"))
    layers.bronze()
    layers.t = None
    layers.silver()
    text = plan(layers.read("silver/sale_lines"), "simple")
    assert "Join" not in text
    layers.gold()
    assert {n.split("/")[0] for n in layers.written} == {"bronze", "silver", "gold"}
    assert layers.read("gold/dim_country").count() == tables.nation.count()
