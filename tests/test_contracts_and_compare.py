"""A contract that cannot fire proves nothing: each is shown a frame that violates it."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import compare, contracts, lineage, measures, metadata

AXES = ("fiscal_year string, fiscal_quarter string, department string, product_segment string, "
        "customer_segment string, country string, channel string")
SUMMARY = (f"{AXES}, sale_lines bigint, units bigint, revenue_usd decimal(38,4), "
           "cancelled_usd decimal(38,4), carried_rate_usd decimal(38,4)")


def summary(spark, *rows):
    full = [("FY1", "FY1-Q1", "D1", seg, "C1", "N1", channel, 2, 3, Decimal(usd), Decimal(1),
             Decimal(0)) for channel, seg, usd in rows]
    return spark.createDataFrame(full, SUMMARY)


def details(frame):
    return sorted(r["detail"] for r in frame.collect())


def test_channels(spark):
    full = summary(spark, ("store", "S1", 5), ("web", "S2", 7))
    assert details(contracts.channels_present(full)) == []
    assert details(contracts.channels_present(full.filter("channel = 'web'"))) == ["store"]


def test_country_including_null(spark):
    dim = spark.createDataFrame([("N1",)], "country string")
    facts = spark.createDataFrame([("N1",), ("N9",), (None,)], "country string")
    assert contracts.country_resolves(facts, dim).count() == 2
    assert contracts.country_resolves(facts.filter("country = 'N1'"), dim).count() == 0


def test_fiscal_label(spark):
    rows = [(dt.date(2024, 3, 31), "FY2024"), (dt.date(2024, 4, 1), "FY2024"),
            (dt.date(2024, 4, 2), "FY2025"), (dt.date(2024, 4, 3), None)]
    frame = spark.createDataFrame(rows, "day date, label string")
    assert details(contracts.fiscal_is_not_calendar(frame, "day", "label")) == [
        "2024-04-01 FY2024", "2024-04-03 null"]


def test_money_type(spark):
    tables = {"a": spark.createDataFrame([], "usd double, n int"),
              "b": spark.createDataFrame([], "usd decimal(19,4), n double")}
    columns = metadata.catalogue(spark, tables)
    assert details(contracts.money_is_decimal(columns, ["usd"])) == ["a.usd"]


def test_conservation(spark):
    kept = summary(spark, ("store", "S1", 5), ("web", "S2", 7))
    lines = spark.createDataFrame(
        [(Decimal(5), False), (Decimal(7), False), (Decimal(2), True), (None, False)],
        "usd decimal(19,4), is_cancelled boolean")
    assert contracts.summary_conserves_revenue(kept, contracts.line_totals(lines)).count() == 0
    short = contracts.line_totals(lines.filter("usd <> 7"))
    assert [d.split()[0] for d in details(contracts.summary_conserves_revenue(kept, short))] == [
        "revenue_usd", "sale_lines"]


def test_sizes(spark):
    tables = {"full": spark.range(3), "empty": spark.range(0)}
    assert details(contracts.not_empty(tables)) == ["empty"]
    told = spark.createDataFrame([("full", 4), ("other", 1)], "table_name string, n_rows bigint")
    counts = metadata.row_counts(tables)
    assert details(contracts.expected_counts(counts, told)) == [
        "empty 0 none", "full 3 4", "other none 1"]


def test_generic(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "k int, v string")
    parent = spark.createDataFrame([(2,)], "k int")
    assert details(contracts.not_null(frame, "k")) == ["k: 1"]
    assert details(contracts.unique(frame, ["k"])) == ["1 2"]
    assert details(contracts.accepted_values(frame, "v", ["a"])) == ["v b 1"]
    assert details(contracts.relationship(frame, "k", parent, "k")) == ["k 1"]
    assert contracts.not_null(frame.filter("k = 1"), "k").count() == 0
    assert contracts.unique(frame, ["v"]).count() == 0


def test_zero_snapshot_is_refused(spark):
    empty = measures.grand_totals(summary(spark).filter("false"))
    assert empty.first()["revenue_usd"] == 0
    assert contracts.not_all_zero(empty).count() == 1
    some = measures.grand_totals(summary(spark, ("web", "S1", 1)))
    assert contracts.not_all_zero(some).count() == 0


def test_report_lists_silent_contracts(spark):
    found = spark.createDataFrame([("b", "x"), ("b", "y")], "contract string, detail string")
    got = {r["contract"]: (r["status"], r["violations"]) for r in
           contracts.report(["a", "b"], found).collect()}
    assert got == {"a": ("holds", 0), "b": ("violated", 2)}


def test_reconcile_is_null_safe_and_keeps_both_sides(spark):
    left = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, 1)], "k int, v int")
    right = spark.createDataFrame([(1, 5), (2, None), (3, None), (5, 1)], "k int, v int")
    got = {r["k"]: r["agrees"] for r in compare.reconcile(left, right, "k", ["v"]).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_snapshots_compare_as_text(spark):
    one = spark.createDataFrame([(Decimal("1.5000"), 3)], "usd decimal(19,4), n bigint")
    two = spark.createDataFrame([(Decimal("1.50000"), 3)], "usd decimal(19,5), n bigint")
    got = {r["metric"]: r["agrees"] for r in compare.compare_snapshots(one, two).collect()}
    assert got == {"usd": False, "n": True}


def test_multisets(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    right = spark.createDataFrame([(2,), (1,)], "a int")
    row = compare.same_rows(left, right).first()
    assert (row["left_only"], row["right_only"], row["equal"]) == (1, 0, False)
    assert compare.same_rows(left, left.orderBy(F.desc("a"))).first()["equal"]
    assert compare.missing_each_way(left, right).count() == 0


def test_checksum_leaves_integers_out(spark):
    frame = spark.createDataFrame(
        [(1, 0.5, Decimal("1.25")), (2, 0.25, None)], "i int, f double, d decimal(9,2)")
    row = compare.checksum(frame).first()
    assert (row["n_rows"], row["decimal_total"], row["double_total"]) == (2, Decimal("1.25"), 0.75)


def test_measures_for_any_slice(spark):
    frame = summary(spark, ("store", "S1", 5), ("web", "S1", 7), ("web", "S2", 1))
    got = {r["product_segment"]: r["gross_usd"] for r in
           measures.slice_by(frame, ["product_segment"], ["gross_usd"]).collect()}
    assert got == {"S1": 14, "S2": 2}
    with pytest.raises(KeyError):
        measures.slice_by(frame, [], ["profit"])
    assert "revenue_usd" in measures.measure_names()


def test_pack_tells_null_labels_from_totals(spark):
    frame = summary(spark, ("store", None, 5), ("web", "S2", 7))
    rows = measures.reporting_pack(frame).collect()
    of_product = {r["product_segment"]: r["revenue_usd"] for r in rows if r["slice_id"] == 5}
    assert of_product == {None: 5, "S2": 7}
    assert [r["revenue_usd"] for r in rows if r["slice_id"] == 7] == [12]


def test_drift(spark):
    a = metadata.catalogue(spark, {"t": spark.createDataFrame([], "x int, y string, z date")})
    b = metadata.catalogue(spark, {"t": spark.createDataFrame([], "x bigint, y string, w date")})
    got = {r["column_name"]: r["status"] for r in metadata.drift(a, b).collect()}
    assert got == {"x": "retyped", "y": "same", "z": "missing", "w": "added"}


def test_same_named_tables_of_two_schemas_stay_apart(spark):
    one = metadata.catalogue(spark, {"t": spark.createDataFrame([], "a int")}, "one")
    two = metadata.catalogue(spark, {"t": spark.createDataFrame([], "b int, a int")}, "two")
    rows = metadata.columns_per_table(one.unionByName(two)).orderBy("schema_name").collect()
    assert [r["columns"] for r in rows] == ["a:int", "b:int,a:int"]


MOVES = "move string, step string, producer string, reads array<string>, writes array<string>"


def moves(spark):
    return spark.createDataFrame(
        [("m1", "s", "Copy", ["a"], ["x"]), ("m2", "s", "Reported", ["b", "c"], ["y"]),
         ("m3", "t", "Copy", ["x", "y"], ["z"])], MOVES)


def test_edges_stay_within_their_move(spark):
    got = sorted((r["src"], r["dst"]) for r in lineage.edges(moves(spark)).collect())
    assert got == [("a", "x"), ("b", "y"), ("c", "y"), ("x", "z"), ("y", "z")]


def test_phantoms(spark):
    def listed(*targets):
        return sorted((r["src"], r["dst"]) for r in lineage.phantom_edges(moves(spark), targets).collect())

    assert listed("x", "y", "z") == [("a", "y"), ("b", "x"), ("c", "x")]
    assert listed("x") == [("b", "x"), ("c", "x")] and listed("nowhere") == []
    counted = {(r["step"], r["dst"]): r["phantom_edges"] for r in
               lineage.phantom_counts(moves(spark)).collect()}
    assert counted == {("s", "x"): 2, ("s", "y"): 1, ("t", "z"): 0}


def test_walk_finds_shortest_distances_and_ends_on_cycles(spark):
    links = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("q", "r")], "src string, dst string")
    start = spark.createDataFrame([("c",)], "node string")
    got = {r["node"]: r["depth"] for r in lineage.ancestors(links, start).collect()}
    assert got == {"c": 0, "b": 1, "a": 1}


def test_walk_goes_as_deep_as_the_graph(spark):
    chain = [(f"n{i + 1}", f"n{i}") for i in range(100)]
    links = spark.createDataFrame(chain, "src string, dst string").coalesce(1)
    start = spark.createDataFrame([("n0",)], "node string")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r["node"]: r["depth"] for r in lineage.ancestors(links, start).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert got == {f"n{i}": i for i in range(101)}


def test_orphans_and_foreign_roots(spark):
    links = lineage.edges(moves(spark))
    sources = spark.createDataFrame([("a",), ("b",), ("lost",)], "node string")
    assert [r["node"] for r in lineage.orphans(sources, links).collect()] == ["lost"]
    assert [r["node"] for r in lineage.foreign_roots(sources, links).collect()] == ["c"]


@pytest.mark.parametrize("fault", ["rate", "lines"])
def test_a_fault_of_the_star_alone_does_not_agree(spark, small_folder, monkeypatch, fault):
    """The audit shares nothing with the star, so a wrong rate or a lost line shows."""
    from pyspark.sql import functions as F

    from ledgerloom import fixtures
    from ledgerloom.operators import fx
    from ledgerloom.plans.catalog import QUERIES

    if fault == "rate":
        right = fx.to_usd
        monkeypatch.setattr(fx, "to_usd", lambda lines: right(lines.withColumn("rate", F.expr("rate + 1"))))
    else:
        whole = fixtures.store_sales
        monkeypatch.setattr(fixtures, "store_sales", lambda t, *a, **k: whole(t, *a, **k).filter("order_key % 9 <> 4"))
    assert QUERIES["jn_08_reconcile_join"](spark, small_folder).filter("NOT agrees").count() > 0
    assert QUERIES["jn_09_snapshot_compare"](spark, small_folder).filter("NOT agrees").count() > 0
    found = QUERIES["dq_05_summary_conserves_revenue"](spark, small_folder)
    assert found.filter("frame = 'built'").count() > 0


def test_orphan_lines_and_missing_rates_are_told(spark):
    lines = spark.createDataFrame(
        [(True, "missing", None), (False, "missing", "CUR1"), (False, "quoted", "CUR1"), (True, "quoted", "CUR2")],
        "is_orphan_order boolean, rate_status string, currency string")
    assert [r["detail"] for r in contracts.no_orphan_lines(lines).collect()] == ["lines 2"]
    assert sorted(r["detail"] for r in contracts.rate_is_known(lines).collect()) == ["CUR1 1", "none 1"]
    good = lines.filter("NOT is_orphan_order AND rate_status = 'quoted'")
    assert contracts.no_orphan_lines(good).count() == 0 and contracts.rate_is_known(good).count() == 0
