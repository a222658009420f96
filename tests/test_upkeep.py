"""The maintained summary against a full rebuild."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from ledgerloom.operators import upkeep
from ledgerloom.operators.star import revenue_summary
from ledgerloom.session import new_folder
from ledgerloom.sources import landing, sinks

SCHEMA = ("channel string, order_key bigint, order_date date, department string, product_segment string, "
          "customer_segment string, country string, units bigint, usd decimal(38,4), is_cancelled boolean, rate_status string")


def line(rng, order):
    day = None if order % 11 == 0 else dt.date(2019 + order % 4, 1 + order % 12, 15)
    return (rng.choice(["store", "web"]), order, day, "D1", rng.choice(["S1", "S2"]), "C1", rng.choice(["N1", "N2"]), rng.randint(1, 9),
            rng.choice([None, Decimal(rng.randint(1, 10**6)) / 100]), rng.random() < 0.2, rng.choice(["quoted", "carried", "missing"]))


def rows(frame):
    return sorted((tuple(r) for r in frame.select(*upkeep.SUMMARY.names).collect()), key=str)


def builds(spark, folder, state):
    held = spark.read.parquet(f"{folder}/states/state={state}").collect()
    return {r.fiscal_year: r.build for r in held}


def test_deliveries_give_what_a_rebuild_gives(spark):
    rng = random.Random(4)
    truth = {}
    for _ in range(400):
        order = rng.randrange(80)
        made = line(rng, order)
        truth.setdefault((made[0], order), []).append(made)
    frame = lambda lines: spark.createDataFrame([x for ls in lines.values() for x in ls], SCHEMA)
    folder = new_folder(spark, "t-upkeep")
    table = upkeep.MaintainedSummary(spark, folder)
    assert table.read().count() == 0
    table.rebuild(frame(truth))
    assert rows(table.read()) == rows(revenue_summary(frame(truth)))
    for step in range(3):
        # Orders corrected, orders that vanish, orders that are new; a few more each time.
        chosen = [k for k in truth if k[1] % 20 == step]
        after = {k: [line(rng, k[1])[1:] for _ in range(2)] for k in chosen[1:]} | {("web", 1000 + step): [line(rng, 1000 + step)[1:]]}
        after = {k: [(k[0], *x) for x in ls] for k, ls in after.items()}
        before = {k: truth[k] for k in chosen}
        # Opened anew each time: what holds is told by the folder alone.
        upkeep.MaintainedSummary(spark, folder).apply(frame(before), frame(after))
        for k in chosen:
            del truth[k]
        truth |= after
        assert rows(upkeep.MaintainedSummary(spark, folder).read()) == rows(revenue_summary(frame(truth)))


def test_untouched_years_are_not_rewritten(spark):
    rng = random.Random(5)
    lines = [line(rng, order) for order in range(100)]
    folder = new_folder(spark, "t-upkeep")
    table = upkeep.MaintainedSummary(spark, folder)
    table.rebuild(spark.createDataFrame(lines, SCHEMA))
    years = builds(spark, folder, 0)
    late = [("web", 5000, dt.date(2021, 6, 1), "D1", "S1", "C1", "N1", 2, Decimal(5), False, "quoted")]
    change = table.apply(spark.createDataFrame([], SCHEMA), spark.createDataFrame(late, SCHEMA))
    assert [(r.fiscal_year, r.sale_lines, r.units) for r in change.collect()] == [("FY2022", 1, 2)]
    assert builds(spark, folder, 1) == {y: int(y == "FY2022") for y in years}
    written = spark.read.parquet(f"{folder}/rows/build=1").select("fiscal_year").distinct().collect()
    assert [r.fiscal_year for r in written] == ["FY2022"]


def test_a_delivery_that_changes_nothing(spark):
    rng = random.Random(6)
    lines = spark.createDataFrame([line(rng, order) for order in range(30)], SCHEMA)
    table = upkeep.MaintainedSummary(spark, new_folder(spark, "t-upkeep"))
    table.rebuild(lines)
    told = rows(table.read())
    assert table.apply(lines, lines).count() == 0
    assert rows(table.read()) == told
    assert upkeep.superseded(lines, lines.where("order_key = 7")).count() == 1


def test_the_manifest_tells_what_was_sent(spark):
    folder = new_folder(spark, "t-manifest")
    for name, n in (("a", 7), ("b", 0)):
        sinks.write_with_manifest(spark.range(n), f"{folder}/{name}", name, f"{folder}/manifest")
    told = {r.table_name: r.n_rows for r in spark.read.schema(sinks.MANIFEST).parquet(f"{folder}/manifest").collect()}
    assert told == {"a": 7, "b": 0}
    assert landing.read_master(spark, f"{folder}/a", spark.range(1).schema).count() == 7
