from __future__ import annotations

import datetime as dt
import json
import random

import pytest

from ledgerloom.operators import cdc
from ledgerloom.session import new_folder
from ledgerloom.streaming import cdc_stream

START = dt.datetime(2024, 1, 1)


def flat(spark, rows):
    """rows: (key, lsn, op)."""
    full = [
        (key, lsn, START + dt.timedelta(seconds=lsn), op, None, op + str(lsn), lsn)
        for key, lsn, op in rows
    ]
    return spark.createDataFrame(full, cdc_stream.FLAT)


def live(frame):
    return sorted((r["key"], r["lsn"]) for r in frame.collect())


def test_delete_removes_and_recreate_restores(spark):
    rows = [(1, 1, "c"), (1, 2, "d"), (2, 3, "c"), (2, 4, "d"), (2, 5, "c"), (3, 6, "r")]
    assert live(cdc.current_state(flat(spark, rows))) == [(2, 5), (3, 6)]


def test_arrival_order_does_not_matter(spark):
    rows = [(k, lsn, "u") for lsn, k in enumerate([1, 2, 1, 1, 2, 3])]
    shuffled = rows[::-1]
    assert live(cdc.current_state(flat(spark, shuffled))) == [(1, 3), (2, 4), (3, 5)]


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_history_is_the_same_for_every_run_length(spark, chunk):
    rng = random.Random(3)
    rows = [(1 if rng.random() < 0.7 else rng.randrange(5), lsn, rng.choice("cuud"))
            for lsn in range(60)]
    expected = []
    for key in range(5):
        own = [r for r in rows if r[0] == key]
        for here, following in zip(own, [*own[1:], None]):
            if here[2] != "d":
                end = None if following is None else START + dt.timedelta(seconds=following[1])
                expected.append((key, here[1], end, following is None))
    got = cdc.history(flat(spark, rows + rows[:10]), chunk).collect()
    assert sorted(((r["key"], r["lsn"], r["valid_to"], r["is_current"]) for r in got), key=str) \
        == sorted(expected, key=str)


def record(offset, key, value, partition=0):
    key = key if key is None or isinstance(key, str) else json.dumps({"user_id": key})
    value = value if value is None or isinstance(value, str) else json.dumps(value)
    return {"topic": "t", "topic_partition": partition, "topic_offset": offset, "key": key, "value": value}


def envelope(lsn, op, after=None, before=None):
    return {"before": before, "after": after, "source": {"lsn": lsn}, "op": op, "ts_us": 1_704_067_200_000_000}


def read(spark, records):
    lines = [(x if isinstance(x, str) else json.dumps(x),) for x in records]
    return cdc.read_envelopes(cdc.read_records(spark.createDataFrame(lines, "value string")))


def test_good_broken_and_tombstone_are_told_apart_and_nothing_is_lost(spark):
    row = {"value": 1.5, "k": 3}
    records = [
        record(0, 1, envelope(2, "c", row)),
        record(1, 2, {"schema": {"type": "struct"}, "payload": envelope(3, "u", row)}),
        record(2, "7", envelope(4, "d")), record(3, 7, None),
        record(4, 1, '{"op": '), record(5, 1, envelope(None, "u", row)), record(6, None, envelope(5, "u", row)),
        record(7, 1, envelope(6, "x", row)), record(8, 1, envelope(7, "u")), '{"topic": "t", "top', "noise",
    ]
    envelopes = read(spark, records).cache()
    kinds = {r["kind"]: r["count"] for r in envelopes.groupBy("kind").count().collect()}
    assert kinds == {"good": 3, "tombstone": 1, "broken": 7} and sum(kinds.values()) == len(records)
    good = sorted((r["topic_offset"], r["key"], r["lsn"], r["k"]) for r in cdc.unwrap(envelopes, origin=True).collect())
    assert good == [(0, 1, 2, 3), (1, 2, 3, 3), (2, 7, 4, None)]
    assert cdc.unwrap(envelopes).first()["ts"] == START
    assert [r["key"] for r in cdc.tombstones(envelopes).collect()] == [7]
    assert {r["value"] for r in cdc.broken(envelopes).collect()} >= {'{"op": ', "noise", '{"topic": "t", "top'}


def test_delete_takes_the_row_before(spark):
    frame = read(spark, [record(0, 1, envelope(2, "d", before={"value": 1.5, "k": 3}))])
    assert cdc.unwrap(frame).first()["k"] == 3


def test_completeness_names_the_short_and_the_broken_partition(spark):
    seen = spark.createDataFrame(
        [(0, 1, "good"), (0, 5, "tombstone"), (1, 2, "good"), (3, 1, "broken")],
        "topic_partition int, topic_offset bigint, kind string",
    )
    told = spark.createDataFrame(
        [(0, 2, 5), (1, 2, 3), (2, 1, 4), (3, 1, 1)],
        "topic_partition int, expected_events bigint, expected_last bigint",
    )
    got = {r["topic_partition"]: r["complete"] for r in cdc.completeness(seen, told).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False}


def test_stream_lands_broken_records_in_quarantine(spark):
    landed = new_folder(spark, "t-records")
    rows = [record(n, n, envelope(n, "c", {"k": n}) if n % 3 else "{cut", n % 2) for n in range(9)]
    spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").repartition(3).write.text(landed)
    good, bad = cdc_stream.land_changes(
        cdc_stream.envelope_source(spark, landed, files_per_batch=1),
        *[new_folder(spark, f"t-{n}") for n in ("good", "bad", "check")])
    assert sorted(r["topic_offset"] for r in good.collect()) == [1, 2, 4, 5, 7, 8]
    assert sorted((r["topic_offset"], r["value"]) for r in bad.collect()) == [(0, "{cut"), (3, "{cut"), (6, "{cut")]


BATCHES = [
    [(1, 1, "c"), (2, 2, "c"), (3, 3, "c")],
    [(1, 6, "u"), (2, 7, "d")],
    [(1, 5, "u"), (2, 4, "u")],  # older than what is stored
    [(2, 9, "c"), (3, 8, "d"), (4, 10, "c")],
    [(5, 11, "u")],
]
AFTER_ALL = [(1, 6), (2, 9), (4, 10), (5, 11)]


@pytest.mark.parametrize("compact_every", [1, 2, 3, 50])
def test_state_table_ignores_replays_and_late_changes(spark, compact_every):
    table = cdc_stream.StateTable(spark, new_folder(spark, "t-state"), compact_every)
    for number, rows in enumerate(BATCHES):
        table.apply(flat(spark, rows), number)
        if number in (1, 3):
            table.apply(flat(spark, rows), number)
        if number == 2:
            assert live(table.current()) == [(1, 6), (3, 3)]
    assert live(table.current()) == AFTER_ALL


def _land(spark, folder, batches, first):
    for number, rows in enumerate(batches, start=first):
        docs = [(json.dumps(record(n, k, envelope(n, op, {"k": n}))),) for k, n, op in rows]
        spark.createDataFrame(docs, "value string").coalesce(1).write.mode("append").text(folder)


@pytest.mark.parametrize("mode", ["table", "keyed"])
def test_stream_restarts_where_it_stopped(spark, mode):
    landed, state = new_folder(spark, "t-land"), new_folder(spark, "t-out")
    check = new_folder(spark, "t-check")

    def run():
        changes = cdc_stream.envelope_source(spark, landed, files_per_batch=1)
        if mode == "table":
            return cdc_stream.apply_changes(changes, state, check, compact_every=2).current()
        return cdc_stream.run_keyed_state(changes, check)

    _land(spark, landed, BATCHES[:2], 0)
    assert live(run()) == [(1, 6), (3, 3)]
    _land(spark, landed, BATCHES[2:], 2)
    assert live(run()) == AFTER_ALL
    assert live(run()) == AFTER_ALL


def test_keyed_state_is_read_from_the_store_alone(spark):
    landed, check = new_folder(spark, "t-land"), new_folder(spark, "t-check")
    _land(spark, landed, BATCHES, 0)
    changes = cdc_stream.envelope_source(spark, landed, files_per_batch=1)
    state = cdc_stream.run_keyed_state(changes, check)
    assert live(state) == AFTER_ALL
    # The only input is the checkpoint: no table of batches is written or read.
    assert not state.inputFiles() and "StateScan" in state._jdf.queryExecution().executedPlan().toString()
    before = cdc_stream.read_keyed_state(spark, check, 1).filter("op != 'd'")
    assert live(before) == [(1, 6), (3, 3)]


def test_keyed_state_of_a_stream_without_records(spark):
    landed, check = new_folder(spark, "t-land"), new_folder(spark, "t-check")
    spark.createDataFrame([], "value string").write.text(landed)
    state = cdc_stream.run_keyed_state(cdc_stream.envelope_source(spark, landed), check)
    assert state.count() == 0 and state.columns == ["key", "lsn", "ts", "op", "value", "event_type", "k"]


def test_a_record_is_parsed_once_whatever_reads_it(spark):
    records = spark.range(3).selectExpr(
        "'t' AS topic", "0 AS topic_partition", "id AS topic_offset", "CAST(id AS STRING) AS key",
        """concat('{"op": "d", "source": {"lsn": ', id, '}}') AS value""")
    flat = cdc.unwrap(cdc.read_envelopes(records))
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
    assert sorted((r.key, r.lsn, r.op) for r in flat.collect()) == [(0, 0, "d"), (1, 1, "d"), (2, 2, "d")]
