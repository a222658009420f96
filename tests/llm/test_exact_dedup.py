from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import oracle
from ledgerloom.llm import exact_dedup as ed
from ledgerloom.llm.common import ORACLES, QUERIES, new_folder


def weak_digest():
    """A digest of four values, so that different texts collide (local, to travel by value)."""

    class Weak:
        def __init__(self, data: bytes):
            self.data = data

        def hexdigest(self) -> str:
            return str(len(self.data) % 4)

    return Weak


ROWS = [
    (1, "Same text", "a"), (7, "same TEXT", "b"), (3, "other", "c"), (4, None, "d"), (5, "", "e"),
    (6, "ÉTÉ", "f"), (2, "été", "g"), (9, "four", "h"), (9, "four", "i"), (None, "OTHER", "j"), (8, "five", "k"),
]
SCHEMA = "doc_id bigint, text string, digest string"


def told(rows):
    groups: dict[str, list] = {}
    for i, text, _ in rows:
        groups.setdefault("".join(c.lower() if c.isascii() else c for c in text or ""), []).append(i)
    return sorted((str(i), max((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g)


def test_query_equals_sql(spark, small_folder):
    problems, _ = oracle.compare(
        spark, oracle.connect(small_folder), QUERIES["op4_exact_dedup"], ORACLES["op4_exact_dedup"], small_folder)
    assert not problems


def test_groups_and_collisions(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for digest in (hashlib.sha256, weak_digest()):
        got = ed.decisions(docs, digest).collect()
        assert sorted((str(r.doc_id), r.keep_id, r.group_size) for r in got) == told(ROWS)
        kept = [r for r in got if r.kept]
        assert len(kept) == len({r.keep_id for r in got}) and all(r.doc_id == r.keep_id for r in kept)
        whole = ed.deduplicate(docs, digest)
        assert whole.columns == docs.columns
        assert sorted(r.doc_id for r in whole.collect()) == [2, 3, 5, 6, 7, 8, 9]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert ed.decisions(docs).count() == 0
    assert ed.deduplicate(docs).columns == docs.columns


def test_state_goes_on_in_a_later_run(spark):
    log, state, checkpoint = (new_folder(spark, n) for n in ("log", "state", "checkpoint"))
    rows = spark.createDataFrame([(1, "x", "f", 0), (2, "y", "f", 1)], ed.LOG_SCHEMA)
    rows.write.mode("append").parquet(log)
    first = {r.digest: (r.best.doc_id, r.group_size) for r in ed.run_state(spark, log, state, checkpoint).collect()}
    spark.createDataFrame([(5, "x", "g", 0), (0, "y", "g", 1), (3, "z", "g", 2)], ed.LOG_SCHEMA).write.mode("append").parquet(log)
    then = {r.digest: (r.best.doc_id, r.group_size) for r in ed.run_state(spark, log, state, checkpoint).collect()}
    assert first == {"x": (1, 1), "y": (2, 1)}
    assert then == {"x": (5, 2), "y": (2, 2), "z": (3, 1)}


@pytest.fixture
def scan(spark):
    """A file scan with odd texts, and columns that bear the names of the locator and of results."""
    folder = new_folder(spark, "scan")
    long = "Long text. " * 200_000
    rows = [(1, None, "a", 1, True), (2, "", "b", 2, False), (3, long, "c", 3, None), (4, long.upper(), None, 4, True), (5, "one", "e", None, True)]
    spark.createDataFrame(rows, "doc_id bigint, text string, file string, row int, kept boolean").repartition(3).write.parquet(folder)
    return spark.read.parquet(folder)


def test_a_scan_keeps_null_empty_and_long_texts_and_all_columns(scan):
    kept = ed.deduplicate(scan)
    assert kept.columns == scan.columns
    assert sorted(((r.doc_id, r.file, r.row, r.kept) for r in kept.collect())) == [(2, "b", 2, False), (4, None, 4, True), (5, "e", None, True)]


def test_a_fanned_out_scan_has_a_locator_for_each_row(spark, scan):
    three = scan.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    for docs in (three, scan.drop("file").unionByName(scan.drop("file")), scan.join(spark.range(2))):
        kept = ed.deduplicate(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5]
    sizes = {r.doc_id: r.group_size for r in ed.decisions(three).collect()}
    assert sizes == {1: 6, 2: 6, 3: 6, 4: 6, 5: 3}


def test_filtered_and_projected_scans(scan):
    kept = ed.deduplicate(scan.where("doc_id != 4").withColumn("text", F.upper("text")))
    assert sorted((r.doc_id, r.text[:3]) for r in kept.collect()) == [(2, ""), (3, "LON"), (5, "ONE")]


def test_sql_keeps_one_of_equal_rows(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (1, "x"), (2, "X"), (3, None), (None, ""), (5, "y"), (5, "y"), (None, "z")],
                          "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    name = "op4_exact_dedup"
    problems, rows = oracle.compare(spark, oracle.connect(str(tmp_path)), QUERIES[name], ORACLES[name], str(tmp_path))
    assert not problems and rows == 8
