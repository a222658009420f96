"""Each rule of the run-event observer fires on what it should and on nothing else."""

from __future__ import annotations

import pytest

from ledgerloom import schemas
from ledgerloom.operators import observer


def events(spark, *rows):
    full = [{name: row.get(name) for name in schemas.RUN_EVENT.names} for row in rows]
    return spark.createDataFrame(full, schemas.RUN_EVENT)


def judge(spark, **row):
    got = observer.classify(events(spark, {"run": 1, "seq": 1, **row})).first()
    return None if got["tag"] is None else (got["tag"], got["why"])


def test_loss_is_reported_with_its_count(spark):
    assert judge(spark, kind="dropped", dropped=7) == ("DROPPED", "events lost: 7")
    assert judge(spark, kind="dropped") == ("DROPPED", "events lost: 0")


@pytest.mark.parametrize("status", [*schemas.JOB_STATUS_FINE, "", None])
def test_fine_job_status_is_silent(spark, status):
    assert judge(spark, kind="job", status=status, job_type="Nightly") is None


@pytest.mark.parametrize("status", ["Failed", "Cancelled", "Deduped"])
def test_other_job_status_is_a_finding(spark, status):
    assert judge(spark, kind="job", status=status, job_type="N", failure_reason="x") == (
        "JOB", f"N -> {status} x",
    )


def test_job_text_is_trimmed_and_defaults_its_type(spark):
    assert judge(spark, kind="job", status="Failed") == ("JOB", "? -> Failed")


def test_activity_error_outranks_status_and_retry(spark):
    row = {"kind": "activity", "activity": "copy", "status": "Failed", "retry": 2}
    assert judge(spark, **row, error="boom") == ("ACTIVITY", "copy: boom")
    assert judge(spark, **row) == ("ACTIVITY", "copy: Failed")


def test_retry_only_when_set(spark):
    row = {"kind": "activity", "activity": "copy", "status": "Succeeded", "error": ""}
    assert judge(spark, **row, retry=2) == ("RETRY", "copy: attempt 2")
    assert judge(spark, **row, retry=0) is None
    assert judge(spark, **row) is None


@pytest.mark.parametrize("producer", schemas.PRODUCERS_OBSERVED + schemas.PRODUCERS_CLAIMED)
def test_known_producers_are_silent(spark, producer):
    assert judge(spark, kind="lineage", producer=producer) is None


@pytest.mark.parametrize("producer", ["Mystery", "", None])
def test_unknown_producer_is_a_finding(spark, producer):
    assert judge(spark, kind="lineage", producer=producer)[0] == "LINEAGE"


@pytest.mark.parametrize("kind", ["table", None, "?"])
def test_other_kinds_are_silent(spark, kind):
    assert judge(spark, kind=kind, status="Failed", error="x", retry=1, producer="m") is None


def test_vocabularies_are_disjoint():
    assert not set(schemas.PRODUCERS_OBSERVED) & set(schemas.PRODUCERS_CLAIMED)


def test_run_summary_flags(spark):
    log = events(
        spark,
        {"run": 1, "kind": "lineage", "producer": "Reported"},
        {"run": 1, "kind": "lineage", "producer": "Mystery"},
        {"run": 2, "kind": "lineage", "producer": "Copy"},
        {"run": 2, "kind": "lineage", "producer": "Reported"},
        {"run": 3, "kind": "job", "status": "Completed"},
        {"run": 4, "kind": "lineage"},
        {"run": 4, "kind": "dropped", "dropped": 3},
    )
    rows = {r["run"]: r for r in observer.run_summary(log).collect()}
    assert [rows[i]["all_claimed"] for i in (1, 2, 3, 4)] == [True, False, False, True]
    assert (rows[1]["claimed"], rows[1]["unknown"]) == (1, 1)
    assert rows[4]["incomplete"] and rows[4]["events_lost"] == 3 and rows[4]["claimed"] == 0
    assert not rows[2]["incomplete"]


def test_run_level_finding_is_shown_however_long_the_list(spark):
    rows = [{"run": 1, "seq": i, "kind": "job", "status": "Failed"} for i in range(80)]
    log = events(spark, *rows, {"run": 1, "seq": 99, "kind": "lineage", "producer": "Reported"})
    shown = observer.top_findings(observer.findings(log)).collect()
    assert len(shown) == 61
    assert shown[0]["tag"] == "TOTAL" and shown[0]["why"] == "81"
    assert shown[1]["tag"] == observer.GRAPH


def test_no_findings_leave_only_the_total(spark):
    log = events(spark, {"run": 1, "seq": 1, "kind": "table"})
    shown = observer.top_findings(observer.findings(log)).collect()
    assert [(r["tag"], r["why"]) for r in shown] == [("TOTAL", "0")]


def test_missing_kind_counts_under_the_default(spark):
    log = events(spark, {"run": 1}, {"run": 1, "kind": "job"}, {"run": 1})
    got = [(r["kind"], r["n"]) for r in observer.most_frequent(
        observer.kind_counts(log), "kind").collect()]
    assert got == [("?", 2), ("job", 1)]
