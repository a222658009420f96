"""Queries on the run-event log, in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import fixtures, schemas
from ledgerloom.fixtures import Tables
from ledgerloom.operators import compare, observer
from ledgerloom.plans import sql
from ledgerloom.plans.registry import query

CLASSIFIED = sql.using(sql.RUN_EVENTS, sql.FINDINGS)


@query("flt_03_event_rules", CLASSIFIED + "SELECT run, seq, kind, tag, why FROM classified")
def event_rules(t: Tables) -> DataFrame:
    return observer.classify(fixtures.run_events(t)).select("run", "seq", "kind", "tag", "why")


@query(
    "scl_10_message_format",
    CLASSIFIED + "SELECT tag, why, count(*) AS n FROM classified WHERE tag IS NOT NULL GROUP BY ALL",
)
def message_format(t: Tables) -> DataFrame:
    found = observer.classify(fixtures.run_events(t)).filter(F.col("tag").isNotNull())
    return found.groupBy("tag", "why").agg(F.count("*").alias("n"))


@query(
    "agg_07_kind_counts",
    sql.using(sql.RUN_EVENTS)
    + """SELECT coalesce(CASE WHEN kind <> 'table' THEN kind END, '?') AS kind, count(*) AS n
FROM run_events GROUP BY 1""",
)
def kind_counts(t: Tables) -> DataFrame:
    """Events per kind; the ``table`` kind is blanked so that the default label is used."""
    blanked = F.when(F.col("kind") != "table", F.col("kind"))
    return observer.kind_counts(fixtures.run_events(t).withColumn("kind", blanked))


PRODUCER_SQL = """
SELECT coalesce(producer, '') AS producer, count(*) AS n,
       CASE WHEN producer IN ('Copy', 'NotebookObserved', 'Warehouse', 'DirectLake') THEN 'observed'
            WHEN producer IN ('Notebook', 'Reported') THEN 'claimed' ELSE 'unknown' END AS standing
FROM run_events WHERE kind = 'lineage' GROUP BY ALL"""


@query("agg_08_producer_counts", sql.using(sql.RUN_EVENTS) + PRODUCER_SQL)
def producer_counts(t: Tables) -> DataFrame:
    return observer.producer_counts(fixtures.run_events(t))


OBSERVED = "producer IN ('Copy', 'NotebookObserved', 'Warehouse', 'DirectLake')"
CLAIMED = "producer IN ('Notebook', 'Reported')"
RUN_SUMMARY = f"""run_summary AS (
  SELECT run, count(*) AS events,
         count(*) FILTER (WHERE kind = 'lineage' AND {OBSERVED}) AS observed,
         count(*) FILTER (WHERE kind = 'lineage' AND {CLAIMED}) AS claimed,
         count(*) FILTER (WHERE kind = 'lineage' AND (producer IS NULL OR producer = 'Mystery'))
           AS unknown,
         count(*) FILTER (WHERE kind = 'dropped') AS loss_signals,
         CAST(coalesce(sum(dropped), 0) AS BIGINT) AS events_lost
  FROM picked GROUP BY run
)"""
RUN_SUMMARY_SQL = """
SELECT *, observed = 0 AND claimed + unknown > 0 AS all_claimed, loss_signals > 0 AS incomplete
FROM run_summary"""

# One run whose witnessed edges are reported as claims, so that the run-level rule has something
# to say.
PICKED = f"""picked AS (
  SELECT * REPLACE (CASE WHEN run = 3 AND {OBSERVED} THEN 'Reported' ELSE producer END AS producer)
  FROM run_events
)"""


def events_with_a_claimed_run(t: Tables) -> DataFrame:
    witnessed = (F.col("run") == 3) & F.col("producer").isin(schemas.PRODUCERS_OBSERVED)
    claimed = F.when(witnessed, schemas.PRODUCERS_CLAIMED[1]).otherwise(F.col("producer"))
    return fixtures.run_events(t).withColumn("producer", claimed)


@query(
    "agg_09_evidence_vs_claim",
    sql.using(sql.RUN_EVENTS, PICKED, RUN_SUMMARY) + RUN_SUMMARY_SQL,
)
def evidence_vs_claim(t: Tables) -> DataFrame:
    return observer.run_summary(events_with_a_claimed_run(t))


@query(
    "srt_02_order_by_count_desc",
    sql.using(sql.RUN_EVENTS)
    + "SELECT kind, count(*) AS n FROM run_events GROUP BY kind ORDER BY n DESC, kind",
)
def order_by_count_desc(t: Tables) -> DataFrame:
    return observer.most_frequent(observer.kind_counts(fixtures.run_events(t)), "kind")


@query(
    "srt_02_producers_by_count",
    sql.using(sql.RUN_EVENTS) + PRODUCER_SQL + " ORDER BY n DESC, producer",
)
def producers_by_count(t: Tables) -> DataFrame:
    return observer.most_frequent(observer.producer_counts(fixtures.run_events(t)), "producer")


FOUND = sql.using(
    sql.RUN_EVENTS, PICKED, RUN_SUMMARY, sql.FINDINGS.replace("FROM run_events", "FROM picked")
) + """
, found AS (
  SELECT run, seq, tag, why FROM classified WHERE tag IS NOT NULL
  UNION ALL
  SELECT run, NULL, 'GRAPH', 'no edge of this run was witnessed' FROM run_summary
  WHERE observed = 0 AND claimed + unknown > 0
)"""


@query("set_02_union_findings", FOUND + "SELECT run, seq, tag, why FROM found")
def union_findings(t: Tables) -> DataFrame:
    return observer.findings(events_with_a_claimed_run(t))


@query(
    "lim_01_top_findings",
    FOUND + """
SELECT -1 AS rank, NULL AS run, NULL AS seq, 'TOTAL' AS tag, CAST(count(*) AS VARCHAR) AS why
FROM found
UNION ALL
SELECT * FROM (
  SELECT CASE tag WHEN 'GRAPH' THEN 0 WHEN 'DROPPED' THEN 1 ELSE 2 END AS rank, run, seq, tag, why
  FROM found ORDER BY rank, seq NULLS FIRST, run LIMIT 60)""",
)
def top_findings(t: Tables) -> DataFrame:
    """Sixty findings to show and the number of all of them."""
    return observer.top_findings(observer.findings(events_with_a_claimed_run(t)))


@query(
    "set_03_set_difference",
    sql.using(sql.RUN_EVENTS) + """
SELECT producer, side FROM (
  (SELECT DISTINCT coalesce(producer, '') AS producer, 'left' AS side
   FROM run_events WHERE kind = 'lineage')
) WHERE producer IN ('', 'Mystery')
UNION ALL SELECT 'Export', 'right'""",
)
def set_difference(t: Tables) -> DataFrame:
    """Producers seen in the log against a vocabulary that also lists one never seen."""
    seen = observer.producer_counts(fixtures.run_events(t)).select("producer")
    names = schemas.PRODUCERS_OBSERVED + schemas.PRODUCERS_CLAIMED + ["Export"]
    known = t.spark.createDataFrame([(n,) for n in names], "producer string")
    return compare.missing_each_way(seen, known)


@query(
    "set_04_set_intersection",
    f"""WITH k AS (SELECT user_id, {sql.K} % 8 AS p FROM events WHERE event_type = 'view')
SELECT DISTINCT user_id FROM k WHERE p < 4 INTERSECT SELECT user_id FROM k WHERE p IN (4, 5)""",
)
def set_intersection(t: Tables) -> DataFrame:
    """Shoppers whose views left both witnessed and claimed edges."""
    views = t.events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("seq"), "user_id"
    )
    edges = fixtures.run_events(t).filter(F.col("kind") == "lineage").join(views, "seq")
    kind = observer.standing(F.col("producer"))
    return compare.in_both(
        edges.filter(kind == "observed").select("user_id"),
        edges.filter(kind == "claimed").select("user_id"),
    )
