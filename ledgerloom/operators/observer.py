"""Findings in a run-event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.schemas import (
    FINDINGS_SHOWN,
    JOB_STATUS_FINE,
    PRODUCERS_CLAIMED,
    PRODUCERS_OBSERVED,
    STATUS_FAILED,
)

GRAPH = "GRAPH"


def _listed(names: list[str]) -> str:
    return ", ".join(f"'{name}'" for name in names)


# The first rule that fires wins. Empty text counts as missing, a retry of 0 as none.
_TAG = f"""
CASE WHEN kind = 'dropped' THEN 'DROPPED'
     WHEN kind = 'job' AND nullif(status, '') NOT IN ({_listed(JOB_STATUS_FINE)}) THEN 'JOB'
     WHEN kind = 'activity' AND (nullif(error, '') IS NOT NULL OR status = '{STATUS_FAILED}')
       THEN 'ACTIVITY'
     WHEN kind = 'activity' AND coalesce(retry, 0) <> 0 THEN 'RETRY'
     WHEN kind = 'lineage' AND coalesce(producer, '')
       NOT IN ({_listed(PRODUCERS_OBSERVED + PRODUCERS_CLAIMED)}) THEN 'LINEAGE'
END"""
_WHY = """
CASE tag
  WHEN 'DROPPED' THEN concat('events lost: ', coalesce(dropped, 0))
  WHEN 'JOB' THEN trim(concat(coalesce(job_type, '?'), ' -> ', status, ' ',
                              coalesce(failure_reason, '')))
  WHEN 'ACTIVITY' THEN concat(coalesce(activity, '?'), ': ', coalesce(nullif(error, ''), status))
  WHEN 'RETRY' THEN concat(coalesce(activity, '?'), ': attempt ', retry)
  WHEN 'LINEAGE' THEN concat('producer not known: ', coalesce(producer, ''))
END"""


def classify(events: DataFrame) -> DataFrame:
    """All events with ``tag`` and ``why``, null where nothing is remarkable."""
    return events.withColumn("tag", F.expr(_TAG)).withColumn("why", F.expr(_WHY))


def kind_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(F.coalesce("kind", F.lit("?")).alias("kind")).agg(
        F.count("*").alias("n")
    )


def producer_counts(events: DataFrame) -> DataFrame:
    producer = F.coalesce("producer", F.lit(""))
    return (
        events.filter(F.col("kind") == "lineage")
        .groupBy(producer.alias("producer"))
        .agg(F.count("*").alias("n"))
        .withColumn("standing", standing(F.col("producer")))
    )


def standing(producer: Column) -> Column:
    return (
        F.when(producer.isin(PRODUCERS_OBSERVED), "observed")
        .when(producer.isin(PRODUCERS_CLAIMED), "claimed")
        .otherwise("unknown")
    )


def most_frequent(counts: DataFrame, name: str) -> DataFrame:
    return counts.orderBy(F.desc("n"), name)


def run_summary(events: DataFrame) -> DataFrame:
    """Per run: evidence against claims, and whether the record itself is whole."""
    is_edge = F.col("kind") == "lineage"
    kind_of = standing(F.coalesce("producer", F.lit("")))

    def edges(which: str) -> Column:
        return F.count_if(is_edge & (kind_of == which))

    lost = F.when(F.col("kind") == "dropped", F.coalesce("dropped", F.lit(0)))
    return (
        events.groupBy("run")
        .agg(
            F.count("*").alias("events"),
            edges("observed").alias("observed"),
            edges("claimed").alias("claimed"),
            edges("unknown").alias("unknown"),
            F.count_if(F.col("kind") == "dropped").alias("loss_signals"),
            F.coalesce(F.sum(lost), F.lit(0)).alias("events_lost"),
        )
        .withColumns(
            {
                "all_claimed": (F.col("observed") == 0)
                & (F.col("claimed") + F.col("unknown") > 0),
                "incomplete": F.col("loss_signals") > 0,
            }
        )
    )


def findings(events: DataFrame) -> DataFrame:
    """Event findings and, per run, the judgement no single event can make."""
    of_events = (
        classify(events).filter(F.col("tag").isNotNull()).select("run", "seq", "tag", "why")
    )
    of_runs = (
        run_summary(events)
        .filter("all_claimed")
        .select(
            "run", F.lit(None).cast("bigint").alias("seq"), F.lit(GRAPH).alias("tag"),
            F.lit("no edge of this run was witnessed").alias("why"),
        )
    )
    return of_events.unionByName(of_runs)


def top_findings(found: DataFrame, shown: int = FINDINGS_SHOWN) -> DataFrame:
    """The first findings to look at and one row with the number of all of them.

    Run-level findings come first, so a long list of events cannot push them out.
    """
    rank = F.when(F.col("tag") == GRAPH, 0).when(F.col("tag") == "DROPPED", 1).otherwise(2)
    head = (
        found.withColumn("rank", rank)
        .orderBy("rank", "seq", "run")
        .limit(shown)
        .select("rank", "run", "seq", "tag", "why")
    )
    count = found.agg(F.count("*").alias("n")).select(
        F.lit(-1).alias("rank"),
        F.lit(None).cast("bigint").alias("run"),
        F.lit(None).cast("bigint").alias("seq"),
        F.lit("TOTAL").alias("tag"),
        F.col("n").cast("string").alias("why"),
    )
    return count.unionByName(head)
