"""Queries on the lineage graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import fixtures
from ledgerloom.fixtures import Tables
from ledgerloom.operators import lineage
from ledgerloom.plans import sql
from ledgerloom.plans.registry import query


@query("lin_01_moves_to_edges", sql.using(sql.EDGES) + "SELECT src, dst, producer FROM edges")
def moves_to_edges(t: Tables) -> DataFrame:
    return lineage.edges(fixtures.moves(t))


@query(
    "lin_02_phantom_edges",
    sql.using(sql.EDGES) + """
, steps AS (SELECT split_part(src, ':', 1) AS step, src, dst FROM edges)
SELECT a.step, a.dst, count(*) FILTER (WHERE e.src IS NOT NULL) AS real_edges,
       count(*) AS flat_edges, count(*) FILTER (WHERE e.src IS NULL) AS phantom_edges
FROM (SELECT DISTINCT r.step, r.src, w.dst FROM steps r JOIN steps w ON r.step = w.step) a
LEFT JOIN steps e ON a.step = e.step AND a.src = e.src AND a.dst = e.dst
GROUP BY ALL""",
)
def phantom_edges(t: Tables) -> DataFrame:
    """Edges a flat report of each step would have claimed into each target."""
    return lineage.phantom_counts(fixtures.moves(t))


@query(
    "lin_03_upstream_walk",
    sql.using(sql.EDGES).replace("WITH ", "WITH RECURSIVE ", 1) + """
, walk(node, depth) AS (
  SELECT 'star:revenue', 0
  UNION
  SELECT e.src, w.depth + 1 FROM walk w JOIN edges e ON e.dst = w.node
)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY node""",
)
def upstream_walk(t: Tables) -> DataFrame:
    """Everything the star comes from, down to single customers and suppliers."""
    start = t.spark.createDataFrame([("star:revenue",)], "node string")
    return lineage.ancestors(lineage.edges(fixtures.moves(t)), start)


@query(
    "lin_03_all_ancestors",
    sql.using(sql.EDGES).replace("WITH ", "WITH RECURSIVE ", 1) + """
, walk(node, ancestor, depth) AS (
  SELECT dst, src, 1 FROM edges
  UNION
  SELECT w.node, e.src, w.depth + 1 FROM walk w JOIN edges e ON e.dst = w.ancestor
)
SELECT node, ancestor, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE node <> ancestor GROUP BY ALL""",
)
def all_ancestors(t: Tables) -> DataFrame:
    """Everything that any node comes from, paths doubled round by round."""
    return lineage.all_ancestors(lineage.edges(fixtures.moves(t)))


@query(
    "lin_04_orphan_nodes",
    """
SELECT 'part:' || p_partkey AS node, 'feeds_nothing' AS problem FROM part
UNION ALL SELECT 'supplier:' || s_suppkey, 'root_not_declared' FROM supplier""",
)
def orphan_nodes(t: Tables) -> DataFrame:
    """Declared sources that feed nothing, and roots left out of the declared sources."""
    edges = lineage.edges(fixtures.moves(t))
    sources = fixtures.source_nodes(t)
    told = sources.filter(~F.col("node").startswith("supplier:"))
    silent = lineage.orphans(sources, edges).withColumn("problem", F.lit("feeds_nothing"))
    foreign = lineage.foreign_roots(told, edges)
    return silent.unionByName(foreign.withColumn("problem", F.lit("root_not_declared")))


@query(
    "lin_05_evidence_split",
    sql.using(sql.EDGES) + """
SELECT dst, count(*) FILTER (WHERE producer <> 'Reported') AS observed,
       count(*) FILTER (WHERE producer = 'Reported') AS claimed, CAST(0 AS BIGINT) AS unknown
FROM edges GROUP BY dst""",
)
def evidence_split(t: Tables) -> DataFrame:
    return lineage.evidence_by_target(lineage.edges(fixtures.moves(t)))
