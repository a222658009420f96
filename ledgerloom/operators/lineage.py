"""Lineage edges from precise moves, and walks over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.observer import standing
from ledgerloom.session import cut, cut_by


def edges(moves: DataFrame) -> DataFrame:
    """Reads x writes of each move and of nothing wider than a move."""
    return (
        moves.select("producer", F.explode("reads").alias("src"), "writes")
        .select("src", F.explode("writes").alias("dst"), "producer")
        .distinct()
    )


def phantom_counts(moves: DataFrame) -> DataFrame:
    """Per step and target: the edges a flat read list would claim and no move holds.

    Counted from degrees (readers of the step less real readers of the target), so the flat
    product itself is never built.
    """
    pairs = moves.select("step", F.explode("reads").alias("src"), "writes").select(
        "step", "src", F.explode("writes").alias("dst")
    )
    step_readers = pairs.groupBy("step").agg(F.count_distinct("src").alias("flat_edges"))
    real = pairs.distinct().groupBy("step", "dst").agg(F.count("*").alias("real_edges"))
    return real.join(step_readers, "step").withColumn(
        "phantom_edges", F.col("flat_edges") - F.col("real_edges")
    )


def phantom_edges(moves: DataFrame, targets: Sequence[str]) -> DataFrame:
    """The phantom edges into some targets by name; ``phantom_counts`` answers for all.

    Each reader of a step meets the given targets of its step, and no others.
    """
    pairs = moves.select("step", F.explode("reads").alias("src"), "writes")
    written = pairs.select("step", F.explode("writes").alias("dst")).filter(F.col("dst").isin(*targets))
    of_step = written.groupBy("step").agg(F.collect_set("dst").alias("asked"))
    flat = pairs.select("step", "src").distinct().join(of_step, "step").select(
        "src", F.explode("asked").alias("dst")
    )
    return flat.distinct().subtract(edges(moves).select("src", "dst"))


def ancestors(links: DataFrame, start: DataFrame) -> DataFrame:
    """Every node upstream of the start nodes with its shortest distance, however deep.

    One equi-join per level; a node is visited once, so cycles end. Each level is cut into the shared
    folder, so neither the plan nor the recovery work after a lost executor grows with depth. The
    edges are dealt out by target once, so that each level moves its frontier alone.
    """
    up = cut_by(links.select("src", "dst").distinct(), "dst")
    seen = cut(start.select("node").distinct().withColumn("depth", F.lit(0)))
    frontier, depth = seen, 0
    while True:
        depth += 1
        reached = (
            up.join(frontier.select(F.col("node").alias("dst")), "dst")
            .select(F.col("src").alias("node"))
            .distinct()
        )
        frontier = cut(
            reached.join(seen.select("node"), "node", "left_anti").withColumn(
                "depth", F.lit(depth)
            )
        )
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
        if depth % 5 == 0:
            seen = cut(seen)


def all_ancestors(links: DataFrame) -> DataFrame:
    """``node, ancestor, depth``: every pair of different nodes that a path connects, with its shortest length.

    Paths double: what is ``reach`` edges away exactly continues with every pair known so far, of ``reach`` edges
    or fewer, so a depth of a thousand takes ten rounds, for all nodes at once. A round forms only pairs that are
    farther apart than those before, and cycles end because a pair is known once. The result is as large as the
    number of such pairs; a walk from a few nodes is ``ancestors``.
    """
    edges = links.select(F.col("dst").alias("node"), F.col("src").alias("ancestor")).filter("node <> ancestor").distinct()
    known, reach = cut(edges.withColumn("depth", F.lit(1))), 1
    while True:
        far = known.filter(F.col("depth") == reach).select("node", F.col("ancestor").alias("via"))
        further = known.select(F.col("node").alias("via"), "ancestor", (F.col("depth") + reach).alias("depth"))
        found = (
            far.join(further, "via").filter("node <> ancestor")
            .groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))
            .join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti")
        )
        found = cut(found)
        if found.isEmpty():
            return known
        known, reach = cut(known.unionByName(found)), 2 * reach


def orphans(sources: DataFrame, links: DataFrame) -> DataFrame:
    """Declared source nodes that feed nothing."""
    return sources.join(links.select(F.col("src").alias("node")), "node", "left_anti")


def foreign_roots(sources: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes that nothing feeds and that are no declared source."""
    roots = links.select(F.col("src").alias("node")).distinct().join(
        links.select(F.col("dst").alias("node")), "node", "left_anti"
    )
    return roots.join(sources, "node", "left_anti")


def evidence_by_target(links: DataFrame) -> DataFrame:
    """Witnessed and claimed edges into each node."""
    kind = standing(F.col("producer"))
    return links.groupBy("dst").agg(
        F.count_if(kind == "observed").alias("observed"),
        F.count_if(kind == "claimed").alias("claimed"),
        F.count_if(kind == "unknown").alias("unknown"),
    )
