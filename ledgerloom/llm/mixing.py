"""Mixing sources to target weights by systematic sampling, with DataFrame operations only.

A source's expected copies per document are its target over its size. Documents of a source are put
in one order (size, then five hex digits of the id's SHA-256, then id); the running sum of expected
copies plus one offset per source is taken, and a document is emitted once for each integer that
its step crosses. Ordering by size keeps the taken words of a source within about one document of
the target.

The order is never sorted in one task: positions are sums of counts on four levels (size, two hash
digits, three hash digits, document), so a hot source, or a hot size within it, spreads over a million
cells. Targets fill up like water: sources in order of target cap over weight, one row per source.

Null text has size 0; a null source is a source of its own, last in order. Rows that are equal in
source, size and id take their copies in any order. A table without words gives targets and copies 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm.common import query, stored, table, word_count

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
_SALT = "mix"
CELL = ["_source", "_size", "_h1", "_h2"]


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``source``, ``source_size`` -> also ``target``: shares by weight, none above ``most`` x size.

    Sharing the excess by weight again and again ends where every uncapped source has
    ``weight * level``; the level comes from one running sum over the sources by cap per weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn(
        "_w", F.get(cycle, (F.row_number().over(order) - 1) % len(weights))
    ).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    )
    # The first source, in rising order, that its share doesn't fill sets the level for the rest.
    open_level = F.when(F.col("_cap") > F.col("_w") * F.col("_level"), F.col("_level"))
    return (
        weighed.withColumn("_level", level)
        .withColumn("_level", F.first(open_level, ignorenulls=True).over(rising))
        .withColumn("target", F.coalesce(F.least("_cap", F.col("_w") * F.col("_level")), "_cap"))
        .select("source", "source_size", "target")
    )


def _hex(text, start: int, digits: int):
    return F.conv(F.substring(F.sha2(text, 256), start, digits), 16, 10).cast("long")


def _before(counts: DataFrame, keys: list[str], within: list[str], by: str, name: str) -> DataFrame:
    w = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("_n").over(w), F.lit(0)))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS, seed: int = 0) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    made = ["size", "source_size", "target", "copies", "taken"]
    # Working columns begin with an underscore; such columns of the input are put by.
    held = {c: f"_held{c}" for c in docs.columns if c.startswith("_")}
    docs = docs.select(*[F.col(f"`{c}`").alias(held.get(c, c)) for c in docs.columns])
    named = {put: c for c, put in held.items()}
    rows = docs.drop(*made).withColumns({
        "_source": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")),
        "_size": word_count(F.col("text")),
        "_h1": _hex(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 1, 2),
        "_h2": _hex(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 3, 3),
    })
    # Texts are read twice: for these counts, which all coarser ones come from, and for the result.
    cells = stored(rows.groupBy(*CELL).agg(F.count("*").alias("_n")), "mixing-cells")
    by_h1 = cells.groupBy(*CELL[:3]).agg(F.sum("_n").alias("_n"))
    by_size = cells.groupBy(*CELL[:2]).agg(F.sum("_n").alias("_n"))
    sources = cells.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_n")).alias("source_size")).select(
        F.when(F.col("_source") != "n", F.substring("_source", 2, 1 << 30)).alias("source"), "source_size"
    )
    rate = targets(sources, weights, most).select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_source"),
        "source_size", "target",
        F.when(F.col("target") >= F.col("source_size") * most, F.lit(float(most)))
        .when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(F.lit(0.0)).alias("_rate"),
    )
    offset = (_hex(F.concat(F.lit(f"{_SALT}{seed}:"), "_source"), 1, 12) / F.lit(float(16**12)))
    rate = rate.select(
        "_source", "source_size", "target",
        F.floor("_rate").alias("_whole"),
        (F.col("_rate") - F.floor("_rate")).cast("decimal(16,15)").alias("_part"),
        offset.cast("decimal(16,15)").alias("_offset"),
    )
    start = (
        _before(cells, CELL, CELL[:3], "_h2", "_p3").drop("_n")
        .join(_before(by_h1, CELL[:3], CELL[:2], "_h1", "_p2").drop("_n"), CELL[:3])
        .join(_before(by_size, CELL[:2], CELL[:1], "_size", "_p1").drop("_n").join(rate, "_source"), CELL[:2])
        .select(*CELL, "source_size", "target", "_whole", "_part", "_offset",
                (F.col("_p1") + F.col("_p2") + F.col("_p3")).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy(*CELL).orderBy("doc_id"))
    step = lambda k: F.floor(k.cast("decimal(19,0)") * F.col("_part") + F.col("_offset"))
    return (
        rows.withColumn("_place", place).join(start, CELL)
        .withColumn("_k", F.col("_start") + F.col("_place"))
        .withColumn("copies", (F.col("_whole") + step(F.col("_k")) - step(F.col("_k") - 1)).cast("long"))
        .withColumn("size", F.col("_size")).withColumn("taken", F.col("copies") * F.col("size"))
        .select(*[F.col(f"`{c}`").alias(named.get(c, c)) for c in docs.columns if c not in made], *made)
    )


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS, seed: int = 0) -> DataFrame:
    """The documents of the mix, each as many times as it is taken, with the columns of ``docs``."""
    whole = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_doc"))
    taken = mix(whole, weights, most, seed).where("copies > 0")
    return taken.select("_doc", F.explode(F.expr("sequence(1L, copies)")).alias("_copy")).select("_doc.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 5) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0.0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0.0)) AS lvl
  FROM w WINDOW before AS (ORDER BY cap / w, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size,
         coalesce(least(cap, w * (
           SELECT lvl FROM l WHERE cap > w * lvl ORDER BY cap / w, source NULLS LAST LIMIT 1)), cap) AS target
  FROM l
), r AS (
  SELECT *, CASE WHEN target >= 3 * source_size THEN 3.0 WHEN source_size > 0 THEN target / source_size
            ELSE 0.0 END::DOUBLE AS rate,
         (('0x' || substr(sha256('mix0:' || coalesce('s' || source, 'n')), 1, 12))::BIGINT
          / 281474976710656.0::DOUBLE)::DECIMAL(16,15) AS u
  FROM t
), k AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, floor(rate)::BIGINT AS whole, u,
         (rate - floor(rate))::DECIMAL(16,15) AS part,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.h, d.doc_id) AS k
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       ((whole + floor(k::DECIMAL(19,0) * part + u) - floor((k - 1)::DECIMAL(19,0) * part + u))::BIGINT
        * size) AS taken
FROM k
"""


@query("op8_mixing", SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
