"""Exact deduplication as a stateful stream over digests, checked byte for byte on hits.

1. ``digest_log`` reads every text once and writes a log: document id, SHA-256 of the text with A-Z
   lower-cased, and the content locator (file and row) of the document. Texts stay where they are.
2. ``run_state`` streams the log through a keyed aggregation whose state lives on disk (RocksDB) and
   never expires: per digest the stable identifier, its locator and the number of documents. Later
   runs with the same folders carry on from the state; copies combine before the shuffle.
3. ``verify`` follows the locators of all hits (digests seen more than once), and compares whole texts
   with that of the retained document. Equal digests with other bytes become groups of their own.

A locator is a row of a file. That it names one row only is checked on the log: a frame whose rows share
locators (a scan that was fanned out by ``explode``, a join or a union with itself) is written down first, and so is
a frame that is no file scan. The locator's columns have names that the input doesn't have; all columns of the input
survive ``deduplicate``.

Null text counts as empty; texts may be of any length that one row can hold. Repeated rows are copies like any other:
of rows with the same id and text exactly one is kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import Scratch, batches_with, query, stored, table

LOG_SCHEMA = "doc_id bigint, digest string, file string, row bigint"
STATE_SCHEMA = "digest string, best struct<doc_id:bigint,file:string,row:bigint>, group_size bigint"
# A run has few batches: each store is closed after its commit, so that a node holds open only the
# stores of its running tasks, however many partitions the state has.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def located(docs: DataFrame) -> tuple[DataFrame, str, str] | None:
    """``docs`` with the file and the row of each of its rows, and the names of these two columns."""
    file, row = "file", "row"
    while {file, row} & set(docs.columns):
        file, row = f"_{file}", f"_{row}"
    try:
        return docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)), file, row
    except AnalysisException:
        return None


def digest_log(docs: DataFrame, digest=hashlib.sha256) -> DataFrame:
    """One row per document: id, digest of the normalised text, locator."""

    def digests(texts: list[bytes]) -> dict[str, list]:
        # bytes.lower() changes A-Z only.
        return {"digest": [digest(t.lower()).hexdigest() for t in texts]}

    made = batches_with(
        docs.select("doc_id", "text", "file", "row"), "text",
        {"digest": pa.string()}, {"digest": "string"}, digests,
    )
    return made.select("doc_id", "digest", "file", "row")


def run_state(spark: SparkSession, log: str, state: str, checkpoint: str) -> DataFrame:
    """Stream what is new in the ``log`` folder into the keyed state; the newest row per digest."""
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    grouped = (
        spark.readStream.schema(LOG_SCHEMA).parquet(log).groupBy("digest")
        .agg(F.max(F.struct("doc_id", "file", "row")).alias("best"), F.count("*").alias("group_size"))
    )

    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/batch={number}")

    (
        grouped.writeStream.outputMode("update").foreachBatch(publish)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        .awaitTermination()
    )
    if not spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(log).select("path").take(1):
        return spark.createDataFrame([], STATE_SCHEMA)
    newest = spark.read.schema(STATE_SCHEMA + ", batch int").parquet(state)
    return newest.groupBy("digest").agg(
        F.max_by(F.struct("best", "group_size"), "batch").alias("s")
    ).select("digest", "s.best", "s.group_size")


def verify(docs: DataFrame, log: DataFrame, state: DataFrame, scratch: Scratch) -> DataFrame:
    """Documents whose bytes differ from the retained ones of their digest, grouped by their bytes.

    ``docs`` are ``file, row, text``.
    """
    normal = F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower())
    hits = state.where("group_size > 1").select("digest", F.col("best").alias("keep"))
    members = scratch.stored(log.join(hits, "digest").join(docs, ["file", "row"]), "members")
    held = members.where("keep.file = file AND keep.row = row").select(
        "digest", F.col("text").alias("held")
    )
    differing = (
        members.join(held, "digest")
        # Equal as they are, or else after lower-casing.
        .where(~F.col("text").eqNullSafe(F.col("held")))
        .select("digest", "doc_id", "file", "row", normal.alias("text"),
                F.translate(F.coalesce("held", F.lit("")), UPPER, UPPER.lower()).alias("held"))
        .where("text != held").drop("held")
    )
    groups = differing.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("best"), F.count("*").alias("group_size")
    )
    return differing.join(groups, ["digest", "text"]).select(
        "file", "row", "digest", "best", "group_size"
    )


def _logged(docs: DataFrame, digest, scratch: Scratch) -> tuple[DataFrame, DataFrame, str, tuple[str, str]]:
    """Located documents, their log, its folder and the names of the locator; each locator names one row."""
    place = located(docs)
    for _ in range(2):
        if place:
            found, file, row = place
            rows = found.select("doc_id", "text", F.col(file).alias("file"), F.col(row).alias("row"))
            log, folder = scratch.written(digest_log(rows, digest), "log")
            log = docs.sparkSession.read.schema(LOG_SCHEMA).parquet(folder)
            if not log.groupBy("file", "row").agg(F.count("*").alias("n")).where("n > 1").take(1):
                return found, log, folder, (file, row)
        # Kept beside the result, which reads it.
        place = located(stored(docs, "dedup-landing"))
    raise ValueError("rows of a written table have no locators of their own")


def _decided(docs: DataFrame, digest) -> tuple[DataFrame, DataFrame, tuple[str, str]]:
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    found, log, folder, (file, row) = _logged(docs, digest, scratch)
    # Written down, so that joins meet a plain exchange, whose hot digests adaptive execution splits.
    state = scratch.stored(run_state(spark, folder, scratch.folder("state"), scratch.folder("checkpoint")), "newest")
    texts = found.select(F.col(file).alias("file"), F.col(row).alias("row"), "text")
    apart = scratch.stored(verify(texts, log, state, scratch), "collisions")
    plain = log.join(state, "digest")
    if apart.take(1):
        # Collisions of the digest: their documents leave the group of the digest.
        left = apart.groupBy("digest").agg(F.count("*").alias("gone"))
        plain = (
            plain.join(apart.select("file", "row"), ["file", "row"], "left_anti")
            .join(left, "digest", "left")
            .withColumn("group_size", F.expr("group_size - coalesce(gone, 0)")).drop("gone")
            .unionByName(log.join(apart.drop("digest"), ["file", "row"]))
        )
    told = stored(plain.select(
        "doc_id", "digest", "file", "row", F.col("best.doc_id").alias("keep_id"), "group_size",
        F.expr("best.file = file AND best.row = row").alias("kept"),
    ), "dedup-decisions")
    scratch.drop()
    return found, told, (file, row)


def decisions(docs: DataFrame, digest=hashlib.sha256) -> DataFrame:
    """Per document: doc_id, digest, locator, keep_id, group_size and kept."""
    return _decided(docs, digest)[1]


def deduplicate(docs: DataFrame, digest=hashlib.sha256) -> DataFrame:
    """The retained documents with all their columns."""
    found, told, (file, row) = _decided(docs, digest)
    kept = told.where("kept").select(F.col("file").alias(file), F.col("row").alias(row))
    return found.join(kept, [file, row], "left_semi").select(*docs.columns)


SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, row_number() OVER (PARTITION BY d.t ORDER BY d.doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""


@query("op4_exact_dedup", SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return decisions(table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )
