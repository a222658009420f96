"""What the training-data operators share: reading, session settings, Arrow batches, a registry."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.session import new_folder, shared_root, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# An Arrow batch ends at whichever bound comes first, so that a worker holds few megabytes of text.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# Short rows (ids, digests, links) that are worth a task of their own.
TASK_ROWS = 1 << 13

WORD = r"[^\x20\x09-\x0D]+"


def session(spark: SparkSession) -> SparkSession:
    tune(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame``; without SQL the tests alone check it."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(session(spark), folder.rstrip("/"))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, kept if executors go."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def few(frame: DataFrame, rows: int) -> DataFrame:
    """No more partitions than so many short rows fill: a task costs more than it works otherwise."""
    return frame.coalesce(max(1, -(-rows // TASK_ROWS)))


class Scratch:
    """Tables of one computation below a folder of their own, let go of together when it has its result."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.made = spark, new_folder(spark, name), 0

    def folder(self, name: str) -> str:
        self.made += 1
        return f"{self.root}/{self.made:03d}-{name}"

    def written(self, frame: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = self.folder(name)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path), path

    def stored(self, frame: DataFrame, name: str) -> DataFrame:
        return self.written(frame, name)[0]

    def drop(self) -> None:
        """Whatever is still to be read must have been written elsewhere before."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        # Shuffle files go when nothing refers to their frames any more.
        gc.collect()
        jvm.System.gc()


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_values(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes, null as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def batches_with(
    frame: DataFrame, text: str, new: dict[str, pa.DataType], spark_types: dict[str, str],
    work: Callable[[list[bytes]], dict[str, list]],
) -> DataFrame:
    """``frame`` with columns computed by ``work`` from the texts of each Arrow batch.

    Columns of the frame that bear the name of a new one are replaced.
    """
    kept = [c for c in frame.columns if c not in new]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name in kept]
        + [f"`{n}` {t}" for n, t in spark_types.items()]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = work(utf8_values(batch.column(text)))
            arrays = [batch.column(c) for c in kept] + [pa.array(made[n], t) for n, t in new.items()]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *new])

    return frame.mapInArrow(run, schema)


__all__ = [
    "ORACLES", "QUERIES", "Scratch", "TASK_ROWS", "WORD", "batches_with", "few", "new_folder", "query", "session", "shared_root",
    "stored", "table", "utf8_values", "word_count",
]
