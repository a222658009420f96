"""Session settings the library relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Timestamps with an offset are folded to UTC before their date is taken.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs the parent one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stream state off the heap: keyed state grows with the number of keys.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

PARTITION_BYTES = 128 << 20
# Every machine has its own, whatever TMPDIR says.
MACHINE_FOLDERS = ("/tmp", "/var/tmp")

_local_folders: dict[str, str] = {}


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built.

    With the size of the input, exchanges start from as many partitions as it fills at
    ``PARTITION_BYTES`` each; adaptive execution merges what turns out small, but never splits an
    exchange that began too narrow.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    return spark


def local_session(cores: int | str = 8, name: str = "ledgerloom") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.streaming.stateStore.maintenanceInterval", "600s")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A local session without the setting gets one temporary folder; a cluster session without it, or
    with one machine's temporary folder, is refused, because such a folder would not survive the loss
    of that machine. (Other ``file:`` paths may be mounts that all machines share.)
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        app = context.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="ledgerloom-")
        root = _local_folders[app]
    plain = f"/{root.removeprefix('file:').strip('/')}/"
    own = {f"{folder.rstrip('/')}/" for folder in (*MACHINE_FOLDERS, tempfile.gettempdir())}
    if not context.master.startswith("local") and root.startswith(("/", "file:")) and plain.startswith(tuple(own)):
        raise ValueError(f"spark.checkpoint.dir is {root}, a temporary folder of one machine")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared root; Spark creates it on the first write."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(frame: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder and forget how it was computed."""
    shared_root(frame.sparkSession)
    return frame.checkpoint()


def cut_by(frame: DataFrame, key: str) -> DataFrame:
    """``cut``, dealt out by ``key`` for joins to come: they move the other side alone.

    An adaptive plan doesn't tell its partitioning, so this one cut is planned without.
    """
    spark = frame.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(frame.repartition(parts, key))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
