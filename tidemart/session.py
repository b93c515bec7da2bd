"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings every job relies on. No size is raised above Spark's own
# broadcast threshold: a table is broadcast only when its estimated or measured
# size is under that limit, and joined by shuffle with skew splitting otherwise.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # Small files share a task only up to this size, so that few large row groups still spread.
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.files.openCostInBytes": "1m",
}

# A task of a stream reads less: the compressed records of a topic grow some fifteen-fold as they are read.
STREAM_SETTINGS = {**RUNTIME_SETTINGS, "spark.sql.files.maxPartitionBytes": "16m"}
STREAM = "spark.tidemart.stream"

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INITIAL_PER_CORE = 4

_unset_root: str | None = None
_shipped: set[str] = set()


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session and send the package to its workers.

    Shuffles begin with ``INITIAL_PER_CORE`` partitions per core of the cluster, which
    adaptive execution coalesces; ``input_bytes``, the size a job is about to shuffle,
    raises that number.
    """
    settings = STREAM_SETTINGS if spark.conf.get(STREAM, None) else RUNTIME_SETTINGS
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    initial = shuffle_partitions(spark, input_bytes or 0)
    if input_bytes is not None or spark.conf.get(INITIAL, None) is None:
        spark.conf.set(INITIAL, str(initial))
    ship(spark)
    return spark


def shuffle_partitions(spark: SparkSession, input_bytes: int, target_bytes: int = 512 << 20) -> int:
    """Partitions of about ``target_bytes`` each, at least some per core."""
    return max(INITIAL_PER_CORE * spark.sparkContext.defaultParallelism, -(-input_bytes // target_bytes))


def ship(spark: SparkSession) -> None:
    """Make the package importable in the Python workers of a cluster, once per application.

    Workers of a local master import from the driver's own path. Others get the
    package as a zip file through Spark's file server, unless it is installed there
    (``TIDEMART_INSTALLED=1``).
    """
    context = spark.sparkContext
    if context.master.startswith("local") or os.environ.get("TIDEMART_INSTALLED") or context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidemart-zip-")) / "tidemart.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))


def local_session(cpus: str | int = "*", memory: str = "12g", app: str = "tidemart") -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def stream_session(spark: SparkSession, ends: bool = False) -> SparkSession:
    """A sibling session for streaming queries.

    The number of state store partitions is fixed when a stream first starts,
    so it follows the cores of the cluster rather than the batch default.
    ``ends`` is for state with a time to live read with ``availableNow``: Spark
    would otherwise run empty batches for ever to look for expired state. Joins
    whose state has a time to live stamp both sides with their arrival, so the
    later of both tells how far time has gone.
    """
    child = spark.newSession()
    child.conf.set(STREAM, "true")
    configure(child)
    child.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    # A micro-batch may be as large as a table: shuffles begin as in a batch, small ones are coalesced.
    child.conf.set(INITIAL, str(shuffle_partitions(spark, 0)))
    # A few hundred folders of a keyed table are listed faster by the driver than by a job.
    child.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", "400")
    child.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # What a job shuffled goes as it ends; it would else lie there until the driver collects its garbage.
    child.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    # Changes alone are checkpointed, and rows of the state are not looked up to be counted.
    child.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    child.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    # A state lies on disk twice, in the executors' stores and in the checkpoint.
    child.conf.set("spark.sql.streaming.stateStore.rocksdb.compression", "zstd")
    child.conf.set("spark.sql.streaming.stateStore.compression.codec", "zstd")
    if ends:
        child.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
        child.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    return child


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``."""
    global _unset_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _unset_root is None:
        _unset_root = tempfile.mkdtemp(prefix="tidemart-")
    return _unset_root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the shared root."""
    return f"{shared_root(spark)}/tidemart/{name}-{uuid.uuid4().hex[:12]}"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path, in name order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()) if fs.exists(root) else []


def folder_files(spark: SparkSession, path: str) -> list[tuple[int, float]]:
    """Size and time of writing (seconds) of the data files right in a folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s for s in fs.listStatus(root) if s.isFile() and s.getPath().getName()[0] not in "._"]
    return [(s.getLen(), s.getModificationTime() / 1000) for s in found]


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(root).getLength() if fs.exists(root) else 0


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that nobody reads any more, if it is there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path whose write was committed, in name order."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(p.getName() for p in found if fs.exists(hadoop.Path(p, "_SUCCESS")))


def remove_folders(spark: SparkSession, paths: list[str], marker: str, before: float) -> list[str]:
    """Remove folders that a marker file replaces, if it was written before a time (seconds); the folders removed."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    mark = hadoop.Path(marker)
    fs = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(mark) or fs.getFileStatus(mark).getModificationTime() / 1000 > before:
        return []
    return [p for p in paths if fs.delete(hadoop.Path(p), True)]
