"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Needed for right results: windows and hours are cut in UTC, and the oracle
# engine has no session zone at all.
RESULT_SETTINGS = {"spark.sql.session.timeZone": "UTC"}

# Wanted at scale; only applied where the session owner left them unset.
# RocksDB keeps streaming state off the heap, so state may outgrow memory;
# changelog checkpoints upload the change of a batch rather than the whole state.
# A stream's log of files taken is rewritten as a whole at every compaction, and
# every micro-batch lists what has not been deleted of it: a run of many small
# micro-batches compacts seldom and deletes early.
# Skewed partitions of a join are split even if the aggregation after it then
# needs a shuffle of its own.
SCALE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.fileSource.log.compactInterval": "100",
    "spark.sql.streaming.fileSource.log.cleanupDelay": "5000",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# On a local disk Spark by its own choice looks for links before every rename, and without Hadoop's
# native library each look starts a program: eight a file, three files a micro-batch.  Only where
# checkpoints are local: a rename over an existing file needs Spark's choice on a shared store.
LOCAL_SETTINGS = {
    "spark.sql.streaming.checkpointFileManagerClass":
        "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
}


_shipped: set[str] = set()


def _set_where_unset(spark: SparkSession, settings: dict[str, str]) -> None:
    chosen = spark.conf.getAll
    for name, value in settings.items():
        if name not in chosen:
            spark.conf.set(name, value)


def has_local_scratch(spark: SparkSession) -> bool:
    """Whether the working folder, and with it checkpoints without a place of their own, are on a local disk."""
    root = spark._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.checkpoint.dir", None) or "/")
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that they need no copy of it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-package-"), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, files in os.walk(here):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.join("tidemark", os.path.relpath(path, here)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session made elsewhere."""
    ship_package(spark)
    for name, value in RESULT_SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    _set_where_unset(spark, SCALE_SETTINGS)
    if has_local_scratch(spark):
        _set_where_unset(spark, LOCAL_SETTINGS)
    return spark


def build_session(app: str = "tidemark", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution and skew handling on and no web page.

    On a local master the number of shuffle partitions follows the thread count.
    On a cluster it is left to the deployment, and adaptive execution merges
    small partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.catalogImplementation", "in-memory")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            inside = master[master.find("[") + 1:-1] if "[" in master else "1"
            threads = str(os.cpu_count() or 1) if inside == "*" else inside
            builder = (builder.config("spark.sql.shuffle.partitions", threads)
                       .config("spark.driver.memory", "8g"))
    for settings in (RESULT_SETTINGS, SCALE_SETTINGS, conf or {}):
        for name, value in settings.items():
            builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if has_local_scratch(spark):
        _set_where_unset(spark, LOCAL_SETTINGS)
    ship_package(spark)
    return spark
