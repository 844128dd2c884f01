"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library relies on. The number of shuffle partitions
# is the cluster's; loads raise it to fit their input (see sized_shuffles).
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Stream state of many keys belongs on disk, not in the executors' heaps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Loads write two folders per task: both stay open, so rows need no sort by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


# Text grows about tenfold as rows in a duplicate drop, so a task gets a tenth of what it may hold.
PARTITION_BYTES = 64 * 1024 * 1024
# What adaptive execution may merge into one task: compressed, so a part of the above.
MERGED_BYTES = 16 * 1024 * 1024
UNKNOWN_SIZE = 2**62
RUN_ID = uuid.uuid4().hex
_run_folders: set[str] = set()


def build_session(app: str = "tidegate", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Whether every executor runs in this process; a local cluster has processes of its own."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    A machine-local folder is only chosen where the setting is absent and every
    executor runs in this process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidegate-")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    run = f"{shared_root(spark)}/tidegate-{RUN_ID}"
    if run not in _run_folders:
        # Made first: Hadoop only notes a folder for removal at the driver's end if it exists.
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(run)
        system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(hadoop_path)
        system.deleteOnExit(hadoop_path)
        _run_folders.add(run)
    return f"{run}/{label}-{uuid.uuid4().hex[:12]}"


def input_bytes(df: DataFrame) -> int:
    """Size of the files a frame reads, as far as Spark knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return sum(size for size in sizes if size < UNKNOWN_SIZE)


@contextmanager
def bounded_tasks(spark: SparkSession, partition_bytes: int = PARTITION_BYTES) -> Iterator[None]:
    """Lower what a task reads from files, and what adaptive execution merges, to these sizes; both are put back afterwards."""
    conf, bytes_of = spark.conf, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    most = {"spark.sql.files.maxPartitionBytes": partition_bytes, "spark.sql.adaptive.advisoryPartitionSizeInBytes": MERGED_BYTES}
    before = {name: conf.get(name) for name in most}
    try:
        for name, size in most.items():
            if bytes_of(before[name]) > size:
                conf.set(name, f"{size}b")
        yield
    finally:
        for name, value in before.items():
            conf.set(name, value)


@contextmanager
def sized_shuffles(df: DataFrame, partition_bytes: int = PARTITION_BYTES) -> Iterator[None]:
    """Raise the number of shuffle partitions to what the frame's input needs, for one write, with tasks as in :func:`bounded_tasks`.

    Adaptive execution merges and splits partitions but does not start with more
    than the setting. The setting is never lowered, and is put back afterwards.
    """
    conf, name = df.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(name)
    needed = input_bytes(df) // partition_bytes
    try:
        if needed > int(before):
            conf.set(name, str(needed))
        with bounded_tasks(df.sparkSession):
            yield
    finally:
        conf.set(name, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def leave_mark(spark: SparkSession, path: str) -> None:
    """An empty file that says a step is done."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, True).close()


def path_matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob pattern names any file or folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return found is not None and len(found) > 0


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that is not there is no error."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none where there is no such folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(hadoop_path)] if system.exists(hadoop_path) else []


def rename_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another name that no other has."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(path) for path in (source, target))
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(new) or not system.rename(old, new):
        raise RuntimeError(f"{source} could not be renamed to {target}")
