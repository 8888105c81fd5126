"""Session construction and shared-folder helpers.

The library never creates a session at import time: every job and operator
takes ``spark`` as a parameter. ``build_session`` is a convenience for
scripts and tests.
"""

from __future__ import annotations


import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins at runtime from real
# shuffle sizes (broadcast only when the measured side is small), coalesces
# small partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files go when their data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerflow",
    shuffle_partitions: int | None = None,
    jars: list[str] | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a configured session.

    ``jars`` puts JDBC drivers on the driver and executor class path (the
    reference does this with two extraClassPath settings).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if jars:
        builder = builder.config("spark.jars", ",".join(jars))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is used
    as is; without it this raises, as a folder of one machine would lose rows.
    Only in local mode (one machine) a fresh folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for intermediate written tables (lineage cuts, round trips); never a
    machine-local temporary folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex}"


def planned_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of ``df``; None where it has none."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001
        return None
    return size if size < 2**56 else None


def input_bytes(df: DataFrame) -> int:
    """What the inputs of ``df`` hold, as far as the optimizer knows it. Unlike
    ``planned_bytes`` this does not multiply the sides of a join."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(s for s in sizes if s < 2**56)


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


_INITIAL_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_parts_for(spark: SparkSession, frames, target_bytes: int = 512 * 1024 * 1024, max_parts: int = 200_000) -> int | None:
    """Shuffle partitions for the estimated size of ``frames`` together (None:
    keep the configured count, or no estimate available)."""
    est = 0
    for df in frames:
        size = planned_bytes(df)
        if size is None:
            return None
        est += size
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    parts = min(max_parts, max(current, -(-est // target_bytes)))
    return parts if parts > current else None


@contextmanager
def sized_shuffle(spark: SparkSession, *frames, target_bytes: int = 512 * 1024 * 1024, max_parts: int = 200_000):
    """Within the block, shuffles start with enough partitions for ``frames``.

    AQE can only coalesce shuffle partitions, not split them (except skewed
    join partitions), so an aggregation over 100 TB needs its partition
    count up front: input bytes / ``target_bytes`` (the optimizer's size
    estimate of ``frames``) becomes AQE's initial partition number, which it
    then coalesces for small data. Nothing changes when the user has set
    that number. The previous setting is restored on exit.
    """
    parts = None if spark.conf.get(_INITIAL_PARTS, None) else shuffle_parts_for(spark, frames, target_bytes, max_parts)
    if parts:
        spark.conf.set(_INITIAL_PARTS, str(parts))
    try:
        yield parts
    finally:
        if parts:
            spark.conf.unset(_INITIAL_PARTS)


_SPLIT = "spark.sql.files.maxPartitionBytes"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: What a task of ``small_tasks`` reads, at most, of files or of a shuffle.
TASK_BYTES = 8 * 1024 * 1024


def _bytes(spark: SparkSession, key: str) -> int:
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))


@contextmanager
def small_tasks(spark: SparkSession, *frames, task_bytes: int | None = None, max_tasks: int = 10_000):
    """Within the block, a task reads ``task_bytes`` of files or of a shuffle.

    A grouping by whole rows keeps each row that is new to it in memory, on
    both sides of its shuffle: over 100 bytes for a row of which a compressed
    file may hold six. With Spark's 128 MB and 64 MB such a task comes to
    several GB. Beyond ``max_tasks`` tasks (by the size of the inputs
    of ``frames``) they get larger instead of more. Smaller sizes and a larger
    partition number that are set already stay; all are restored on exit.
    """
    est = sum(map(input_bytes, frames))
    size = max(task_bytes or TASK_BYTES, est // max_tasks)
    parts = int(spark.conf.get(_INITIAL_PARTS, None) or spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # rows take more room in a shuffle than in a compressed file
    wanted = {_SPLIT: min(size, _bytes(spark, _SPLIT)), _ADVISORY: min(size, _bytes(spark, _ADVISORY)), _INITIAL_PARTS: max(parts, min(max_tasks, 4 * est // size))}
    before = spark.conf.getAll
    for key, value in wanted.items():
        spark.conf.set(key, str(value))
    try:
        yield wanted[_INITIAL_PARTS]
    finally:
        for key in wanted:
            if key in before:
                spark.conf.set(key, before[key])
            else:
                spark.conf.unset(key)

def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote (any Hadoop file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path (tests only)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["DEFAULT_CONF", "build_session", "broadcast_threshold", "ensure_checkpoint_dir", "input_bytes", "is_local", "planned_bytes", "remove_path", "scratch_path", "sized_shuffle", "shuffle_parts_for", "small_tasks", "local_path"]

