"""Session construction and the shared scratch location.

Every job that writes intermediate data (CSV stages, split files, stream
checkpoints) writes below the folder the cluster names in
``spark.checkpoint.dir``.  A folder is only invented when the session has
none configured, which is the case in local tests.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


#: Stage folders named so far, by application.
_SCRATCH: dict[str, list[str]] = {}

CLUSTER_PROFILE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast planned from file-size estimates (compressed Parquet can
    # inflate many times); AQE broadcasts a side only after its shuffle has
    # run and its real size is known, and explicit broadcasts are used only
    # for tables with a proven row bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoints whose frames are gone are removed from the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def ship_by_value(module_name: str) -> None:
    """Send a module's functions to the executors inside the task closures.

    Python UDFs and ``mapInPandas`` functions are normally pickled by
    reference, so every executor would need this package installed.
    Pickling them by value makes the few functions that run inside tasks
    self-contained; numpy/pandas/pyarrow, which are imported by reference,
    are part of any PySpark installation.
    """
    from pyspark import cloudpickle

    register = getattr(cloudpickle, "register_pickle_by_value", None)
    if register is not None:  # otherwise executors need the package on their path
        register(sys.modules[module_name])


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cairn",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UI off, UTC)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**CLUSTER_PROFILE, **(extra or {})}.items():
        builder = builder.config(key, value)
    return (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CAIRN_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Root folder for intermediate data that every executor can reach.

    Reads ``spark.checkpoint.dir`` (or the directory set through
    ``SparkContext.setCheckpointDir``).  When neither is set, a local session
    gets a fresh folder, registered as the checkpoint directory so that later
    calls agree on it; any other master raises, because a folder of one
    machine is not what its executors share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        current = None
    if current:
        return current.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master!r})")
    folder = tempfile.mkdtemp(prefix="cairn-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique sub-folder of the shared directory for one job's stage data.

    It stays until :func:`release_scratch`; :func:`scratch` removes its own at the end of a block.
    """
    path = f"{shared_dir(spark)}/cairn/{purpose}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in whatever store Spark reaches it; False if there was none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(store.delete(target, True))


def release_scratch(spark: SparkSession) -> int:
    """Remove the stage folders that :func:`scratch_path` has named for this application; returns how many there were.

    Call it when nothing reads them any more: a frame over a stage folder reads its files at each action.
    """
    app = spark.sparkContext.applicationId
    paths = _SCRATCH.pop(app, [])
    return sum(remove_path(spark, p) for p in paths)


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch folder for the actions inside the ``with`` block, removed after it."""
    path = scratch_path(spark, purpose)
    try:
        yield path
    finally:
        remove_path(spark, path)
        _SCRATCH.get(spark.sparkContext.applicationId, []).remove(path)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Cache ``df`` for the actions inside the ``with`` block, then release it.

    Worth it only when one frame feeds two or more actions; a cached frame
    is served from memory/disk, and lost blocks are recomputed from
    lineage.  Cache *after* projecting to the needed columns, or column
    pruning stops at the cache.
    """
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()
