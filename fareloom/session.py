"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import warnings
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job here assumes. Partition counts are left to the caller:
# they depend on the cluster, and AQE merges small shuffle partitions itself.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sessions of a hot key are merged in each task before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Stream state on local disk, with its changes uploaded to the checkpoint, instead
# of on the executor heap. The runners in ``streaming`` start every query with it.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Python workers live from job to job. With these they give the memory of large arrays
# back when a task is done with them, instead of keeping it beside the next job's.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "MALLOC_TRIM_THRESHOLD_": "1048576",
}

_local_roots: dict[str, str] = {}


def build_session(
    app: str, master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Session with ``SETTINGS``, then ``conf`` on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Let Python workers started from another folder import this package, and start
    them with ``WORKER_MEMORY`` where the job does not say otherwise."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)


def give_back(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are over, and give memory that the
    driver's Python has freed back to the machine.

    It does so when a collection in the driver's JVM finds that nothing refers to them
    any more; left alone, a driver with little to do keeps the files of hours."""
    gc.collect()
    spark._jvm.System.gc()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def _file_system(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), there


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, on whatever file system it is."""
    system, there = _file_system(spark, path)
    system.delete(there, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder that this library wrote another name; its new parent is made."""
    system, there = _file_system(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(to)
    system.mkdirs(new.getParent())
    if not system.rename(there, new):
        raise OSError(f"{path} could not be renamed to {to}")


def modified(spark: SparkSession, path: str) -> int:
    """When ``path`` last changed, in milliseconds."""
    system, there = _file_system(spark, path)
    return system.getFileStatus(there).getModificationTime()


def file_times(spark: SparkSession, folder: str) -> dict[str, int]:
    """Visible files of ``folder`` and when they changed; none if it is not there."""
    system, there = _file_system(spark, folder)
    found = system.listStatus(there) if system.exists(there) else []
    times = {f.getPath().getName(): f.getModificationTime() for f in found if f.isFile()}
    return {name: t for name, t in times.items() if not name.startswith(("_", "."))}


def set_file_times(spark: SparkSession, folder: str, times: dict[str, int]) -> None:
    """Let files of ``folder`` look changed at these milliseconds."""
    system, there = _file_system(spark, folder)
    for name, time in times.items():
        system.setTimes(spark._jvm.org.apache.hadoop.fs.Path(there, name), time, -1)


def app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that all executors share.

    The folder is ``spark.checkpoint.dir``. Only a local master may do without
    it, as a machine-local folder would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root and not is_local(spark) and _file_system(spark, root)[0].getScheme() == "file":
        warnings.warn(f"{root} must be a folder that all machines mount", stacklevel=2)
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_roots.get(app_id(spark))
        if root is None:
            root = _local_roots[app_id(spark)] = tempfile.mkdtemp(prefix="fareloom-")
    return f"{root.rstrip('/')}/fareloom-{app_id(spark)}/{label}-{uuid.uuid4().hex[:12]}"
