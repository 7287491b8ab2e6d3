"""Where tables and checkpoints go, and the few file-system questions we ask."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SHARED_FOLDER = "spark.checkpoint.dir"
#: Run folders handed out, by application.
_RUNS: dict[str, list[str]] = {}
#: Names in the catalog of tables in run folders, by application.
_NAMES: dict[str, set[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only where driver and executors are one process a folder of the warehouse does as well; on
    a cluster the warehouse may be a folder of the driver's machine, so the setting is required.
    """
    configured = spark.conf.get(_SHARED_FOLDER, None) or spark.sparkContext.getConf().get(
        _SHARED_FOLDER
    )
    if configured:
        return configured.rstrip("/")
    if not f"{spark.sparkContext.master}[".startswith("local["):
        raise RuntimeError(f"set {_SHARED_FOLDER} to a folder that every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_runs"


def new_run_folder(spark: SparkSession, label: str) -> str:
    """A fresh location for one run; the name never repeats.

    It stays until :func:`remove_run_folders`, as results are read from it.
    """
    folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _RUNS.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def _hadoop_path(spark: SparkSession, location: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, fs = _hadoop_path(spark, location)
    return fs.exists(path)


def ensure_folder(spark: SparkSession, location: str) -> None:
    path, fs = _hadoop_path(spark, location)
    fs.mkdirs(path)


def remove(spark: SparkSession, location: str) -> None:
    path, fs = _hadoop_path(spark, location)
    fs.delete(path, True)


def forget_with_run_folders(spark: SparkSession, location: str, name: str) -> None:
    """Drop a table's name together with the run folder that its location is in, if it is in one."""
    application = spark.sparkContext.applicationId
    if any(location.startswith(f"{run}/") for run in _RUNS.get(application, [])):
        _NAMES.setdefault(application, set()).add(name)


def remove_run_folders(spark: SparkSession) -> int:
    """Delete the run folders and table names of this session's queries, once their results are read."""
    for name in _NAMES.pop(spark.sparkContext.applicationId, set()):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    taken = _RUNS.pop(spark.sparkContext.applicationId, [])
    for location in taken:
        remove(spark, location)
    return len(taken)


def date_files(spark: SparkSession, location: str, millis: int) -> None:
    """Set the modification time of the files of a folder, for tests of late files."""
    path, fs = _hadoop_path(spark, location)
    for status in fs.listStatus(path):
        fs.setTimes(status.getPath(), millis, -1)


def size_of(spark: SparkSession, location: str) -> int:
    """Bytes of all files under a location."""
    path, fs = _hadoop_path(spark, location)
    return fs.getContentSummary(path).getLength()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Existing locations that match a glob pattern."""
    path, fs = _hadoop_path(spark, pattern)
    return [str(status.getPath()) for status in fs.globStatus(path) or []]
