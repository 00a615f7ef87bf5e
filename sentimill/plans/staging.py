"""Intermediate tables in the folder all executors share.

A staged table cuts lineage, survives the loss of executors, is pruned like any
Parquet table and has a known size, so Spark's own broadcast check works on it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# The folder of this application's staged tables below each shared folder.
_RUNS: dict[tuple[str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a fresh local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    local = _RUNS.get((spark.sparkContext.applicationId, "local"))
    if local is None:
        local = tempfile.mkdtemp(prefix="sentimill-")
        _RUNS[spark.sparkContext.applicationId, "local"] = local
    return local


def run_folder(spark: SparkSession) -> str:
    """The one folder that holds all staged tables of this application."""
    shared = shared_folder(spark)
    at = (spark.sparkContext.applicationId, shared)
    if at not in _RUNS:
        _RUNS[at] = f"{shared}/sentimill-{uuid.uuid4().hex}"
    return _RUNS[at]


def _path(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _path(spark, path)
    return files.exists(place)


def version(spark: SparkSession, *paths: str) -> tuple:
    """Names, sizes and times of the files below ``paths``; it changes when a table is written anew."""
    found = []
    for path in paths:
        files, place = _path(spark, path)
        if not files.exists(place):
            continue
        for status in files.listStatus(place):
            found.append((status.getPath().getName(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


# Results that several queries of an application read, by application, name and version of their input.
_KEPT: dict[tuple, str] = {}


def kept(spark: SparkSession, name: str, of: tuple, write: Callable[[str], None]) -> str:
    """The folder that ``write`` has filled; it is called again when ``of`` changes or the folder is gone."""
    at = (spark.sparkContext.applicationId, name, of)
    if at not in _KEPT or not exists(spark, _KEPT[at]):
        path = fresh_path(spark, name)
        write(path)
        _KEPT[at] = path
    return _KEPT[at]


def remove_staged(spark: SparkSession) -> None:
    """Delete every table this application has staged; call it when results have been written."""
    files, place = _path(spark, run_folder(spark))
    files.delete(place, True)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of one staged table that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if run_folder(spark).rsplit("/", 1)[1] in file:
            files, place = _path(spark, file)
            files.delete(place, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the run's folder that nothing else uses."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), most_rows: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table; ``most_rows`` of a file, if rows are large."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.partitionBy(*partition_by).option("maxRecordsPerFile", most_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A table scan dealt out by key when it has fewer files than there are cores.

    Text work on a table of a few files would otherwise keep a few cores busy; a table with enough files is
    returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if len(scan.inputFiles()) < cores else scan


_SCAN_TASKS = "spark.sql.files.minPartitionNum"


@contextmanager
def fine_scans(spark: SparkSession, per_core: int = 4) -> Iterator[None]:
    """Inside, a file scan is cut into ``per_core`` tasks a core or more, where files allow it, so that few cores wait for the last task.

    Spark's own aim is one task a core, of which one too many leaves the cores idle for a second round.  Tasks stay within the largest size set.
    """
    before = spark.conf.get(_SCAN_TASKS, None)
    spark.conf.set(_SCAN_TASKS, str(max(int(before or 0), per_core * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SCAN_TASKS)
        else:
            spark.conf.set(_SCAN_TASKS, before)
