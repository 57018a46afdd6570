"""Scratch tables and file metadata, on whatever file system the paths name."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
LOCAL_SCRATCH = "platterwatch.scratch.dir"  # our own setting, used where the one above is unset

_local = threading.local()


def scratch_base(spark: SparkSession) -> str:
    """The shared folder the session names, else (local runs and tests only) a temporary one."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(LOCAL_SCRATCH, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="platterwatch-")
        spark.conf.set(LOCAL_SCRATCH, base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in a folder of its own, which is removed when the session's JVM ends."""
    folder = f"{scratch_base(spark)}/{name}-{uuid.uuid4().hex}"
    fs, target = _file_system(spark, folder)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    _open_scopes()[-1].append(folder)
    return f"{folder}/data"


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch paths that this thread makes inside the block when it ends."""
    scopes = _open_scopes()
    scopes.append([])
    try:
        yield
    finally:
        remove(spark, scopes.pop())


def release_scratch(spark: SparkSession) -> None:
    """Remove the scratch paths this thread made outside of scopes. DataFrames over them become
    unreadable."""
    outer = _open_scopes()[0]
    remove(spark, outer)
    outer.clear()


def _open_scopes() -> list[list[str]]:
    if not hasattr(_local, "scopes"):
        _local.scopes = [[]]
    return _local.scopes


def remove(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        fs, target = _file_system(spark, folder)
        fs.delete(target, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a batch result once and read it back: computed once, used often, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The full address of a path, as Spark resolves it. Python code in tasks needs it: there a path without
    a scheme would be one of the machine's own disk."""
    fs, target = _file_system(spark, path)
    return fs.makeQualified(target).toString()


def arrow_store(uri: str):
    """(file system of pyarrow, path in it) of a full address, for Python code in tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """The data files below a path as rows (path, length). Spark lists large trees in tasks; contents are
    not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length")


def numbered_folders(spark: SparkSession, path: str) -> list[int]:
    """The folders below a path that have a number as their name, in order; none if it is missing."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(target)]
    return sorted(int(name) for name in names if name.isdigit())
