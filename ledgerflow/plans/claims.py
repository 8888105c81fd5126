"""Exclusive claims and markers on the shared file system.

A claim is a file that one writer alone can create: the name says what is
claimed (a table's next version, a step of a run). On HDFS and stores like it
``create(overwrite=false)`` is one atomic call of the name node; on a
machine's own file system Hadoop checks first and creates then, so there the
claim goes through the operating system's exclusive create.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentWriteError(RuntimeError):
    """Another writer holds what this one needs."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str, dirs: bool | None = None) -> list[str]:
    """Names in a folder (of folders or files only, if ``dirs`` says so)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if dirs is None or st.isDirectory() == dirs]


def age(spark: SparkSession, path: str) -> float:
    """Seconds since the file was written."""
    p, fs = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when it is there already. Of any number of
    callers, just one gets True."""
    p, fs = _fs(spark, path)
    fs.mkdirs(p.getParent())
    jvm = spark.sparkContext._jvm
    try:
        if fs.getScheme() == "file":
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(p.toUri().getPath()).toPath(), spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            fs.create(p, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


@contextmanager
def claimed(spark: SparkSession, path: str, what: str):
    """Hold ``path`` for the block. A writer that fails gives its claim back;
    one that succeeds leaves it (its result has the name for good). The claim
    of a writer that died stays, and ``what`` can be claimed again when
    someone who knows has deleted the file."""
    if not create(spark, path):
        raise ConcurrentWriteError(f"{what} is being written by another writer ({path})")
    try:
        yield path
    except BaseException:
        delete(spark, path)
        raise
