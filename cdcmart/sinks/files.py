"""File-system calls on whatever storage a path names, through Spark's Hadoop configuration."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if the path is missing."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes stored below a path."""
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that nobody has created yet; False if it is there. One of several writers wins."""
    fs, target = _open(spark, path)
    fs.mkdirs(target.getParent())
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if fs.exists(target):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is missing."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of everything directly below a path; none if the path is missing."""
    fs, target = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was last written, by the clock of this machine."""
    fs, target = _open(spark, path)
    return time.time() - fs.getFileStatus(target).getModificationTime() / 1000
