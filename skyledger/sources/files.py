"""Folders and small text files through the file system Spark itself uses."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when it does not exist."""
    fs, where = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def ages(spark: SparkSession, path: str) -> dict[str, float]:
    """Names directly under a folder, with the seconds since each was last changed."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return {}
    now = time.time()
    return {s.getPath().getName(): now - s.getModificationTime() / 1000 for s in fs.listStatus(where)}


def remove(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None when there is no such file."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write(fs, where, text: str, overwrite: bool) -> None:
    stream = fs.create(where, overwrite)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist yet, whole or not at all; false if another writer was first.

    The text is written beside it and moved into place, so nobody reads half a file; a move onto a file that is there
    fails.
    """
    fs, where = _open(spark, path)
    beside = where.getParent().suffix(f"/.{spark._jvm.java.util.UUID.randomUUID().toString()}")
    _write(fs, beside, text, True)
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    renames = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    renames[0] = options
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(where), renames)
        return True
    except Py4JJavaError as e:
        fs.delete(beside, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file anew; readers treat it as a hint only."""
    fs, where = _open(spark, path)
    _write(fs, where, text, True)
