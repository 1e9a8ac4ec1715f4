"""Files and folders on any Hadoop file system."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) for ``path`` (any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence of ``path`` on its Hadoop file system (any scheme)."""
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    fs, hpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file; empty if it is not there."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return ""
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text``; False if it is there already.

    Of several callers one succeeds. HDFS checks and creates in one step, as
    do object stores with conditional writes; a plain file system gets the
    whole file by a hard link, which fails if the name is taken.
    """
    fs, hpath = _fs(spark, path)
    if fs.getScheme() == "file":
        target = hpath.toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        whole = os.path.join(os.path.dirname(target), f".{uuid.uuid4().hex}")
        with open(whole, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(whole, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(whole)
        return True
    try:
        out = fs.create(hpath, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True
