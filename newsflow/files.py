"""Small files through the Hadoop file system of their path (HDFS, S3, local): pointers, claims, log entries."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """``(path, file system)`` of the JVM."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder and when each was last changed (milliseconds); empty where there is no folder."""
    p, fs = hadoop_path(spark, folder)
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)} if fs.exists(p) else {}


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_file(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Put a file in place by one rename: a reader sees the old content or the new one.

    ``replace=False``: only where there is none yet; returns whether this call made it.
    """
    folder, _, name = path.rpartition("/")
    tmp, fs = hadoop_path(spark, f"{folder}/.{name.lstrip('.')}.{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    sc = spark.sparkContext
    dst, _ = hadoop_path(spark, path)
    rename = sc._jvm.org.apache.hadoop.fs.Options.Rename
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if replace else rename.NONE
    try:
        sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), sc._jsc.hadoopConfiguration()).rename(
            tmp.makeQualified(fs.getUri(), fs.getWorkingDirectory()),
            dst.makeQualified(fs.getUri(), fs.getWorkingDirectory()), how)
    except Py4JJavaError as exc:
        if replace or "FileAlreadyExistsException" not in str(exc.java_exception):
            raise
        fs.delete(tmp, False)
        return False
    return True
