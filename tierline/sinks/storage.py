"""The few file operations Spark's writers do not offer, on any file system
Spark reaches.  All use of the JVM's file system classes is in this module."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where it is missing."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file whole or not at all: its bytes go to a name of their own,
    which is renamed once they are written.  An existing file is an error."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    half = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(half, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename(spark, half, p, jvm)


def rename(spark: SparkSession, half, p, jvm) -> None:
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # without OVERWRITE an existing target is an error
    context.rename(half, p, spark.sparkContext._gateway.new_array(kind, 0))
