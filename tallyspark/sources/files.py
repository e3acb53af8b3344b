"""Small files next to a table, through the file system that Spark itself uses for the path."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _system(spark, path)
    return system.exists(where)


def modified(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder with the seconds of their last change; empty where there is none."""
    system, where = _system(spark, path)
    if not system.exists(where):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in system.listStatus(where)}


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _system(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    system, where = _system(spark, path)
    system.delete(where, True)


def create(spark: SparkSession, path: str, text: str) -> None:
    """A new file with all of ``text``, or FileExistsError: written aside and moved into place by
    a rename that does not replace, so no reader sees a part of it."""
    system, where = _system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    choice = spark.sparkContext._gateway.new_array(rename, 1)
    choice[0] = rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.makeQualified(where).toUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(system.makeQualified(aside), system.makeQualified(where), choice)
    except Py4JJavaError as e:
        system.delete(aside, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            raise FileExistsError(path) from None
        raise
