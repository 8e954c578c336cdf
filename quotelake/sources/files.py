"""Small files and folder names, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, place: str) -> bool:
    files, path = _at(spark, place)
    return files.exists(path)


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Whole paths that a glob pattern matches, in order."""
    files, path = _at(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(path) or ())


def read_text(spark: SparkSession, place: str) -> str:
    files, path = _at(spark, place)
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, place: str, text: str) -> bool:
    """Puts a whole new file in its place; False if there is one already."""
    files, path = _at(spark, place)
    if files.exists(path):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}-{uuid.uuid4().hex}")
    files.mkdirs(path.getParent())
    stream = files.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    return files.rename(draft, path)


def put_text(spark: SparkSession, place: str, text: str) -> None:
    """Writes a small file, in place of an older one."""
    files, path = _at(spark, place)
    files.mkdirs(path.getParent())
    stream = files.create(path, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def remove(spark: SparkSession, place: str) -> None:
    files, path = _at(spark, place)
    files.delete(path, True)
