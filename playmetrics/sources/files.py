"""The few file-system questions that Spark's readers do not answer."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there; a storage error is raised, never read as "no"."""
    fs, where = _open(spark, path)
    return fs.exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isFile())


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small text file."""
    (row,) = spark.read.text(path, wholetext=True).collect()
    return row[0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole or not at all; an existing one is an error."""
    fs, where = _open(spark, path)
    _, beside = _open(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    stream = fs.create(beside)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(where) or not fs.rename(beside, where):
        fs.delete(beside, False)
        raise FileExistsError(f"{path}: another build has published this version")
