"""Small files and folders, through the Hadoop file system that Spark itself writes with."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(context._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if there is none or it was not written to its end."""
    where, files = _at(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "ChecksumException":
            return None
        raise
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    where, files = _at(spark, path)
    stream = files.create(where, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _at(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it, if it is there."""
    where, files = _at(spark, path)
    files.delete(where, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    where, files = _at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where) if f.isDirectory())
