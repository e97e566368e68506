"""Files and folders as the session's file systems list them."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listed_files(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """``path, length, modified`` of all files below one or more folders. No file is opened.

    Spark lists the folders, many at a time on the executors; hidden files, whose names begin with ``_`` or ``.``, are left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").options(**options)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def literal_path(path: str) -> str:
    """``path`` for a reader that takes patterns, so that it means the file of that name."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _system(spark, path)
    return system.exists(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none where there is no such folder."""
    system, folder = _system(spark, path)
    if not system.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(folder) if entry.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> bool:
    system, folder = _system(spark, path)
    return system.delete(folder, True)


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """Makes an empty file; False if there is one already. Of several callers at a time one gets True.

    The file system decides: HDFS and the local one do so atomically, an object store only if it writes on condition.
    """
    system, file = _system(spark, path)
    system.mkdirs(file.getParent())
    if system.getScheme() == "file":
        # Hadoop's local file system looks first and creates then; the operating system does both at once.
        return spark.sparkContext._jvm.java.io.File(file.toUri().getPath()).createNewFile()
    try:
        system.create(file, False).close()
    except Py4JJavaError as failed:
        if failed.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def plain_files(spark: SparkSession, path: str) -> dict[str, int]:
    """The names of the files right below ``path`` with their times of change, in milliseconds."""
    system, folder = _system(spark, path)
    if not system.exists(folder):
        return {}
    return {entry.getPath().getName(): entry.getModificationTime() for entry in system.listStatus(folder) if entry.isFile()}


def remove_file(spark: SparkSession, path: str) -> bool:
    system, file = _system(spark, path)
    return system.delete(file, False)
