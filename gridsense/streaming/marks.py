"""Small marks and folder work on the shared storage, by Hadoop's file system.

A mark is an empty file named by a number; creating one is atomic, and the
largest number counts. The last two are kept.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder (none where there is no folder)."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def list_folders(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers of files and folders named ``<prefix><number>``."""
    names = [x[len(prefix):] for x in list_names(spark, folder) if x.startswith(prefix)]
    return sorted(int(x) for x in names if x.lstrip("-").isdigit())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def note(spark: SparkSession, folder: str, n: int) -> None:
    """Note ``n`` in a folder of marks."""
    p, fs = _path(spark, f"{folder}/n={n}")
    fs.create(p, True).close()
    for old in list_folders(spark, folder, "n=")[:-2]:
        remove(spark, f"{folder}/n={old}")


def noted(spark: SparkSession, folder: str) -> int | None:
    """The largest number noted, or None."""
    return max(list_folders(spark, folder, "n="), default=None)
