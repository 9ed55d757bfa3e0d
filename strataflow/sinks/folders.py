"""Folders of tables, through the file system that holds them."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, folder: str):
    """The file system and path of a folder; names as the file system gives them may hold escapes."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder)) if "://" in folder or folder.startswith("file:") else jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there."""
    files, path = _located(spark, folder)
    files.delete(path, True)


def _exists(spark: SparkSession, folder: str) -> bool:
    files, path = _located(spark, folder)
    return files.exists(path)


def swap(spark: SparkSession, fresh: str, folder: str) -> None:
    """Puts the folder ``fresh`` in the place of ``folder`` by renames; the old one is deleted last, and put back if the new one can't take its place."""
    files, source = _located(spark, fresh)
    _, target = _located(spark, folder)
    _, old = _located(spark, f"{folder.rstrip('/')}.old-{uuid.uuid4().hex}")
    was_there = files.exists(target)
    if was_there and not files.rename(target, old):
        raise OSError(f"{folder} cannot be moved aside")
    if not files.exists(source) or not files.rename(source, target):
        if was_there:
            files.rename(old, target)
        raise OSError(f"{fresh} cannot take the place of {folder}")
    if was_there:
        files.delete(old, True)
    # Listings that a session has kept name files that are gone.
    spark.catalog.refreshByPath(folder)
