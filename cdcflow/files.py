"""Small files and folders in whatever store a path names, by Spark's own file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, in order; nothing if it isn't there."""
    store, place = _place(spark, folder)
    return sorted(found.getPath().getName() for found in store.listStatus(place)) if store.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds, if it is there."""
    store, place = _place(spark, path)
    store.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    store, place = _place(spark, path)
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file, of which readers see all or nothing; one that is there already is an error."""
    store, place = _place(spark, path)
    _, beside = _place(spark, f"{place.getParent()}/.{uuid.uuid4().hex}")
    stream = store.create(beside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if store.exists(place) or not store.rename(beside, place):
        store.delete(beside, False)
        raise FileExistsError(path)
