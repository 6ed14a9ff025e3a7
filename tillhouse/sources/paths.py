"""Folders of tables on any store that Spark reaches: existence, removal, replacement."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything but hidden entries; a partition isn't hidden, whatever its name begins with."""
    files, place = _file_system(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
    return any("=" in name or not name.startswith(("_", ".")) for name in names)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none where it doesn't exist."""
    files, place = _file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place) if f.isDirectory()] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` make a complete new folder beside ``path``, then switch to it.

    A run that fails while writing leaves the old table as it was. Between the two renames the table is absent for a
    moment, but its old files are only removed after the new ones are in place.
    """
    mark = uuid.uuid4().hex[:12]
    new, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    write(new)
    files, place = _file_system(spark, path)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    replaced = files.exists(place)
    if replaced and not files.rename(place, path_of(old)):
        raise OSError(f"cannot move {path} aside; the new table is in {new}")
    if not files.rename(path_of(new), place):
        raise OSError(f"cannot move {new} to {path}; the old table is in {old}")
    if replaced:
        files.delete(path_of(old), True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder in the shared folder that is removed at the end."""
    from tillhouse.session import new_folder

    folder = new_folder(spark, label)
    try:
        yield folder
    finally:
        remove(spark, folder)
