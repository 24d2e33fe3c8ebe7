"""Replacing a written table without ever leaving nothing in its place."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def staged_replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Have ``write`` fill a folder beside ``path``, and put that folder in the place of what is there.

    If ``write`` fails, what was at ``path`` is as it was and the new folder is gone. Only a whole table takes the place, by
    two renames: the old one aside, the new one in. If the second fails, the old one goes back; if the driver dies between them,
    the old table lies beside under a name that begins with ``_old-`` and no reader of the parent folder looks at. In
    a store that renames by copying, the second rename takes as long as a copy.

    Spark's own overwrite removes the old table before the first task has written anything.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    place = files.makeQualified(place)
    name = uuid.uuid4().hex
    beside, old = (hadoop.Path(place.getParent(), f"_{kind}-{name}") for kind in ("staged", "old"))
    try:
        write(beside.toString())
        there = files.exists(place)
        if there and not files.rename(place, old):
            raise OSError(f"{path} can't be moved aside")
        try:
            moved, why = files.rename(beside, place), None
        except Py4JJavaError as failed:
            moved, why = False, failed
        if not moved:
            if there:
                files.rename(old, place)
            raise OSError(f"the new table can't be moved to {path}") from why
    finally:
        files.delete(beside, True)
    files.delete(old, True)
