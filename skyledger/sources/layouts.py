"""Column orders of delimited files, found where the files are read.

Executors take the first line of each file. The driver is told the distinct column orders; only if there
are several does it also take the paths of the files of each, which its listing holds anyway. It opens no file.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

HEADS = "file string, names array<string>, width int"
#: Files up to this many bytes are read to their end, many to a task.
SMALL = 1 << 20
#: For larger ones: no file is cut, no two share a task, and a task is handed one line at a time.
ONE_FILE_A_TASK = {
    "spark.sql.files.maxPartitionBytes": str(1 << 50),
    "spark.sql.files.openCostInBytes": str(1 << 50),
    "spark.sql.files.maxPartitionNum": str((1 << 31) - 1),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
}


def has_names(header: Sequence[str]) -> bool:
    """Whether a first line names the fields; without the name ``origin`` it is data."""
    return "origin" in (name.strip().lower() for name in header)


def _one_file_a_task(spark: SparkSession) -> SparkSession:
    """A session of the same application with settings of its own."""
    reader = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if not key.startswith("spark."):  # a file system's
            reader.conf.set(key, value)
    for key, value in ONE_FILE_A_TASK.items():
        reader.conf.set(key, value)
        if reader.conf.get(key) != value:
            raise RuntimeError(f"{key} can't be set to {value}, so that each file is a task of its own")
    return reader


def _first_lines(end_after_first: bool):
    """``file, names, width`` from a task's lines, which come file by file; with ``end_after_first`` the task is over after one."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            files, names, widths = [], [], []
            for file, line in zip(batch["file"].to_pylist(), batch["value"]):
                if file != last:
                    last = file
                    fields = [field.strip().lower() for field in next(csv.reader([line.as_py()]), [])]
                    files.append(file)
                    names.append(fields if "origin" in fields else None)
                    widths.append(len(fields))
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.string()), pa.array(names, pa.list_(pa.string())), pa.array(widths, pa.int32())], ["file", "names", "width"]
            )
            if end_after_first and files:
                return

    return heads


def file_heads(spark: SparkSession, path: str) -> DataFrame:
    """``file, names, width`` of each file that holds a line.

    ``names`` are the first line's fields, stripped and in lower case, or NULL if it names no fields; ``width`` is their
    number. Compressed files are read as well. Of a file larger than ``SMALL`` a task reads the first line and what the file system's
    buffer holds beyond it, and ends; the caller's settings stay as they are.
    """

    def lines(session: SparkSession, size: Column) -> DataFrame:
        text = session.read.text(path).where(size & (F.col("_metadata.file_block_start") == 0))
        return text.select(F.col("_metadata.file_path").alias("file"), "value")

    bytes_of = F.col("_metadata.file_size")
    small = lines(spark, bytes_of <= SMALL).mapInArrow(_first_lines(False), HEADS)
    return small.union(lines(_one_file_a_task(spark), bytes_of > SMALL).mapInArrow(_first_lines(True), HEADS))


def _readable(uri: str) -> str:
    """A file's URI as a path that a reader takes for this file and for no pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def column_orders(spark: SparkSession, path: str) -> list[tuple[list[str], list[str] | None]]:
    """Field names and files of each column order among the files at ``path``.

    Files are None if all have one order. A file without a header, such as a later part of one that was cut,
    has the order of those that have one, which then must agree. If none has one, the names are blanks, as many as the widest
    first line has fields.
    """
    heads = file_heads(spark, path).persist()
    try:
        orders = heads.groupBy("names").agg(F.max("width").alias("width"), F.min("file").alias("file")).collect()
        named = [order.names for order in orders if order.names is not None]
        bare = [order for order in orders if order.names is None]
        if not named:
            return [([""] * max((order.width for order in bare), default=0), None)]
        if len(named) == 1:
            return [(named[0], None)]
        if bare:
            raise ValueError(f"{bare[0].file} has no header, and the headers of other files differ")
        files = heads.groupBy("names").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("names").collect()
        return [(row.names, [_readable(file) for file in row.files]) for row in files]
    finally:
        heads.unpersist()
