"""Delimited records whose quoted fields may hold line breaks, from files that are cut into splits.

A file that is read line by line can be cut anywhere, but then nobody knows whether a cut lies inside quotes. It depends on the
number of quotes before it, and that adds up: each split counts its own, a running total over the splits of a file gives the
parity at each cut, and with it each split finds its records alone. A record that crosses cuts leaves a piece in each split; the pieces
are few and are put together by file and place. So one huge file is read by many tasks, which a reader of multi-line
records can't do.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .flights import DIALECT

#: Longest record, in characters. A longer one is taken for a quote that is never closed.
LONGEST = 1 << 26
#: Cuts inside quotes up to which every task is told of them; there are at most as many as splits.
MOST_CUTS = 1_000_000
PIECES = "file string, start long, place int, record string"


def _pieces(begins_inside: Broadcast[dict[str, set[int]]], whole: bool, longest: int):
    """The records of each split that lie wholly in it, or the pieces of those that don't. Lines come in their order.

    The function takes all it needs with it, as the workers need not have this package; the starts of splits that begin inside
    quotes are broadcast, so that a worker reads them once and not with each task.
    """
    kinds = {"file": pa.string(), "start": pa.int64(), "place": pa.int32(), "record": pa.string()}

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size, odd, place, piece = None, [], 0, False, 0, False
        for batch in batches:
            out = []
            for file, start, line in zip(*(batch[c].to_pylist() for c in ("file", "start", "value"))):
                if (file, start) != at:
                    if held and not whole:  # open at the end of its split
                        out.append((*at, place, "\n".join(held)))
                    at, held, size, place = (file, start), [], 0, 0
                    odd = piece = start in begins_inside.value.get(file, ())
                held.append(line)
                size += len(line) + 1
                odd ^= line.count('"') % 2 == 1
                if not odd:
                    if piece != whole:
                        out.append((*at, place, "\n".join(held)))
                    held, size, place, piece = [], 0, place + 1, False
                elif size > longest:
                    raise ValueError(f"{file}: a record is longer than {longest} characters; is a quote never closed?")
            yield batch_of(out)
        if held and not whole:
            yield batch_of([(*at, place, "\n".join(held))])

    return records


def read_records(spark: SparkSession, path: str, longest: int = LONGEST) -> DataFrame:
    """``file, record`` for each record of the file(s): text up to a line break outside quotes, which is not part of it.

    A carriage return before that line break is dropped; one inside quotes stays. A quote inside a quoted field is doubled,
    so it doesn't change the parity. Empty lines are records. A file whose last quote is never closed ends the job if that makes
    a record longer than ``longest`` in one split; else the rest of the file is its last record. The files are read twice, and
    once more if a cut lies inside quotes, when only the splits beside such cuts go through the search for pieces.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    splits = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    parities = splits.select("file", "start", (total % 2 == 1).alias("begins"), ((total + F.col("quotes")) % 2 == 1).alias("ends"))
    touched = parities.where("begins OR ends").limit(2 * MOST_CUTS + 1).collect()
    if len(touched) > 2 * MOST_CUTS:
        raise ValueError(f"more than {MOST_CUTS} cuts lie inside quotes; use larger splits")
    begins = defaultdict(set)
    for row in touched:
        if row.begins:
            begins[row.file].add(row.start)
    inside = spark.sparkContext.broadcast(dict(begins))
    whole = lines.mapInArrow(_pieces(inside, True, longest), PIECES).select("file", "record")
    if touched:
        beside = F.broadcast(spark.createDataFrame([(r.file, r.start, r.begins) for r in touched], "file string, start long, begins boolean"))
        pieces = lines.join(beside.select("file", "start"), ["file", "start"], "left_semi").mapInArrow(_pieces(inside, False, longest), PIECES)
        # The first piece of a split that begins inside quotes goes on; any other opens a record.
        opens = ~(F.col("begins") & (F.col("place") == 0))
        earlier = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, 0)
        numbered = pieces.join(beside, ["file", "start"]).withColumn("number", F.sum(opens.cast("long")).over(earlier))
        parts = F.array_sort(F.collect_list(F.struct("start", "place", "record")))
        joined = numbered.groupBy("file", "number").agg(parts.alias("parts"))
        text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
        whole = whole.unionByName(joined.select("file", text.alias("record")))
    return whole.withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_quoted_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The fields of each record as ``schema`` names and types them.

    A header is found by content, the names of ``schema`` in their order, so a file may be cut anywhere. Empty records are left out.
    """
    kept = DIALECT | {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    header = ",".join(T.StructType.fromDDL(schema).names)
    records = read_records(spark, path).where((F.col("record") != "") & (F.col("record") != header))
    return records.select(F.from_csv("record", schema, kept).alias("fields")).select("fields.*")
