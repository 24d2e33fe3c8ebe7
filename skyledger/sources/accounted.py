"""Reading with account of every line: kept lines, left-out lines with the reason, and their numbers, from one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.cleaning import STRICT, Fields, clean
from ..operators.rejects import reject_reason, reject_reasons
from ..session import scratch_folder
from .flights import read_flights_text


@dataclass(frozen=True)
class Accounted:
    """What became of the lines.

    flights   typed, cleaned flights, as ``read_flights`` gives them
    rejects   the other lines' fields as text, with ``reason`` and the ``file`` they stand in
    lines     number of lines read
    reasons   number of lines left out for each possible reason, zeros included; with the flights they add up to ``lines``
    """

    flights: DataFrame
    rejects: DataFrame
    lines: int
    reasons: dict[str, int]


def read_accounted(
    spark: SparkSession,
    path: str,
    fields: Fields = STRICT,
    keep_rest: bool = False,
    header: Sequence[str] | None = None,
    airport: Fields | None = None,
) -> Accounted:
    """``read_flights`` that loses no line from sight.

    The files are scanned once. The scan writes the fields read as Parquet in the shared folder, each line with its reason,
    and the counts come with it; reports then read the kept lines from there, so several reports cost no second scan.
    Kept lines and rejects go to the same files: to part them, each task would first have to sort all its lines.
    With ``airport``, a line is kept if it is good for the airport's mean.
    """
    read = airport or fields
    text = read_flights_text(spark, path, keep_rest, header, fields.columns)
    judged = text.withColumns({"reason": reject_reason(read), "file": F.input_file_name()})
    reasons = list(reject_reasons(read))
    counted = Observation()
    counts = [F.count_if(F.col("reason") == name).alias(f"reason_{i}") for i, name in enumerate(reasons)]
    observed = judged.observe(counted, F.count(F.lit(1)).alias("lines"), *counts)
    place = scratch_folder(spark, "accounted")
    observed.write.parquet(place)
    written = spark.read.schema(judged.schema).parquet(place)
    kept = written.where("reason IS NULL").select(*text.columns)
    rejects = written.where("reason IS NOT NULL")
    found = counted.get
    return Accounted(
        clean(kept, fields, airport), rejects, found["lines"], {name: found[f"reason_{i}"] for i, name in enumerate(reasons)}
    )
