"""Run one job from the command line: ``spark-submit run.py ...`` or ``python -m skyledger ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import JOBS, ROUTE_PRESETS, merge_job, run_job, state_job
from .session import build_session


def first_lines(spark: SparkSession, path: str, n: int) -> list[str]:
    """The first ``n`` lines of a written report in the order of its parts.

    They come from the report, which is small, not from running the analysis a second time.
    A reader takes large parts first, so each part is read by itself.
    """
    lines: list[str] = []
    for part in sorted(spark.read.text(path).inputFiles()):
        if len(lines) < n:
            lines += [row.value for row in spark.read.text(part).limit(n - len(lines)).collect()]
    return lines


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="skyledger", description=__doc__)
    parser.add_argument("analysis", choices=sorted(JOBS))
    parser.add_argument("--input_path", required=True, help="flights, a file or folder on any file system")
    parser.add_argument("--output_path", required=True, help="folder to replace with the report")
    parser.add_argument("--format", help="report format; each analysis has a default")
    parser.add_argument("--means_path", help="airport means to look up, as written by airport_mean")
    parser.add_argument("--rejects_path", help="folder to replace with the lines left out, each with its reason")
    parser.add_argument("--state_path", help="state of a route analysis: the input becomes a batch of it, the report covers all batches")
    parser.add_argument("--batch", help="name of the batch; one of that name is replaced")
    parser.add_argument("--preview", type=int, default=0, metavar="N", help="print N lines of the written report")
    args = parser.parse_args(arguments)
    formats = JOBS[args.analysis].formats
    if args.format and args.format not in formats:
        parser.error(f"{args.analysis} can be written as: {', '.join(formats)}")
    if bool(args.state_path) != bool(args.batch):
        parser.error("--state_path and --batch go together")
    if args.state_path and (args.analysis not in ROUTE_PRESETS or args.rejects_path):
        parser.error("only a route analysis keeps a state, and it writes no rejects")
    spark = build_session(f"skyledger {args.analysis}")
    try:
        if args.state_path:
            merge_job(spark, args.analysis, args.input_path, args.state_path, args.batch)
            state_job(spark, args.analysis, args.state_path, args.output_path, args.format)
        else:
            counts = run_job(spark, args.analysis, args.input_path, args.output_path, args.format, args.means_path, args.rejects_path)
            for name, lines in (counts or {}).items():
                if lines:
                    print(f"{name}: {lines}")
        if args.preview:
            for line in first_lines(spark, args.output_path, args.preview):
                print(line)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
