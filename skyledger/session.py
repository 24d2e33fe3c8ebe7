"""Session for stand-alone runs and the shared folder for tables written along the way."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths given out to each application and not yet released.
_SCRATCH: dict[str, list[str]] = {}


def build_session(app_name: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on.

    The master, memory and partition counts belong to ``spark-submit``; ``master`` is for
    tests and the bench only. Adaptive execution merges small shuffle partitions, so a
    cluster run can set ``spark.sql.shuffle.partitions`` for its largest shuffle.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local-mode session,
    whose executors live on this machine, may fall back to a temporary folder. What is
    written there stays until ``release_scratch``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        shared = os.path.join(tempfile.gettempdir(), "skyledger")
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Remove the tables that this session has written along the way.

    To be called by whoever has finished with the results: a result is read from such tables.
    """
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def write_and_reread(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where two branches of a plan need the same aggregate: the input is scanned once,
    a lost executor costs no recomputation, and the table's size is known to the planner.
    """
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
