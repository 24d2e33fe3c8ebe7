"""The airport-mean table that one job writes and the next one looks up."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

MEANS_SCHEMA = "origin string, airport_mean double"


def read_airport_means(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Tab-separated ``airport, mean`` lines.

    A path that does not exist is an error, unless ``missing_ok``: then the table is empty,
    and every airport looked up in it gets the default mean.
    """
    try:
        return spark.read.option("sep", "\t").schema(MEANS_SCHEMA).csv(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MEANS_SCHEMA)
        raise
