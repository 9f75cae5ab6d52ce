"""Read request logs written as CSV with a header."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from reshelve.schema import LOG_COLUMNS
from reshelve.sources.records import read_csv
from reshelve.sources.tables import path_exists

log = logging.getLogger(__name__)


def conform_log(df: DataFrame) -> DataFrame:
    """Select the known log columns by header name, typed, with the defaults filled in."""
    columns = []
    for header, (name, kind, default) in LOG_COLUMNS.items():
        value = F.col(f"`{header}`").cast(kind) if header in df.columns else F.lit(None).cast(kind)
        if default is not None:
            value = F.coalesce(value, F.lit(default).cast(kind))
        columns.append(value.alias(name))
    return df.select(*columns)


def read_log(spark: SparkSession, path: str, multi_line: bool = True,
             split: bool = True) -> DataFrame:
    """Read a log; one that does not exist is reported and read as empty.

    Quotes inside a value are doubled, and values may hold line breaks. Files are split all the
    same, see :mod:`reshelve.sources.records`; logs known to hold no such line breaks are read
    once less with ``multi_line`` off. ``split`` off reads each file by one task, for files with
    quotes inside values that have none around them.
    """
    if not path_exists(spark, path):
        log.warning("request log %s not found, going on without samples", path)
        headers = ", ".join(f"`{header}` string" for header in LOG_COLUMNS)
        raw = spark.createDataFrame([], headers)
    elif multi_line and split:
        raw = read_csv(spark, path)
    else:
        raw = spark.read.csv(path, header=True, escape='"', multiLine=multi_line)
    return conform_log(raw)


def convert_log(spark: SparkSession, path: str, target: str, multi_line: bool = True,
                split: bool = True) -> DataFrame:
    """Convert a log to Parquet once, and read that."""
    read_log(spark, path, multi_line, split).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
