"""Set the measured queries of several systems side by side."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reshelve.plans import latency
from reshelve.schema import CATALOGUE, CATALOGUE_SCHEMA
from reshelve.session import build_session
from reshelve.sinks.staged import write_report
from reshelve.sources.request_log import read_log


def catalogue(spark: SparkSession, rows=None) -> DataFrame:
    """The queries to compare, one row per query and system."""
    return spark.createDataFrame(CATALOGUE if rows is None else rows, CATALOGUE_SCHEMA)


def compare(stats: DataFrame, queries: DataFrame) -> DataFrame:
    """Attach the per-label rollup to the catalogue, with best, worst and relative scale.

    A label without samples keeps its row with ``has_data`` false. The best and the worst
    average of a query are marked where more than one system has data; ties are all marked,
    best before worst. The scale is the average in percent of the query's greatest, at
    least 2.
    """
    query = Window.partitionBy("query_id")
    average = F.col("avg_ms")
    several = F.count("avg_ms").over(query) > 1
    best = several & (average == F.min("avg_ms").over(query))
    worst = several & (average == F.max("avg_ms").over(query)) & ~F.col("is_best")
    longest = F.greatest(F.lit(1.0), F.max("avg_ms").over(query))
    return (queries.join(stats, "label", "left")
            .withColumn("has_data", F.col("samples").isNotNull())
            .withColumn("is_best", F.coalesce(best, F.lit(False)))
            .withColumn("is_worst", F.coalesce(worst, F.lit(False)))
            .withColumn("scale_pct", F.greatest(average / longest * 100, F.lit(2.0)))
            .withColumn("scale_pct", F.when(F.col("has_data"), F.col("scale_pct"))))


def report(spark: SparkSession, log: str, target: str, fmt: str = "csv",
           multi_line: bool = True) -> DataFrame:
    """From a request log to the written comparison."""
    found = compare(latency.rollup(read_log(spark, log, multi_line)), catalogue(spark))
    write_report(found.orderBy("query_id", "system"), target, fmt)
    return found


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(description="Compare the queries of a request log.")
    parser.add_argument("log", help="CSV file, folder or pattern")
    parser.add_argument("target", help="folder of the report")
    parser.add_argument("--format", default="csv", choices=("csv", "json", "parquet"))
    parser.add_argument("--single-line", action="store_true",
                        help="no value holds a line break, so files can be split")
    args = parser.parse_args(argv)
    spark = build_session("comparison")
    try:
        report(spark, args.log, args.target, args.format, not args.single_line)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
