"""Percentiles from a stored table of counts, without the log.

Response times are counted per label, outcome, minute and log-linear bucket: times below 2 ** BITS
each have a bucket of their own, greater ones share one with those that have the same first BITS
binary digits. A time and the middle of its bucket differ by less than one part in 2 ** BITS, and so
does every percentile from that of the log, also one between two samples.

Counts of parts of a log add up, so a table grows by appending the counts of what is new, and
percentiles of any labels, outcomes and span of minutes come from the sums. Its size depends on the
minutes and the spread of the times, not on the number of samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reshelve.operators.ranks import SPAN, interpolated, pivoted, rank_values
from reshelve.plans.latency import MINUTE, PERCENTILES, bucket, ended, failed

BITS = 8
KEYS = ("label", "failed", "bucket_ms", "value")


def middle(value: Column, bits: int = BITS) -> Column:
    """The middle of the bucket of a whole number; those of negative ones mirror the others."""
    size = F.abs(value)
    shift = F.greatest(F.length(F.bin(size)) - bits, F.lit(0)).cast("int")
    low = F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)
    half = F.call_function("shiftright", F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), shift) - 1, F.lit(1))
    return F.when(value < 0, -(low + half)).otherwise(low + half)


def count_table(log: DataFrame, value: str = "elapsed", width: int = MINUTE,
                bits: int = BITS) -> DataFrame:
    """label, failed, bucket_ms, value and n: samples by label, outcome, the minute they end in and
    the middle of their bucket. Samples without a label or time are left out."""
    whole = F.col(value).cast("bigint")
    rows = log.select("label", F.coalesce(failed(), F.lit(False)).alias("failed"),
                      bucket(ended(), width), middle(whole, bits).alias("value"))
    return (rows.where("label IS NOT NULL AND value IS NOT NULL AND bucket_ms IS NOT NULL")
            .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")))


def append_counts(log: DataFrame, path: str, value: str = "elapsed", width: int = MINUTE,
                  bits: int = BITS) -> None:
    """Add the counts of a log, or of a part of it, to a stored table."""
    count_table(log, value, width, bits).write.mode("append").parquet(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; counts of the same bucket may stand in several rows."""
    return spark.read.schema(
        "label string, failed boolean, bucket_ms bigint, value bigint, n bigint").parquet(path)


def percentiles_of(counts: DataFrame, by: list[str], points: dict[int, str] | None = None,
                   start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """Interpolated percentiles per group of a table of counts, of the minutes from ``start_ms`` on
    and before ``end_ms``. ``by`` may name the label, the outcome and the minute, or nothing."""
    if start_ms is not None:
        counts = counts.where(F.col("bucket_ms") >= start_ms)
    if end_ms is not None:
        counts = counts.where(F.col("bucket_ms") < end_ms)
    points = points or PERCENTILES
    summed = (counts.groupBy(*by, "value").agg(F.sum("n").alias("n"))
              .withColumn("span", F.floor(F.col("value") / SPAN)))
    return pivoted(interpolated(rank_values(summed, by), by, list(points)), by, points)


def compact_counts(counts: DataFrame) -> DataFrame:
    """The same table with one row per bucket."""
    return counts.groupBy(*KEYS).agg(F.sum("n").alias("n"))
