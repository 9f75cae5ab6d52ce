"""Request-log analytics: rollups, percentiles, Apdex, histograms and series over time.

Input frames have the columns of :func:`reshelve.sources.request_log.read_log`. Series over
time take the bucket width in milliseconds; unless stated otherwise a sample belongs to the
bucket in which it ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reshelve.functions.rounding import ratio, round_binary
from reshelve.operators.ranks import (
    count_values, interpolated, pivoted, rank_values, stepped)

TOTAL = "Total"
MINUTE = 60_000
SATISFIED_MS = 500
TOLERATED_MS = 1500
PERCENTILES = {500: "median", 900: "p90", 950: "p95", 990: "p99"}


def failed() -> Column:
    """Whether a sample failed; anything but a spelling of "false" is a success."""
    return F.lower("success") == "false"


def ended() -> Column:
    return F.col("start_ms") + F.col("elapsed")


def bucket(instant: Column, width: int) -> Column:
    """Start of the tumbling bucket an instant falls in, epoch milliseconds."""
    return (instant - F.pmod(instant, F.lit(width))).alias("bucket_ms")


def rollup(log: DataFrame) -> DataFrame:
    """Per label: counts, extremes, average, error share and requests per busy second."""
    count, elapsed = F.col("samples"), F.col("total_ms")
    return (log.groupBy("label")
            .agg(F.count(F.lit(1)).alias("samples"),
                 F.sum("elapsed").alias("total_ms"),
                 F.min("elapsed").alias("min_ms"),
                 F.max("elapsed").alias("max_ms"),
                 F.count_if(failed()).alias("errors"))
            .withColumn("avg_ms", round_binary(ratio(elapsed, count), 1))
            .withColumn("error_pct", round_binary(ratio(F.col("errors"), count) * 100, 1))
            .withColumn("busy_rate", round_binary(ratio(count, elapsed / 1000), 2)))


def _with_total(per_label: DataFrame, *columns: Column, also: tuple[str, ...] = ()) -> DataFrame:
    """Aggregate an already aggregated frame per label and over all labels. The grouping
    sets are expanded from one row per label (and ``also``), not from samples."""
    sets = [["label", *also], list(also)]
    return (per_label.groupingSets(sets, "label", *also)
            .agg(*columns, F.grouping("label").alias("is_total"))
            .withColumn("label", F.when(F.col("is_total") == 1, TOTAL).otherwise(F.col("label"))))


def percentiles(log: DataFrame, by: list[str], points: dict[int, str] | None = None,
                value: str = "elapsed") -> DataFrame:
    """Interpolated percentiles per group, one column each; points are thousandths."""
    points = points or PERCENTILES
    ranked = rank_values(count_values(log, by, value), by)
    return pivoted(interpolated(ranked, by, list(points)), by, points)


def percentiles_with_total(log: DataFrame, points: dict[int, str] | None = None) -> DataFrame:
    """Percentiles per label and over all samples."""
    points = points or PERCENTILES
    counts = _with_total(count_values(log, ["label"], "elapsed"), F.sum("n").alias("n"),
                         also=("span", "value"))
    by = ["label", "is_total"]
    return pivoted(interpolated(rank_values(counts, by), by, list(points)), by, points)


def totals(log: DataFrame) -> DataFrame:
    """Counts, mean, extremes and rates per label and over all samples. Rates are per second
    of wall clock, from the first start to the last end."""
    per_label = log.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(failed()).alias("failures"),
        F.sum("elapsed").alias("sum_ms"), F.min("elapsed").alias("low"),
        F.max("elapsed").alias("high"), F.min("start_ms").alias("first"),
        F.max(ended()).alias("last"), F.sum("bytes").alias("received"),
        F.sum("sent_bytes").alias("sent"))
    summed = _with_total(
        per_label,
        F.sum("n").alias("samples"), F.sum("failures").alias("errors"),
        F.sum("sum_ms").alias("sum_ms"), F.min("low").alias("min_ms"),
        F.max("high").alias("max_ms"), F.min("first").alias("first"),
        F.max("last").alias("last"), F.sum("received").alias("received"),
        F.sum("sent").alias("sent"))
    seconds = (F.col("last") - F.col("first")) / 1000
    return summed.select(
        "label", "is_total", "samples", "errors",
        (ratio(F.col("errors"), F.col("samples")) * 100).alias("error_pct"),
        ratio(F.col("sum_ms"), F.col("samples")).alias("mean_ms"), "min_ms", "max_ms",
        ratio(F.col("samples"), seconds).alias("wall_rate"),
        ratio(F.coalesce("received", F.lit(0)) / 1024, seconds).alias("received_kb_rate"),
        ratio(F.coalesce("sent", F.lit(0)) / 1024, seconds).alias("sent_kb_rate"))


def statistics(log: DataFrame) -> DataFrame:
    """The full table: totals and percentiles per label and over all samples."""
    return totals(log).join(percentiles_with_total(log), ["label", "is_total"])


def _error_type() -> Column:
    return F.concat_ws("/", F.col("response_code"), F.col("response_message"))


def error_types(log: DataFrame) -> DataFrame:
    """Failed samples by error, as a share of all errors and of all samples."""
    kinds = (log.where(failed()).groupBy(_error_type().alias("error"))
             .agg(F.count(F.lit(1)).alias("errors")))
    seen = log.agg(F.count(F.lit(1)).alias("samples"),
                   F.count_if(failed()).alias("failures"))
    return (kinds
            .withColumn("pct_of_errors",
                        F.col("errors") * 100.0 / seen.select("failures").scalar())
            .withColumn("pct_of_samples",
                        F.col("errors") * 100.0 / seen.select("samples").scalar())
            .orderBy(F.desc("errors"), "error"))


def top_errors(log: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent errors of each label."""
    order = Window.partitionBy("label").orderBy(F.desc("errors"), "error")
    return (log.where(failed()).groupBy("label", _error_type().alias("error"))
            .agg(F.count(F.lit(1)).alias("errors"))
            .withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= k))


def apdex(log: DataFrame, satisfied: int = SATISFIED_MS,
          tolerated: int = TOLERATED_MS) -> DataFrame:
    """Apdex per label and overall; a failed sample counts as frustrated."""
    good = ~failed() & (F.col("elapsed") <= satisfied)
    fair = ~failed() & (F.col("elapsed") > satisfied) & (F.col("elapsed") <= tolerated)
    per_label = log.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(good).alias("good"),
        F.count_if(fair).alias("fair"))
    return (_with_total(per_label, F.sum("n").alias("samples"), F.sum("good").alias("satisfied"),
                        F.sum("fair").alias("tolerating"))
            .withColumn("apdex", (F.col("satisfied") + F.col("tolerating") / 2) / F.col("samples")))


def bands(log: DataFrame, satisfied: int = SATISFIED_MS,
          tolerated: int = TOLERATED_MS) -> DataFrame:
    """Samples by response band, errors apart. Every band is present."""
    band = (F.when(failed(), 3).when(F.col("elapsed") <= satisfied, 0)
            .when(F.col("elapsed") <= tolerated, 1).otherwise(2))
    names = [f"<= {satisfied} ms", f"> {satisfied} ms and <= {tolerated} ms",
             f"> {tolerated} ms", "error"]
    counts = log.agg(*[F.count_if(band == i).alias(f"band_{i}") for i in range(4)])
    rows = F.array(*[F.struct(F.lit(i).alias("band"), F.lit(name).alias("name"),
                              F.col(f"band_{i}").alias("samples"))
                     for i, name in enumerate(names)])
    return counts.select(F.inline(rows))


def outcome_share(log: DataFrame) -> DataFrame:
    """Percentages of successes and failures."""
    counts = log.agg(F.count(F.lit(1)).alias("n"), F.count_if(failed()).alias("failures"))
    return counts.select(
        (ratio(F.col("n") - F.col("failures"), F.col("n")) * 100).alias("ok_pct"),
        (ratio(F.col("failures"), F.col("n")) * 100).alias("ko_pct"))


def histogram(log: DataFrame, width: int = 100) -> DataFrame:
    """Samples per label and bucket of response time."""
    return (log.groupBy("label", (F.floor(F.col("elapsed") / width) * width).alias("from_ms"))
            .agg(F.count(F.lit(1)).alias("samples")))


def percentile_curve(log: DataFrame) -> DataFrame:
    """Response time by percentile, 0 to 100 in steps of 0.1, per label."""
    ranked = rank_values(count_values(log, ["label"], "elapsed"), ["label"])
    return stepped(ranked, ["label"]).select(
        "label", (F.col("point") / 10).alias("percentile"), F.col("value").alias("elapsed"))


def means_over_time(log: DataFrame, width: int = MINUTE) -> DataFrame:
    """Mean response time, latency and connect time per label and bucket."""
    return (log.groupBy("label", bucket(ended(), width))
            .agg(F.avg("elapsed").alias("mean_elapsed"), F.avg("latency").alias("mean_latency"),
                 F.avg("connect").alias("mean_connect")))


def percentiles_over_time(log: DataFrame, width: int = MINUTE) -> DataFrame:
    """Extremes and percentiles of successful samples per bucket. The extremes are taken
    from the same counted values as the percentiles."""
    by = ["bucket_ms"]
    good = log.where(~failed()).select("elapsed", bucket(ended(), width))
    points = {0: "min_ms", 1000: "max_ms", **PERCENTILES}
    return percentiles(good, by, points)


def _per_second(width: int) -> Column:
    return F.count(F.lit(1)) / (width / 1000)


def hits_over_time(log: DataFrame, width: int = MINUTE) -> DataFrame:
    """Requests started per second."""
    return log.groupBy(bucket(F.col("start_ms"), width)).agg(_per_second(width).alias("rate"))


def codes_over_time(log: DataFrame, width: int = MINUTE) -> DataFrame:
    """Responses per second by response code."""
    return (log.groupBy("response_code", bucket(ended(), width))
            .agg(_per_second(width).alias("rate")))


def transactions_over_time(log: DataFrame, width: int = MINUTE) -> DataFrame:
    """Finished requests per second by label and outcome."""
    return (log.groupBy("label", failed().alias("failed"), bucket(ended(), width))
            .agg(_per_second(width).alias("rate")))


def total_over_time(log: DataFrame, width: int = MINUTE) -> DataFrame:
    """Finished requests per second by outcome."""
    return (log.groupBy(failed().alias("failed"), bucket(ended(), width))
            .agg(_per_second(width).alias("rate")))


def thread_group() -> Column:
    """Thread names end in group and thread number; what precedes names the group."""
    return F.regexp_replace("thread_name", r" \d+-\d+$", "")


def threads_over_time(log: DataFrame, width: int = MINUTE) -> DataFrame:
    """Mean number of active threads per thread group and bucket."""
    return (log.groupBy(thread_group().alias("thread_group"), bucket(ended(), width))
            .agg(F.avg("all_threads").alias("mean_threads")))


def elapsed_by_threads(log: DataFrame) -> DataFrame:
    """Mean response time per label and number of active threads."""
    return log.groupBy("label", "all_threads").agg(F.avg("elapsed").alias("mean_elapsed"))


def elapsed_by_mean_threads(log: DataFrame) -> DataFrame:
    """Mean number of active threads and mean response time per label."""
    return log.groupBy("label").agg(F.avg("all_threads").alias("mean_threads"),
                                    F.avg("elapsed").alias("mean_elapsed"))


def bytes_over_time(log: DataFrame, width: int = MINUTE) -> DataFrame:
    """Bytes received and sent per second."""
    seconds = width / 1000
    return (log.groupBy(bucket(ended(), width))
            .agg((F.sum("bytes") / seconds).alias("received_rate"),
                 (F.sum("sent_bytes") / seconds).alias("sent_rate")))


def median_by_load(log: DataFrame, value: str = "elapsed", width: int = 1000) -> DataFrame:
    """Median of ``value`` against the request rate, successes and failures apart.

    Buckets of equal rate are pooled. The rate counts all samples of a bucket, also those that
    lack the value. Samples are counted per bucket and value first, and only counts are joined.
    """
    counted = count_values(log.select(value, failed().alias("failed"), bucket(ended(), width)),
                           ["bucket_ms", "failed"], value)
    rates = (log.groupBy(bucket(ended(), width))
             .agg((F.count(F.lit(1)) * 1000 / width).alias("rate")))
    by = ["rate", "failed"]
    pooled = (counted.join(rates, "bucket_ms").groupBy(*by, "span", "value")
              .agg(F.sum("n").alias("n")))
    median = {500: f"median_{value}"}
    return pivoted(interpolated(rank_values(pooled, by), by, [500]), by, median)
