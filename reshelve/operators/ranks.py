"""Exact percentiles from counted values.

Samples are first counted per distinct value, so what is ranked grows with the number of
distinct milliseconds, not with the number of samples. Running counts are taken in two
steps, over spans of values and inside a span, so no window holds more than one span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reshelve.functions.nulls import complete

SPAN = 4096
GRID = 1000


def count_values(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count samples per group and distinct value, aggregating before the shuffle. Each value
    comes with the span it lies in; samples without a group or value are left out."""
    whole = F.col(value).cast("bigint")
    keyed = df.select(*by, F.floor(whole / SPAN).alias("span"), whole.alias("value"))
    return (keyed.where(complete(keyed, [*by, "span"]))
            .groupBy(*by, "span", "value").agg(F.count(F.lit(1)).alias("n")))


def rank_values(counts: DataFrame, by: list[str]) -> DataFrame:
    """Add to each counted value the ranks it covers (``before`` exclusive to ``upto``
    inclusive), the group's ``total`` and the next greater value.

    The counts are used twice and joined. Their keys are tested for null beforehand, as the
    join would test them on one side only; so both uses stay alike and share one shuffle.
    """
    spanned = counts.where(complete(counts, [*by, "span"]))
    group = Window.partitionBy(*by)
    along = group.orderBy("span")
    spans = (spanned.groupBy(*by, "span")
             .agg(F.sum("n").alias("span_n"), F.min("value").alias("span_min"))
             .select(*by, "span",
                     (F.sum("span_n").over(along) - F.col("span_n")).alias("span_before"),
                     F.lead("span_min").over(along).alias("span_next"),
                     F.sum("span_n").over(group).alias("total")))
    inside = Window.partitionBy(*by, "span").orderBy("value")
    return (spanned.join(spans, [*by, "span"])
            .withColumn("upto", F.col("span_before") + F.sum("n").over(inside))
            .select(*by, "value", "n", "total", "upto",
                    (F.col("upto") - F.col("n")).alias("before"),
                    F.coalesce(F.lead("value").over(inside), F.col("span_next")).alias("next")))


def _div(numerator: Column, denominator: Column) -> Column:
    """Integer quotient; dividing as doubles or decimals would round at large counts."""
    return F.call_function("div", numerator, denominator)


def _ceil_div(numerator: Column, denominator: Column) -> Column:
    return _div(numerator + denominator - 1, denominator)


def _thousandths(points: list[int] | None, low: Column, high: Column) -> Column:
    """The requested points between two bounds, as an array."""
    if points is None:
        return F.when(low <= high, F.sequence(low, high))
    return F.filter(F.array(*[F.lit(p).cast("bigint") for p in points]),
                    lambda p: (p >= low) & (p <= high))


def interpolated(ranked: DataFrame, by: list[str], points: list[int]) -> DataFrame:
    """Percentiles at position ``p * (n + 1)``, interpolated, clamped to the extremes.

    Points are in thousandths. Each ranked value emits just the points whose lower rank it
    covers, so nothing is joined or compared pairwise.
    """
    n1 = F.col("total") + 1
    low = F.when(F.col("before") == 0, F.lit(0)).otherwise(
        _ceil_div((F.col("before") + 1) * GRID, n1))
    high = F.when(F.col("upto") == F.col("total"), F.lit(GRID)).otherwise(
        _ceil_div((F.col("upto") + 1) * GRID, n1) - 1)
    position = F.col("point") * n1
    rank = _div(position, F.lit(GRID))
    fraction = F.pmod(position, F.lit(GRID)) / GRID
    between = (rank >= 1) & (rank < F.col("total")) & (rank == F.col("upto"))
    value = F.col("value").cast("double")
    return (ranked
            .select(*by, "value", "next", "total", "upto",
                    F.explode(_thousandths(points, low.cast("bigint"), high.cast("bigint")))
                    .alias("point"))
            .select(*by, "point",
                    F.when(between, value + fraction * (F.col("next") - F.col("value")))
                    .otherwise(value).alias("value")))


def stepped(ranked: DataFrame, by: list[str]) -> DataFrame:
    """For each thousandth the smallest value that more than that share of samples reach,
    without interpolation; the last point is the maximum."""
    total = F.col("total")
    low = _ceil_div(F.col("before") * GRID, total)
    high = F.when(F.col("upto") == total, F.lit(GRID).cast("bigint")).otherwise(
        _ceil_div(F.col("upto") * GRID, total) - 1)
    return ranked.select(
        *by, F.explode(_thousandths(None, low, high)).alias("point"),
        F.col("value").cast("double").alias("value"))


def pivoted(points: DataFrame, by: list[str], names: dict[int, str]) -> DataFrame:
    """One column per percentile."""
    columns = [F.max(F.when(F.col("point") == p, F.col("value"))).alias(name)
               for p, name in names.items()]
    return points.groupBy(*by).agg(*columns)
