"""Ranges of ids: totals over a range, ids inside any range, rows inside each range.

None of these makes a row per id of a range, so what a range costs doesn't depend on its width.

* A total over a range is the difference of two running totals: up to its end, and up to the id
  before its start. Running totals are worked out per span of ids. Each span starts with what all
  spans before it hold, which is a running total over spans, found the same way; so no window
  holds more than the ids of one span, and nothing is joined.
* An id lies inside some range if more ranges have started up to there than have ended, which is
  a running total as well.
* Rows are joined to ranges by bins of ids. A range looks at bins at least as wide as itself, so
  at two at most, and a row is looked for in the bin sizes in use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Ids per span are 2 ** 16, and as many spans are in a span of spans. Ids below 2 ** 48 leave no
# more than that in the last step either, which takes all there are.
SPAN_BITS = 16
LEVELS = 3
# Bin sizes are powers of 16, so a bin is up to 16 times as wide as a range that uses it.
BIN_BITS = 4
SHIFTS = range(0, 64, BIN_BITS)


def running_totals(values: DataFrame, points: DataFrame, keys: Sequence[str] = (),
                   levels: int = LEVELS) -> DataFrame:
    """The sums of all columns of ``values`` up to and including each of the ``points``, per key.

    ``values`` has ``id``, the keys and the columns to sum, ``points`` has ``id`` and the keys,
    each combination once. Nothing up to a point gives null.
    """
    sums = [c for c in values.columns if c not in (*keys, "id")]
    span = F.shiftright("id", SPAN_BITS)
    values = values.where("id IS NOT NULL").groupBy(*keys, "id").agg(*[F.sum(c).alias(c) for c in sums])
    rows = values.withColumns({"step": F.lit(1)}).unionByName(
        points.select(*keys, "id").withColumn("step", F.lit(2)), allowMissingColumns=True)
    if levels > 1:
        # What stands before each span with points is the running total up to the span before it.
        whole = values.withColumn("id", span)
        wanted = points.select(*keys, (span - 1).alias("id")).distinct()
        before = running_totals(whole, wanted, keys, levels - 1)
        rows = rows.unionByName(before.withColumns({
            "id": F.shiftleft(F.col("id") + 1, SPAN_BITS), "step": F.lit(0)}))
        rows = rows.withColumn("span", span)
    window = (Window.partitionBy(*keys, *(["span"] if levels > 1 else []))
              .orderBy("id", "step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.select(*keys, "id", "step", *[F.sum(c).over(window).alias(c) for c in sums])
            .where("step = 2").select(*keys, "id", *sums))


def _bigint(column: str) -> Column:
    return F.col(column).cast("bigint")


def range_totals(ranges: DataFrame, values: DataFrame, start: str, end: str,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Each range with the sums of the columns of ``values`` whose ``id`` is inside, 0 where there
    are none. A range that ends before it starts or has a null key holds nothing, one without
    bounds is left out, and so are values without an id."""
    sums = [c for c in values.columns if c not in (*keys, "id")]
    before, last = _bigint(start) - 1, _bigint(end)
    bounds = ranges.where(F.col(start) <= F.col(end))
    ends = bounds.select(*keys, F.explode(F.array(before, last)).alias("id")).distinct()
    totals = running_totals(values, ends, keys)

    def side(name: str) -> DataFrame:
        return totals.select(*keys, F.col("id").alias(name),
                             *[F.col(c).alias(f"{name}_{c}") for c in sums])

    found = (ranges.where(F.col(start).isNotNull() & F.col(end).isNotNull())
             .withColumns({"__before": before, "__last": last})
             .join(side("__before"), [*keys, "__before"], "left")
             .join(side("__last"), [*keys, "__last"], "left"))

    def total(c: str) -> Column:
        upto, below = (F.coalesce(f"{name}_{c}", F.lit(0)) for name in ("__last", "__before"))
        return F.when(F.col(start) <= F.col(end), upto - below).otherwise(F.lit(0)).alias(c)

    return found.select(*ranges.columns, *map(total, sums))


def covered(ids: DataFrame, ranges: DataFrame, start: str, end: str) -> DataFrame:
    """The ``id`` values, once each, that are inside any of the ranges."""
    turns = F.explode(F.array(F.struct(_bigint(start).alias("id"), F.lit(1).alias("open")),
                              F.struct((_bigint(end) + 1).alias("id"), F.lit(-1).alias("open"))))
    changes = (ranges.where(F.col(start) <= F.col(end)).select(start, end).distinct()
               .select(turns.alias("turn")).select("turn.*"))
    wanted = ids.select(_bigint("id").alias("id")).distinct()
    return running_totals(changes, wanted).where("open > 0").select("id")


def rows_in_ranges(ranges: DataFrame, rows: DataFrame, key: str, start: str,
                   end: str) -> DataFrame:
    """Every range with each of the rows whose ``key`` is inside."""
    width = _bigint(end) - _bigint(start)
    bits = F.when(width == 0, F.lit(0)).otherwise(F.length(F.bin(width)))
    shift = (F.ceil(bits / BIN_BITS) * BIN_BITS).cast("int")
    bins = F.array_distinct(F.array(F.call_function("shiftright", _bigint(start), F.col("__shift")),
                                    F.call_function("shiftright", _bigint(end), F.col("__shift"))))
    asked = (ranges.where(F.col(start) <= F.col(end)).withColumn("__shift", shift)
             .withColumn("__bin", F.explode(bins)))
    used = asked.select("__shift").distinct()  # at most one row per bin size
    held = (rows.withColumn("__shift", F.explode(F.array(*map(F.lit, SHIFTS))))
            .join(F.broadcast(used), "__shift", "left_semi")
            .withColumn("__bin", F.call_function("shiftright", _bigint(key), F.col("__shift"))))
    return (asked.join(held, ["__shift", "__bin"])
            .where(F.col(key).between(F.col(start), F.col(end))).drop("__shift", "__bin"))
