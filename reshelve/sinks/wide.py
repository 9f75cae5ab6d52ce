"""Load the wide table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from reshelve.operators.wide import (
    BUCKET, buckets_for, cluster_by, refuse_null_keys, typed, upsert, with_bucket)
from reshelve.schema import WIDE_KEY, WIDE_SCHEMA
from reshelve.session import shuffles_removed, stored
from reshelve.sources.snapshots import (
    Snapshot, commit, load_folder, read_snapshot, written_buckets)
from reshelve.sources.stores import read_buckets, read_wide

ATTEMPTS = 10
# Rows of a bucket that one task merges, about a hundred megabytes.
ROWS_PER_PIECE = 500_000


def write_wide(df: DataFrame, path: str, fmt: str = "parquet", truncate: bool = False,
               buckets: int | None = None, partitions: int | None = None,
               connector: Mapping[str, str] | None = None,
               schema: T.StructType = WIDE_SCHEMA) -> None:
    """Upsert rows into the wide table, or replace its content with ``truncate``.

    Files are laid out by customer: a folder per bucket of customers, sorted by key inside. The
    number of buckets is set when the table is created, from the number of rows if it is not
    given, and kept by later loads. A load writes folders of its own, for the buckets it has rows
    for, and beside its rows those of the table it leaves in them. Other buckets are not
    touched, and readers need not merge anything. The load is seen when its snapshot is committed; one that dies before
    leaves the table as it was. With ``connector`` options the rows go to the store the format
    names, which does all that itself.
    """
    rows = refuse_null_keys(upsert(typed(df, schema)), schema)
    if connector is not None:
        (cluster_by(rows, partitions=partitions).write.format(fmt)
         .mode("overwrite" if truncate else "append").options(**connector).save())
        return
    spark = df.sparkSession
    seen = None if truncate else read_snapshot(spark, path)
    if seen:
        buckets = seen.buckets
    elif buckets is None:
        rows = stored(rows)
        buckets = buckets_for(rows.count())
    new, load, found, mixed = with_bucket(rows, buckets), None, set(), False

    def write(laid_out: DataFrame) -> None:
        with shuffles_removed(spark):
            (laid_out.write.format(fmt).mode("append").partitionBy(BUCKET)
             .save(load_folder(path, load)))

    for _ in range(ATTEMPTS):
        seen = read_snapshot(spark, path)
        held = set(seen.loads) if seen and not truncate else set()
        if held and seen.buckets != buckets:
            raise RuntimeError(f"the table under {path} was replaced during a load")
        if load is None or mixed:  # beside the rows lie those that an earlier version left
            load, mixed = uuid.uuid4().hex, False
            write(cluster_by(new, (BUCKET,), (BUCKET, *WIDE_KEY), partitions))
            found = written_buckets(spark, load_folder(path, load), BUCKET)
        both = found & held
        if both:
            mine = Snapshot(0, buckets, schema.json(), dict.fromkeys(found, load))
            counts = _rows_left(spark, path, seen, mine, both)
            if counts:
                mixed = True
                keys = _keys_only(read_buckets(spark, path, mine, set(counts)))
                write(_replaced(spark, path, seen, keys, counts, set(counts), left_only=True))
        own = {**(seen.loads if held else {}), **dict.fromkeys(found, load)}
        version = seen.version + 1 if seen else 0
        if commit(spark, path, Snapshot(version, buckets, schema.json(), own)):
            return
    raise RuntimeError(f"other loads kept committing under {path}")


def _rows_per_bucket(rows: DataFrame) -> dict[int, int]:
    """The number of rows in each bucket, a few thousand numbers at most."""
    with shuffles_removed(rows.sparkSession):
        return {r[BUCKET]: r["count"] for r in rows.groupBy(BUCKET).count().collect()}


def _rows_left(spark: SparkSession, path: str, seen: Snapshot, mine: Snapshot,
               both: set[int]) -> dict[int, int]:
    """The number of rows of a load in each bucket where it leaves rows of the table.

    Only keys are compared. The lines of an order are a bit each of a number per 64 of them, and
    these numbers are made before the shuffle.
    """
    def lines(snapshot: Snapshot, name: str) -> DataFrame:
        bit, none = F.expr("shiftleft(1L, int(line_number & 63))"), F.lit(0).cast("bigint")
        return read_buckets(spark, path, snapshot, both).select(
            BUCKET, *WIDE_KEY[:2], _block(),
            *[(bit if n == name else none).alias(n) for n in ("held", "loaded")])

    orders = (lines(seen, "held").unionByName(lines(mine, "loaded"))
              .groupBy(BUCKET, *WIDE_KEY[:2], "block")
              .agg(F.bit_or("held").alias("held"), F.bit_or("loaded").alias("loaded")))
    left = F.bit_count(F.col("held").bitwiseAND(F.bitwise_not("loaded")))
    with shuffles_removed(spark):
        found = (orders.groupBy(BUCKET)
                 .agg(F.sum(F.bit_count("loaded")).alias("loaded"), F.sum(left).alias("left"))
                 .where("left > 0").collect())
    return {r[BUCKET]: r["loaded"] for r in found}


def _block() -> Column:
    """Number of 64 line numbers that stay together, as the lines of an order compress well."""
    return F.shiftright("line_number", 6).alias("block")


def _keys_only(rows: DataFrame) -> DataFrame:
    """The same rows with nulls for all but bucket and key."""
    return rows.select(*[
        F.col(f.name) if f.name in (BUCKET, *WIDE_KEY) else F.lit(None).cast(f.dataType).alias(f.name)
        for f in rows.schema])


def _replaced(spark: SparkSession, path: str, seen: Snapshot, new: DataFrame,
              counts: Mapping[int, int], both: set[int], left_only: bool = False) -> DataFrame:
    """The rows of a load with those of the table it leaves in its buckets, laid out, or with
    ``left_only`` just the latter; then of the load only the keys matter.

    All rows are shuffled once, to pieces of a bucket by key: as many as its rows need, so that a
    bucket with a large customer has more. New and old rows of a key meet there, and the new one
    stays.
    """
    old = read_buckets(spark, path, seen, both)
    held = _rows_per_bucket(old)
    pieces = spark.createDataFrame(
        [(b, max(1, -(-(counts.get(b, 0) + held.get(b, 0)) // ROWS_PER_PIECE)))
         for b in set(counts) | set(held)], f"{BUCKET} int, pieces int")
    rows = (old.select(*new.columns, F.lit(False).alias("later"))
            .unionByName(new.withColumn("later", F.lit(True)))
            .join(F.broadcast(pieces), BUCKET, "left"))
    piece = F.pmod(F.xxhash64(*WIDE_KEY[:2], _block()), F.coalesce("pieces", F.lit(1)))
    others = [c for c in new.columns if c not in (BUCKET, *WIDE_KEY)]
    last = (rows.withColumn("piece", piece).repartition(BUCKET, "piece")
            .groupBy(BUCKET, *WIDE_KEY, "piece")
            .agg(F.max(F.struct("later", *others)).alias("row")))
    if left_only:
        last = last.where(~F.col("row.later"))
    return (last.select(*[F.col(f"row.{c}").alias(c) if c in others else F.col(c)
                          for c in new.columns])
            .sortWithinPartitions(BUCKET, *WIDE_KEY))


def compact_wide(spark: SparkSession, path: str, target: str) -> None:
    """Write a table to another folder by one load."""
    buckets = read_snapshot(spark, path).buckets
    write_wide(read_wide(spark, path).drop(BUCKET), target, truncate=True, buckets=buckets)
