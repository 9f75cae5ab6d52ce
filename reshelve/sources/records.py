"""Split CSV files whose quoted values hold line breaks.

Whether a line break ends a record depends on all quotes before it in the file. So quotes are
counted per block of a file first, which any number of tasks can do; a running sum over the blocks,
one row each, tells which blocks start inside a quoted value. With that known, every block is cut
into records by itself. A record that reaches over the end of its block leaves a part in each,
and only these parts are shuffled and put together.

This holds for files whose quotes only stand around values, and doubled inside them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

QUOTE = '"'
# What a row of a block is: a record, the end, the start or the middle of one that reaches over.
WHOLE, LAST, FIRST, MIDDLE = range(4)
CUT = pa.schema([("record", pa.string()), ("file", pa.string()), ("block", pa.int64()),
                 ("kind", pa.int32())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files in order, with the file and the block each stands in."""
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def _blocks(lines: DataFrame) -> DataFrame:
    """One row per block: whether it starts and whether it ends inside a quoted value."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    # One row per block, some tens of bytes for some tens of megabytes of file.
    held = counts.withColumn("before", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    return held.select("file", "block", (F.col("before") % 2 == 1).alias("inside"),
                       ((F.col("before") + F.col("quotes")) % 2 == 1).alias("goes_on"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut lines into records, block after block; the lines of a block come in order. The first
    record of a file is its header and left out."""
    at, open_lines, kind, header = None, [], WHOLE, False

    def rows(records, kinds) -> pa.RecordBatch:
        n = len(kinds)
        return pa.RecordBatch.from_arrays(
            [records, pa.array([at[0]] * n, pa.string()), pa.array(np.full(n, at[1]), pa.int64()),
             pa.array(kinds, pa.int32())], schema=CUT)

    def left() -> Iterator[pa.RecordBatch]:
        """What a block leaves open at its end."""
        if open_lines and not header:
            reach = MIDDLE if kind == LAST else FIRST
            yield rows(pa.array(["\n".join(open_lines)]), np.array([reach]))

    for batch in batches:
        lines, file, block, inside = batch.columns
        new = np.ones(len(lines), bool)
        new[1:] = np.diff(block.to_numpy()) != 0
        if len(lines) > 1:
            new[1:] |= pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(lines)]):
            here = (file[start].as_py(), block[start].as_py())
            if here != at:
                yield from left()
                at, open_lines = here, []
                kind = LAST if inside[start].as_py() else WHOLE
                header = here[1] == 0
            part = lines.slice(start, end - start)
            odd = pc.count_substring(part, QUOTE).to_numpy(zero_copy_only=False) % 2
            closed = (int(kind == LAST or bool(open_lines)) + odd.cumsum()) % 2 == 0
            ends = np.flatnonzero(closed) + 1
            cuts = np.r_[0, ends].astype(np.int32)
            rest = part.slice(int(cuts[-1])).to_pylist()
            if not len(ends):
                open_lines += rest
                continue
            records = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), part), "\n")
            if open_lines:
                text = "\n".join([*open_lines, records[0].as_py()])
                records = pa.concat_arrays([pa.array([text]), records[1:]])
            kinds = np.zeros(len(ends), np.int32)
            kinds[0] = kind
            if header:
                records, kinds = records[1:], kinds[1:]
            if len(kinds):
                yield rows(records, kinds)
            open_lines, kind, header = rest, WHOLE, False
    if at is not None:
        yield from left()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files with a header, as text in the one column ``record``."""
    lines = _lines(spark, path)
    blocks = _blocks(lines)

    def cut(wanted: DataFrame, how: str) -> DataFrame:
        """Lines keep their order: the blocks, one row each, are the side that is broadcast."""
        known = lines.join(F.broadcast(wanted), ["file", "block"], how)
        return known.select("value", "file", "block", F.coalesce("inside", F.lit(False))).mapInArrow(
            _cut, "record string, file string, block long, kind int")

    whole = cut(blocks.where("inside").select("file", "block", "inside"), "left").where(
        F.col("kind") == WHOLE)
    parts = cut(blocks.where("inside OR goes_on").select("file", "block", "inside"), "inner").where(
        F.col("kind") != WHOLE)
    # Within a block the end of an earlier record comes before the start of the next.
    order = F.struct("block", F.col("kind") == FIRST)
    begun = Window.partitionBy("file").orderBy(order)
    joined = (parts.withColumn("number", F.sum((F.col("kind") == FIRST).cast("int")).over(begun))
              .groupBy("file", "number").agg(F.sort_array(F.collect_list(
                  F.struct(order.alias("place"), "record"))).alias("parts"))
              .select(F.array_join("parts.record", "\n").alias("record")))
    ended = F.regexp_replace("record", "\r$", "").alias("record")
    return whole.select("record").unionByName(joined).select(ended).where("record != ''")


def read_csv(spark: SparkSession, path: str, escape: str = QUOTE) -> DataFrame:
    """Read CSV files with a header, all columns as text, by as many tasks as their size asks for."""
    names = spark.read.csv(path, header=True, escape=escape, multiLine=True).columns
    kinds = ", ".join("`{}` string".format(name.replace("`", "``")) for name in names)
    if not names:
        return spark.createDataFrame([], "record string").drop("record")
    values = F.from_csv("record", F.lit(kinds), {"escape": escape, "multiLine": "true"})
    return read_records(spark, path).select(values.alias("row")).select("row.*")
