"""Read stored models: the document collection and the wide table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reshelve.operators.document import MARKS, Documents
from reshelve.operators.wide import BUCKET
from reshelve.schema import WIDE_SCHEMA
from reshelve.sources.layout import read_layout
from reshelve.sources.snapshots import DATA, LOAD, Snapshot, read_snapshot
from reshelve.sources.tables import read_if_present


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                   padded: bool = True) -> Documents:
    """Read a collection written by :func:`reshelve.sinks.documents.write_documents`, with what
    was set aside from it.

    JSON carries no types, so its reader is told the schema.
    """
    rejected = read_if_present(spark, f"{path}/rejected_pieces")
    reader = spark.read.format(fmt)
    if schema is None and rejected is not None:  # an empty collection has no files to ask
        schema = rejected.drop(*MARKS, BUCKET).schema
    if schema is not None:
        reader = reader.schema(T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())]))
    whole = {"whole": F.lit(True), "first": F.lit(True), "carried": F.lit(False)}
    pieces = reader.load(f"{path}/accepted").withColumns(whole)
    layout = read_layout(spark, path)
    if rejected is not None:
        pieces = pieces.unionByName(rejected, allowMissingColumns=True)
    return Documents(pieces, padded, layout[0].buckets if layout else None)


def read_buckets(spark: SparkSession, path: str, snapshot: Snapshot,
                 wanted: set[int] | None = None) -> DataFrame:
    """The rows of some buckets of a snapshot of the wide table, or of all."""
    schema = T.StructType.fromJson(json.loads(snapshot.schema))
    columns = T.StructType([
        T.StructField(f.name, f.dataType, True, {"buckets": snapshot.buckets})
        if f.name == "customer_id" else f for f in schema])
    folders = snapshot.folders(path, BUCKET, wanted)
    if not folders:
        return spark.createDataFrame([], T.StructType([*columns]).add(BUCKET, "integer"))
    kept = T.StructType([*columns]).add(LOAD, "string").add(BUCKET, "integer")
    return spark.read.schema(kept).option("basePath", f"{path}/{DATA}").parquet(*folders).drop(LOAD)


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """Read the wide table as it was last committed, with the bucket of each row."""
    snapshot = read_snapshot(spark, path)
    if snapshot is None:
        raise ValueError(f"there is no wide table under {path}")
    return read_buckets(spark, path, snapshot).select(*WIDE_SCHEMA.names, BUCKET)
