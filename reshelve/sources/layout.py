"""What a reader must know about stored documents: the number of buckets."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reshelve.sources.tables import path_exists

LAYOUT = "_layout"
SCHEMA = "load int, buckets int, schema string"


def read_layout(spark: SparkSession, path: str) -> list:
    """The loads of a collection in order, a short list; empty if there is none."""
    if not path_exists(spark, f"{path}/{LAYOUT}"):
        return []
    return spark.read.schema(SCHEMA).json(f"{path}/{LAYOUT}/*").orderBy("load").collect()


def write_layout(spark: SparkSession, path: str, buckets: int, load: int = 0, schema: str = "",
                 mode: str = "overwrite") -> None:
    """Note a load, in a folder of its own."""
    row = spark.createDataFrame([(load, buckets, schema)], SCHEMA).coalesce(1)
    row.write.mode(mode).json(f"{path}/{LAYOUT}/{load}")
