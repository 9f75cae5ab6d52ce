"""Conform enriched rows to the wide table, resolve repeated keys and lay rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reshelve.functions.nulls import complete
from reshelve.schema import WIDE_KEY, WIDE_SCHEMA

BUCKET = "customer_bucket"


def to_wide(enriched: DataFrame, schema: T.StructType = WIDE_SCHEMA) -> DataFrame:
    """Type the 18 wide columns and drop rows lacking a part of the key."""
    source = {"nation": "nation_name", "region": "region_name"}
    typed = [F.col(source.get(f.name, f.name)).cast(f.dataType).alias(f.name)
             for f in schema]
    rows = enriched.select(*typed)
    return rows.where(complete(rows, WIDE_KEY))


def conform(df: DataFrame, schema: T.StructType = WIDE_SCHEMA) -> DataFrame:
    """Check a frame against the table contract: names, types and non-null keys.

    A missing or mistyped column fails at once, a null key when the rows are written.
    """
    return refuse_null_keys(typed(df, schema), schema)


def typed(df: DataFrame, schema: T.StructType = WIDE_SCHEMA) -> DataFrame:
    """The columns of the table in their types; a missing or mistyped one fails at once."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.to(T.StructType([T.StructField(f.name, f.dataType) for f in schema]))


def refuse_null_keys(df: DataFrame, schema: T.StructType = WIDE_SCHEMA) -> DataFrame:
    """The same rows; a null in a key is an error when they are written. The keys become
    expressions, which hides how rows are partitioned, so this comes after steps that use it."""
    keys = {f.name for f in schema if not f.nullable}
    return df.select(*[
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in key column {c}")))
        .otherwise(F.col(c)).alias(c) if c in keys else F.col(c)
        for c in df.columns])


def upsert(df: DataFrame, keys=WIDE_KEY) -> DataFrame:
    """Keep one row per key, the greatest.

    Rows of one key are reduced before the shuffle, and the shuffle is on the whole key, so
    neither a large customer nor a much repeated key piles up in one task. Rows that a join left
    partitioned by a part of the key, as the lines of orders are, are not shuffled again.
    """
    others = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max(F.struct(*others)).alias("row"))
            .select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c)
                      for c in df.columns]))


# The multiplier and modulus that spread neighbouring ids over the buckets.
SPREAD, SPREAD_MODULUS = 2_654_435_761, 2 ** 31


def bucket_of(key: Column | int, buckets: int) -> Column | int:
    """Bucket of a customer id, as a column or for a single id."""
    if isinstance(key, int):
        return key % SPREAD_MODULUS * SPREAD % SPREAD_MODULUS % buckets
    short = F.pmod(key.cast("bigint"), F.lit(SPREAD_MODULUS))
    mixed = F.pmod(short * SPREAD, F.lit(SPREAD_MODULUS))
    return F.pmod(mixed, F.lit(buckets)).cast("int")


def buckets_for(rows: int, in_each: int = 10_000_000) -> int:
    """Number of buckets that leaves so many rows, under a gigabyte, in each."""
    return max(8, -(-rows // in_each))


def with_bucket(df: DataFrame, buckets: int) -> DataFrame:
    """Add the bucket column and note the number of buckets in the key's metadata."""
    return (df.withMetadata("customer_id", {"buckets": buckets})
            .withColumn(BUCKET, bucket_of(F.col("customer_id"), buckets)))


def of_customer(stored: DataFrame, customer_id: int, buckets: int | None = None) -> DataFrame:
    """Rows of one customer; of a stored table only the folder of its bucket is read."""
    found = stored.where(F.col("customer_id") == customer_id)
    if BUCKET not in stored.columns:
        return found
    buckets = buckets or stored.schema["customer_id"].metadata["buckets"]
    return found.where(F.col(BUCKET) == bucket_of(customer_id, int(buckets)))


def of_customers(stored: DataFrame, keys: DataFrame, buckets: int | None = None) -> DataFrame:
    """Rows of the customers in ``keys``; of a stored table only the folders of their buckets
    are read. The buckets asked for, a few thousand numbers at most, are looked up first."""
    if BUCKET in stored.columns:
        count = int(buckets or stored.schema["customer_id"].metadata["buckets"])
        asked = keys.select(bucket_of(F.col("customer_id"), count).alias("b")).distinct()
        wanted = sorted(r.b for r in asked.collect())
        if len(wanted) < count:
            stored = stored.where(F.col(BUCKET).isin(wanted))
    return stored.join(keys, "customer_id", "left_semi")


def cluster_by(df: DataFrame, keys=("customer_id",), order=WIDE_KEY,
               partitions: int | None = None) -> DataFrame:
    """Bring the rows of a key together, sorted.

    Rebalancing hashes on the key like a plain repartition, but lets adaptive execution cut
    a partition swollen by one large key into several tasks and merge small ones.
    """
    hint = [F.col(k) for k in keys] if partitions is None else [partitions, *map(F.col, keys)]
    clustered = df.hint("rebalance", *hint)
    return clustered.sortWithinPartitions(*order) if order else clustered
