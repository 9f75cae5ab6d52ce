"""Mixing sources to target weights by Poisson replication.

A source that should make up the share w of `size` documents and has n of them repeats each at
the mean rate size * w / n. A document's number of copies is the inverse of the Poisson
distribution of its source's rate at a number between 0 and 1 that is hashed from a seed and the
id, so it is the same on every run and in every order. Copies are exploded and dealt out by
another hash, and each partition is sorted by it, which shuffles them globally.

Results in odd cases:

* A null source is a source of its own. A source without weight, or with weight zero, is left out.
* A null text is copied like any other. A row with a null id is hashed by its text.
* Repeated rows count as documents of their source and get the same number of copies each.
* An empty table gives an empty result.
* `copy` replaces a column of that name; working columns begin with two underscores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reshelve.session import stored

SEED = 17
# Weights that are not given follow the number of documents to this power.
TEMPERATURE = 0.5
# Rates of up to so many sources are broadcast, about 500 bytes each at the usual rates of a few
# copies; above it they are joined by shuffle, with every source split over SALTS keys.
MAX_BROADCAST_SOURCES = 20_000
MAX_BROADCAST_STEPS = 4_000_000
SALTS = 64


def poisson_steps(rate: float) -> np.ndarray:
    """The distribution function at 0, 1, 2 ... up to where it is one to double precision."""
    if rate <= 0:
        return np.array([1.0])
    most = int(np.ceil(rate + 12 * np.sqrt(rate) + 30))
    logs = np.log(np.maximum(np.arange(most + 1), 1)).cumsum()
    return np.exp(np.arange(most + 1) * np.log(rate) - rate - logs).cumsum()


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _steps(rates: pd.Series) -> pd.Series:
    return pd.Series([poisson_steps(r) for r in rates], dtype=object)


def _uniform(*parts):
    """A number between 0 and 1 from the first 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None,
          temperature: float = TEMPERATURE, size: float | None = None) -> DataFrame:
    """(source, rate): how often each document of a source is repeated on average."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        given = docs.sparkSession.createDataFrame(
            [(source, float(w)) for source, w in weights.items()], "key string, w double")
        counts = counts.join(given, F.col("source").eqNullSafe(F.col("key"))).drop("key")
    counts = stored(counts)
    documents, total = counts.agg(F.sum("n"), F.sum("w")).first()
    if not total:  # no documents, or none in a source with a weight
        return counts.select("source", F.lit(0.0).alias("rate"))
    size = float(documents if size is None else size)
    return counts.select("source", (F.lit(size) * F.col("w") / F.lit(total) / F.col("n"))
                         .alias("rate"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None,
        temperature: float = TEMPERATURE, size: float | None = None,
        seed: int = SEED) -> DataFrame:
    """All columns and `copy`, from 1, in a shuffled order; `size` documents are expected,
    as many as the input has in the sources with a weight unless it is given."""
    found = rates(docs, weights, temperature, size).withColumnRenamed("source", "__source")
    found = stored(found.select("__source", "rate", _steps("rate").alias("__steps")))
    sources, steps = found.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.size("__steps")), F.lit(0))).first()
    found = found.drop("rate")
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    same = F.col("source").eqNullSafe(F.col("__source"))
    rows = docs.drop("copy").withColumn("__key", key)
    if sources <= MAX_BROADCAST_SOURCES and steps <= MAX_BROADCAST_STEPS:
        rows = rows.join(F.broadcast(found), same)
    else:
        found = found.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("__own", F.pmod(F.hash("__key"), F.lit(SALTS)))
        rows = rows.join(found, same & (F.col("__own") == F.col("__salt"))).drop("__own", "__salt")
    rows = rows.withColumn("__u", _uniform(F.lit(str(seed)), F.col("__key")))
    copies = F.size(F.filter("__steps", lambda step: step < F.col("__u")))
    rows = rows.withColumn("__n", copies).where("__n > 0").drop("__source", "__steps", "__u")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    rows = rows.withColumn("__order", F.xxhash64(F.lit(seed), "__key", "copy")).drop("__key", "__n")
    return rows.repartition("__order").sortWithinPartitions("__order").drop("__order")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, mixed so that sources weigh as the root of their size."""
    return mix(spark.read.parquet(f"{folder}/documents.parquet"))


OP6_SQL = f"""
WITH RECURSIVE counts AS (
  SELECT source, count(*) AS n, pow(CAST(count(*) AS DOUBLE), {TEMPERATURE}) AS w
  FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT CAST(sum(n) AS DOUBLE) FROM counts) * w / (SELECT sum(w) FROM counts) / n
    AS rate FROM counts),
steps(source, rate, k, p, step) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), step + p * rate / (k + 1) FROM steps
  WHERE k < rate + 12 * sqrt(rate) + 29),
drawn AS (
  SELECT *, (CAST(('0x' || substr(md5('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT)
             + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, CAST(s.k + 1 AS INTEGER) AS copy
FROM drawn d JOIN steps s ON s.source = d.source AND s.step < d.u
"""
