"""Line dedup: content-defined chunks of lines, removed where they repeat anywhere.

Each line is hashed. A rolling hash over the last lines' hashes ends a chunk where its low bits
are zero, so the same lines are cut the same way wherever they stand, whatever comes before them.
A chunk of two lines or more whose hash occurs more than once is fetched, and compared as text.
Of equal chunks the first stays, by document id and place; the others' lines are removed.
Short passages inside otherwise different documents mostly hold no whole chunk and stay.

With `cut=pairs` every two lines that follow each other are compared instead. A run of two lines
or more that stands earlier consists of such pairs, so all its lines are removed, however short
it is and whatever stands around it; only a blank line between two blank lines may stay. Each
line removed stands in an earlier place, and the first of equal lines is never removed.

Results in odd cases:

* A null text is passed on as it is; an empty one has a single empty line and stays.
* Chunks of white space only are never removed. A document all of whose lines are removed stays,
  with an empty text.
* Rows of the same id and text are one document and get the same result. Documents without id
  come after all others, in the order of a hash of their text.
* An empty table gives an empty result.
* `n_lines` and `n_removed` replace columns of these names; working ones begin with two
  underscores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reshelve.session import stored

# Lines under the rolling hash, the share of places where it ends a chunk, lines of a chunk.
WINDOW = 2
DIVISOR = 2
LEAST_LINES = 2
FACTOR = 0x9E3779B97F4A7C15
WRAP = (1 << 64) - 1
LAST = (1 << 63) - 1


def _mixed(value: int) -> int:
    """The upper half of a product, whose bits depend on all of the value's."""
    return (value * FACTOR & WRAP) >> 32


def chunks(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The lines of a text, and the chunks as ranges of lines."""
    lines = text.split("\n")
    hashes = [xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) for line in lines]
    leaving = pow(FACTOR, WINDOW, 1 << 64)
    found, start, rolling = [], 0, 0
    for i, own in enumerate(hashes):
        rolling = (rolling * FACTOR + own) & WRAP
        if i >= WINDOW:
            rolling = (rolling - hashes[i - WINDOW] * leaving) & WRAP
        if i + 1 - start >= LEAST_LINES and _mixed(rolling) % DIVISOR == 0:
            found.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        found.append((start, len(lines)))
    return lines, found


def pairs(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The lines of a text, and every two that follow each other as ranges of lines."""
    lines = text.split("\n")
    return lines, [(i, i + LEAST_LINES) for i in range(len(lines) - LEAST_LINES + 1)]


def _repeatable(text: str, cut) -> Iterator[tuple[int, str]]:
    """Number and text of the chunks of several lines that are not blank."""
    lines, found = cut(text)
    for number, (start, end) in enumerate(found):
        if end - start >= LEAST_LINES:
            joined = "\n".join(lines[start:end])
            if joined.strip():
                yield number, joined


def _hash(text: str, bits: int) -> int:
    own = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return (own >> (64 - bits)) - (1 << 63)


def _hasher(bits: int, cut):
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame(
                [(key, mark, number, _hash(chunk, bits))
                 for key, mark, text in zip(rows["key"], rows["mark"], rows["text"])
                 for number, chunk in _repeatable(text, cut)],
                columns=["key", "mark", "number", "hash"])

    return hashed


def _fetcher(cut):
    def fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = []
            for key, mark, text, wanted in zip(rows["key"], rows["mark"], rows["text"],
                                               rows["numbers"]):
                wanted = set(wanted.tolist())
                found += [(key, mark, number, chunk)
                          for number, chunk in _repeatable(text, cut) if number in wanted]
            yield pd.DataFrame(found, columns=["key", "mark", "number", "chunk"])

    return fetched


def _without(cut):
    @F.pandas_udf(T.StructType().add("text", "string").add("n_lines", "integer")
                  .add("n_removed", "integer"))
    def without(texts: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        found = []
        for text, gone in zip(texts, numbers):
            if text is None:
                found.append((None, 0, 0))
                continue
            lines, parts = cut(text)
            gone = set() if gone is None else {
                i for n in np.asarray(gone).tolist() for i in range(*parts[n])}
            kept = [line for i, line in enumerate(lines) if i not in gone]
            found.append(("\n".join(kept) if gone else text, len(lines), len(gone)))
        return pd.DataFrame(found, columns=["text", "n_lines", "n_removed"])

    return without


def repeated(docs: DataFrame, hash_bits: int = 64, cut=chunks) -> DataFrame:
    """(key, mark, numbers): the chunks to remove of each document that has any.

    Chunks with a hash of their own are dropped by a count. Only the others' texts are fetched
    and grouped as texts, which is the byte comparison.
    """
    texts = docs.where("text is not null").select(*_identity(), "text")
    places = texts.mapInPandas(_hasher(hash_bits, cut), "key long, mark long, number int, hash long")
    places = stored(places.distinct())
    shared = places.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wanted = places.join(shared.select("hash"), "hash").groupBy("key", "mark").agg(
        F.collect_list("number").alias("numbers"))  # no more than the chunks of one document
    fetched = stored(texts.join(wanted, ["key", "mark"]).mapInPandas(
        _fetcher(cut), "key long, mark long, number int, chunk string"))
    first = fetched.groupBy("chunk").agg(F.min(F.struct("key", "mark", "number")).alias("first"))
    gone = fetched.join(first, "chunk").where(F.struct("key", "mark", "number") != F.col("first"))
    return gone.groupBy("key", "mark").agg(F.collect_set("number").alias("numbers"))


def _identity():
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"),
            F.xxhash64("text").alias("mark"))


def remove_repeated(docs: DataFrame, hash_bits: int = 64, cut=chunks) -> DataFrame:
    """All columns, the text without repeated chunks, and its lines and how many were removed."""
    gone = repeated(docs, hash_bits, cut).select(F.col("key").alias("__key"), F.col("mark").alias("__mark"),
                                 F.col("numbers").alias("__numbers"))
    key, mark = _identity()
    rows = docs.drop("n_lines", "n_removed").withColumns({"__key": key, "__mark": mark})
    rows = rows.join(gone, ["__key", "__mark"], "left").drop("__key", "__mark")
    rows = rows.withColumn("__new", _without(cut)("text", "__numbers"))
    return rows.withColumns({name: F.col(f"__new.{name}") for name in (
        "text", "n_lines", "n_removed")}).drop("__new", "__numbers")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that repeat an earlier chunk."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return remove_repeated(docs)


def op4_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without any run of two lines or more that stands earlier."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return remove_repeated(docs, cut=pairs)
