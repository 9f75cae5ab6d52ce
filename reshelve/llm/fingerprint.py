"""Document fingerprints: SimHash votes and permuted block tables, in DataFrame functions only.

A text's terms are its pairs of adjacent words in lower case, the last word also alone. A term
weighs as often as it occurs: each occurrence votes with its 64-bit hash, for a bit that is set
and against one that is not. A fingerprint bit is 1 when the votes for it win.

Results in odd cases:

* A null text is an empty one. A text without words has the fingerprint zero.
* Texts with the same words have the same fingerprint, also when rows or ids repeat.
* Rows with a null id have fingerprints, but no place in the order and so no next document: the
  second half of their edited text is empty and their likeness to the next is 0.
* An empty table gives an empty result.
* Other columns are dropped, so their names cannot clash.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reshelve.llm.columns import SPACE, distance, hex_of, signed, text_or_empty
from reshelve.session import stored

BITS = 64
# Two counters of 32 bits share a long, so 32 sums hold the votes of all 64 bits. A counter
# overflows at four thousand million terms, more than one Spark string can hold.
LANES = 32
LANE_MASK = (1 << 32) | 1
RADIUS = 3
BLOCKS = 6
# Documents of a bucket of neighbours, and the most buckets there are: their first ids are
# broadcast, 24 bytes each, so at most 2.4 MB whatever the number of documents.
BUCKET_ROWS = 512
MAX_BUCKETS = 100_000


def words_of(text: Column) -> Column:
    """The words of a text in lower case; a single empty one if there are none."""
    return F.split(F.lower(F.regexp_replace(text, rf"^{SPACE}|{SPACE}$", "")), SPACE)


def term_hashes(words: Column) -> Column:
    """The hashes of all terms, one for each occurrence; `words` must be a stored column."""
    return F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per key with the fingerprint of its text as a signed 64-bit number.

    Keys must be unique and their partitioning is kept: rows dealt by some of the keys are
    not shuffled again. The exploded terms never leave the task that reads the text; they are
    summed there.
    """
    terms = rows.select(*keys, words_of(F.col(text)).alias("__w")).select(*keys, F.when(
        F.col("__w")[0] != "", term_hashes(F.col("__w"))).otherwise(
        F.array(F.lit(0).cast("long"))).alias("__h"))
    # The outer form, as no filter is inferred from it: that would split each text once more
    # for every word.
    terms = terms.select(*keys, F.explode_outer("__h").alias("__h"))
    lanes = [F.sum(F.shiftrightunsigned("__h", i).bitwiseAND(F.lit(LANE_MASK))).alias(f"__s{i}")
             for i in range(LANES)]
    sums = terms.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *lanes)
    bits = F.lit(0).cast("long")
    for i in range(LANES):
        low = F.col(f"__s{i}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(f"__s{i}", 32)
        for at, votes in ((i, low), (i + 32, high)):
            bits = bits.bitwiseOR(F.when(votes * 2 > F.col("__n"), F.lit(signed(1 << at)))
                                  .otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, bits.alias("fingerprint"))


def likeness(left: Column, right: Column) -> Column:
    """Share of equal bits of two fingerprints, 0 to 1."""
    return 1 - distance(left, right) / BITS


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The masks of the permuted block tables.

    The bits are cut into blocks. Two fingerprints that differ in at most `radius` bits agree
    on at least `blocks - radius` whole blocks, so one table per choice of that many blocks
    finds them with an equality.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("there must be more blocks than differing bits, 64 at most")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(block, blocks - radius)]


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS,
                  blocks: int = BLOCKS) -> DataFrame:
    """All pairs (query, fingerprint) of distinct fingerprints within the radius, each once.

    Both sides have a `fingerprint` column, null ones match nothing. Equal fingerprints are
    reduced first, so copies do not multiply. A pair that agrees in several tables is kept only
    in the first, which needs no distinct step.
    """
    masks = block_masks(radius, blocks)

    def keyed(rows, name):
        rows = rows.where("fingerprint is not null").select(F.col("fingerprint").alias(name))
        return rows.distinct().select(name, F.posexplode(F.array(
            *[F.col(name).bitwiseAND(F.lit(signed(m))) for m in masks])).alias("__t", "__k"))

    pairs = keyed(queries, "query").join(keyed(index, "fingerprint"), ["__t", "__k"])
    differing = F.col("query").bitwiseXOR(F.col("fingerprint"))
    first = F.coalesce(*[F.when(differing.bitwiseAND(F.lit(signed(m))) == 0, F.lit(t))
                         for t, m in enumerate(masks)])
    return pairs.where((F.bit_count(differing) <= radius) & (F.col("__t") == first)).select(
        "query", "fingerprint", F.bit_count(differing).alias("distance"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the text of the next id, after the last the first.

    Ids are cut into buckets of equal width of about `BUCKET_ROWS` documents. The first
    document of each bucket is sent to the bucket before as well, as a guest behind its last
    row, so that one shuffle by bucket is all; guests stay in the result, marked. Equal ids
    follow one another by text. Rows without id have no next text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty("text").alias("text"))
    low, high, count = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    if not count:
        low, high, count = 0, 0, 1
    buckets = min(MAX_BUCKETS, math.ceil(count / BUCKET_ROWS))
    width = (high - low) // buckets + 1
    rows = rows.withColumn("bucket", F.when(
        F.col("doc_id").isNotNull(), F.expr(f"(doc_id - {low}L) div {width}L")).otherwise(
        -1 - F.pmod(F.xxhash64("text"), F.lit(buckets))))
    before = F.lag("bucket").over(Window.orderBy("bucket"))  # MAX_BUCKETS rows at most
    last = F.max("bucket").over(Window.partitionBy(F.lit(0)))
    firsts = (rows.where("doc_id is not null").groupBy("bucket")
              .agg(F.min("doc_id").alias("doc_id"))
              .select("doc_id", F.coalesce(before, last).alias("before")))
    rows = rows.join(F.broadcast(firsts), "doc_id", "left")
    rows = rows.select("doc_id", "text", F.explode(F.when(F.col("before").isNull(), F.array(
        F.struct("bucket", F.lit(False).alias("guest")))).otherwise(F.array(
            F.struct("bucket", F.lit(False).alias("guest")),
            F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest")))))
        .alias("at")).select("doc_id", "text", "at.bucket", "at.guest")
    order = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    return rows.select(
        "bucket", F.row_number().over(order).alias("place"), "guest", "doc_id", "text",
        F.when(F.col("doc_id").isNotNull(), F.lead("text").over(order)).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The second half of a text replaced by the start of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half),
                    F.substring(F.coalesce(following, F.lit("")), F.lit(1), half))


def op1_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they are.

    `n_near` is set for the stated query set, ids divisible by 100: how many rows of the whole
    table, itself included, have a fingerprint within three bits of its own.
    """
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    change = edited(F.col("text"), F.col("next_text"))
    keys = ["bucket", "place", "guest", "doc_id", "n_chars", "sha", "kind"]
    texts = with_next(docs).select(
        "bucket", "place", "guest", "doc_id", F.length("text").cast("long").alias("n_chars"),
        "text", change.alias("edited"))
    texts = texts.select(
        "bucket", "place", "guest", "doc_id", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
        F.posexplode(F.array("text", "edited")).alias("kind", "text"))
    prints = fingerprints(texts.where("not (guest and kind = 1)"), keys, "text")
    both = prints.groupBy(*keys[:-1]).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("changed"))
    order = Window.partitionBy("bucket").orderBy("place")
    rows = both.withColumn("following", F.when(
        F.col("doc_id").isNotNull(), F.lead("own").over(order))).where("not guest")
    rows = rows.select("doc_id", "n_chars", "sha", "own", "changed", "following")
    rows = stored(rows)  # read three times below
    copies = rows.groupBy(F.col("own").alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"))
    asked = rows.where("doc_id % 100 = 0").select(F.col("own").alias("fingerprint"))
    near = (within_radius(asked, copies).join(copies, "fingerprint")
            .groupBy("query").agg(F.sum("n").alias("n_near")))
    near = rows.where("doc_id % 100 = 0").select("doc_id", F.col("own").alias("query")).distinct(
        ).join(near, "query").select("doc_id", "n_near")
    return rows.join(near, "doc_id", "left").select(
        "doc_id", "n_chars", F.col("sha").alias("edited_sha256"),
        hex_of(F.col("own")).alias("fingerprint"),
        hex_of(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        F.coalesce(likeness(F.col("own"), F.col("following")), F.lit(0.0)).alias("near_next"),
        "n_near")
