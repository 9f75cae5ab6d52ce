"""SimHash near-dedup: fingerprints of word shingles, linked through covering bit masks.

Every one of the 64 bits gets a vector of radius + 1 bits. Each of the other non-zero vectors
of that length makes a mask: the bits whose vectors have an odd product with it. The vectors of
up to `radius` differing bits leave some vector orthogonal to all of them, and under its mask the
two fingerprints are equal. So fingerprints within the radius always meet in some table, and no
link is lost.

`groups` votes with the hashes of three-word shingles. `deduplicate` is meant for copies with a few
words changed, five-word shingle similarity of 0.8 and more, which change too many of those: it
votes with the words themselves, weighted by length and the root of their count, as long words
are rare, and links two texts when any of three such fingerprints is within four bits. An edit
in one piece, such as a cut end, moves those further apart, so texts not linked yet meet again
by min-hashes of their five-word shingles, and are linked when the exact similarity of their
shingles is 0.8 or more. Texts of just 0.8 meet with a probability of 99.9 %, more similar ones
with a higher one.

Results in odd cases:

* A null text is an empty one. Texts without words have the fingerprint zero and link like others.
* Repeated rows give repeated rows of the result, in the same group.
* A row with a null id has a fingerprint; its group is named by the least id that is not null,
  and is null when there is none.
* `deduplicate` keeps one row of each group, with or without an id; rows that share an id but are no
  near copies are of different groups, so all stay. The same text under the same id stays once.
* Very long texts are shingled whole. Ties in id go to the text with the least hash.
* An empty table gives an empty result.
* Other columns are dropped by `groups` and kept by `deduplicate`; the columns added there have
  names of their own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reshelve.llm.columns import hex_of, signed, text_or_empty
from reshelve.llm.forest import components, unite
from reshelve.session import stored

BITS = 64
WORDS = 3
SEED = 42
RADIUS = 3
# Hashes voted on at once, and fingerprints of a bucket that one task compares with as many.
CHUNK = 1 << 16
BLOCK = 2048
# The fingerprints of `deduplicate`: how many, and within how many bits one of them must be.
PARTS = 3
NEAR_RADIUS = 4
STEP = 0x9E3779B97F4A7C15
# The shingles compared exactly by `deduplicate`, the bands of min-hashes by which texts meet and
# the min-hashes of a band, and texts of a bucket that one task compares with as many.
ALIKE_WORDS = 5
BANDS = 14
BAND_ROWS = 4
ALIKE_BLOCK = 512
MINIMA = np.random.Generator(np.random.PCG64(SEED)).integers(
    0, 1 << 64, (2, BANDS * BAND_ROWS, 1), np.uint64) | np.uint64(1)


def simhash(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of a text as an unsigned number; votes are counted chunk by chunk."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    shingles = map(b" ".join, zip(*[islice(found, i, None) for i in range(words)])) \
        if len(found) >= words else iter([b" ".join(found)])
    votes = np.zeros(BITS, np.int64)
    while chunk := [xxhash.xxh64_intdigest(s, seed) for s in islice(shingles, CHUNK)]:
        octets = np.array(chunk, "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.ArrayType(T.LongType()))
def shingle_prints(texts: pd.Series) -> pd.Series:
    prints = np.fromiter((simhash(t) for t in texts), np.uint64, len(texts))
    return pd.Series([p[None] for p in prints.view(np.int64)], dtype=object)


def weighted_simhash(text: str, parts: int = PARTS) -> np.ndarray:
    """Fingerprints of the words of a text, each from another mixture of the words' hashes."""
    votes = np.zeros((parts, BITS), np.float64)
    counts = iter(Counter(text.encode("utf-8", "surrogatepass").lower().split()).items())
    while chunk := list(islice(counts, CHUNK)):
        weight = np.array([len(w) * math.sqrt(n) for w, n in chunk], np.float32)
        own = np.array([xxhash.xxh64_intdigest(w, SEED) for w, _ in chunk], "<u8")
        for part in range(parts):
            mixed = own + np.uint64(part * STEP & (1 << 64) - 1)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                mixed = (mixed ^ mixed >> np.uint64(shift)) * np.uint64(factor)
            octets = (mixed ^ mixed >> np.uint64(31)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(octets, axis=1, bitorder="little").astype(np.float32)
            votes[part] += weight @ (2 * bits - 1)
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<u8").ravel()


@F.pandas_udf(T.ArrayType(T.LongType()))
def word_prints(texts: pd.Series) -> pd.Series:
    return pd.Series([weighted_simhash(t).view(np.int64) for t in texts], dtype=object)


def shingle_set(text: str) -> np.ndarray:
    """The sorted hashes of the distinct five-word shingles, or of a shorter text's words."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    n = min(len(found), ALIKE_WORDS)
    shingles = map(b" ".join, zip(*[islice(found, i, None) for i in range(n)]))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64))


def bands(shingles: np.ndarray) -> np.ndarray:
    """A key per band of min-hashes; none for a text without words."""
    if not shingles.size:
        return np.empty(0, np.int64)
    least = np.full(BANDS * BAND_ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, shingles.size, 4096):
        mixed = shingles[at:at + 4096] * MINIMA[0] + MINIMA[1]
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(STEP)
        np.minimum(least, (mixed ^ mixed >> np.uint64(29)).min(axis=1), out=least)
    keys = np.zeros(BANDS, np.uint64)
    for row in least.reshape(BANDS, BAND_ROWS).T:
        keys = (keys ^ row) * np.uint64(STEP)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def shingle_bands(texts: pd.Series) -> pd.Series:
    return pd.Series([bands(shingle_set(t)) for t in texts], dtype=object)


@F.pandas_udf(T.BinaryType())
def shingle_bytes(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t).tobytes() for t in texts], dtype=object)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks that guarantee a collision within the radius."""
    vectors = (1 << (radius + 1)) - 1
    own = [i % vectors + 1 for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (own[i] & v).bit_count() % 2)
            for v in range(1, vectors + 1)]


def link_runs(run: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """For each row the least row its fingerprint is linked to inside its run.

    Rows of a run are adjacent. Each is compared with the next, the one after and so on; rows
    whose run has ended leave the comparison, so the work is that of the pairs inside runs.
    """
    parent = np.arange(len(prints))
    active, shift = parent.copy(), 1
    while True:
        active = active[active + shift < len(prints)]
        active = active[run[active] == run[active + shift]]
        if not active.size:
            return parent
        near = active[np.bitwise_count(prints[active] ^ prints[active + shift]) <= radius]
        unite(parent, near, near + shift)
        shift += 1


def link_alike(nodes: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of sets with a similarity of 0.8 or more that connect nodes not connected before."""
    order = np.argsort([s.size for s in sets], kind="stable")
    sets, nodes = [sets[i] for i in order], nodes[order]
    sizes, group, found = np.array([s.size for s in sets]), nodes.copy(), []
    for a in range(len(sets)):
        end = np.searchsorted(sizes, sizes[a] * 5 // 4, "right")
        for b in a + 1 + np.flatnonzero(group[a + 1:end] != group[a]):
            if group[a] != group[b]:
                both = np.intersect1d(sets[a], sets[b], assume_unique=True).size
                if 9 * both >= 4 * (sizes[a] + sizes[b]):
                    found.append((int(nodes[a]), int(nodes[b])))
                    group[group == group[b]] = group[a]
    return found


def _forest(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Edges that connect the same nodes, each to the least one it is connected with. Tasks that
    see other parts of a large group mostly name the same few nodes, so equal edges abound."""
    nodes, ends = np.unique(np.r_[a, b], return_inverse=True)
    parent = np.arange(len(nodes))
    unite(parent, ends[:len(a)], ends[len(a):])
    other = parent != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[other], "b": nodes[parent[other]]}, dtype=np.int64)


def _in_runs(linked):
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket and block pair; a run that may go on waits for more rows."""
        held = None
        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if not len(rows):
                continue
            keys = rows[["k", "i", "j"]].to_numpy()
            run = np.r_[0, np.cumsum((keys[1:] != keys[:-1]).any(axis=1))]
            start = int(np.searchsorted(run, run[-1]))
            held = rows.iloc[start:]
            if start:
                yield linked(rows.iloc[:start], run[:start])
        if held is not None and len(held):
            yield linked(held, np.zeros(len(held), np.int64))

    return link


def _linker(radius: int):
    def linked(rows: pd.DataFrame, run: np.ndarray) -> pd.DataFrame:
        prints = rows["fingerprint"].to_numpy().astype(np.int64)
        nodes = rows["node"].to_numpy()
        parent = link_runs(run, prints.view(np.uint64), radius)
        other = nodes[parent] != nodes
        return _forest(nodes[other], nodes[parent[other]])

    return _in_runs(linked)


def _verified(rows: pd.DataFrame, run: np.ndarray) -> pd.DataFrame:
    nodes, found = rows["node"].to_numpy(), []
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    for start, end in zip(starts, [*starts[1:], len(run)]):
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"].iloc[start:end]]
        found += link_alike(nodes[start:end], sets)
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def _in_blocks(rows: DataFrame, by: str, block: int, *columns: str) -> DataFrame:
    """Each row once per pair of blocks of its bucket k of n rows."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    rows = rows.select("k", *columns, blocks.alias("blocks"),
                       F.pmod(F.xxhash64(by), blocks).cast("int").alias("own"))
    rows = rows.select("k", *columns, "own", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return rows.select("k", F.least("own", "other").alias("i"),
                       F.greatest("own", "other").alias("j"), *columns)


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect exactly the nodes connected by some part within the radius.

    `prints` has a row per node with its `parts`, one fingerprint or several. Buckets with one
    node are dropped by a count. A bucket is cut into blocks, and each pair of blocks is compared
    where it lands, so no task holds more than two blocks of a bucket however large it is. A task
    returns a forest of its links, not all pairs. A bucket is named by a hash of its table and
    key; two with the same hash would be compared as one, which links nothing else.
    """
    masks = [signed(m) for m in covering_masks(radius)]
    keyed = prints.select("node", F.posexplode("parts").alias("part", "fingerprint")).select(
        "node", "part", "fingerprint", F.posexplode(F.array(
            *[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "k"))
    keyed = keyed.select("node", "fingerprint", F.xxhash64("part", "t", "k").alias("k"))
    shared = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = _in_blocks(keyed.join(shared, "k"), "node", block, "node", "fingerprint")
    return (rows.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j")
            .mapInPandas(_linker(radius), "a long, b long"))


def alike(docs: DataFrame, texts: DataFrame, block: int = ALIKE_BLOCK) -> DataFrame:
    """Edges (a, b) that connect the nodes of texts with a shingle similarity of 0.8 or more.

    `texts` has the node, mark and bands of every distinct text. Only texts that share a bucket
    with another node are read again for their shingles.
    """
    keyed = texts.select("node", "mark", F.posexplode("bands").alias("t", "k")).select(
        "node", "mark", F.xxhash64("t", "k").alias("k"))
    shared = keyed.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high"))
    rows = stored(keyed.join(shared.where("low < high"), "k").select("k", "n", "node", "mark"))
    sets = docs.select(_mark(), text_or_empty("text").alias("text")).join(
        rows.select("mark").distinct(), "mark", "left_semi").dropDuplicates(["mark"])
    rows = _in_blocks(rows, "mark", block, "node", "mark").join(
        sets.select("mark", shingle_bytes("text").alias("shingles")), "mark")
    return (rows.select("k", "i", "j", "node", "shingles").repartition("k", "i", "j")
            .sortWithinPartitions("k", "i", "j").mapInPandas(
                _in_runs(_verified), "a long, b long"))


def _mark():
    return F.md5(text_or_empty("text")).alias("mark")


def _merged(named: DataFrame, edges: DataFrame) -> DataFrame:
    """`named` with the components that the edges between its components make."""
    linked = components(edges).select(F.col("node").alias("__node"),
                                      F.col("component").alias("__component"))
    return named.join(linked, F.col("component") == F.col("__node"), "left").withColumn(
        "component", F.coalesce("__component", "component")).drop("__node", "__component")


def groups(docs: DataFrame, radius: int = RADIUS, prints=shingle_prints,
           exact: bool = False) -> DataFrame:
    """(doc_id, parts, component_id): the fingerprints as signed numbers, the group by its least
    id. Texts with the same fingerprints are compared once. With `exact`, texts whose shingles
    are alike are in one group, too."""
    text = text_or_empty("text")
    more = [_mark(), shingle_bands(text).alias("bands")] if exact else []
    found = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               prints(text).alias("parts"), *more))
    distinct = found.groupBy("parts").agg(F.min("doc_id").alias("least"))
    distinct = stored(distinct.withColumn("component", F.monotonically_increasing_id()))
    named = _merged(distinct, links(distinct.withColumnRenamed("component", "node"), radius))
    if exact:
        named = stored(named)
        texts = found.where("size(bands) > 0").select("parts", "mark", "bands").distinct().join(
            named.select("parts", F.col("component").alias("node")), "parts")
        named = _merged(named, alike(docs, texts))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("parts", "component", "component_id")
    return found.join(named, "parts").select(
        "doc_id", "parts", "component_id", *(["component", "mark"] if exact else []))


def deduplicate(docs: DataFrame, radius: int = NEAR_RADIUS, prints=word_prints) -> DataFrame:
    """One document of each group with all its columns: that with the least id, those without one
    last; of several texts with that id the one with the least hash. Different texts of one id
    that are no near copies all stay."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "mark"))
    kept = groups(docs, radius, prints, exact=True).groupBy("component").agg(
        first.alias("first"))
    # No part of the key is null, so repeated rows are dropped where the join has put them and
    # texts are shuffled once.
    key = ["__without", "__id", "__mark"]
    kept = kept.select(F.col("first.without").alias("__without"),
                       F.coalesce("first.doc_id", F.lit(0)).alias("__id"),
                       F.col("first.mark").alias("__mark"))
    own = F.col("doc_id").cast("long")
    marked = docs.withColumns({"__without": own.isNull(), "__id": F.coalesce(own, F.lit(0)),
                               "__mark": _mark()})
    return marked.join(kept, key).dropDuplicates(key).select(*docs.columns)


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint and group of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return groups(docs).select("doc_id", hex_of(F.col("parts")[0]).alias("fingerprint"),
                               "component_id")
