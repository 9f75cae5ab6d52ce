"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A text's n-grams are its words, the shapes of its words, the pairs of adjacent shapes, and marks
for a word that stands twice or three times in a row. Only whether an n-gram occurs counts. Indicators
are scaled by the log ratio of their shares in the two classes, each text is scaled to length
one, and a linear hinge-loss model is fitted by dual coordinate descent. Two numbers turn its
margin into a probability.

The fit uses the SAMPLE_ROWS labelled rows with the least id hashes, 12,000 unless set; only
their n-gram numbers reach the driver, four bytes each. Scores use the text alone.

Results in odd cases:

* A null or empty text has no n-grams and gets the score of the margin zero plus the bias.
* Labels other than 0 and 1 and null ids are ignored; of several labels of an id the least counts.
* Without labels every score is 0.5, with one class only it is that class.
* Repeated rows are scored each; a null id is not held out and never learned from.
* An empty table gives an empty result. `keep` returns the columns of its input only.
"""

from __future__ import annotations

import math
import operator
import zlib
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reshelve.llm.columns import text_or_empty

SAMPLE_ROWS = 12_000
FOLDS = 3
FOLD = 1
# N-grams are numbered by their CRC in this many buckets.
BUCKETS = 1 << 20
COST = 1.0
ROUNDS = 20
MAX_CACHED = 400_000
TWICE, THRICE = (zlib.crc32(mark) % BUCKETS for mark in (b"r2", b"r3"))


def shape(word: str) -> str:
    """Runs of capitals, small letters and digits as X, x and 9; other characters stay."""
    kinds = ("9" if c.isdigit() else ("x" if c == c.lower() else "X") if c.isalpha() else c
             for c in word)
    return "".join(k if k in "Xx9" else k * min(3, len(list(run))) for k, run in groupby(kinds))


class Grams:
    """Numbers of the n-grams of a text, with the numbers of known words and pairs kept."""

    def __init__(self):
        self.words: dict[str, tuple[str, int]] = {}
        self.pairs: dict[tuple[str, str], int] = {}

    def _word(self, word: str) -> tuple[str, int]:
        if len(self.words) >= MAX_CACHED:
            self.words.clear()
        found = self.words[word] = (
            shape(word), zlib.crc32(f"w {word.lower()}".encode()) % BUCKETS)
        return found

    def _pair(self, pair: tuple[str, str]) -> int:
        if len(self.pairs) >= MAX_CACHED:
            self.pairs.clear()
        found = self.pairs[pair] = zlib.crc32(f"s {pair[0]}\n{pair[1]}".encode()) % BUCKETS
        return found

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        if not words:
            return np.empty(0, np.int64)
        known, pairs = self.words, self.pairs
        entries = [known.get(w) or self._word(w) for w in words]
        shapes = [e[0] for e in entries]
        found = {e[1] for e in entries}
        adjacent = set(zip(shapes, shapes[1:])) | {(s, "") for s in set(shapes)}
        found.update(pairs.get(p) or self._pair(p) for p in adjacent)
        again = list(map(operator.eq, words, words[1:]))
        if any(again):
            found.add(TWICE)
            if any(map(operator.and_, again, again[1:])):
                found.add(THRICE)
        return np.fromiter(found, np.int64, len(found))


@dataclass
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, grams: np.ndarray) -> float:
        ratio = self.ratio[grams]
        length = math.sqrt(float(ratio @ ratio))
        return float(self.weight[grams] @ ratio) / length + self.bias if length else self.bias

    def score(self, grams: np.ndarray) -> float:
        z = self.slope * self.margin(grams) + self.offset
        return 1 / (1 + math.exp(-min(max(z, -500), 500)))


def _log_ratio(texts: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = np.ones((2, BUCKETS))
    for grams, label in zip(texts, good):
        counts[int(label), grams] += 1
    rare = counts.sum(axis=0) <= 3  # n-grams of a single text say nothing of others
    counts /= counts.sum(axis=1, keepdims=True)
    ratio = np.divide(counts[1], counts[0])
    np.log(ratio, out=ratio)
    ratio[rare] = 0
    return ratio


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 0) -> Model:
    """Fit on n-gram numbers and labels 0 and 1; the classes weigh the same in all."""
    good = np.asarray(labels) == 1
    flat = np.zeros(BUCKETS, np.float32)
    if not len(good) or good.all() or not good.any():
        offset = 0.0 if not len(good) else 500.0 if good.all() else -500.0
        return Model(flat, flat, 0.0, 0.0, offset)
    ratio = _log_ratio(texts, good)
    ends = np.cumsum([np.count_nonzero(ratio[grams]) for grams in texts])
    numbers, values = np.empty(ends[-1], np.int32), np.empty(ends[-1])
    rows = list(zip(np.split(numbers, ends[:-1]), np.split(values, ends[:-1])))
    for grams, (own, value) in zip(texts, rows):
        own[:] = grams[ratio[grams] != 0]
        value[:] = ratio[own]
        length = np.linalg.norm(value)
        if length:
            value /= length
    sign = np.where(good, 1.0, -1.0)
    limit = COST * np.where(good, len(good) / (2 * good.sum()), len(good) / (2 * (~good).sum()))
    square = np.array([v @ v + 1 for _, v in rows])  # the bias is one more indicator
    weight, bias = np.zeros(BUCKETS), 0.0
    alpha = np.zeros(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        for i in random.permutation(len(rows)):
            grams, value = rows[i]
            gradient = sign[i] * (weight[grams] @ value + bias) - 1
            moved = min(max(alpha[i] - gradient / square[i], 0.0), limit[i])
            if moved != alpha[i]:
                step = (moved - alpha[i]) * sign[i]
                weight[grams] += step * value
                bias += step
                alpha[i] = moved
    margins = np.array([weight[g] @ v + bias for g, v in rows])
    slope, offset = _calibrate(margins, good, limit)
    return Model(ratio.astype(np.float32), weight.astype(np.float32), bias, slope, offset)


def _calibrate(margins: np.ndarray, good: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """A logistic curve through the margins, by Newton steps; targets are kept off 0 and 1."""
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    x = np.c_[margins, np.ones(len(margins))]
    found = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (share * (p - target)) + 1e-6 * found)
        found = found - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(found[0]), float(found[1])


def held_out(doc_id: Column) -> Column:
    """Whether an id belongs to the fold that is never learned from."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == FOLD, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
                           & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("__quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    rows = docs.select("doc_id", text_or_empty("text").alias("__text")).join(
        F.broadcast(chosen), "doc_id")  # sample_rows ids at most

    @F.pandas_udf("binary")
    def numbers(texts: pd.Series) -> pd.Series:
        grams = Grams()
        return pd.Series([np.sort(grams.of(t)).astype("<i4").tobytes() for t in texts],
                         dtype=object)

    # As bytes, since the driver's JVM and Python would make an object of every number of an array.
    found = rows.select("doc_id", "__quality", numbers("__text").alias("grams")).collect()
    found.sort(key=lambda row: row["doc_id"])
    return fit([np.frombuffer(row["grams"], "<i4") for row in found],
               np.array([row["__quality"] for row in found]))


def scorer(model: Model):
    """A column function from text to score."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        grams = Grams()
        return pd.Series([model.score(grams.of(t)) for t in texts], dtype=float)

    return score


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents the model accepts, with their columns."""
    return docs.where(scorer(model)(text_or_empty("text")) >= 0.5)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The score of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       scorer(model)(text_or_empty("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
