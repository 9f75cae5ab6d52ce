"""Toxicity by weak supervision.

Many voters look at the labelled sample: written lexicons, patterns, words and stems that the
labels point to, one that votes clean where none of them finds anything, and the annotator. A
voter says toxic, clean or nothing. A generative label model explains the votes by a hidden label:
each voter's answer depends on the label, and of two voters that agree more than the label explains
one depends on the other as well (a forest of the strongest such ties). Expectation maximisation
estimates those tables, that is how accurate and how correlated the voters are, and the
probability of the hidden label of every text. A logistic model on words and stems is fitted to
these probabilities; it alone scores texts.

The fit uses the SAMPLE_ROWS labelled rows with the least id hashes, 12,000 unless set. Their
words are counted on the cluster; the driver gets the FEATURES words and stems that tell the most,
and which of them each sampled text has.

Results in odd cases:

* A null or empty text has no words and gets the score of the bias.
* Whole texts are scored, of any length. A word counts once per text.
* Labels other than 0 and 1 and null ids are ignored; of several labels of an id the greatest
  counts. Without labels every score is 0.5, with labels of one class only it is that class.
* Repeated rows are scored each; a null id is not held out and never learned from. Ties between
  words that tell as much go to the first in byte order.
* An empty table gives an empty result. `scored` replaces columns named `score` and `predicted`.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reshelve.llm.columns import text_or_empty
from reshelve.llm.memory import Remembered, per_process

SAMPLE_ROWS = 12_000
FEATURES = 4096
LEAST_TEXTS = 3
FOLDS, FOLD = 5, 0
# Mined voters, and how many standard errors apart the classes have to be for one.
MINED, TELLING = 64, 4.0
STEMS = range(3, 9)
ROUNDS, TIED = 40, 0.01
STEPS, RATE, DECAY = 600, 0.1, 1e-4
# How often the annotator is taken to be right, and how alike two mined voters may be.
TRUST, ALIKE = 0.98, 0.7
MAX_CACHED = 400_000

WORD = re.compile(r"[^\W_]+")
DISGUISED = re.compile(r"(?=\w*\d)(?=\w*[^\W\d])\w+")
PLAIN = str.maketrans("013457", "oieast")

# Words a reader would take as an insult or as contempt, per lexicon.
LEXICONS = {
    "persons": "idiot idiots moron morons loser losers clown fool imbecile jerk dumbass",
    "contempt": "stupid pathetic worthless disgusting ridiculous useless dumb brainless",
    "things": "scum trash garbage filth vermin parasite parasites rats",
    "hate": "hate despise loathe kill die hang",
    "german": "idiot dummkopf trottel versager abschaum widerlich wertlos dumm blöd arschloch",
    "french": "idiot imbécile crétin minable ordure déchet stupide débile connard abruti",
    "spanish": "idiota imbécil estúpido basura patético inútil asqueroso tonto escoria",
}
_NAMES = "|".join(LEXICONS["persons"].split() + LEXICONS["contempt"].split()
                  + LEXICONS["things"].split())
PATTERNS = {
    "at a person": re.compile(rf"\byou(?:'re)?\b(?:\W+\w+){{0,3}}\W+(?:{_NAMES})\b", re.I),
    "of a kind": re.compile(rf"\b(?:what an?|such an?|total|complete|you)\W+(?:{_NAMES})\b", re.I),
    "threat": re.compile(r"\b(?:will|gonna|going to|should)\W+(?:kill|hurt|beat|destroy)\b", re.I),
    "send away": re.compile(r"\b(?:shut up|get lost|drop dead|go to hell|go away)\b", re.I),
    "hidden letters": re.compile(r"\b[a-z]{1,3}[*#@$]{2,}[a-z]+\b", re.I),
    "insult shouted": re.compile(rf"\b(?:{_NAMES.upper()})\b"),
    "insult and mark": re.compile(rf"\b(?:{_NAMES})\b\W*!", re.I),
}


def features(word: str) -> list[str]:
    """A word, what it spells if digits stand for letters, and its stems, which end in a star."""
    found = [word]
    if DISGUISED.fullmatch(word):
        found.append(word.translate(PLAIN))
    return found + [word[:k] + "*" for k in STEMS if k < len(word)]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def written_votes(text: str) -> list[int]:
    """One per lexicon and pattern: 1 where it finds something."""
    words = words_of(text)
    return [int(not words.isdisjoint(lexicon.split())) for lexicon in LEXICONS.values()] + [
        int(pattern.search(text) is not None) for pattern in PATTERNS.values()]


@dataclass
class LabelModel:
    """P(vote | label, vote of the voter it depends on) for voters answering -1, 0 or 1."""

    parent: list[int]
    tables: list[np.ndarray] = field(default_factory=list)
    prior: float = 0.5

    def _codes(self, votes: np.ndarray) -> list[np.ndarray]:
        value = votes.astype(np.int64) + 1
        return [value[:, j] if p < 0 else value[:, p] * 3 + value[:, j]
                for j, p in enumerate(self.parent)]

    def learn(self, votes: np.ndarray, belief: np.ndarray) -> None:
        """The tables that explain the votes best if the labels are as believed."""
        self.prior = float((belief.sum() + 1) / (len(belief) + 2))
        self.tables = []
        for p, code in zip(self.parent, self._codes(votes)):
            rows = 1 if p < 0 else 3
            table = np.stack([np.bincount(code, w, rows * 3).reshape(rows, 3) + 0.5
                              for w in (1 - belief, belief)])
            self.tables.append(table / table.sum(axis=2, keepdims=True))

    def probability(self, votes: np.ndarray, annotated: np.ndarray | float = 0.5) -> np.ndarray:
        """That each text is toxic, given all votes and what the annotator says."""
        odds = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        odds += np.log(annotated / (1 - np.asarray(annotated)))
        for table, code in zip(self.tables, self._codes(votes)):
            ratio = np.log(table[1] / table[0]).ravel()
            odds += ratio[code]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def accuracy(self) -> np.ndarray:
        """Of each voter that depends on none: how likely its answer is right when it gives one."""
        found = []
        for p, table in zip(self.parent, self.tables):
            if p < 0:
                right = self.prior * table[1, 0, 2] + (1 - self.prior) * table[0, 0, 0]
                wrong = self.prior * table[1, 0, 0] + (1 - self.prior) * table[0, 0, 2]
                found.append(right / (right + wrong))
            else:
                found.append(np.nan)
        return np.array(found)


def ties(votes: np.ndarray, belief: np.ndarray) -> np.ndarray:
    """How much the votes of each two voters tell of each other once the label is known, in nats."""
    kinds = [(votes == v).astype(float) for v in (-1, 0, 1)]
    found = np.zeros((votes.shape[1], votes.shape[1]))
    for weight in (1 - belief, belief):
        total = weight.sum() + 1e-9
        alone = [(weight @ k) / total for k in kinds]
        for a, x in enumerate(kinds):
            for b, y in enumerate(kinds):
                both = (x * weight[:, None]).T @ y / total
                expected = np.outer(alone[a], alone[b])
                with np.errstate(divide="ignore", invalid="ignore"):
                    found += total / len(votes) * np.where(
                        both > 1e-12, both * np.log(both / np.maximum(expected, 1e-300)), 0.0)
    np.fill_diagonal(found, 0)
    return found


def forest(strength: np.ndarray, least: float = TIED) -> list[int]:
    """The voter each depends on, or -1: a greatest spanning forest of the ties."""
    n = len(strength)
    parent, joined = [-1] * n, [False] * n
    for root in range(n):
        if joined[root]:
            continue
        joined[root] = True
        best, source = strength[root].copy(), np.full(n, root)
        while True:
            best[joined] = -1
            j = int(best.argmax())
            if best[j] < least:
                break
            parent[j], joined[j] = int(source[j]), True
            nearer = strength[j] > best
            best[nearer], source[nearer] = strength[j][nearer], j
    return parent


def label_model(votes: np.ndarray, annotated: np.ndarray) -> tuple[LabelModel, np.ndarray]:
    """Fit from what the annotator says, first with voters taken as independent, then with their
    ties. The annotator is one more voter, whose accuracy is given."""
    belief = annotated
    model = LabelModel([-1] * votes.shape[1])
    for _ in range(ROUNDS // 4):
        model.learn(votes, belief)
        belief = model.probability(votes, annotated)
    model = LabelModel(forest(ties(votes, belief)))
    for _ in range(ROUNDS):
        model.learn(votes, belief)
        belief = model.probability(votes, annotated)
    return model, belief


@dataclass
class Model:
    """Weights of words and stems."""

    weight: dict[str, float]
    bias: float
    voters: LabelModel | None = None

    def of_word(self, word: str) -> float:
        return sum(self.weight.get(f, 0.0) for f in features(word))


def logistic(row: np.ndarray, column: np.ndarray, value: np.ndarray, target: np.ndarray,
             n: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model for soft targets, by gradient steps over all texts,
    each weight with a rate of its own that falls with the gradients it has seen."""
    weight, seen = np.zeros(n + 1), np.full(n + 1, 1e-12)  # the last one is the bias
    for _ in range(STEPS):
        margin = np.bincount(row, value * weight[column], len(target)) + weight[n]
        left = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) / len(target)
        slope = np.r_[np.bincount(column, value * left[row], n) + DECAY * weight[:n], left.sum()]
        seen += slope * slope
        weight = weight - RATE * slope / np.sqrt(seen)
    return weight[:n], float(weight[n])


def mined_votes(strength: np.ndarray, row: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
    """Voters for the words and stems the labels point to most, each for other texts than those
    before it."""
    place = {f: row[column == f] for f in np.argsort(-strength, kind="stable")[:8 * MINED].tolist()
             if strength[f] > TELLING}
    taken: list[set] = []
    for texts in map(set, map(np.ndarray.tolist, place.values())):
        if len(taken) < MINED and all(
                len(texts & other) <= ALIKE * len(texts | other) for other in taken):
            taken.append(texts)
    votes = np.zeros((n, len(taken)), np.int8)
    for k, texts in enumerate(taken):
        votes[list(texts), k] = 1
    return votes


def fit(names: list[str], strength: np.ndarray, row: np.ndarray, column: np.ndarray,
        count: np.ndarray, written: np.ndarray, labels: np.ndarray) -> Model:
    """Fit on which features, how often and which written voters each text has, and its label."""
    labels = np.asarray(labels) == 1
    if not len(labels) or labels.all() or not labels.any():
        return Model({}, 0.0 if not len(labels) else 500.0 if labels.all() else -500.0)
    votes = mined_votes(strength, row, column, len(labels))
    telling = strength[column] > TELLING
    hits = np.bincount(row[telling], minlength=len(labels))
    found = np.c_[written, votes, *(hits >= k for k in (2, 4, 8, 16)), -(hits == 0).astype(int)]
    model, belief = label_model(found.astype(np.int8), np.where(labels, TRUST, 1 - TRUST))
    scale = np.minimum(np.abs(strength), 12) / 12
    weight, bias = logistic(row, column, count * scale[column], belief, len(names))
    weight = weight * scale
    kept = {names[i]: float(weight[i]) for i in np.flatnonzero(weight)}
    return Model(kept, bias, model)


def held_out(doc_id: Column) -> Column:
    """Whether an id belongs to the fold that is never learned from."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == FOLD, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
                           & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    rows = docs.select("doc_id", text_or_empty("text").alias("__text")).join(
        F.broadcast(chosen), "doc_id")  # sample_rows ids at most

    @F.pandas_udf("array<string>")
    def all_features(texts: pd.Series) -> pd.Series:
        known = Remembered(features, MAX_CACHED)
        return pd.Series([sorted({f for w in words_of(t) for f in known[w]}) for t in texts],
                         dtype=object)

    sizes = {r["__toxic"]: r["n"] for r in rows.groupBy("__toxic").agg(
        F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return fit([], np.empty(0), *(np.empty(0, int) for _ in range(3)), np.empty((n0 + n1, 0)),
                   np.full(n0 + n1, int(n1 > 0)))
    share = (F.col("n") + 1) / F.lit(n0 + n1 + 2)
    told = (F.col("toxic") / n1 - (F.col("n") - F.col("toxic")) / n0) / F.sqrt(
        share * (1 - share) * F.lit(1 / n0 + 1 / n1))
    told = (rows.select("__toxic", F.explode(all_features("__text")).alias("feature"))
            .groupBy("feature").agg(F.sum("__toxic").alias("toxic"), F.count("*").alias("n"))
            .where(F.col("n") >= LEAST_TEXTS).select("feature", told.alias("told"))
            .orderBy(F.abs("told").desc(), "feature").limit(FEATURES).toPandas())
    names = told["feature"].tolist()
    number = {name: i for i, name in enumerate(names)}

    @F.pandas_udf("found array<int>, times array<int>, votes array<int>")
    def read(texts: pd.Series) -> pd.DataFrame:
        known = Remembered(lambda w: [number[f] for f in features(w) if f in number], MAX_CACHED)
        found = []
        for text in texts:
            ids = np.array([i for w in words_of(text) for i in known[w]], np.int32)
            ids, times = np.unique(ids, return_counts=True)
            found.append((ids, times.astype(np.int32), np.array(written_votes(text), np.int32)))
        return pd.DataFrame(found, columns=["found", "times", "votes"])

    sample = rows.select("doc_id", "__toxic", read("__text").alias("seen")).select(
        "doc_id", "__toxic", "seen.*").toPandas().sort_values("doc_id", kind="stable")
    size = np.array([len(x) for x in sample["found"]])
    return fit(names, told["told"].to_numpy(), np.repeat(np.arange(len(size)), size),
               np.concatenate(sample["found"].to_list()).astype(np.int64),
               np.concatenate(sample["times"].to_list()).astype(float),
               np.stack(sample["votes"].to_list()), sample["__toxic"].to_numpy())


class Scorer:
    """Scores texts, with the weights of known words kept."""

    def __init__(self, model: Model):
        self.bias = model.bias
        self.words = Remembered(model.of_word, MAX_CACHED)

    def score(self, text: str) -> float:
        margin = self.bias + sum(sorted(map(self.words.__getitem__, words_of(text))))
        return 1 / (1 + math.exp(-min(max(margin, -500.0), 500.0)))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns with `score`, 0 to 1, and `predicted`, 1 if the score is 0.5 or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scorer = per_process("toxicity", sent, Scorer)
        return pd.Series([scorer.score(t) for t in texts], dtype=float)

    return docs.withColumn("score", score(text_or_empty(text))).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The score of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                                      "score", "predicted")
