"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer reads the text, normalises it (spaces become a visible mark, one may be put in
front) and writes pieces. Its arcs are the pieces of the vocabulary, and the bytes of a character
that no piece has. Composed with an input it is a lattice over the positions of the text; the
ids are those of its shortest path in the tropical semiring, where weights add along a path and
the least counts.

* Of a unigram model the arcs weigh minus their score.
* A merge model admits a piece after another only if the merges of the two together end in just
  these two; an arc between others weighs infinity. A sequence all of whose neighbours are
  admitted is the one the merges make, and every prefix has exactly one, so the shortest path is
  the only finite one and equals the merges in order of score.

Results in odd cases:

* A null or empty text has no ids and decodes to the empty text.
* A text of several megabytes, or a word of that size, is encoded in time proportional to it.
* The mark itself, U+2581, decodes to a space, and a lone byte piece that is not UTF-8 to U+FFFD;
  every other text decodes to itself.
* Repeated rows, ties and null ids change nothing: each row is encoded alone.
* An empty table gives an empty result. Added columns replace columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The vocabulary file must be readable on the driver only; its pieces are sent to the tasks.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Segments, pairs and pieces remembered by a task, twice: those in use and those used before. Texts encoded at once.
MAX_CACHED = 300_000
ROWS = 256
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
INFINITY = float("inf")


@dataclass(frozen=True)
class Vocabulary:
    """What is compiled from a model file."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    merges: bool
    prefix: bool
    squeeze: bool
    unknown: int


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model file; those with a table of character replacements are not supported."""
    from sentencepiece import sentencepiece_model_pb2 as model

    proto = model.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    trainer, rules = proto.trainer_spec, proto.normalizer_spec
    if rules.precompiled_charsmap or trainer.treat_whitespace_as_suffix or \
            not rules.escape_whitespaces or trainer.model_type not in (1, 2):
        raise ValueError(f"{path}: its normaliser or kind of model is not supported")
    return Vocabulary(
        [p.piece for p in proto.pieces], [p.score for p in proto.pieces],
        [p.type for p in proto.pieces], trainer.model_type == 2, rules.add_dummy_prefix,
        rules.remove_extra_whitespaces, trainer.unk_id)


class _Bounded(dict):
    """Remembered results of a function. When there are too many, those used since the last time
    are kept and the others forgotten."""

    def __init__(self, of):
        super().__init__()
        self.of = of
        self.older: dict = {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.of(key)
        if len(self) >= MAX_CACHED:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


@dataclass
class Transducer:
    vocabulary: Vocabulary
    ids: dict[str, int] = field(init=False)

    def __post_init__(self):
        v = self.vocabulary
        usable = [i for i, kind in enumerate(v.types) if kind in (NORMAL, USER)]
        self.ids = {v.pieces[i]: i for i in usable}
        self.weight = {v.pieces[i]: -v.scores[i] for i in usable}
        self.longest = max(map(len, self.ids), default=1)
        self.trie: dict = {}
        for piece in self.ids:
            node = self.trie
            for character in piece:
                node = node.setdefault(character, {})
            node[""] = piece
        self.bytes = {int(v.pieces[i][3:-1], 16): i for i, kind in enumerate(v.types)
                      if kind == BYTE}
        self.spelled = [
            bytes([int(p[3:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL
            else " ⁇ ".encode() if kind == UNKNOWN else p.encode()
            for p, kind in zip(v.pieces, v.types)]
        self.worst = max(self.weight.values(), default=0.0) + 10
        self.segment = self._cuts()
        self.segments = _Bounded(lambda s: tuple(self.shortest_path(s)))
        self.pairs = _Bounded(lambda pair: self.merged(pair[0] + pair[1]) == [*pair]
                              and self.whole[pair[1]])
        self.whole = _Bounded(lambda piece: self.merged(piece) == [piece])

    def _cuts(self) -> re.Pattern | None:
        """A pattern for segments that can be solved alone, as no piece reaches past their ends.

        A path stops before a mark that follows another character, after a run of letters, and on
        both sides of a line break, where the vocabulary has no piece that says otherwise;
        letters that some piece continues with another sign do not count as such.
        """
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            return None
        letter = re.compile(r"[^\W\d_]")
        going_on = {a for p in self.ids for a, b in zip(p, p[1:])
                    if letter.match(a) and not letter.match(b)}
        breaks = "".join(c for c in "\n\r\t" if all(c not in p for p in self.ids if len(p) > 1))
        others = re.escape("".join(sorted(going_on)))
        letters = rf"[^\W\d_{others}]"
        signs = rf"(?:(?![{MARK}{breaks}])[\W\d_{others}])"
        lone = f"|[{breaks}]" if breaks else ""
        return re.compile(f"{MARK}*{signs}*{letters}+|{MARK}*{signs}+|{MARK}+{lone}")

    def normalised(self, text: str) -> str:
        if self.vocabulary.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.vocabulary.prefix else "") + text.replace(" ", MARK)

    def merged(self, text: str) -> list[str]:
        """What the merges make of a short text: the best pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            weight, at = min((self.weight.get(a + b, INFINITY), i)
                             for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if weight == INFINITY:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def shortest_path(self, text: str) -> list[int]:
        """The ids along the least path through the lattice of a normalised text."""
        found = self._finite(text) if self.vocabulary.merges else self._least(text)
        return [i for piece in found for i in self.written(piece)]

    def _least(self, text: str) -> list[str]:
        """The pieces of the least path, position by position."""
        cost = [0.0] + [INFINITY] * len(text)
        last = [""] * (len(text) + 1)
        for start in range(len(text)):
            for end in range(start + 1, min(len(text), start + self.longest) + 1):
                piece = text[start:end]
                weight = self.weight.get(piece, self.worst if end == start + 1 else INFINITY)
                if cost[start] + weight < cost[end]:
                    cost[end], last[end] = cost[start] + weight, piece
        found, end = [], len(text)
        while end:
            found.append(last[end])
            end -= len(last[end])
        return found[::-1]

    def _arcs(self, text: str, start: int) -> list[str]:
        """The arcs that leave a position, shortest first; a character without piece has one."""
        node, found = self.trie, []
        for character in text[start:start + self.longest]:
            node = node.get(character)
            if node is None:
                break
            if "" in node:
                found.append(node[""])
        if not found or len(found[0]) > 1:
            found.insert(0, text[start])
        return found

    def _finite(self, text: str) -> list[str]:
        """The pieces of the only finite path: arcs are tried depth first, the longest before
        others, and those that led nowhere are not tried again."""
        whole, pairs, size = self.whole, self.pairs, len(text)
        path: list[str] = []
        at, last, dead = 0, "", set()
        open_ = [self._arcs(text, 0)]
        while at < size:
            arcs = open_[-1]
            while arcs:
                piece = arcs.pop()
                if (pairs[last, piece] if at else whole[piece]) and \
                        not (dead and (at, piece) in dead):
                    path.append(piece)
                    at += len(piece)
                    last = piece
                    if at < size:
                        open_.append(self._arcs(text, at))
                    break
            else:
                open_.pop()
                path.pop()
                at -= len(last)
                dead.add((at, last))
                last = path[-1] if path else ""
        return path

    def written(self, piece: str) -> list[int]:
        """The ids an arc writes: that of its piece, else its bytes, else the unknown one."""
        if piece in self.ids:
            return [self.ids[piece]]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        return [self.vocabulary.unknown]

    def encode(self, text: str) -> np.ndarray:
        text = self.normalised(text)
        parts = self.segment.findall(text) if self.segment else [text] if text else []
        found = chain.from_iterable(map(self.segments.__getitem__, parts))
        return np.fromiter(found, np.int32)

    def decode(self, ids) -> str:
        """The text of ids; the mark put in front by the normaliser is taken off."""
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        if self.vocabulary.prefix and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """All columns with `ids`, their number `n_ids` and whether they decode to the text."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary, megabytes
    kept = docs.drop("ids", "n_ids", "exact")
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_ids", T.IntegerType()),
                           T.StructField("exact", T.BooleanType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A few rows at a time, so that the ids of very long texts do not pile up."""
        transducer = _transducer(sent)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = [t or "" for t in part.column(at).to_pylist()]
                ids = [transducer.encode(t) for t in texts]
                size = np.array([len(i) for i in ids], np.int32)
                values = pa.array(np.concatenate(ids), pa.int32())
                ends = np.r_[0, size.cumsum()].astype(np.int32)
                exact = [transducer.decode(i.tolist()) == t for i, t in zip(ids, texts)]
                arrays = [*part.columns, pa.ListArray.from_arrays(pa.array(ends), values),
                          pa.array(size), pa.array(exact)]
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema])

    return kept.mapInArrow(coded, schema)


_TRANSDUCERS: dict[int, Transducer] = {}


def _transducer(sent) -> Transducer:
    """One transducer per worker process and vocabulary, as its memory of segments is worth
    keeping from batch to batch."""
    key = id(sent.value)
    if key not in _TRANSDUCERS:
        _TRANSDUCERS.clear()
        _TRANSDUCERS[key] = Transducer(sent.value)
    return _TRANSDUCERS[key]


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """All columns with the text of the ids as `decoded`; null ids give the empty text."""
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def text(found: pd.Series) -> pd.Series:
        transducer = _transducer(sent)
        return pd.Series([transducer.decode([] if i is None else i) for i in found], dtype=object)

    return rows.withColumn("decoded", text(F.col(ids)))


def op7_pieces(spark: SparkSession, folder: str, model: str = MODEL) -> DataFrame:
    """The ids of every document, and whether they decode to its text."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return encode(docs, read_vocabulary(model)).drop("text")
