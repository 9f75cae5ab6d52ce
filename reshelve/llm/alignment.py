"""Cross-tokenizer alignment: two tokenizers' tokens of a text linked where their bytes overlap.

Both tokenizers encode a space and the text. Two pointers, one to a token of A and one to a token
of B, run along the bytes: each step links the two tokens, then moves on whichever ends first, or
both, which is a cut. One NumPy state vector holds the pointers of all texts of a batch and moves
them in lockstep; finished ones are taken out of it. Texts longer than LANE bytes are entered at
several places at once, so one very long text doesn't keep a vector of one alive.

A part of a text, from a space after another character than white space to the next, is encoded
once and remembered: neither tokenizer lets a token or a rule reach across such a place. Where a
vocabulary says otherwise, texts are encoded whole.

How often two ids are linked in all documents is counted by blocks: a block is a bounded number of
links of adjacent documents and keeps a dictionary of its distinct pairs. The dictionaries are
shuffled and summed, never the links.

Results in odd cases:

* A null or empty text, or one that a tokenizer doesn't give back byte for byte (as one with
  U+2581 in it), has no tokens; all numbers are zero and the digest is empty.
* Texts of any length are encoded whole. Memory grows with the longest text, and with the longest
  part without a space.
* Repeated rows and null ids change nothing: each row is aligned alone, and all rows count.
* Ties: every pair whose count is the highest of its B id is a best one.
* An empty table gives an empty result. Added columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reshelve.session import shared_folder

# Read on the driver only; their bytes, some megabytes, are sent to the tasks.
FILE_A = "/opt/tokenizers/byte_bpe_50k.json"
FILE_B = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BREAK = re.compile(r"(?<=\S) ")
# The rule by which byte-level files of this kind cut texts, and characters whose kind (letter,
# digit, white space) is the same in all versions of Unicode; parts of these only may go the fast way.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = re.compile("[\x00-\x7f\xa0-\u0233\u2010-\u2027\u2030-\u203e\u20ac]{0,1000}")
LANE = 512
# Bytes of text aligned at once; parts remembered by a task, and their bytes.
BATCH = 1 << 20
MAX_PARTS, MAX_PART_BYTES = 300_000, 16 << 20
# A block ends at either.
BLOCK_LINKS, BLOCK_ROWS = 1_000_000, 20_000
ARRAYS = ("a_ids", "b_ids", "cut_a", "cut_b", "link_a", "link_b")


@dataclass(frozen=True)
class Vocabularies:
    """The contents of a byte-level file of `tokenizers` and a model file of `sentencepiece`."""

    a: bytes
    b: bytes


def read_vocabularies(file_a: str = FILE_A, file_b: str = FILE_B) -> Vocabularies:
    found = []
    for path in (file_a, file_b):
        with open(path, "rb") as file:
            found.append(file.read())
    return Vocabularies(*found)


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if printable,
    the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    """The ids that both tokenizers give to parts of texts, with the known parts kept."""

    def __init__(self, files: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a process per core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.a.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=files.b)
        rules = json.loads(files.a)
        before = rules["pre_tokenizer"] or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError("the first vocabulary must be byte-level without a space of its own")
        byte, special = byte_characters(), {t["id"]: t["content"] for t in rules["added_tokens"]}
        self.bytes_a = [
            special[i].encode() if i in special else bytes(map(byte.__getitem__, token))
            for token, i in sorted(rules["model"]["vocab"].items(), key=lambda item: item[1])]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)]
        self.size_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.fast = self._fast(rules)
        self.mark = self.b.piece_to_id(MARK)
        self.apart = before.get("use_regex", True) and rules["normalizer"] is None \
            and not any(MARK in p.lstrip(MARK) for p in pieces)
        self._forget()

    def _fast(self, rules: dict):
        """The same merges as a table of ranks, where ids follow the order of the merges."""
        model, before = rules["model"], rules["pre_tokenizer"]
        ids = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [ids[x + y] for x, y in merges]
        if not before.get("use_regex", True) or rules["normalizer"] or made != sorted(made) \
                or model.get("ignore_merges") or model.get("dropout") \
                or len({ids[c] for c in byte_characters()} | set(made)) != 256 + len(made):
            return None
        from tiktoken import Encoding

        ranks = {self.bytes_a[i]: i for i in [*(ids[c] for c in byte_characters()), *made]}
        return Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks,
                        special_tokens={}).encode_ordinary

    def _ids_a(self, parts: list[str]) -> list[list[int]]:
        found = [self.fast(" " + p) if PLAIN.fullmatch(p) else None for p in parts] \
            if self.fast else [None] * len(parts)
        others = [i for i, ids in enumerate(found) if ids is None]
        for i, e in zip(others, self.a.encode_batch_fast([" " + parts[i] for i in others],
                                                         add_special_tokens=False)):
            found[i] = e.ids
        return found

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.whole = np.empty(0, bool)
        self.held = 0

    def _learn(self, parts: list[str]) -> None:
        """Encode parts not known yet. B puts a space in front of a part of its own accord, but
        not of an empty one."""
        of_a = self._ids_a(parts)
        of_b = [ids if p else [self.mark]
                for p, ids in zip(parts, self.b.encode(parts, num_threads=1))]
        texts = [f" {p}".encode() for p in parts]
        whole = [b"".join(map(self.bytes_a.__getitem__, x)) == t
                 == b"".join(map(self.bytes_b.__getitem__, y))
                 for x, y, t in zip(of_a, of_b, texts)]
        for side, found in enumerate((of_a, of_b)):
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
            self.ids[side] = np.r_[self.ids[side], flat]
            self.ends[side] = np.r_[self.ends[side], self.ends[side][-1] + sizes.cumsum()]
        self.whole = np.r_[self.whole, np.array(whole, bool)]
        start = len(self.known)
        self.known.update(zip(parts, range(start, start + len(parts))))
        self.held += sum(map(len, texts))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after another for A and for B, and how many each text has."""
        if len(self.known) > MAX_PARTS or self.held > MAX_PART_BYTES:
            self._forget()
        parts: list[str] = []
        counts = []
        for text in texts:
            if text:
                parts += BREAK.split(text) if self.apart else [text]
            counts.append(len(parts))
        missing = set(parts).difference(self.known)
        if missing:
            self._learn(list(missing))
        numbers = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        text_of = np.repeat(np.arange(len(texts)), np.diff(counts, prepend=0))
        broken = np.zeros(len(texts), bool)
        broken[text_of[~self.whole[numbers]]] = True
        kept = ~broken[text_of]
        numbers, text_of = numbers[kept], text_of[kept]
        found = []
        for ids, ends in zip(self.ids, self.ends):
            size = ends[numbers + 1] - ends[numbers]
            last = size.cumsum()
            at = np.arange(last[-1] if len(last) else 0) + np.repeat(ends[numbers] - last + size,
                                                                     size)
            found += [ids[at], np.bincount(text_of, size, len(texts)).astype(np.int64)]
        return found[0], found[2], found[1], found[3]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, start: np.ndarray,
             stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between tokens of A and of B, given by where each token ends, in the order of the
    bytes: the tokens' numbers, and whether both end there.

    `start` and `stop` are the byte ranges to run along, in order and without gaps between
    tokens; a link belongs to the range in which its overlap starts.
    """
    lane = np.arange(len(start))
    i = np.searchsorted(end_a, start, "right")
    j = np.searchsorted(end_b, start, "right")
    begun = np.maximum(np.r_[0, end_a][i], np.r_[0, end_b][j])  # where the overlap starts
    before = begun < start  # that link belongs to the range before, so step over it
    step_a, step_b = end_a[i] <= end_b[j], end_b[j] <= end_a[i]
    reached = np.where(before, np.minimum(end_a[i], end_b[j]), start)
    i, j = i + (before & step_a), j + (before & step_b)
    going = reached < stop
    lane, i, j, stop = lane[going], i[going], j[going], stop[going]
    lanes, links_a, links_b, cuts = [], [], [], []
    while len(lane):
        a, b = end_a[i], end_b[j]
        reached = np.minimum(a, b)
        lanes.append(lane)
        links_a.append(i)
        links_b.append(j)
        cuts.append(a == b)
        i, j = i + (a == reached), j + (b == reached)
        going = reached < stop
        if not going.all():
            lane, i, j, stop = lane[going], i[going], j[going], stop[going]
    if not lanes:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    step = np.repeat(np.arange(len(lanes)), [len(x) for x in lanes])
    lane = np.concatenate(lanes)
    size = np.bincount(lane, minlength=len(start))
    place = (size.cumsum() - size)[lane] + step
    found = []
    for values in (links_a, links_b, cuts):
        values = np.concatenate(values)
        ordered = np.empty_like(values)
        ordered[place] = values
        found.append(ordered)
    return found[0], found[1], found[2]


def aligned(encoder: Encoder, texts: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each of ARRAYS the values of all texts one after another, and how many each has.

    Cuts are given as the numbers of tokens up to there, links as numbers of tokens in the text.
    """
    a, b, n_a, n_b = encoder.encode(texts)
    end_a, end_b = encoder.size_a[a].cumsum(), encoder.size_b[b].cumsum()
    last_a, last_b = n_a.cumsum(), n_b.cumsum()
    stop = np.r_[0, end_a][last_a]
    size = np.diff(stop, prepend=0)
    lanes = -(-size // LANE)
    nth = np.arange(lanes.sum()) - np.repeat(lanes.cumsum() - lanes, lanes)
    start = np.repeat(stop - size, lanes) + nth * LANE
    link_a, link_b, cut = lockstep(end_a, end_b, start,
                                   np.minimum(start + LANE, np.repeat(stop, lanes)))
    text_of = np.repeat(np.arange(len(texts)), n_a)[link_a]
    link_a, link_b = link_a - (last_a - n_a)[text_of], link_b - (last_b - n_b)[text_of]
    n_links = np.bincount(text_of, minlength=len(texts))
    n_cuts = np.bincount(text_of[cut], minlength=len(texts))
    return {"a_ids": (a, n_a), "b_ids": (b, n_b),
            "cut_a": (link_a[cut] + 1, n_cuts), "cut_b": (link_b[cut] + 1, n_cuts),
            "link_a": (link_a, n_links), "link_b": (link_b, n_links)}


def _lists(values: np.ndarray, sizes: np.ndarray, kind=pa.int32()) -> pa.ListArray:
    ends = np.r_[0, sizes.cumsum()].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to about a limit."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(sent) -> Encoder:
    """One per worker process and pair of vocabularies."""
    key = id(sent.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(sent.value)
    return _ENCODERS[key]


def _linked(batches: Iterator[pa.RecordBatch], sent, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches whose last column is the text, with ARRAYS instead of it."""
    encoder = _encoder(sent)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        for start, end in _slices(pc.binary_length(texts).fill_null(0).to_pylist(), BATCH):
            found = aligned(encoder, texts.slice(start, end - start).to_pylist())
            rest = [c.slice(start, end - start) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*rest, *(_lists(*found[c]) for c in ARRAYS)],
                                             names=names)


def _text_last(docs: DataFrame, text: str, added: tuple[str, ...]) -> DataFrame:
    return docs.select(*[c for c in docs.columns if c not in (*added, text)],
                       F.col(text).cast("string").alias("__text"))


def align(docs: DataFrame, files: Vocabularies, text: str = "text") -> DataFrame:
    """The columns but the text, with arrays: ids of both tokenizers, numbers of tokens up to each
    cut, and the two tokens of each link."""
    sent = docs.sparkSession.sparkContext.broadcast(files)
    kept = _text_last(docs, text, ARRAYS)
    schema = T.StructType([*kept.schema.fields[:-1],
                           *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ARRAYS)])
    return kept.mapInArrow(lambda batches: _linked(batches, sent, schema.names), schema)


def _numbers(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of arrays one after another, and how many each row has."""
    found = batch.column(batch.schema.names.index(column))
    values = found.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values, np.diff(found.offsets.to_numpy()).astype(np.int64)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return sizes.cumsum() - sizes


DIGITS = 10


def _group_texts(a, n_a, b, n_b, cut_a, cut_b, n_cuts) -> list[memoryview]:
    """`a1,a2|b1;a3|b2,b3` for each row: decimal ids in order, groups between cuts."""
    row = np.repeat(np.arange(len(n_a)), n_cuts)
    stop_a, stop_b = cut_a + _starts(n_a)[row], cut_b + _starts(n_b)[row]
    size_a, size_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
    group_a = np.repeat(np.arange(len(row)), size_a)
    group_b = np.repeat(np.arange(len(row)), size_b)
    at_a = np.arange(len(a)) + (stop_b - size_b)[group_a]
    at_b = np.arange(len(b)) + stop_a[group_b]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[at_a], ids[at_b] = a, b
    sign = np.full(len(ids), ord(","), np.uint8)
    sign[stop_a - 1 + stop_b - size_b] = ord("|")
    sign[stop_b - 1 + stop_a] = ord(";")
    width = np.ones(len(ids), np.int64)
    for k in range(1, DIGITS):
        width += ids >= 10 ** k
    end = (width + 1).cumsum()
    out = np.empty(end[-1] if len(end) else 0, np.uint8)
    out[end - 1] = sign
    left, place = ids, end - 2
    while len(left):
        out[place] = left % 10 + ord("0")
        more = left >= 10
        left, place = left[more] // 10, place[more] - 1
    last = np.r_[0, end][(n_a + n_b).cumsum()]
    view = memoryview(out)
    return [view[s:max(s, e - 1)] for s, e in zip(np.r_[0, last[:-1]].tolist(), last.tolist())]


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a block with the numbers of their distinct pairs in the block's dictionary and how
    often they hold each; the dictionary stands in the first row."""
    task = TaskContext.get()
    number = task.partitionId() << 32 if task else 0
    rows, keys, sizes, held, n_rows = [], [], [], 0, 0

    def block() -> pa.RecordBatch:
        key, size = np.concatenate(keys), np.concatenate(sizes)
        pairs, pair = np.unique(key, return_inverse=True)
        total = np.bincount(pair, minlength=len(pairs))
        own, times = np.unique(np.repeat(np.arange(len(size)), size) * len(pairs) + pair,
                               return_counts=True)
        of_row = np.bincount(own // max(1, len(pairs)), minlength=len(size))
        first = np.zeros(len(size), np.int64)
        first[0] = len(pairs)
        table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [*table.columns, pa.array(np.full(len(size), number, np.int64)),
             _lists(own % max(1, len(pairs)), of_row), _lists(times, of_row),
             _lists(pairs, first, pa.int64()), _lists(total, first, pa.int64())], names=names)

    for batch in batches:
        links = batch.column(batch.schema.names.index("link_a"))
        lengths = np.diff(links.offsets.to_numpy()).tolist()
        for start, end in _slices(lengths, BLOCK_LINKS):
            part = batch.slice(start, end - start)
            a, n_a = _numbers(part, "a_ids")
            b, n_b = _numbers(part, "b_ids")
            cut_a, n_cuts = _numbers(part, "cut_a")
            cut_b, _ = _numbers(part, "cut_b")
            link_a, n_links = _numbers(part, "link_a")
            link_b, _ = _numbers(part, "link_b")
            row = np.repeat(np.arange(end - start), n_links)
            key = a[link_a + _starts(n_a)[row]] << 32 | b[link_b + _starts(n_b)[row]]
            digests = [hashlib.sha256(t).hexdigest() if len(t) else ""
                       for t in _group_texts(a, n_a, b, n_b, cut_a, cut_b, n_cuts)]
            if held and (held + len(key) > BLOCK_LINKS or n_rows + end - start > BLOCK_ROWS):
                yield block()
                rows, keys, sizes, held, n_rows, number = [], [], [], 0, 0, number + 1
            others = [c for c in batch.schema.names if c not in ARRAYS]
            rows.append(pa.RecordBatch.from_arrays(
                [*(part.column(part.schema.names.index(c)) for c in others),
                 *(pa.array(n, pa.int64()) for n in (n_a, n_b, n_cuts, n_links)),
                 pa.array(digests)], names=names[:len(others) + 5]))
            keys.append(key)
            sizes.append(n_links)
            held, n_rows = held + len(key), n_rows + end - start
    if rows:
        yield block()


COUNTED = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def summarise(docs: DataFrame, files: Vocabularies, text: str = "text") -> DataFrame:
    """The columns but the text, with numbers of tokens, groups and links of `align`, the digest
    of the groups, and how common the links are among all rows: `n_best` links have the highest
    count of their B id, `count_sum` sums the counts."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(files)
    kept = _text_last(docs, text, (*ARRAYS, *COUNTED))
    others = kept.schema.fields[:-1]
    longs, integers = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    numbers = [T.StructField(c, T.LongType()) for c in COUNTED[:4]]
    digest = T.StructField("groups_sha256", T.StringType())
    schema = T.StructType([
        *others, *numbers, digest, T.StructField("__block", T.LongType()),
        T.StructField("__pair", integers), T.StructField("__times", integers),
        T.StructField("__key", longs), T.StructField("__total", longs)])
    folder = f"{shared_folder(spark)}/links-{uuid.uuid4().hex}"
    linked = [*(f.name for f in others), *ARRAYS]
    kept.mapInArrow(lambda batches: _blocks(_linked(batches, sent, linked), schema.names), schema) \
        .write.option("compression", "zstd").parquet(folder)
    blocks, dictionaries = (spark.read.schema(schema).parquet(folder) for _ in range(2))

    pairs = dictionaries.where(F.size("__key") > 0).select(
        "__block", F.posexplode(F.arrays_zip("__key", "__total")).alias("__at", "pair")).select(
        "__block", "__at", F.col("pair.__key").alias("__key"), F.col("pair.__total").alias("n"))
    counts = pairs.groupBy("__key").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("b", F.col("__key").bitwiseAND(0xFFFFFFFF))
    highest = counts.groupBy("b").agg(F.max("count").alias("most"))
    # One row per id of B: its vocabulary bounds what is broadcast.
    counts = counts.join(F.broadcast(highest), "b").select(
        "__key", "count", (F.col("count") == F.col("most")).alias("best"))
    known = pairs.join(counts, "__key").select("__block", "__at", "count", "best")

    names = [f.name for f in others]
    result = T.StructType([*others, *numbers, digest,
                           *(T.StructField(c, T.LongType()) for c in COUNTED[5:])])

    def looked_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        count, best = (np.zeros(found.num_rows, np.int64) for _ in range(2))
        at = found.column("__at").to_numpy()
        count[at] = found.column("count").to_numpy()
        best[at] = found.column("best").to_numpy()
        sums = []
        for batch in rows.to_batches():
            pair, n = _numbers(batch, "__pair")
            times, _ = _numbers(batch, "__times")
            row = np.repeat(np.arange(len(n)), n)
            sums.append([_sums(row, times * x[pair], len(n)) for x in (best, count)])
        columns = [*(rows.column(c) for c in names), *(rows.column(c) for c in COUNTED[:5]),
                   *(pa.array(np.concatenate([s[k] for s in sums])) for k in range(2))]
        return pa.table(columns, names=result.names)

    return blocks.drop("__key", "__total").groupBy("__block").cogroup(
        known.groupBy("__block")).applyInArrow(looked_up, result)


def _sums(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of values per row, in whole numbers; the rows are in order."""
    running = np.r_[0, values.cumsum()]
    ends = np.searchsorted(row, np.arange(n), "right")
    return running[ends] - running[np.r_[0, ends[:-1]]]


def op13_align(spark: SparkSession, folder: str, file_a: str = FILE_A,
               file_b: str = FILE_B) -> DataFrame:
    """How the tokens of two tokenizers meet in every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = summarise(docs, read_vocabularies(file_a, file_b))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        "groups_sha256")
