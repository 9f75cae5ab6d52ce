"""Phrase collocation mining: frequent phrases and how much more often their words meet than chance
would have it, per language.

Phrases are counted in a HAT-trie: a shallow trie over word ids whose leaves are hash containers of
the words that follow. A container that grows too large bursts into a node with a container per
next word. When a task holds too many phrases, it writes its largest subtrees whole, each as a run
sorted by phrase, and goes on without them. Runs are dealt out by their prefix and merged there.

Phrases are counted in passes of growing length. A phrase can only be frequent if the shorter ones
in it are, so a pass skips what holds a rare one. It asks a bitmap of fixed size for that, which
never calls a frequent phrase rare; a rare one it lets through is counted and then dropped.

Words and counts:

* A-Z is lower-cased. Texts split into pieces at `.,;:!?` and U+000A to U+000D, pieces into words at
  spaces and tabs. Phrases lie within a piece; overlapping occurrences all count.
* A prefix that begins more than one in HOT_SHARE of all phrases is dealt out by whole phrases.

Results in odd cases:

* A null or empty text has no words; a null language is `und`, and one table row's language may
  hold all rows, as nothing but the first rows of each language is ever sorted by it.
* Very long texts are read in slices that end between pieces; a piece without any end is read whole.
* Repeated rows count each; ids are not looked at. Ties in score go to the more frequent phrase,
  then to the first in byte order.
* An empty table gives an empty result. No column of the input but text and language is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reshelve.llm.columns import text_or_empty
from reshelve.session import stored

LONGEST, LEAST, TOP = 5, 100, 2000
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t",
                       b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
SKIPPED, END = -2, -1
# Bytes of text read at once, phrases and words a task holds, and a container before it bursts.
BATCH, MAX_PHRASES, MAX_WORDS, BURST = 4 << 20, 1_000_000, 400_000, 16_384
# Phrases merged at once, at least.
MERGED = 1_000_000
HOT_SHARE = 2048
BITS_PER_PHRASE, MAX_BITS = 16, 1 << 27


# A container's key is up to two word ids behind a leading one, in 63 bits.
ID_BITS = 31
ONE, MASK = 1 << ID_BITS, (1 << ID_BITS) - 1
TWO = ONE << ID_BITS


class Node(dict):
    """A trie node: the subtree of each next word, a node or a hash container, and the counts of
    the phrases that end with it."""

    def __init__(self):
        super().__init__()
        self.ends: dict[int, int] = {}


class Trie:
    """Counts of phrases of two word ids and more."""

    def __init__(self):
        self.root = Node()
        self.size = 0

    def add(self, phrases: np.ndarray, counts: np.ndarray) -> None:
        """Phrases of one length, a row each, sorted."""
        if len(phrases):
            self._add(self.root, phrases, counts, 0)

    def _add(self, node: Node, phrases: np.ndarray, counts: np.ndarray, depth: int) -> None:
        rest = phrases.shape[1] - depth - 1
        words, numbers = phrases[:, depth], counts.tolist()
        if not rest:
            before, ends = len(node.ends), node.ends
            for word, count in zip(words.tolist(), numbers):
                ends[word] = ends.get(word, 0) + count
            self.size += len(ends) - before
            return
        starts = np.r_[0, np.flatnonzero(np.diff(words)) + 1]
        keys = [] if rest > 2 else _packed(phrases[:, depth + 1:]).tolist()
        stops = [*starts[1:].tolist(), len(words)]
        for word, start, stop in zip(words[starts].tolist(), starts.tolist(), stops):
            child = node.get(word)
            if child is None:
                child = node[word] = Node() if rest > 2 else {}
            elif rest > 2 and type(child) is dict:
                child = node[word] = _burst(child)
            if type(child) is Node:
                self._add(child, phrases[start:stop], counts[start:stop], depth + 1)
                continue
            before = len(child)
            for key, count in zip(keys[start:stop], numbers[start:stop]):
                child[key] = child.get(key, 0) + count
            self.size += len(child) - before
            if rest > 1 and len(child) > BURST:
                node[word] = _burst(child)

    def spill(self, left: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Take out the largest subtrees, whole, until at most `left` phrases stay: for each length
        of phrase their word ids and counts."""
        sizes = {word: _size(child) for word, child in self.root.items()}
        taken = []
        for word in sorted(sizes, key=sizes.get, reverse=True):
            if self.size <= left:
                break
            taken += _containers(self.root.pop(word), (word,))
            self.size -= sizes[word]
        return _phrases(taken)


def _packed(words: np.ndarray) -> np.ndarray:
    key = np.ones(len(words), np.int64)
    for column in words.T:
        key = key << ID_BITS | column
    return key


def _burst(container: dict) -> Node:
    node = Node()
    for key, count in container.items():
        if key < TWO:
            node.ends[key & MASK] = count
        else:
            node.setdefault(key >> ID_BITS & MASK, {})[ONE | key & MASK] = count
    return node


def _size(child: Node | dict) -> int:
    return len(child) if type(child) is dict else len(child.ends) + sum(map(_size, child.values()))


def _containers(child: Node | dict, path: tuple) -> list[tuple[tuple, dict]]:
    """The containers below, each with the words that lead to it."""
    if type(child) is dict:
        return [(path, child)]
    found = [(path, {ONE | word: count for word, count in child.ends.items()})]
    for word, deeper in child.items():
        found += _containers(deeper, (*path, word))
    return found


def _phrases(containers: list[tuple[tuple, dict]]) -> list[tuple[np.ndarray, np.ndarray]]:
    lengths: dict[int, list] = {}
    for depth in {len(path) for path, _ in containers}:
        held = [(path, c) for path, c in containers if len(path) == depth and c]
        if not held:
            continue
        sizes = [len(c) for _, c in held]
        total = sum(sizes)
        paths = np.repeat(np.array([path for path, _ in held], np.int64), sizes, axis=0)
        keys = np.fromiter(chain.from_iterable(c for _, c in held), np.int64, total)
        counts = np.fromiter(chain.from_iterable(c.values() for _, c in held), np.int64, total)
        two = keys >= TWO
        for rows, words in ((~two, [keys & MASK]), (two, [keys >> ID_BITS & MASK, keys & MASK])):
            if rows.any():
                lengths.setdefault(depth + len(words), []).append((
                    np.column_stack([paths[rows], *(w[rows] for w in words)]), counts[rows]))
    return [(np.concatenate([m for m, _ in parts]), np.concatenate([c for _, c in parts]))
            for parts in lengths.values()]


def word_hash(group: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(group.encode() + b"\0" + word)


def mixed(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of the hashes of the words of each phrase."""
    found = np.zeros(len(hashes[0]), np.uint64)
    for word in hashes:
        found = (found ^ word) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found


@dataclass(frozen=True)
class Known:
    """A bitmap of the frequent phrases of one length: two bits each."""

    length: int
    words: np.ndarray

    def places(self, hashes: np.ndarray) -> list[np.ndarray]:
        mask = np.uint64(len(self.words) * 64 - 1)
        return [hashes & mask, (hashes >> np.uint64(32)) & mask]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes):
            bits = self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))
            found &= (bits & np.uint64(1)).astype(bool)
        return found


def remember(frequent: DataFrame, length: int) -> Known:
    """The bitmap of all frequent phrases of a length. It has at most MAX_BITS bits, which are put
    together in the tasks; beyond that it lets more rare ones through."""
    rows = frequent.where(F.col("size") == length).select("group", "phrase")
    bits = 1 << 12
    while bits < min(MAX_BITS, rows.count() * BITS_PER_PHRASE):
        bits *= 2
    empty = Known(length, np.zeros(bits // 64, np.uint64))

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [p.encode().split(b" ") for p in batch.column(1).to_pylist()]
            groups = batch.column(0).to_pylist()
            hashes = mixed([np.array([word_hash(g, w[k]) for g, w in zip(groups, words)],
                                     np.uint64) for k in range(length)])
            place = np.concatenate(empty.places(hashes))
            bit = np.uint64(1) << (place & np.uint64(63))
            yield pa.RecordBatch.from_arrays(
                [pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(bit.view(np.int64))],
                names=["at", "bit"])

    found = rows.mapInArrow(set_bits, "at long, bit long").groupBy("at").agg(
        F.bit_or("bit").alias("bits")).toArrow()
    empty.words[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return empty


class Numbers(dict):
    """Numbers of words; new words get the next one and are noted."""

    def __init__(self):
        super().__init__({b"": SKIPPED, b"\n": END})
        self.next, self.new = 0, []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.next + len(self.new)
        self.new.append(word)
        return number


class Counter:
    """Phrases of one group in one task."""

    def __init__(self, group: str, sizes: tuple[int, ...], known: list[Known]):
        self.group, self.sizes = group, sizes
        self.rare = next((k for k in known if k.length == 1), None)
        self.shorter = max(known, key=lambda k: k.length, default=None)
        self.total = 0
        self.clear()

    def clear(self) -> None:
        self.trie = Trie()
        self.single = np.empty(0, np.int64)
        self.number = Numbers()
        self.words: list[bytes] = []
        self.hashes = np.empty(0, np.uint64)

    def _numbers(self, tokens: list[bytes]) -> np.ndarray:
        """Word ids; rare words end a phrase as a piece does."""
        ids = np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))
        new, first = self.number.new, self.number.next
        if not new:
            return ids
        hashes = np.array([word_hash(self.group, w) for w in new], np.uint64)
        if self.rare:
            kept = self.rare.has(mixed([hashes]))
            final = np.where(kept, first + kept.cumsum() - 1, END)
            self.number.update(zip(new, final.tolist()))
            late = ids >= first
            ids[late] = final[ids[late] - first]
            new, hashes = [w for w, k in zip(new, kept) if k], hashes[kept]
        self.words += new
        self.hashes = np.r_[self.hashes, hashes]
        self.number.next, self.number.new = len(self.words), []
        return ids

    def read(self, text: bytes) -> None:
        """Count the phrases of whole pieces of text, folded already."""
        ids = self._numbers(text.replace(b"\n", b" \n ").split(b" "))
        ids = ids[ids != SKIPPED]
        if 1 in self.sizes:
            found = np.bincount(ids[ids >= 0], minlength=len(self.words))
            self.total += int(found.sum())
            found[:len(self.single)] += self.single
            self.single = found
        if self.sizes != (1,):
            self._longer(ids)

    def _longer(self, ids: np.ndarray) -> None:
        """Phrases of two words and more: each length is grouped by the group of the length before
        and its last word, so that the trie gets each phrase of the text once, with its count."""
        shortest, longest = min(self.sizes), max(self.sizes)
        ids = np.r_[ids, np.full(longest, END)]
        at = np.flatnonzero(ids[:-longest] >= 0)
        good, length = None, 0
        if self.shorter and self.shorter.length > 1:
            length = self.shorter.length
            start = _inside(ids, at, length)
            found = self.shorter.has(mixed([self.hashes[ids[start + k]] for k in range(length)]))
            good = np.zeros(len(ids), bool)
            good[start[found]] = True
        at = _inside(ids, at, shortest)
        for k in range(shortest - length + 1 if length else 0):
            at = at[good[at + k]]
        group = ids[at]
        for size in range(2, longest + 1):
            if size > shortest:
                going = ids[at + size - 1] >= 0
                if length:
                    going &= good[at + size - length]
                at, group = at[going], group[going]
            key = group << 32 | ids[at + size - 1]
            if size == 2 == longest:
                pairs, count = np.unique(key, return_counts=True)
                self.trie.add(np.column_stack([pairs >> 32, pairs & 0xFFFFFFFF]), count)
                break
            _, first, group, count = np.unique(key, return_index=True, return_inverse=True,
                                               return_counts=True)
            if size in self.sizes:
                self.trie.add(ids[at[first][:, None] + np.arange(size)], count)


    def taken(self, left: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
        """Word ids and counts of the phrases of some subtrees, and if nothing is to stay of all."""
        found = self.trie.spill(left)
        at = np.flatnonzero(self.single)
        if not left and len(at):
            found.append((at[:, None], self.single[at]))
            self.single = np.empty(0, np.int64)
        return found


def _inside(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The places where that many words follow without an end."""
    for k in range(1, size):
        at = at[ids[at + k] >= 0]
    return at


def counted(docs: DataFrame, sizes: tuple[int, ...], known: list[Known], hot: set,
            least: int) -> DataFrame:
    """group, phrase, size and count of the phrases of some lengths that occur at least that often;
    with length 1 also a row with a null phrase, whose count is that of all words."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}
        for group, text in _slices(batches):
            counter = counters.get(group)
            if counter is None:
                counter = counters[group] = Counter(group, sizes, known)
            counter.read(text)
            if sum(len(c.words) for c in counters.values()) > MAX_WORDS or \
                    sum(len(c.number) for c in counters.values()) > 2 * MAX_WORDS:
                for counter in counters.values():
                    yield from _runs(counter, counter.taken(), hot, parts)
                    counter.clear()
            while sum(c.trie.size for c in counters.values()) > MAX_PHRASES:
                largest = max(counters.values(), key=lambda c: c.trie.size)
                yield from _runs(largest, largest.taken(max(1, largest.trie.size // 2)), hot, parts)
        for counter in counters.values():
            yield from _runs(counter, counter.taken(), hot, parts)
            if counter.total:
                place = xxhash.xxh32_intdigest(counter.group.encode()) % parts
                yield _rows([place], [counter.group], [None], [counter.total])

    return docs.mapInArrow(runs, RUN).repartitionById(parts, F.col("part").cast("int")).mapInArrow(
        lambda batches: _merged(batches, least),
        "group string, phrase string, size int, count long")


RUN = "part long, group string, run binary, n long"
RUN_SCHEMA = pa.schema([("part", pa.int64()), ("group", pa.string()), ("run", pa.binary()),
                        ("n", pa.int64())])


def _rows(part, group, run, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v, f.type) for v, f in zip((part, group, run, n), RUN_SCHEMA)], schema=RUN_SCHEMA)


def _runs(counter: Counter, taken: list[tuple[np.ndarray, np.ndarray]], hot: set,
          parts: int) -> Iterator[pa.RecordBatch]:
    """A sorted run for each prefix partition: phrases, their lengths in bytes and their counts."""
    texts = pa.array(counter.words, pa.binary())
    for ids, counts in taken:
        used, number = np.unique(ids, return_inverse=True)
        names = texts.take(pa.array(used))
        rank = np.empty(len(used), np.int64)
        rank[pc.array_sort_indices(names).to_numpy()] = np.arange(len(used))
        ranks = rank[number.reshape(ids.shape)]
        part = (_prefix(counter, ids, hot) % np.uint64(parts)).astype(np.int64)
        order = _sorted(ranks, part, len(used), parts)
        ids, counts, part = ids[order], counts[order], part[order]
        phrase = pc.binary_join_element_wise(*(texts.take(pa.array(c)) for c in ids.T), b" ")
        sizes = pc.binary_length(phrase).to_numpy().astype(np.int64)
        ends = np.r_[0, sizes.cumsum()]
        data = memoryview(phrase.buffers()[2] or b"")
        starts = np.r_[0, np.flatnonzero(np.diff(part)) + 1]
        stops = np.r_[starts[1:], len(part)]
        packed = [_pack(sizes[s:e], counts[s:e], data[ends[s]:ends[e]])
                  for s, e in zip(starts.tolist(), stops.tolist())]
        yield _rows(part[starts], [counter.group] * len(starts), packed, stops - starts)


def _sorted(ranks: np.ndarray, part: np.ndarray, words: int, parts: int) -> np.ndarray:
    """The order of phrases by partition, then word by word."""
    width = max(1, (words - 1).bit_length())
    if width * ranks.shape[1] + parts.bit_length() > 62:
        return np.lexsort([*ranks.T[::-1], part])
    key = part
    for column in ranks.T:
        key = key << width | column
    return key.argsort()


def _pack(sizes: np.ndarray, counts: np.ndarray, text: memoryview) -> bytes:
    whole = b"".join([sizes.astype("<u4").tobytes(), counts.astype("<i8").tobytes(), text])
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def _unpack(run: bytes, n: int) -> pa.Table:
    size = int.from_bytes(run[:8], "little")
    whole = pa.decompress(run[8:], size, codec="zstd", asbytes=True)
    sizes = np.frombuffer(whole, "<u4", n)
    counts = np.frombuffer(whole, "<i8", n, 4 * n)
    ends = np.r_[0, sizes.cumsum(dtype=np.int64)]
    phrases = pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends.tobytes()),
                                               pa.py_buffer(whole[12 * n:]))
    return pa.table({"phrase": phrases, "count": pa.array(counts.astype(np.int64))})


def _prefix(counter: Counter, ids: np.ndarray, hot: set) -> np.ndarray:
    """A hash of what a phrase is dealt out by: its first word or two, or below a hot prefix all of
    its words."""
    hashes = [counter.hashes[c] for c in ids.T]
    found = mixed(hashes[:max(1, min(2, len(hashes) - 1))])
    for prefix in hot:
        words = prefix[1].split(b" ")
        numbers = [counter.number.get(w, END) for w in words]  # asks without noting new ones
        if prefix[0] == counter.group and len(words) < ids.shape[1] and min(numbers) >= 0:
            below = (ids[:, :len(words)] == numbers).all(axis=1)
            if below.any():
                found[below] = mixed([h[below] for h in hashes])
    return found


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Merge the runs of a prefix partition. Its distinct phrases are held, so their number is set by
    the number of shuffle partitions."""
    schema = pa.schema([("group", pa.string()), ("phrase", pa.string()), ("size", pa.int32()),
                        ("count", pa.int64())])
    held: dict[str, list[pa.Table]] = {}
    totals: dict[str, int] = {}
    size, limit = 0, MERGED

    def summed(tables: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(tables).group_by("phrase", use_threads=False).aggregate(
            [("count", "sum")])
        return found.select(["phrase", "count_sum"]).rename_columns(["phrase", "count"])

    def frequent() -> Iterator[pa.RecordBatch]:
        for group, tables in held.items():
            found = summed(tables)
            found = found.filter(pc.greater_equal(found.column("count"), least))
            n = found.num_rows
            spaces = pc.count_substring(found.column("phrase"), " ")
            yield from pa.table([pa.array([group] * n, pa.string()),
                                 found.column("phrase").cast(pa.string()),
                                 pc.add(spaces, 1).cast(pa.int32()), found.column("count")],
                                schema=schema).to_batches()
        if totals:
            n = len(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals)), pa.array([None] * n, pa.string()),
                 pa.array([None] * n, pa.int32()), pa.array(list(totals.values()), pa.int64())],
                schema=schema)

    for batch in batches:
        for _, group, run, n in zip(*(c.to_pylist() for c in batch.columns)):
            if run is None:
                totals[group] = totals.get(group, 0) + n
            else:
                held.setdefault(group, []).append(_unpack(run, n))
                size += n
            if size > limit:  # add up what there is so far
                held = {g: [summed(tables)] for g, tables in held.items()}
                size = sum(t[0].num_rows for t in held.values())
                limit = max(MERGED, 2 * size)
    yield from frequent()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts of a group, folded, about BATCH bytes at a time; each ends with a piece."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            folded = text.encode().translate(FOLD)
            start = 0
            while len(folded) - start > BATCH:  # a very long text
                end = folded.find(b"\n", start + BATCH)
                if end < 0:
                    break
                yield group, folded[start:end]
                start = end
            held.setdefault(group, []).append(folded[start:])
            sizes[group] = sizes.get(group, 0) + len(folded) - start
            if sizes[group] >= BATCH or sum(sizes.values()) >= 2 * BATCH:
                largest = max(sizes, key=sizes.get)
                yield largest, b"\n".join(held.pop(largest))
                del sizes[largest]
    for group, texts in held.items():
        yield group, b"\n".join(texts)


def frequent_phrases(docs: DataFrame, text: str = "text", group: str = "lang",
                     longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """group, phrase, size and count of all phrases of up to `longest` words that occur at least
    `least` times in a group, and a row with a null phrase per group with the number of words."""
    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("group"),
                       text_or_empty(text).alias("text"))
    found, known, hot = None, [], set()
    # Lengths counted in each pass; each skips phrases that hold a rare one of the pass before.
    for sizes in ((1,), (2,), (3,), tuple(range(4, longest + 1))):
        if not sizes or sizes[0] > longest:
            break
        level = stored(counted(rows, sizes, known, hot, least))
        found = level if found is None else found.unionByName(level)
        if max(sizes) < longest:
            known = [*known[:1], remember(level, max(sizes))]
            if max(sizes) <= 2:
                hot |= _hot(level, found)
    return found


def _hot(level: DataFrame, found: DataFrame) -> set:
    """Prefixes that begin more than one in HOT_SHARE of all phrases, which are HOT_SHARE at most."""
    total = found.where(F.col("phrase").isNull()).agg(F.sum("count")).first()[0] or 0
    rows = level.where(F.col("phrase").isNotNull() & (F.col("count") * HOT_SHARE > total))
    return {(r["group"], r["phrase"].encode()) for r in rows.select("group", "phrase").toLocalIterator()}


def _cut(k: int) -> tuple:
    words = F.split("phrase", " ")
    return (F.array_join(F.slice(words, 1, k), " "),
            F.array_join(F.slice(words, k + 1, LONGEST), " "))


def collocations(frequent: DataFrame, top: int = TOP, longest: int = LONGEST,
                 cover: int = 100) -> DataFrame:
    """The first phrases of each group by score, from what `frequent_phrases` gives.

    The score of a cut is a thousand times how much more often its two parts meet than they would
    by chance, rounded down; the lowest-scoring cut counts. A phrase goes if a longer one that
    holds it occurs at least `cover` hundredths as often.
    """
    totals = frequent.where(F.col("phrase").isNull()).select("group", F.col("count").alias("n"))
    counts = frequent.where(F.col("phrase").isNotNull()).select("group", "phrase", "size", "count")
    candidates = counts.where(F.col("size") >= 2).withColumnRenamed("count", "a")
    cuts = [F.struct(F.lit(k).alias("k"), _cut(k)[0].alias("first"), _cut(k)[1].alias("rest"))
            for k in range(1, longest)]
    parted = candidates.select("group", "phrase", "a", F.explode(
        F.slice(F.array(*cuts), F.lit(1), F.col("size") - 1)).alias("cut")).select(
        "group", "phrase", "a", "cut.*")
    lefts = counts.select("group", F.col("phrase").alias("first"), F.col("count").alias("l"))
    rights = counts.select("group", F.col("phrase").alias("rest"), F.col("count").alias("r"))
    wide = [F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")]
    scored = (parted.join(lefts, ["group", "first"]).join(rights, ["group", "rest"])
              .join(F.broadcast(totals) if _few(totals) else totals, "group")
              .select("group", "phrase", "a", "k", "l", "r", "n", F.call_function(
                  "div", (wide[0] * F.lit(1000).cast("decimal(4,0)") * wide[1]).cast(
                      "decimal(38,0)"), wide[2] * wide[3]).alias("score")))
    lowest = scored.groupBy("group", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")).select(
        "group", "phrase", "cut.*")
    words = F.split("phrase", " ")
    inner = [F.struct(F.array_join(F.slice(words, i + 1, size), " ").alias("phrase"),
                      F.lit(size + i).alias("reach"), F.lit(size).alias("length"))
             for size in range(2, longest) for i in range(longest - size + 1)]
    held = candidates.where(F.col("size") > 2).select("group", "a", "size", F.explode(
        F.array(*inner)).alias("part")).where(
        (F.col("part.reach") <= F.col("size")) & (F.col("part.length") < F.col("size"))).groupBy(
        "group", F.col("part.phrase").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = lowest.join(held, ["group", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    order = Window.partitionBy("group").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "group", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


MAX_GROUPS = 100_000


def _few(totals: DataFrame) -> bool:
    """Whether groups are so few that their totals may be broadcast."""
    return totals.limit(MAX_GROUPS + 1).count() <= MAX_GROUPS


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The most telling phrases of each language of the documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang")
    return collocations(frequent_phrases(docs)).withColumnRenamed("group", "lang")


OP11_SQL = r"""
with pieces as (
  select lang, row_number() over () as piece, words from (
    select lang, [w for w in string_split_regex(piece, '[\x20\x09]+') if w <> ''] as words
    from (select coalesce(lang, 'und') as lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece from documents))
  where len(words) > 0),
totals as (select lang, cast(sum(len(words)) as bigint) as n from pieces group by lang),
counts as (
  select lang, phrase, size, count(*) as a from (
    select lang, size, unnest([array_to_string(words[i:i + size - 1], ' ')
             for i in range(1, len(words) - size + 2)]) as phrase
    from pieces, (select unnest(range(1, 6)) as size) where len(words) >= size)
  group by all having count(*) >= 100),
candidates as (select * from counts where size > 1),
cuts as (
  select lang, phrase, a, k, array_to_string(words[1:k], ' ') as head,
    array_to_string(words[k + 1:], ' ') as rest
  from (select lang, phrase, a, string_split(phrase, ' ') as words, unnest(range(1, size)) as k
        from candidates)),
scored as (
  select c.lang, c.phrase, c.a, c.k, x.a as l, y.a as r, n,
    (1000 * c.a::hugeint * n::hugeint) // (x.a::hugeint * y.a::hugeint) as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = c.head
    join counts y on y.lang = c.lang and y.phrase = c.rest join totals t on t.lang = c.lang),
lowest as (select *, row_number() over (partition by lang, phrase order by score, k) as nth
           from scored),
held as (
  select lang, part, max(a) as longer from (
    select lang, a, unnest([
      array_to_string(string_split(phrase, ' ')[i // size + 1:i % size + 1], ' ')
      for i in range(0, size * size)
      if i % size > i // size and i % size - i // size < size - 1]) as part
    from candidates where size > 2) group by all),
ranked as (
  select lowest.lang, phrase, a, l, r, n, score, row_number() over (
    partition by lowest.lang order by score desc, a desc, phrase) as rank
  from lowest left join held on held.lang = lowest.lang and held.part = phrase
  where nth = 1 and (longer is null or longer < a))
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
  cast(r as bigint) as r, n, cast(score as bigint) as score
from ranked where rank <= 2000
"""
