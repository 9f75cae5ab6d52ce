"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns find what is certainly a secret by its form. The field tags the tokens of a text as
the begin, inside or outside of a secret, by the shapes of a token and its neighbours, by the
words around it that the training text shows near secrets, and by two features of the file. It is
decoded by Viterbi. A tagged span that overlaps no pattern's span is added with the kind `crf`.

It learns from windows around what the patterns find, with the outside everywhere else; from the
same values between ordinary words, so that their shape alone must tell them; and from FORMS, a
table of secrets the patterns do not know and of numbers, codes and names that are none. A third
of the windows is kept from the fit and sets what a tag must have over the outside: the least shift
by which PRECISION of the tagged tokens are right.

The windows come from SAMPLE_ROWS documents that a pattern may match and as many of any kind, those
with the least id hashes; of each at most MAX_WINDOWS windows reach the driver, of 2 * SIDE + 1
tokens each: around its first secrets, its first NUMBERED tokens with digits and its middle. The
field knows the MAX_WORDS most frequent words of up to MAX_WORD characters. All texts are scanned
whole.

Results in odd cases:

* A null text is an empty one: no spans, and the hash of the empty string.
* Without documents that match a pattern no field is trained and none is added to the patterns.
* Repeated rows give repeated results, null ids are passed on and not trained on.
* Very long texts and tokens are scanned like others, one text at a time.
* An empty table gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

import functools
import hashlib
import operator
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from reshelve.llm.columns import text_or_empty
from reshelve.llm.memory import Remembered, per_process

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s]")

SAMPLE_ROWS = 1500
SIDE = 8
NUMBERED = 4
MAX_WINDOWS = 40
MAX_WORDS = 2000
MAX_WORD = 24
LEAST_SEEN = 5
SIZES = (2, 4, 8, 12, 16, 20, 24, 32)
OFFSETS = (-3, -2, -1, 0, 1)
OUTSIDE, BEGIN, INSIDE = range(3)
ROUNDS, RATE, DECAY, FORGET = 150, 0.2, 1e-4, 0.25
MAX_CACHED = 300_000
PRECISION, SHIFTS = 0.995, (0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0)

LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ANY = LOWER + LOWER.upper() + DIGITS
# Labelled forms: text before, letters of the value (a pattern of fixed and drawn ones), text after.
# `*` draws a letter or digit, `+` one of base64, `x` in braces repeats: "ghp_*{36}".
SECRET_FORMS = (
    ("set gh to ", "ghp_*{36}", " for now"), ("deploy key ", "sk_live_*{24}", " keep it"),
    ("Authorization: Bearer ", "eyJ+{20}.eyJ+{40}.+{43}", " sent"), ("pwd=", "*{14}", ";"),
    ("client_key: ", "*{32}", ","), ("aws_secret_access_key = ", "+{40}", ""),
    ("the login is admin / ", "*{12}", " as before"), ("credential ", "*{20}", " expires"),
    ("auth_code='", "*{16}", "'"), ("signing key: ", "+{44}", "="), ("webhook ", "whsec_*{32}", ""),
    ("private_key=", "-+{48}", ""), ("export KEY=", "*{28}", " and run"), ("DB_PASS=", "*{18}", ""),
    ("slack ", "xoxp-0{12}-0{12}-*{24}", " bot"), ("license ", "*{5}-*{5}-*{5}-*{5}-*{5}", " paid"),
)
CLEAN_FORMS = (
    ("see commit ", "#{7}", " for it"), ("fixed in ", "#{10}", " last week"), ("version ", "0.0{2}.0", ""),
    ("call ", "0{3}-0{4}", " now"), ("card 0{4} ", "0{4}", " 0{4}"), ("order no. ", "0{8}", " shipped"),
    ("invoice INV-", "0{4}-0{5}", " is due"), ("at https://host.example/", "a{6}/a{9}", " online"),
    ("mail a.", "a{7}@a{6}.com", " please"), ("on ", "0{4}-0{2}-0{2}", " at noon"),
    ("the file img_", "0{8}_0{6}.jpg", " is new"), ("isbn ", "0{3}-0-0{2}-0{6}-0", " by"),
    ("server ", "srv0{2}.a{7}.net", " is down"), ("colour ", "#{6}", " looks fine"),
    ("address 0{2}.0{3}.", "0{2}.0{3}", " is blocked"), ("part ", "AX-0{4}", " in stock"),
    ("id ", "#{8}-#{4}-#{4}-#{4}-#{12}", " of the row"), ("in src/a{5}/", "a{8}_a{6}.py", " line 0{2}"),
    ("flight ", "LH0{4}", " lands"), ("measured ", "0{3}.0{6}", " units"), ("called ", "a{14}", " by all"),
    ("read ", "a{9}.a{5}.a{12}", " first"), ("room ", "A0{3}", " upstairs"), ("plate ", "AB 0{3} CD", ""),
    ("password=", "", " is empty"), ("token: ", "a{4}", " next"), ("the secret ", "a{9}", " of it"),
    ("page ", "0{3}", " of 0{3}"), ("sum ", "0{12}", " in all"), ("hash ", "#{16}", " of the file"),
)
DRAWS = 40
FORM = re.compile(r"(.)(?:\{(\d+)\})?", re.S)
KIND_OF = {"*": ANY, "+": ANY + "+/", "0": DIGITS, "#": DIGITS + "abcdef", "a": LOWER}


def drawn(form: str, random: np.random.Generator) -> str:
    """A text of a form: signs with a number in braces, and `*`, `+`, are drawn that many times."""
    found = []
    for sign, times in FORM.findall(form):
        if times or sign in "*+":
            letters = KIND_OF.get(sign, sign)
            found += [letters[i] for i in random.integers(0, len(letters), int(times or 1))]
        else:
            found.append(sign)
    return "".join(found)


def examples(seed: int = 0) -> list[tuple[list[str], list[str], list[int], int]]:
    """Windows of the labelled forms, each drawn DRAWS times among invented words."""
    random = np.random.default_rng(seed)
    found = []
    for forms, secret in ((SECRET_FORMS, True), (CLEAN_FORMS, False)):
        for before, value, after in forms:
            for n in range(DRAWS):
                words = [drawn(f"a{{{k}}}", random) for k in random.integers(2, 10, 10)]
                middle = drawn(value, random)
                # Long values stand without what is around them, too.
                bare = n % 2 and (len(middle) >= 20 or not secret)
                left = "" if n % 8 == 1 else " ".join(words[:5]) + " "
                left += "" if bare else drawn(before, random)
                text = left + middle + ("" if bare else drawn(after, random))
                text += "" if n % 8 == 3 else " " + " ".join(words[5:])
                tokens = TOKEN.findall(text)
                own = tags(text, [(len(left), len(left) + len(middle))] if secret else [])
                found.append(([t.lower() if len(t) <= MAX_WORD else "" for t in tokens],
                              [shape(t) for t in tokens], own,
                              file_kind([shape(t) for t in tokens] * 8)))
    return found


def patterns(text: str, words: set[str] | None = None) -> list[tuple[int, int, int]]:
    """(start, end, kind) of what the patterns find, by start, then kind; the text's distinct
    words save a search if they are at hand."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= 20]
    if words is None or max(map(len, words), default=0) >= 24:  # none is found in shorter words
        found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def shape(token: str) -> str:
    """Length, kinds of characters, whether all are hex digits, changes of letter and digit."""
    if len(token) == 1 and not token.isalnum():
        return token
    size = bisect_right(SIZES, len(token))
    base = "" if token.strip("0123456789abcdef") else "x"
    if token.isalpha() and (token.islower() or token.isupper()):
        return f"{size}{'l' if token.islower() else 'u'}{base}0"
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s"
             for c in token]
    digits = [k == "d" for k in kinds if k != "s"]
    changes = sum(a != b for a, b in zip(digits, digits[1:]))
    return f"{size}{''.join(sorted(set(kinds)))}{base}{min(changes, 4)}"


def file_kind(shapes: list[str]) -> int:
    """Number of tokens by powers of four and whether numbers are frequent, as one of 16."""
    size = min(7, max(len(shapes), 1).bit_length() // 2)
    numbers = sum("d" in s for s in shapes)
    return size * 2 + (numbers * 20 > len(shapes))


def tags(text: str, spans: list[tuple[int, int]]) -> list[int]:
    """The tag of each token; a token in a span begins it or continues it."""
    found, at, inside = [], 0, False
    for token in TOKEN.finditer(text):
        while at < len(spans) and spans[at][1] <= token.start():
            at, inside = at + 1, False
        hit = at < len(spans) and spans[at][0] < token.end()
        found.append((INSIDE if inside else BEGIN) if hit else OUTSIDE)
        inside = hit
    return found


def _values(text: str) -> list[tuple[int, int]]:
    """What the field learns to tag: values without their names, joined where they overlap."""
    found = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(s, e) for s, e, kind in patterns(text) if kind]
    joined: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if joined and start < joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def windows(text: str) -> list[tuple[list[str], list[str], list[int], int]]:
    """(words, shapes, tags, file) around each secret, the first tokens with digits, the middle."""
    tokens = TOKEN.findall(text)
    if not tokens:
        return []
    shapes, own = [shape(t) for t in tokens], tags(text, _values(text))
    words = [t.lower() if len(t) <= MAX_WORD else "" for t in tokens]
    centres = {i for i, tag in enumerate(own) if tag == BEGIN} | {len(tokens) // 2}
    centres.update([i for i, s in enumerate(shapes) if "d" in s][:NUMBERED])
    kind = file_kind(shapes)
    cuts = [(max(0, i - SIDE), i + SIDE + 1) for i in sorted(centres)[:MAX_WINDOWS]]
    found = [(words[a:b], shapes[a:b], own[a:b], kind) for a, b in cuts]
    return found + _bare(found)


def _bare(found: list[tuple[list[str], list[str], list[int], int]]) -> list:
    """The long values of windows with a secret once more, in the middle of a clean window."""
    clean = next((w for w in found if not any(w[2])), None)
    bare = []
    for words, shapes, own, kind in found if clean else ():
        for i, tag in enumerate(own):
            if tag == BEGIN and "d" in shapes[i] and not words[i]:
                half = len(clean[0]) // 2
                bare.append(([*clean[0][:half], "", *clean[0][half:]],
                             [*clean[1][:half], shapes[i], *clean[1][half:]],
                             [*clean[2][:half], BEGIN, *clean[2][half:]], kind))
    return bare


@dataclass
class Field:
    """Weights by offset of words and of shapes, of files, and of tag changes."""

    words: dict[str, int]
    shapes: dict[str, int]
    by_word: np.ndarray
    by_shape: np.ndarray
    by_file: np.ndarray
    change: np.ndarray

    def numbers(self, token: str, form: str) -> tuple[int, int]:
        word = self.words.get(token.lower(), 0) if len(token) <= MAX_WORD else 0
        return word, self.shapes.get(form, 0)


def _placed(numbers: np.ndarray, offset: int) -> np.ndarray:
    """For each position the number at an offset along the last axis; 1 beyond the ends."""
    found = np.ones_like(numbers)
    if offset < 0:
        found[..., -offset:] = numbers[..., :offset]
    elif offset > 0:
        found[..., :-offset] = numbers[..., offset:]
    else:
        found[...] = numbers
    return found


def _expected(score: np.ndarray, change: np.ndarray, used: np.ndarray):
    """Tag probabilities of each position and expected tag changes, by forward and backward sums
    that are scaled to one at each position."""
    one = np.ones(3)
    step = np.exp(change - change.max())
    own = np.exp(score - np.maximum(np.maximum(score[..., 0], score[..., 1]), score[..., 2])[..., None])
    forward, backward = own.copy(), np.ones_like(own)
    forward[:, 0] /= (forward[:, 0] @ one)[:, None]
    for t in range(1, score.shape[1]):
        found = (forward[:, t - 1] @ step) * own[:, t]
        forward[:, t] = np.where(used[:, t, None], found / (found @ one)[:, None],
                                 forward[:, t - 1])
    for t in range(score.shape[1] - 2, -1, -1):
        found = (own[:, t + 1] * backward[:, t + 1]) @ step.T
        backward[:, t] = np.where(used[:, t + 1, None], found / (found @ one)[:, None], 1.0)
    single = forward * backward
    single *= (used / (single @ one))[..., None]
    left, right = forward[:, :-1], (own * backward)[:, 1:]
    share = used[:, 1:] / ((left @ step * right) @ one)
    return single, step * np.einsum("nti,ntj->ij", left * share[..., None], right, optimize=True)


def _summed(numbers: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """For each number the sums of its values, tag by tag."""
    flat = numbers.ravel()
    return np.stack([np.bincount(flat, values[..., t].ravel(), n) for t in range(3)], axis=1)


def precise(found: list[tuple[list[str], list[str], list[int], int]], seed: int = 0) -> Field | None:
    """Fit on two thirds of the windows and set the shift of the outside on the others."""
    field = fit([w for i, w in enumerate(found) if i % 3], seed)
    if field is None:
        return None
    kept = []
    for words, shapes, own, kind in found[::3]:
        word = np.array([field.words.get(w, 0) if w else 0 for w in words])
        form = np.array([field.shapes.get(f, 0) for f in shapes])
        score = np.repeat(field.by_file[[kind]], len(own), axis=0)
        for o, offset in enumerate(OFFSETS):
            score += field.by_word[o][_placed(word, offset)] + field.by_shape[o][_placed(form, offset)]
        kept.append((score, np.array(own) != OUTSIDE))
    for shift in SHIFTS:
        moved = np.array([shift, 0, 0])
        told = [np.array(viterbi(score + moved, field.change)) != OUTSIDE for score, _ in kept]
        tagged = sum(int(t.sum()) for t in told)
        right = sum(int((t & own).sum()) for t, (_, own) in zip(told, kept))
        if right >= PRECISION * tagged:
            break
    field.by_file[:, OUTSIDE] += shift
    return field


def fit(found: list[tuple[list[str], list[str], list[int], int]], seed: int = 0) -> Field | None:
    """Train on windows by gradient ascent with per-weight rates; None without any secret."""
    if not any(tag != OUTSIDE for _, _, tags_, _ in found for tag in tags_):
        return None
    seen = Counter(w for words, _, _, _ in found for w in words if w)
    common = sorted((-n, w) for w, n in seen.items() if n >= LEAST_SEEN)[:MAX_WORDS]
    words = {w: i + 2 for i, (_, w) in enumerate(common)}  # 0: other word, 1: beyond the ends
    shapes = {s: i + 2 for i, s in enumerate(sorted({s for _, ss, _, _ in found for s in ss}))}
    length = max(len(t) for _, _, t, _ in found)

    def padded(rows, fill):
        table = np.full((len(rows), length), fill)
        for i, row in enumerate(rows):
            table[i, :len(row)] = row
        return table

    word = padded([[words.get(w, 0) for w in ws] for ws, _, _, _ in found], 1)
    form = padded([[shapes[s] for s in ss] for _, ss, _, _ in found], 1)
    gold = padded([t for _, _, t, _ in found], OUTSIDE)
    used = padded([[1] * len(t) for _, _, t, _ in found], 0).astype(bool)
    file = np.array([kind for *_, kind in found])
    target = np.eye(3)[gold] * used[..., None]
    steps = np.zeros((3, 3))
    np.add.at(steps, (gold[:, :-1][used[:, 1:]], gold[:, 1:][used[:, 1:]]), 1)
    sizes = {"by_word": (len(OFFSETS), len(words) + 2, 3), "by_file": (16, 3), "change": (3, 3),
             "by_shape": (len(OFFSETS), len(shapes) + 2, 3)}
    weight = {name: np.zeros(size) for name, size in sizes.items()}
    square = {name: np.full(size, 1e-6) for name, size in sizes.items()}
    random = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        # Words are forgotten now and then, so that shapes must do without them too.
        heard = np.where(random.random(word.shape) < FORGET, 0, word)
        score = np.repeat(weight["by_file"][file][:, None], length, axis=1)
        for o, offset in enumerate(OFFSETS):
            score += weight["by_word"][o][_placed(heard, offset)]
            score += weight["by_shape"][o][_placed(form, offset)]
        single, pairs = _expected(score, weight["change"], used)
        off = target - single
        slope = {"change": steps - pairs, "by_file": _summed(file, off.sum(axis=1), 16),
                 "by_word": np.zeros(sizes["by_word"]), "by_shape": np.zeros(sizes["by_shape"])}
        for o, offset in enumerate(OFFSETS):
            slope["by_word"][o] = _summed(_placed(heard, offset), off, len(words) + 2)
            slope["by_shape"][o] = _summed(_placed(form, offset), off, len(shapes) + 2)
        for name in weight:
            step = slope[name] - DECAY * len(found) * weight[name]
            square[name] += step ** 2
            weight[name] += RATE * step / np.sqrt(square[name])
    return Field(words, shapes, weight["by_word"], weight["by_shape"], weight["by_file"],
                 weight["change"])


class Scanner:
    """Decodes texts with a field; what is known of tokens and words is kept.

    Words are of few classes: those whose tokens have the same weights. A class has the kinds of its
    tokens in order and the most that one of them adds at each offset.
    """

    def __init__(self, field: Field):
        self.field = field
        self.kinds: dict[tuple[int, int], int] = {(1, 1): 0}
        self.named: list[bool] = [False]
        self.known = Remembered(self._kind, MAX_CACHED)
        self.classes: dict[tuple[int, ...], int] = {}
        self.forms: list[tuple[int, ...]] = []
        self.alike: dict[tuple, int] = {}
        self.alike_words: dict[tuple, int] = {}
        self.words = Remembered(self._word, MAX_CACHED)
        self.table = np.empty((len(OFFSETS), 0, 3))
        self.most = np.empty((0, len(OFFSETS)))
        gain = field.change - field.change[OUTSIDE, OUTSIDE]
        into, out, on = gain[OUTSIDE, BEGIN:].max(), gain[BEGIN:, OUTSIDE].max(), gain[1:, 1:].max()
        # What the changes of tags add to a span is linear in its tokens, so no token is given more
        # than in the shortest or the longest one. A span at an end of the text lacks one change.
        self.slack = float(max(into + out, into, out, on) + _excess(field.by_file).max())
        self.ends = _excess(self._weights()[:, 0])

    def _kind(self, token: str) -> int:
        """The kind of a token: its weights. Those of plain letters, with a full stop behind or
        none, that the field does not know differ by length and case only."""
        core = token[:-1] if token[-1] == "." else token
        if core.isalpha() and (core.islower() or core.isupper()) and \
                token.lower() not in self.field.words:
            key = (bisect_right(SIZES, len(token)), core is token, core.islower(),
                   len(token) == 1 or not core.strip("abcdef"), len(token) == 1)
            found = self.alike.get(key)
            if found is None:
                found = self.alike[key] = self._new_kind(token)
            return found
        return self._new_kind(token)

    def _new_kind(self, token: str) -> int:
        form = shape(token)
        kind = self.kinds.setdefault(self.field.numbers(token, form), len(self.kinds))
        if kind == len(self.named):
            self.named.append("d" in form)
        return kind

    def _word(self, word: str) -> int:
        """The class of a word. Words of plain letters that the field does not know, with a sign
        behind or none, differ by length, case and sign only."""
        core = word if word[-1].isalpha() else word[:-1]
        sign = word[len(core):]
        # In lower or upper case all letters count alike; mixed ones are looked at one by one.
        if not (core.isalpha() and (core.islower() or core.isupper())) or \
                len(sign) == 1 and sign not in ",.;:!?" or core.lower() in self.field.words or \
                sign == "." and word.lower() in self.field.words:
            return self._class(word)
        key = (bisect_right(SIZES, len(core)), bisect_right(SIZES, len(word)), len(core) == 1,
               core.islower(), not core.strip("abcdef"), sign)
        found = self.alike_words.get(key)
        if found is None:
            found = self.alike_words[key] = self._class(word)
        return found

    def _class(self, word: str) -> int:
        kinds = tuple(map(self.known.__getitem__, TOKEN.findall(word)))
        found = self.classes.get(kinds)
        if found is None:
            found = self.classes[kinds] = len(self.forms)
            self.forms.append(kinds)
            if found == len(self.most):
                self.most = np.vstack([self.most, np.empty((found + 1024, len(OFFSETS)))])
            self.most[found] = _excess(self._weights()[:, list(kinds)]).max(
                axis=1, initial=-np.inf)
        return found

    def _can_hold(self, words: set[str]) -> bool:
        """Whether a token could outweigh the outside, were the best neighbours of the whole text
        next to the best token. Exact: a span whose tokens all cannot is never on the best path."""
        classes = list(set(map(self.words.__getitem__, words)))
        bound = np.maximum(self.most[classes].max(axis=0), self.ends).sum()
        return bound + self.slack > 0

    def _weights(self) -> np.ndarray:
        if self.table.shape[1] < len(self.kinds):
            word, form = np.array(list(self.kinds)).T
            self.table = self.field.by_word[:, word] + self.field.by_shape[:, form]
        return self.table

    def score(self, tokens: list[str]) -> np.ndarray:
        """The weight of each tag at each token."""
        return self._score(np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens)))

    def _score(self, kinds: np.ndarray) -> np.ndarray:
        table = self._weights()
        size = min(7, max(len(kinds), 1).bit_length() // 2)
        numbers = int(np.asarray(self.named)[kinds].sum())
        found = np.repeat(self.field.by_file[[size * 2 + (numbers * 20 > len(kinds))]],
                          len(kinds), axis=0)
        for o, offset in enumerate(OFFSETS):
            placed = np.zeros_like(kinds)
            if offset < 0:
                placed[-offset:] = kinds[:offset]
            elif offset:
                placed[:-offset] = kinds[offset:]
            else:
                placed = kinds
            found += table[o][placed]
        return found

    def spans(self, text: str, words: set[str] | None = None) -> list[tuple[int, int]]:
        """The spans the field tags in a text, whose distinct words may be at hand."""
        words = set(text.split()) if words is None else words
        if not words or len(words) > 1 and not self._can_hold(words):
            return []
        # Tokens hold no white space, so those of a text are those of its words.
        kinds = np.fromiter(chain.from_iterable(map(self.forms.__getitem__, map(
            self.words.__getitem__, text.split()))), np.int64)
        if not len(kinds):
            return []
        score = self._score(kinds)
        if len(kinds) > 1 and _excess(score).max() + self.slack <= 0:
            return []
        path = viterbi(score, self.field.change)
        found: list[tuple[int, int]] = []
        for token, tag in zip(TOKEN.finditer(text), path):
            if tag == BEGIN or tag == INSIDE and not (found and open_):
                found.append(token.span())
            elif tag == INSIDE:
                found[-1] = (found[-1][0], token.end())
            open_ = tag != OUTSIDE
        return found


def _excess(weights: np.ndarray) -> np.ndarray:
    """What the better of begin and inside has over the outside."""
    return np.maximum(weights[..., BEGIN], weights[..., INSIDE]) - weights[..., OUTSIDE]


def viterbi(score: np.ndarray, change: np.ndarray) -> list[int]:
    """The best sequence of tags; the lower tag wins a tie."""
    rows, best, back = score.tolist(), None, []
    steps = change.tolist()
    for row in rows:
        if best is None:
            best = row
            continue
        came, now = [], []
        for tag in range(3):
            values = [best[p] + steps[p][tag] for p in range(3)]
            top = max(values)
            came.append(values.index(top))
            now.append(top + row[tag])
        back.append(came)
        best = now
    path = [best.index(max(best))]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1]


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field | None:
    """Train the field on a sample of the documents."""
    rows = docs.select("doc_id", text_or_empty("text").alias("text")).where("doc_id is not null")
    order = (F.xxhash64("doc_id"), "doc_id")
    lower = F.lower("text")
    named = functools.reduce(operator.or_, [F.contains(lower, F.lit(n)) for n in NAMES])
    signed = F.contains("text", F.lit("=")) | F.contains("text", F.lit(":"))
    likely = rows.where(F.contains("text", F.lit("AKIA")) | (signed & named) | F.col("text").rlike(
        "[0-9a-f]{24}")).select("doc_id").distinct()
    chosen = likely.orderBy(*order).limit(sample_rows).union(
        rows.select("doc_id").distinct().orderBy(*order).limit(sample_rows)).distinct()

    @F.pandas_udf("array<struct<words:array<string>,shapes:array<string>,tags:array<int>,file:int>>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("words", "shapes", "tags", "file"), w)) for w in windows(t)]
                          for t in texts], dtype=object)

    # At most twice sample_rows ids are broadcast, and the windows of as many texts collected.
    found = (rows.join(F.broadcast(chosen), "doc_id").select("doc_id", F.posexplode(cut("text")))
             .orderBy("doc_id", "pos").select("col.words", "col.shapes", "col.tags", "col.file")
             .collect())
    found = [(r.words, r.shapes, r.tags, r.file) for r in found]
    if not any(tag != OUTSIDE for _, _, own, _ in found for tag in own):
        return None
    return precise(found + examples())


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf)."""

    sent = docs.sparkSession.sparkContext.broadcast(field)  # weights of MAX_WORDS words

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
                  "n_crf long")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        scanner = per_process("secrets", sent, Scanner) if sent.value else None
        rows = []
        for text in texts:
            words = set(text.split())
            base = patterns(text, words)
            added = [(s, e, 3) for s, e in (scanner.spans(text, words) if scanner else ())
                     if all(e <= b[0] or s >= b[1] for b in base)]
            counts = Counter(kind for *_, kind in base)
            rows.append((counts[0], counts[1], counts[2],
                         hashlib.sha256(_told(base).encode()).hexdigest(),
                         _told(sorted(base + added, key=lambda s: (s[0], s[2]))), len(added)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256",
                                           "spans", "n_crf"])

    return docs.select("doc_id", scanned(text_or_empty("text")).alias("found")).select(
        "doc_id", "found.*")


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return scan(docs, train(docs))
