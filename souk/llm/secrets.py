"""Secret scans: base patterns and a linear-chain conditional random field.

The base patterns give exact spans. The field tags tokens as secret begin,
inside or outside from their shape, the neighbouring words and features of the
whole file, and is decoded by Viterbi. Every token of a text is tagged, ordinary
words too, and a text is one chain, so a secret may run over words and lines.
Where no token can gain by leaving outside, whatever its neighbours are tagged,
all are outside without decoding; that is a bound, not a model of its own.

The field is trained here: pieces of the chains of all documents are its
labelled rows, at most ``MAX_RUNS`` with a token of mixed signs or a word that
names secrets, as many of ordinary words, and of those with a base span
``AS_FOUND``, chosen by a hash. Their labels are the base spans (of assignments
the value). Pieces with a secret are shown again with values drawn anew, until
they are ``MAX_RUNS`` as well: from other alphabets, with a prefix and groups,
over several words; and pieces are shown without their neighbours half of the
time, so that secrets of other makes and in other places are learned as well.

Spark deals out the documents and nothing but the sample is exchanged.
Defined results: a null or empty text has no spans; with no base span in the
table the field adds none; overlapping kinds are all reported; extra columns
of the input are kept.
"""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import accumulate, count, islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, stored, table, text_or_empty

# The base patterns, and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ["assign", "access", "hex", "crf"]
#: Any ASSIGN match holds one of these in lower case.
ASSIGN_KEYS = ("passw", "secret", "token", "apikey", "api_key")
#: Of 24 hex digits in a row, every third one makes a row of 8, wherever the count begins.
EVERY_THIRD = re.compile(r"[0-9a-f]{8}")

#: Labelled pieces of each class used for training. Of those with a secret a
#: tenth at most is as found; their values drawn anew fill the class.
MAX_RUNS = 4_000
AS_FOUND = MAX_RUNS // 10
#: Pieces without a secret that one text gives at most, of either class.
A_TEXT = 8
#: Texts are cut into pieces in the order of their hash, as far as pieces are
#: missing: these shares of all hashes at a time, the last up to the end.
ROUNDS = (1 / 32, 1 / 4, 1)
FEATURES = 1 << 12
EPOCHS, RATE, DECAY = 120, 0.3, 1e-3

OUTSIDE, BEGIN, INSIDE = 0, 1, 2

TURN = re.compile(r"[0-9]|[a-z][A-Z]")
#: What a text is made of: tokens, other signs, line ends.
ITEM = re.compile(r"[0-9A-Za-z_+/.\-]+|[^\s0-9A-Za-z_+/.\-]|\n")
TOKEN = re.compile(r"[0-9A-Za-z_+/.\-]")
#: Signs of a token by class; two classes side by side that are a turn of its shape.
CLASSES = dict.fromkeys(map(ord, string.ascii_lowercase), "a") | dict.fromkeys(map(ord, string.ascii_uppercase), "A")
CLASSES |= dict.fromkeys(map(ord, string.digits), "0") | dict.fromkeys(map(ord, "_+/.-"), "_")
TURNS = ("aA", "0a", "0A", "0_", "a0", "A0", "_0")
HEXED = re.compile("[0-9a-f]+|[0-9A-F]+")
#: Alphabets of the values that training also shows; of letters alone only in their place.
MIXED_SIGNS = string.ascii_letters + string.digits
ALPHABETS = (MIXED_SIGNS, string.ascii_uppercase + string.digits, MIXED_SIGNS + "+/", string.hexdigits[:16], string.digits + "ABCDEF")
LETTERS = (string.ascii_lowercase, string.ascii_uppercase)
#: Words that often name a secret.
TRIGGERS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "private", "signature", "session")
TRIGGER = re.compile("|".join(TRIGGERS), re.IGNORECASE)
#: From this length on, tokens with a digit or a turn make a file dense.
LEAST_TOKEN = 8
LONG = re.compile(rf"[0-9A-Za-z_+/.\-]{{{LEAST_TOKEN},}}")
#: Items seen before and after a token; tokens of a piece, and beside a secret in one.
BEFORE, AFTER = 4, 2
PIECE, BESIDE = 8, 4
#: Words whose scores a task keeps.
KNOWN_WORDS = 1 << 18
#: Kinds of neighbours that have a bound of their own.
NEAR_KINDS = 40

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    out = []
    low = text.lower()
    if any(k in low for k in ASSIGN_KEYS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if EVERY_THIRD.search(text[::3]):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


@lru_cache(1 << 14)
def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


@lru_cache(1 << 16)
def _kind(word: str) -> str:
    if word.isalpha():
        return "upper" if word.isupper() and len(word) > 1 else "word"
    if word.isdigit():
        return "number"
    return word if len(word) == 1 else "mixed"


def _entropy(word: str) -> float:
    n = len(word)
    return -sum(c / n * math.log2(c / n) for c in map(word.count, set(word)))


def _mixed(word: str) -> bool:
    return len(word) >= LEAST_TOKEN and TURN.search(word) is not None


def _has_trigger(text: str) -> bool:
    return any(map(text.lower().__contains__, TRIGGERS))


def _has_mixed(text: str) -> bool:
    """Whether a token may be mixed; if not, none is."""
    reach = LEAST_TOKEN - 1
    return any(LONG.search(text, max(0, m.start() - reach), m.end() + reach) for m in TURN.finditer(text))


def shape(word: str) -> tuple:
    """What the features of a token's shape hang on: its signs by class, their
    turns and spread, and what stands in front."""
    n, classes = len(word), word.translate(CLASSES)
    lower, upper, digits = map(classes.count, "aA0")
    makeup = (lower > 0, upper > 0, digits > 0, lower + upper + digits < n)
    turns = sum(map(classes.count, TURNS)) if digits or upper else 0
    hexed = HEXED.fullmatch(word) is not None
    dots = (min(3, word.count(".")), min(2, word.count("-")), min(2, word.count("/"))) if makeup[3] else (0, 0, 0)
    head = 2 if word.startswith("AKIA") else int(word[:2].isalpha())
    return makeup, min(n, 64) // 4, min(n, 48) // 8, 4 * digits // n, min(6, 8 * turns // n), int(2 * _entropy(word)), hexed, n >= 24, dots, head


@lru_cache(1 << 14)
def _shape_slots(makeup, length, eighth, digits, turns, entropy, hexed, long, dots, head) -> tuple[int, ...]:
    made = "".join(str(int(m)) for m in makeup)
    out = [
        "bias",
        f"makeup {made}",
        f"length {length}",
        f"makeup {made} length {eighth}",
        f"digits {digits}",
        f"turns {turns}",
        f"entropy {entropy}",
        f"hex {hexed} {long}",
        f"dots {dots[0]} {dots[1]} {dots[2]}",
        f"head {('other', made, 'AKIA')[head]}",
    ]
    return tuple(map(_slot, out))


@lru_cache(1 << 16)
def shape_features(word: str) -> tuple[int, ...]:
    return _shape_slots(*shape(word))


def token_features(items: list[str], at: int, file: list[str], context: bool = True) -> list[int]:
    """Feature numbers of the token ``items[at]``: shape, neighbours, file."""
    out = []
    if context:
        before = items[max(0, at - BEFORE) : at][::-1]
        for k, w in enumerate(before):
            out.append(f"before {k} {_kind(w)}")
            if TRIGGER.search(w):
                out += [f"trigger {k}", "trigger"]
        out += [f"after {k} {_kind(w)}" for k, w in enumerate(items[at + 1 : at + 1 + AFTER])]
        out.append("joint " + " ".join(map(_kind, before[:2])))
        if TRIGGER.search(items[at]):
            out.append("trigger inside")
    return [*shape_features(items[at]), *map(_slot, out), *map(_slot, file)]


def file_features(text: str, candidates: int) -> list[str]:
    dense = candidates * 200 // (len(text) + 1)
    return [f"file dense {min(4, dense)}", f"file code {'{' in text or ';' in text}", f"file lines {min(4, text.count(chr(10)) // 8)}"]


def value_spans(text: str) -> list[Span]:
    """Base spans, of assignments the value alone."""
    return sorted((ASSIGN.match(text, a).start(2) if k == 0 else a, k, b) for a, k, b in base_spans(text))


def labels_of(run: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    out: list[int] = []
    done = 0
    for start, end in run:
        while done < len(spans) and spans[done][2] <= start:
            done += 1
        near = takewhile(lambda s: s[0] < end, islice(spans, done, None))
        hit = next((s for s in near if start < s[2]), None)
        out.append(OUTSIDE if hit is None else INSIDE if out and out[-1] and start > hit[0] and run[len(out) - 1][0] >= hit[0] else BEGIN)
    return out


# -- the field -------------------------------------------------------------


@dataclass
class Field:
    """Weights of a linear chain over the tags; ``None`` weights: no secrets."""

    emit: np.ndarray | None  # features x tags
    step: np.ndarray | None  # tag x next tag

    def scores(self, features: list[list[int]]) -> np.ndarray:
        return np.array([self.emit[f].sum(axis=0) for f in features])

    def viterbi(self, features: list[list[int]]) -> list[int]:
        """The most likely tags of one chain."""
        if self.emit is None:
            return [OUTSIDE] * len(features)
        return self.best(self.scores(features))

    def best(self, emit: np.ndarray) -> list[int]:
        (oo, ob, _), (bo, bb, bi), (io, ib, ii) = self.step.tolist()
        rows = iter(emit.tolist())
        o, b, _ = next(rows)
        i = -math.inf
        back = []
        for eo, eb, ei in rows:
            o_o, b_o, i_o = o + oo, b + bo, i + io
            o_b, b_b, i_b = o + ob, b + bb, i + ib
            b_i, i_i = b + bi, i + ii
            to_o, o = (0, o_o) if o_o >= b_o and o_o >= i_o else (1, b_o) if b_o >= i_o else (2, i_o)
            to_b, b = (0, o_b) if o_b >= b_b and o_b >= i_b else (1, b_b) if b_b >= i_b else (2, i_b)
            to_i, i = (1, b_i) if b_i >= i_i else (2, i_i)
            back.append((to_o, to_b, to_i))
            o, b, i = o + eo, b + eb, i + ei
        tags = [OUTSIDE if o >= b and o >= i else BEGIN if b >= i else INSIDE]
        for ways in reversed(back):
            tags.append(ways[tags[-1]])
        return tags[::-1]

    def all_outside(self, emit: np.ndarray) -> bool:
        """Whether no tags can score more than outside everywhere: a token that
        leaves it gains at most its scores, the best step there and the best
        step back."""
        gain, (first, later) = _gain(emit), self.gains
        return bool((gain[:1] + first < -1e-9).all() and (gain[1:] + later < -1e-9).all())

    @cached_property
    def gains(self) -> tuple[float, float]:
        """What steps can add to a token that leaves outside: the first of a
        chain, and a later one."""
        step = self.step - self.step[OUTSIDE, OUTSIDE]
        back = max(0.0, *step[[BEGIN, INSIDE], OUTSIDE])
        return back, back + step[:, [BEGIN, INSIDE]].max()


def _gain(scores: np.ndarray) -> np.ndarray:
    """What the better tag of a secret has more than outside."""
    return np.maximum(scores[..., BEGIN], scores[..., INSIDE]) - scores[..., OUTSIDE]


IS_TOKEN, IS_TRIGGER, IS_MIXED = 1, 2, 4


class Scorer:
    """Scores of all tokens of a text at a time; words keep theirs."""

    def __init__(self, field: Field):
        self.field = field
        self.weight = lambda name: field.emit[_slot(name)]
        self.forget()

    def forget(self) -> None:
        #: words by their first place; the last ones may not be learned yet
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.learned = 0
        self.kinds = {kind: k for k, kind in enumerate(("word", "upper", "mixed", "number"))}
        self.joints: dict[tuple[int, int], np.ndarray] = {}
        self.plain: dict[tuple, int] = {}
        self.plain_gains: dict[tuple, float] = {}
        self.shaped: dict[tuple, int] = {}
        self.bits: dict[tuple, float] = {}
        #: scores of shapes, and of each word its row there (-1: not looked at), its kind and flags
        self.rows, self.used = np.zeros((1024, 3)), 0
        self.shape, self.kind, self.flags = (np.zeros(1024, t) for t in (np.int64, np.int64, np.uint8))
        self.beside = np.zeros((0, BEFORE + AFTER, 3))
        #: of each word what its shape gains outside of `outside` at most, and its class among its neighbours
        self.gain, self.among = np.zeros(1024), np.zeros(1024, np.int64)

    def row(self, score: np.ndarray | float) -> int:
        if self.used == len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        self.rows[self.used] = score
        self.used += 1
        return self.used - 1

    def plain_shape(self, word: str) -> int:
        """The row of the shape of a word of lower-case letters, the first maybe
        a capital: it hangs on few numbers, and most words are such."""
        n, letters = len(word), set(word)
        if len(letters) == n:
            bits = math.log2(n)
        else:
            counts = tuple(sorted(map(word.count, letters)))
            bits = self.bits.get(counts)
            if bits is None:
                bits = self.bits[counts] = _entropy(word)
        key = (min(n, 64), int(2 * bits), word.strip("abcdef") == "", word[0].isupper())
        if key not in self.plain:
            self.plain[key] = self.row(self.field.emit[list(shape_features(word))].sum(axis=0))
        return self.plain[key]

    def plain_gain(self, word: str) -> float:
        """What :meth:`plain_shape` gains at most, by length and capital."""
        key = n, upper = min(len(word), 64), word[0].isupper()
        if key not in self.plain_gains:
            spread = range(int(2 * math.log2(min(n, 27)) + 1e-6) + 1)
            ways = [
                _shape_slots((True, upper, False, False), n // 4, min(n, 48) // 8, 0, 0, e, hexed, n >= 24, (0, 0, 0), 1)
                for e in spread
                for hexed in (False, not upper)
            ]
            self.plain_gains[key] = max(float(_gain(self.field.emit[list(w)].sum(axis=0))) for w in ways)
        return self.plain_gains[key]

    def any_shape(self, word: str) -> int:
        """The row of the shape of any token."""
        key = shape(word)
        if key not in self.shaped:
            self.shaped[key] = self.row(self.field.emit[list(_shape_slots(*key))].sum(axis=0))
        return self.shaped[key]

    def learn(self) -> None:
        """Looks at the words that have a number, but no scores yet."""
        start, end = self.learned, len(self.number)
        shapes, kinds, flags, gains = [], [], [], []
        words = list(islice(reversed(self.number), end - start))[::-1]
        both = "\n".join(words)
        some = not both.isascii() or _has_trigger(both)
        for w in words:
            trigger = some and TRIGGER.search(w) is not None
            plain = w.isascii() and w.isalpha() and w[1:].islower()
            if plain and not trigger:
                shapes.append(-1)
                kinds.append(0)
                flags.append(IS_TOKEN)
                gains.append(self.plain_gain(w))
                continue
            token = plain or TOKEN.match(w) is not None
            row = self.plain_shape(w) if plain else self.any_shape(w) if token else self.row(0.0)
            if token and trigger:
                row = self.row(self.rows[row] + self.weight("trigger inside"))
            shapes.append(row)
            kinds.append(self.kinds.setdefault(_kind(w), len(self.kinds)))
            flags.append(IS_TOKEN * token | IS_TRIGGER * trigger | IS_MIXED * (token and _mixed(w)))
            gains.append(float(_gain(self.rows[row])) if token else -math.inf)
        while end > len(self.kind):
            own = (self.shape, self.kind, self.flags, self.gain, self.among)
            self.shape, self.kind, self.flags, self.gain, self.among = (np.concatenate((x, np.zeros_like(x))) for x in own)
        self.shape[start:end], self.kind[start:end], self.flags[start:end], self.gain[start:end] = shapes, kinds, flags, gains
        self.among[start:end] = 1 + 2 * np.minimum(self.kind[start:end], NEAR_KINDS) + ((self.flags[start:end] & IS_TRIGGER) > 0)
        self.learned = end
        more = list(self.kinds)[len(self.beside) :]
        names = [f"before {k} " for k in range(BEFORE)] + [f"after {k} " for k in range(AFTER)]
        if more:
            self.beside = np.concatenate((self.beside, [[self.weight(n + x) for n in names] for x in more]))
            self.bound_neighbours()

    def bound_neighbours(self) -> None:
        """What two neighbours add to a token's gain at most, by their classes
        (none, or kind and trigger): those next before it, the two before
        these, and those after it. Kinds beyond ``NEAR_KINDS`` share a class that
        adds as much as any feature can."""
        known = min(len(self.beside), NEAR_KINDS)
        most = max(0.0, float(_gain(self.field.emit).max()))
        wide = 2 * NEAR_KINDS + 3
        place = np.zeros((BEFORE + AFTER, wide, 3))
        place[:, 1:, 1:] = most
        again = self.weight("trigger")
        for k in range(BEFORE + AFTER):
            own = self.beside[:known, k]
            place[k, 1 : 1 + 2 * known : 2] = own
            place[k, 2 : 2 + 2 * known : 2] = own + self.weight(f"trigger {k}") + again if k < BEFORE else own
        joint = np.zeros((NEAR_KINDS + 2, NEAR_KINDS + 2, 3))
        joint[..., 1:] = most
        for first in range(known + 1):
            for second in range(known + 1 if first else 1):
                joint[second, first] = self.joint(first, second)
        kind = (np.arange(wide) + 1) // 2
        joint = joint[kind[:, None], kind]
        # classes stand in the order of the text: the second before the first
        self.before = _gain(place[1][:, None] + place[0] + joint).ravel()
        self.further = _gain(place[3][:, None] + place[2]).ravel()
        self.after = _gain(place[4][:, None] + place[5]).ravel()

    def ids(self, items: list[str]) -> np.ndarray:
        if len(self.number) > KNOWN_WORDS:
            self.forget()
        ids = np.fromiter(map(self.number.__getitem__, items), np.int64, len(items))
        if len(self.number) > self.learned:
            self.learn()
        return ids

    def surely_outside(self, text: str, ids: np.ndarray) -> bool:
        """Whether a bound on each token's gain shows that all are outside; if
        not, the scores tell."""
        mixed = int(np.count_nonzero(self.flags[ids] & IS_MIXED))
        gain = self.gain[ids]
        among = np.zeros(len(ids) + BEFORE + AFTER, np.int64)
        among[BEFORE:-AFTER] = self.among[ids]
        pair = among[:-1] * (2 * NEAR_KINDS + 3) + among[1:]
        n = len(ids)
        gain += self.before[pair[BEFORE - 2 : n + BEFORE - 2]]
        gain += self.further[pair[:n]]
        gain += self.after[pair[BEFORE + 1 : n + BEFORE + 1]]
        gain += _gain(sum(map(self.weight, file_features(text, mixed))))
        first, later = self.field.gains
        return bool((gain[:1] + first < -1e-9).all() and (gain[1:] + later < -1e-9).all())

    def scores(self, text: str, items: list[str], ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the tokens, and which items these are."""
        if ids is None:
            ids = self.ids(items)
        for k in np.flatnonzero(self.shape[ids] < 0).tolist():
            self.shape[ids[k]] = self.plain_shape(items[k])
        kind, flags = self.kind[ids], self.flags[ids]
        out = self.rows[self.shape[ids]]
        trigger = (flags & IS_TRIGGER) > 0
        any_trigger = trigger.any()
        for k in range(min(BEFORE, len(ids) - 1)):
            out[k + 1 :] += self.beside[kind[: -k - 1], k]
            if any_trigger:
                out[k + 1 :] += trigger[: -k - 1, None] * (self.weight(f"trigger {k}") + self.weight("trigger"))
        for k in range(min(AFTER, len(ids) - 1)):
            out[: -k - 1] += self.beside[kind[k + 1 :], BEFORE + k]
        wide = len(self.kinds) + 1
        first = np.concatenate(([0], kind[:-1] + 1))
        second = np.concatenate(([0, 0], kind[:-2] + 1))[: len(ids)]
        pairs, place = np.unique(first * wide + second, return_inverse=True)
        out += np.array([self.joint(p // wide, p % wide) for p in pairs.tolist()])[place]
        for name in file_features(text, int(np.count_nonzero(flags & IS_MIXED))):
            out += self.weight(name)
        tokens = np.flatnonzero(flags & IS_TOKEN)
        return out[tokens], tokens

    def joint(self, first: int, second: int) -> np.ndarray:
        if (first, second) not in self.joints:
            names = list(self.kinds)
            self.joints[first, second] = self.weight("joint " + " ".join(names[k - 1] for k in (first, second) if k))
        return self.joints[first, second]

    def secrets(self, text: str) -> list[tuple[int, int, int]]:
        """``(start, end, tag)`` of the tokens of a text that are not outside."""
        items = ITEM.findall(text)
        if self.field.emit is None or not items:
            return []
        ids = self.ids(items)
        if self.surely_outside(text, ids):
            return []
        emit, tokens = self.scores(text, items, ids)
        if not len(tokens) or self.field.all_outside(emit):
            return []
        tags = dict(zip(tokens.tolist(), self.field.best(emit)))
        return [(m.start(), m.end(), tags[k]) for k, m in enumerate(ITEM.finditer(text)) if tags.get(k)]


#: Inside follows begin or inside only.
FORBIDDEN = np.zeros((3, 3))
FORBIDDEN[OUTSIDE, INSIDE] = -1e9


def train(runs: list[tuple[list[list[int]], list[int]]]) -> Field:
    """Maximum likelihood by gradient steps; runs of one length go through
    forward-backward together."""
    if not any(any(tags) for _, tags in runs):
        return Field(None, None)
    by_length: dict[int, list] = {}
    for features, tags in runs:
        by_length.setdefault(len(tags), []).append((features, tags))
    groups = []
    for n, own in sorted(by_length.items()):
        width = max(len(f) for fs, _ in own for f in fs)
        ids = np.full((len(own), n, width), FEATURES)
        for i, (fs, _) in enumerate(own):
            for j, f in enumerate(fs):
                ids[i, j, : len(f)] = f
        groups.append((ids, np.array([t for _, t in own])))
    emit, step = np.zeros((FEATURES + 1, 3)), np.zeros((3, 3))
    moment_e, moment_s = np.zeros_like(emit), np.zeros_like(step)
    total = len(runs)
    for _ in range(EPOCHS):
        ge, gs = -DECAY * emit, -DECAY * step
        for ids, tags in groups:
            n, length, width = ids.shape
            e = emit[ids].sum(axis=2)  # runs x tokens x tags
            t = step + FORBIDDEN
            start = np.array([0.0, 0.0, -1e9])
            fwd, bwd = np.zeros_like(e), np.zeros_like(e)
            fwd[:, 0] = e[:, 0] + start
            for j in range(1, length):
                fwd[:, j] = np.logaddexp.reduce(fwd[:, j - 1, :, None] + t, axis=1) + e[:, j]
            for j in range(length - 2, -1, -1):
                bwd[:, j] = np.logaddexp.reduce(t + (bwd[:, j + 1] + e[:, j + 1])[:, None, :], axis=2)
            z = np.logaddexp.reduce(fwd[:, -1], axis=1)
            p = np.exp(fwd + bwd - z[:, None, None])
            error = np.eye(3)[tags] - p
            for tag in range(3):
                ge[:, tag] += np.bincount(ids.reshape(-1), np.repeat(error[:, :, tag].reshape(-1), width), FEATURES + 1) / total
            for j in range(1, length):
                pair = np.exp(fwd[:, j - 1, :, None] + t + (bwd[:, j] + e[:, j])[:, None, :] - z[:, None, None])
                gs += (np.eye(3)[tags[:, j - 1]][:, :, None] * np.eye(3)[tags[:, j]][:, None, :] - pair).sum(axis=0) / total
        moment_e += ge * ge
        moment_s += gs * gs
        emit += RATE * ge / (np.sqrt(moment_e) + 1e-8)
        step += RATE * gs / (np.sqrt(moment_s) + 1e-8)
        emit[FEATURES] = 0
    return Field(emit[:FEATURES], step + FORBIDDEN)


# -- on tables -------------------------------------------------------------

SECRET, MIXED, PLAIN = 0, 1, 2
PIECE_SCHEMA = "pick long, kind int, items array<string>, first int, tags array<int>, file array<string>"
ARROW_PIECE = pa.schema(
    [
        ("pick", pa.int64()),
        ("kind", pa.int32()),
        ("items", pa.list_(pa.string())),
        ("first", pa.int32()),
        ("tags", pa.list_(pa.int32())),
        ("file", pa.list_(pa.string())),
    ]
)


class Sample:
    """Pieces of texts, of each kind as many as its limit, with the smallest
    picks. A pick starts with the hash of the text, so once the kinds are full a
    text beyond their last ones needn't be cut into pieces at all."""

    def __init__(self, limits: Sequence[int]):
        self.limits = limits
        self.kept: list[dict[int, tuple]] = [{}, {}, {}]
        self.most = [math.inf if limit else -1 for limit in limits]

    def wants(self, kind: int, text_hash: int) -> bool:
        return text_hash << 31 <= self.most[kind]

    def add(self, kind: int, pick: int, row: tuple) -> None:
        kept, limit = self.kept[kind], self.limits[kind]
        kept[pick] = min(row, kept.get(pick, row))
        if len(kept) >= limit + 1000:
            self.kept[kind] = dict(sorted(kept.items())[:limit])
            self.most[kind] = max(self.kept[kind], default=-1)

    def rows(self) -> list[tuple]:
        return [(pick, kind, *row) for kind in range(3) for pick, row in sorted(self.kept[kind].items())[: self.limits[kind]]]


def add_pieces(text: str, sample: Sample) -> None:
    """Cuts a text into pieces: each secret with its neighbours, and of what
    lies between them ``A_TEXT`` of either class, chosen by their hash."""
    text_hash = zlib.crc32(text.encode()) >> 1
    wanted = [sample.wants(kind, text_hash) for kind in range(3)]
    if not any(wanted):
        return
    spans = value_spans(text)
    wanted[SECRET] &= bool(spans)
    trigger = (wanted[MIXED] or wanted[PLAIN]) and _has_trigger(text)
    wanted[MIXED] &= trigger or _has_mixed(text)
    if not any(wanted):
        return
    items = ITEM.findall(text)
    places = [k for k, w in enumerate(items) if TOKEN.match(w)]
    mixed = [_mixed(w) for w in items]
    file = file_features(text, sum(mixed))
    tags = [OUTSIDE] * len(places)
    if spans:
        matches = [m.span() for m in ITEM.finditer(text)]
        tags = labels_of([matches[k] for k in places], spans)

    def piece(begin: int, end: int) -> tuple[list[str], int, int]:
        first, last = places[begin], places[end - 1]
        low = max(0, first - BEFORE)
        own = items[low : last + 1 + AFTER]
        return own, first - low, zlib.crc32("\n".join(own).encode()) >> 1

    for k in (k for k, tag in enumerate(tags) if tag == BEGIN and wanted[SECRET]):
        end = k + 1
        while end < len(tags) and tags[end] == INSIDE:
            end += 1
        begin, end = max(0, k - BESIDE), min(len(tags), end + BESIDE)
        while begin < k and tags[begin] == INSIDE:  # a piece doesn't begin inside
            begin += 1
        own, first, own_hash = piece(begin, end)
        sample.add(SECRET, text_hash << 31 | own_hash, (own, first, tags[begin:end], file))
    found: dict[int, list] = {MIXED: [], PLAIN: []}
    for begin in range(0, len(tags), PIECE):
        end = min(begin + PIECE, len(tags))
        if any(tags[begin:end]):
            continue
        inner = slice(places[begin], places[end - 1] + 1)
        kind = MIXED if any(mixed[inner]) or (trigger and TRIGGER.search("\n".join(items[inner]))) else PLAIN
        if wanted[kind]:
            own, first, own_hash = piece(begin, end)
            found[kind].append((own_hash, own, first, tags[begin:end]))
    for kind, rows in found.items():
        for own_hash, own, first, outside in sorted(rows)[:A_TEXT]:
            sample.add(kind, text_hash << 31 | own_hash, (own, first, outside, file))


def drawn_value(draw: random.Random, alphabet: str | None, n: int) -> list[str]:
    """A secret's words: from one alphabet, of about ``n`` signs or another
    length; without an alphabet, several words, or a prefix and groups."""
    if alphabet is not None:
        return ["".join(draw.choices(alphabet, k=draw.choice((n, draw.randint(8, 20), draw.randint(16, 48)))))]
    if draw.random() < 0.3:
        return ["".join(draw.choices(MIXED_SIGNS, k=draw.randint(8, 24))) for _ in range(draw.randint(2, 4))]
    groups = ["".join(draw.choices(draw.choice(ALPHABETS[:2] + (string.digits,)), k=draw.randint(8, 14))) for _ in range(draw.randint(0, 2))]
    last = "".join(draw.choices(MIXED_SIGNS, k=draw.randint(16, 40)))
    head = "".join(draw.choices(string.ascii_lowercase, k=draw.randint(2, 6)))
    return [draw.choice("_-").join([head, *groups, last])]


#: What values are drawn from anew, one after the other.
MAKES = (*ALPHABETS, None, *LETTERS, None, None)


def drawn_anew(draw: random.Random, items: list[str], first: int, tags: list[int], alphabet: str | None) -> tuple[list[str], list[int]]:
    """A piece with other values in place of its secrets."""
    made, own, left = list(items[:first]), [], iter(tags)
    for w in items[first:]:
        tag = next(left, None) if TOKEN.match(w) else None
        if not tag:
            made.append(w)
            own += [tag] if tag is not None else []
        else:
            parts = drawn_value(draw, alphabet, len(w))
            made += parts
            own += [tag] + [INSIDE] * (len(parts) - 1)
    return made, own


def training_runs(docs: DataFrame, limit: int = MAX_RUNS, as_found: int = AS_FOUND) -> list[tuple[list[list[int]], list[int]]]:
    """``limit`` pieces of each kind, over all documents: of the secret ones
    ``as_found`` at most, and then these with values drawn anew. Copies of a
    text count once.

    The pieces with the smallest picks are taken, and a pick starts with the
    hash of the text. So texts are cut by ranges of their hash, and those of a
    further range only while some kind has fewer pieces than it may: no piece
    of them could be taken otherwise."""

    def cut(missing: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sample = Sample(missing)
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    add_pieces(text, sample)
            rows = sample.rows()
            for k in range(0, len(rows), 5000):
                columns = zip(*rows[k : k + 5000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, ARROW_PIECE)], schema=ARROW_PIECE)

        return label

    texts = docs.select(text_or_empty().alias("text"))
    place = F.shiftright(F.crc32(F.col("text").cast("binary")), 1)
    piece = F.min(F.struct("items", "first", "tags", "file")).alias("piece")
    most = {SECRET: as_found, MIXED: limit, PLAIN: limit}
    heads: dict[int, list] = {kind: [] for kind in most}
    low = 0
    for share in ROUNDS:
        missing = [most[kind] - len(heads[kind]) for kind in range(3)]
        if not any(missing):
            break
        high = int(share * (1 << 31))
        labelled = texts.where((place >= low) & (place < high)).mapInArrow(cut(missing), PIECE_SCHEMA)
        # bounded heads; each task keeps as many rows of its own
        once = stored(labelled.groupBy("pick", "kind").agg(piece), "secret-runs")
        for kind in (k for k in range(3) if missing[k]):
            heads[kind] += once.where(F.col("kind") == kind).orderBy("pick").limit(missing[kind]).select("pick", "piece.*").collect()
        low = high
    out: list[tuple[list[list[int]], list[int]]] = []

    def show(items: list[str], first: int, tags: list[int], file: list[str], context: bool) -> None:
        at = [k for k in range(first, len(items)) if TOKEN.match(items[k])][: len(tags)]
        out.append(([token_features(items, k, file, context) for k in at], tags))

    found = heads[SECRET]
    for k in range(limit if found else 0):
        r, turn = found[k % len(found)], k // len(found)
        draw = random.Random(r.pick + turn)
        if not turn:
            show(r["items"], r["first"], list(r.tags), r.file, True)
        else:
            made = drawn_anew(draw, r["items"], r["first"], list(r.tags), MAKES[(k + turn) % len(MAKES)])
            # letters alone are known as a secret by their place only
            alone = MAKES[(k + turn) % len(MAKES)] not in LETTERS and draw.random() < 0.5
            show(made[0], r["first"], made[1], r.file, not alone)
    for kind in (MIXED, PLAIN):
        for r in heads[kind]:
            show(r["items"], r["first"], list(r.tags), r.file, kind == PLAIN or random.Random(r.pick).random() < 0.5)
    return out


def spans_of(text: str, field: Field | Scorer) -> list[Span]:
    """Base spans and the field's, by start and kind. Tokens tagged secret are
    left out where a base span covers a part of them already; those beside them
    stay."""
    base = base_spans(text)
    scorer = field if isinstance(field, Scorer) else Scorer(field)
    reach = list(accumulate((s[2] for s in base), max, initial=0))
    added = []
    joins = False  # the token before is in the last span
    for a, b, tag in scorer.secrets(text):
        if reach[bisect_left(base, (b,))] > a:
            joins = False
        elif tag == INSIDE and joins:
            added[-1] = (added[-1][0], added[-1][1], b)
        else:
            added.append((a, KINDS.index("crf"), b))
            joins = True
    return sorted(base + added)


SPAN = "array<struct<start:int,kind:int,end:int>>"


def with_spans(docs: DataFrame, field: Field, redact: str | None = None) -> DataFrame:
    """``docs`` with ``spans``; with ``redact``, secrets in ``text`` are
    replaced by it."""
    keep = docs.drop("spans")
    names = keep.columns
    schema = keep.withColumn("spans", F.lit(None).cast(SPAN)).schema
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    shared = docs.sparkSession.sparkContext.broadcast(field)  # FEATURES x 3 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Scorer(shared.value)
        at = names.index("text")
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = [spans_of(t or "", model) for t in texts]
            columns = list(batch.columns)
            if redact is not None:
                columns[at] = pa.array([_redacted(t, s, redact) for t, s in zip(texts, found)], batch.column(at).type)
            made = pa.array([[dict(zip(("start", "kind", "end"), s)) for s in x] for x in found], arrow)
            yield pa.RecordBatch.from_arrays([*columns, made], names=[*names, "spans"])

    return keep.mapInArrow(run, schema)


def _redacted(text: str | None, spans: list[Span], mark: str) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = with_spans(docs, train(training_runs(docs))).drop("text")
    kinds = F.array(*map(F.lit, KINDS))

    def joined(spans):
        one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])
        return F.array_join(F.transform(spans, one), ",")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are blanked out, documents stay."""
    field = train(training_runs(docs))
    redacted = with_spans(docs.select(*DOCUMENT_COLUMNS), field, "[secret]")
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return redacted.withColumn("n_chars", n_chars).select(*DOCUMENT_COLUMNS)
