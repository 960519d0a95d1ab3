"""Word hashes and word shingles inside tasks, many texts at a time."""

from __future__ import annotations

import numpy as np

#: Odd multipliers, one for each place of a shingle.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)

#: Texts handled together, so that the arrays stay in a core's cache.
TOGETHER = 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random value for each byte, ASCII white space (0x20 and 0x09 to 0x0D) 0;
#: the same with A-Z as a-z.
VALUES = mix(np.arange(1, 257, dtype=np.uint64))
VALUES[[32, 9, 10, 11, 12, 13]] = 0
LOWERED = VALUES.copy()
LOWERED[65:91] = VALUES[97:123]
#: Powers of an odd number: what a byte's place in its word multiplies.
POWERS = np.cumprod(np.full(1 << 12, 0xD1342543DE82EF95, np.uint64)).astype(np.uint64)


def word_hashes(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and where each text's begin:
    text k has ``hashes[offsets[k]:offsets[k + 1]]``."""
    texts = [t or b"" for t in texts]
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = (buffer == 32) | ((buffer >= 9) & (buffer <= 13))
    begins = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    offsets = np.concatenate(([0], np.searchsorted(begins, ends)))
    if not len(begins):
        return np.zeros(0, np.uint64), offsets
    lengths = np.diff(np.concatenate((begins, [len(buffer)])))
    kind = np.int32 if len(buffer) < 1 << 31 else np.int64
    place = np.arange(begins[0], len(buffer), dtype=kind) - np.repeat(begins.astype(kind), lengths)
    value = (LOWERED if lower else VALUES).take(buffer[begins[0] :])
    if lengths.max() > len(POWERS):  # long words: the powers start again, spread by how often they did
        value = value * (np.uint64(2) * (place // len(POWERS)).astype(np.uint64) + np.uint64(1))
        place = place % len(POWERS)
    return mix(np.add.reduceat(value * POWERS.take(place), begins - begins[0])), offsets


def roll(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * PLACES[0]
    for k in range(1, size):
        total += (hashes[k : k + n] + np.uint64(k // len(PLACES))) * PLACES[k % len(PLACES)]
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    if len(values) > 1:
        values = values[np.concatenate(([True], values[1:] != values[:-1]))]
    return values


def shingle_sets(texts: list[bytes | None], size: int = 5) -> list[np.ndarray]:
    """Per text: the sorted distinct shingles of its lower-cased words. With
    fewer words the whole sequence counts as one, without words none."""
    hashes, offsets = word_hashes(texts, lower=True)
    rolled = roll(hashes, size)
    out = []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        n = end - begin
        if n >= size:
            out.append(distinct(rolled[begin : end - size + 1]))
        elif n:
            out.append(mix(np.sum(hashes[begin:end] * PLACES[:n], keepdims=True) + np.uint64(1000 + n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit values as Spark longs."""
    return x.view(np.int64)
