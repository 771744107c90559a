"""Hashes of words and of runs of words, for many texts at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1


def _mixed(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed))


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# A random number for each byte; A-Z share those of a-z, so that words are lower-cased on the way.
with np.errstate(over="ignore"):
    CODES = _mixed(17, 256)
CODES[65:91] = CODES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_CHUNK = 1 << 12
_AT_ONCE = 1 << 20  # characters
_POWERS = np.full(_CHUNK + 1, _BASE, np.uint64)
_POWERS[0] = 1
_POWERS = np.cumprod(_POWERS)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word (a run of bytes that are no white space) of a buffer of UTF-8 bytes."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~SPACE[raw]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    with np.errstate(over="ignore"):
        # Polynomial in the place of a byte in its word: words longer than the table of powers go on with its last.
        owner = np.repeat(np.arange(len(starts)), ends - starts)
        at = np.flatnonzero(inside) - starts[owner]
        terms = CODES[raw[inside]] * _POWERS[np.minimum(at, _CHUNK)]
        long = at > _CHUNK
        if long.any():
            terms[long] = mix(terms[long] + at[long].astype(np.uint64))
        first = np.concatenate([[0], np.cumsum(ends - starts)[:-1]]) if len(starts) else np.zeros(0, np.int64)
        sums = np.add.reduceat(terms, first) if len(starts) else np.zeros(0, np.uint64)
        return mix(sums + (ends - starts).astype(np.uint64)), starts


def buffer(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts with a line feed after each, and where each text starts."""
    parts = [(t or "").encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]).astype(np.int64)
    return np.frombuffer(b"\n".join([*parts, b""]), np.uint8), bounds


def distinct_shingles(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``width`` words of each text, sorted, text by text; where each text starts.

    A text with fewer words has the hash of all its words; one without words has none. A-Z are lower-cased.
    Texts are worked on a megabyte at a time, so that what is held besides the result stays small.
    """
    found, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    start = size = total = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= _AT_ONCE or i + 1 == len(texts):
            hashes, bounds = _distinct(texts[start : i + 1], width)
            found.append(hashes)
            ends.append(bounds[1:] + total)
            start, size, total = i + 1, 0, total + len(hashes)
    return np.concatenate(found), np.concatenate(ends)


def _distinct(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    raw, bounds = buffer(texts)
    words, starts = word_hashes(raw)
    first = np.searchsorted(starts, bounds)  # first word of each text
    number = np.diff(first)
    runs = np.where(number >= width, number - width + 1, (number > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(runs)])
    owner = np.repeat(np.arange(len(texts)), runs)
    at = first[owner] + np.arange(len(owner)) - out_bounds[owner]
    h = np.zeros(len(owner), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            there = k < number[owner]
            word = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else np.zeros(0, np.uint64)
            h = np.where(there, mix(h * np.uint64(0x2545F4914F6CDD1D) + word + np.uint64(k + 1)), h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(texts) + 1))
