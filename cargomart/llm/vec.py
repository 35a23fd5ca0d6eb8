"""Word hashes of whole texts, computed on arrays of bytes.

A word's 64-bit hash is a polynomial in its bytes modulo 2**64, taken from
running sums, so that a batch of texts needs no loop over words or characters.
Texts are handled in blocks of about BLOCK_BYTES that end between words; a
text of any length needs memory for one block and 8 bytes a word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Which bytes are parts of words: all but ASCII white space; letters (after
#: lower-casing), digits and everything beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A finalizer that spreads 64-bit values evenly."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (2 * salt + 1)) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            for name, x in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(n + 1, x, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers))
        return cls.up, cls.down


@dataclass
class Words:
    """Words of several texts: hash, first and end byte of each in ``data``
    (lower-cased), and for each text where its words start (and, last, end)."""

    hash: np.ndarray
    first: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    texts: np.ndarray  # first byte of each text
    prefix: np.ndarray  # a row for each length asked for: hashes of the words' first bytes

    def of(self, i: int) -> np.ndarray:
        return self.hash[self.bounds[i] : self.bounds[i + 1]]


def _block(data: np.ndarray, kind: np.ndarray, prefixes: tuple[int, ...]) -> tuple[np.ndarray, ...]:
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = kind[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = turns[::2], turns[1::2]
    up, down = _Powers.of(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])

    def cut(stop: np.ndarray, salt: int) -> np.ndarray:
        return mix((sums[stop] - sums[first]) * down[first] + (stop - first).astype(np.uint64), salt)

    return cut(end, 0), first, end, *[cut(np.minimum(first + n, end), n) for n in prefixes]


def words(texts: list[str], kind: np.ndarray = NOT_SPACE, prefixes: tuple[int, ...] = ()) -> Words:
    """Hashes of all words of the texts, A-Z lower-cased; with ``prefixes``, also
    of each word's first bytes, so many (the word itself if it is shorter)."""
    coded = [t.encode("utf-8", "replace") for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)]
    starts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])
    gaps = np.flatnonzero(~kind[data]) if len(data) > BLOCK_BYTES else None
    parts, at = [], 0
    while at < len(data):
        stop = len(data)
        if stop - at > BLOCK_BYTES:
            stop = int(gaps[np.searchsorted(gaps, at + BLOCK_BYTES)]) + 1
        h, first, end, *more = _block(data[at:stop], kind, prefixes)
        parts.append((h, first + at, end + at, *more))
        at = stop
    h, first, end, *more = (np.concatenate(x) for x in zip(*parts))
    return Words(h, first, end, np.searchsorted(first, starts), data, starts[:-1], np.array(more))


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within a text (fewer words: all of
    them as one), not distinct, and where each text's start (and, last, end)."""
    count = np.diff(w.bounds)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    text = np.repeat(np.arange(len(made)), made)
    first = w.bounds[text] + np.arange(len(text)) - bounds[text]
    h = np.zeros(len(first), np.uint64)
    last = w.bounds[text + 1]
    for k in range(n):
        at = first + k
        there = at < last
        h[there] = mix(h[there] * _M1 + w.hash[at[there]], k + 1)
    return h, bounds
