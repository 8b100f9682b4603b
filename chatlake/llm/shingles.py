"""Word shingles of whole texts as 64-bit hashes, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash is the sum
over its bytes of a mixed value of (byte, place), a shingle's hash chains the
hashes of its words. Two different shingles of a pair of texts get the same hash
with a probability of about 2 ** -64 per pair of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of text that are hashed at once.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_PLACES = mix(np.arange(1000, 1256, dtype=np.uint64) * _STEP)


def _places(n: int) -> np.ndarray:
    global _PLACES
    if n > len(_PLACES):
        _PLACES = mix(np.arange(1000, 1000 + 2 * n, dtype=np.uint64) * _STEP)
    return _PLACES


def _word_hashes(raw: bytes) -> np.ndarray:
    """The hashes of the words of some text, which ends at a word's end."""
    at = np.frombuffer(raw, np.uint8)
    word = ~_SPACE[at]
    before = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64)
    index = np.flatnonzero(word)
    first = np.searchsorted(index, starts)
    lengths = np.diff(np.append(first, len(index)))
    place = np.arange(len(index)) - np.repeat(first, lengths)
    value = _BYTE[_LOWER[at[index]]] + _places(int(lengths.max()))[place]
    value ^= value >> np.uint64(32)
    value *= _C1
    value ^= value >> np.uint64(29)
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def _pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` in pieces that end where a word ends."""
    at = 0
    while len(raw) - at > PIECE:
        cut = max(raw.rfind(c, at, at + PIECE) for c in (b" ", b"\n", b"\t"))
        if cut <= at:  # a word longer than a piece: up to the next white space
            cut = min((i for c in (b" ", b"\n", b"\t") if (i := raw.find(c, at + PIECE)) > 0), default=len(raw))
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def word_hashes(text: str) -> np.ndarray:
    raw = text.encode()
    if len(raw) <= PIECE:
        return _word_hashes(raw)
    return np.concatenate([_word_hashes(p) for p in _pieces(raw)])


def _chain(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    out = words[:n].copy()
    for j in range(1, k):
        out = mix(out * _STEP + words[j : n + j])
    return mix(out + np.uint64(k))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of the ``k``-word shingles of a text.

    With fewer words the whole sequence is the one shingle; without words there is none.
    """
    words = word_hashes(text or "")
    if not len(words):
        return words
    return np.unique(_chain(words, min(k, len(words))))


def set_id(shingles: np.ndarray) -> int:
    """One 64-bit name for a set of shingles; 0 for the empty set."""
    if not len(shingles):
        return 0
    total = np.add.reduce(mix(shingles + _STEP), keepdims=True)
    return int(mix(total + np.uint64(len(shingles))).view(np.int64)[0])
