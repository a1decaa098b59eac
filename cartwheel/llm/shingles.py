"""Sets of word shingles as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

_PIECE = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(5).integers(1, 2 ** 63, 256, dtype=np.uint64)   # a number for each byte
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2 ** 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; kept for the usual size."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, _PIECE + 1024), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known)
        if len(known) <= 4 * _PIECE:
            _powers[base] = known
    return known[:size]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of about a megabyte that end at a blank."""
    start = 0
    while start < len(text):
        end = start + _PIECE
        while end < len(text) and not _BLANK[text[end]]:
            end += 1
        yield text[start:end]
        start = end


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text, lower-cased in ASCII, and where they start."""
    hashes, places, offset = [], [], 0
    for piece in _pieces(text):
        raw = np.frombuffer(piece, np.uint8)
        inside = np.concatenate([[False], ~_BLANK[raw], [False]])
        change = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = change[::2], change[1::2]
        terms = _BYTE[_LOWER[raw]] * _power(_BASE, len(raw))
        total = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        h = (total[end] - total[start]) * _power(_INVERSE, len(raw) + 1)[start]
        hashes.append(mix(h ^ (end - start).astype(np.uint64)))
        places.append(start + offset)
        offset += len(piece)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def shingles_of_words(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; fewer words make one run."""
    if not len(words):
        return words
    size = min(size, len(words))
    h = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        h = mix(h * np.uint64(_BASE) + words[i:len(words) - size + 1 + i])
    return np.unique(h)


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The set of each text, in order. Texts are hashed a megabyte at a time."""
    group: list[bytes] = []
    held = 0

    def flush() -> Iterator[np.ndarray]:
        words, places = word_hashes(b" ".join(group))
        ends = np.cumsum([len(t) + 1 for t in group])
        cuts = np.concatenate([[0], np.searchsorted(places, ends)])
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield shingles_of_words(words[low:high], size)

    for text in texts:
        raw = text.encode() if text else b""
        if group and held + len(raw) > _PIECE:
            yield from flush()
            group, held = [], 0
        group.append(raw)
        held += len(raw) + 1
    if group:
        yield from flush()


def signature(shingles: np.ndarray) -> bytes | None:
    """128 bits that stand for a set; none for the empty one."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None
