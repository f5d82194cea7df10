"""Hashed word shingles of many texts at once."""

from __future__ import annotations

import numpy as np

#: Constants of the hashes; any odd numbers do.
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SEED = 0x51ED270B
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _ladder(size: int) -> list[np.ndarray]:
    """Powers of the radix and of its inverse, for ``size`` bytes at least."""
    if not _powers or len(_powers[0]) < size:
        n = max(size, 1 << 20)
        inverse = np.uint64(pow(int(_RADIX), -1, 1 << 64))
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, r, np.uint64))]) for r in (_RADIX, inverse)]
    return _powers


_byte_value = mix(np.arange(1, 257, dtype=np.uint64) * _RADIX)


def span_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of ``raw`` bytes; equal bytes have equal hashes."""
    power, inverse = _ladder(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_byte_value[raw] * power[: len(raw)])])
    return mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * _MIX[0])


def word_spans(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts, begin and end of every word in them, words of each text.

    A word is a run of anything but ASCII white space; A-Z are lower-cased.
    """
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    if lower:
        raw = np.where((raw >= 0x41) & (raw <= 0x5A), raw | 0x20, raw)
    solid = ~((raw == 0x20) | ((raw >= 9) & (raw <= 13)))
    edge = np.diff(solid.astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    close = np.cumsum([len(d) + 1 for d in data]) if data else np.zeros(0, np.int64)
    return raw, begin, end, np.diff(np.searchsorted(begin, close), prepend=0)


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, in order, and the number of words of each."""
    raw, begin, end, counts = word_spans(texts, lower)
    return span_hashes(raw, begin, end), counts


def shingle_hashes(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' shingles, in order, and the text of each.

    A text of fewer words than ``width`` has its whole sequence as one
    shingle; one without words has none.
    """
    words, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    odd = np.random.default_rng(_SEED).integers(1, 1 << 63, 2 * width, dtype=np.uint64) | np.uint64(1)
    if len(words) < width:
        joined, place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    else:
        last = len(words) - width + 1
        joined = np.zeros(last, np.uint64)
        for k in range(width):
            joined += words[k : k + last] * odd[k]
        whole = owner[:last] == owner[width - 1 :]
        joined, place = joined[whole], owner[:last][whole]
    first = np.cumsum(counts) - counts
    few = np.flatnonzero((counts > 0) & (counts < width))
    if len(few):
        short = counts[few].astype(np.uint64) * odd[width]
        for k in range(width - 1):
            there = counts[few] > k
            short[there] += words[first[few[there]] + k] * odd[width + 1 + k]
        joined, place = np.concatenate([joined, short]), np.concatenate([place, few])
    return mix(joined), place


def narrow(place: np.ndarray, size: int) -> np.ndarray:
    """Small numbers in a type that sorts in linear time, where they fit."""
    return place.astype(np.uint16) if size < 1 << 16 else place


def shingle_sets(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The texts' sets of shingles: sorted hashes text by text, and set sizes."""
    hashes, place = shingle_hashes(texts, width)
    order = np.argsort(hashes)
    order = order[np.argsort(narrow(place, len(texts))[order], kind="stable")]
    hashes, place = hashes[order], place[order]
    if len(hashes):
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (place[1:] != place[:-1])
        hashes, place = hashes[new], place[new]
    return hashes, np.bincount(place, minlength=len(texts))
