"""Word shingles as 64-bit hashes, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. A word is
hashed over its UTF-8 bytes (a polynomial modulo 2**64, then mixed), a shingle
over its words' hashes. Two given shingles collide with odds of about 2**-60.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
#: Bytes whose words are hashed at once.
CHUNK = 1 << 20


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _BASE, _U))


_POWERS = _powers(256)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xA0761D6478BD642F)
    return h ^ (h >> _U(32))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a stretch of text."""
    global _POWERS
    inside = _WORD[data]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts = np.flatnonzero(edge == 1)
    sizes = np.flatnonzero(edge == -1) - starts
    if not len(sizes):
        return np.zeros(0, _U), starts
    if sizes.max() > len(_POWERS):
        _POWERS = _powers(int(sizes.max()))
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum()), dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
    h = _POWERS.take(at)
    h *= (_FOLD[data[inside]].astype(_U) + _U(1))
    return mix(np.add.reduceat(h, first) + sizes.astype(_U)), starts


def word_hashes(data: np.ndarray) -> np.ndarray:
    """One hash per word of a long text, a bounded stretch at a time."""
    parts, start = [np.zeros(0, _U)], 0
    while start < len(data):
        stop = start + CHUNK
        while stop < len(data):  # up to a blank
            blanks = np.flatnonzero(~_WORD[data[stop : stop + CHUNK]])
            if len(blanks):
                stop += int(blanks[0])
                break
            stop += CHUNK
        parts.append(_word_hashes(data[start:stop])[0])
        start = stop
    return np.concatenate(parts)


def _rolled(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive words."""
    h = np.full(len(w) - n + 1, n, _U)
    for k in range(n):
        h = (h ^ w[k : len(w) - n + 1 + k]) * _U(0xE7037ED1A0B428DB)
        h ^= h >> _U(31)
    return mix(h).view(np.int64)


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) > 1 else h


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes (int64) of its shingles of
    ``size`` words; of all its words as one when there are fewer; none without
    words. Short texts are hashed together."""
    raw = [(t or "").encode() for t in texts]
    sets: list[np.ndarray] = []
    a = 0
    while a < len(raw):
        b, held = a + 1, len(raw[a])
        while b < len(raw) and held + len(raw[b]) < CHUNK:
            held += len(raw[b]) + 1
            b += 1
        if b == a + 1:
            words = word_hashes(np.frombuffer(raw[a], np.uint8))
            ends = np.array([0, len(words)])
        else:
            words, starts = _word_hashes(np.frombuffer(b"\n".join(raw[a:b]), np.uint8))
            ends = np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raw[a:b])]))
        rolled = _rolled(words, size) if len(words) >= size else np.zeros(0, np.int64)
        for first, last in zip(ends[:-1].tolist(), ends[1:].tolist()):
            n = last - first
            sets.append(_distinct(rolled[first : last - size + 1]) if n >= size else _rolled(words[first:last], n) if n else np.zeros(0, np.int64))
        a = b
    return sets


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit id per set: equal sets have equal ids, and among D different
    sets about D * D / 2**65 pairs share one. 0 for the empty set."""
    ids = np.zeros(len(sets), np.int64)
    full = [k for k, s in enumerate(sets) if len(s)]
    if full:
        sizes = np.array([len(sets[k]) for k in full])
        h = mix(np.concatenate([sets[k] for k in full]).view(_U) + np.repeat(sizes.astype(_U), sizes))
        first = np.cumsum(sizes) - sizes
        ids[full] = mix(np.add.reduceat(h, first) ^ (np.add.reduceat(mix(h), first) * _U(_BASE))).view(np.int64)
    return ids
