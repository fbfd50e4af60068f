"""Words, word hashes and shingles of many texts at once, as numpy arrays.

Text rule: A-Z are lower-cased, words are runs of bytes outside {space, 9..13}.
"""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _B
    x ^= x >> np.uint64(29)
    x *= _A
    x ^= x >> np.uint64(32)
    return x


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of the words of all texts in order, and for each
    text the number of its first word (one more entry closes the last text)."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    change = np.diff(inside)
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    # a word never runs over the border of two texts
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
    if len(cut):
        start, end = np.sort(np.r_[start, cut]), np.sort(np.r_[end, cut])
    return start, end, np.searchsorted(start, offsets)


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lower-cased words: eight bytes of each word a step."""
    low = np.zeros(len(data) + 8, np.uint8)
    np.take(_LOWER, data, out=low[:len(data)])
    eights = np.ndarray((len(data) + 1,), "<u8", low, 0, (1,))
    left = end - start
    out = mix(left.astype(np.uint64) * _A)
    at, who = start, None
    while len(at):
        part = eights[at] & _TAIL[np.minimum(left, 8)]
        if who is None:
            out = mix(out ^ part)
        else:
            out[who] = mix(out[who] ^ part)
        more = np.flatnonzero(left > 8)
        who = more if who is None else who[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def shingles(word_hash: np.ndarray, first: np.ndarray,
             size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, owner's first): hashes of the ``size``-word shingles of each text, in order.
    Fewer words make one shingle of the whole sequence; no words make none."""
    n_words = np.diff(first)
    n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    own = np.r_[0, np.cumsum(n)]
    if not own[-1]:
        return np.zeros(0, np.uint64), own
    from .common import ranges

    at = ranges(first[:-1], n)
    take = np.repeat(np.minimum(n_words, size), n)
    out = mix(take.astype(np.uint64))
    for k in range(size):
        some = take > k
        if some.all():
            out = mix(out + word_hash[at + k])
        else:
            out[some] = mix(out[some] + word_hash[at[some] + k])
    return out, own


def distinct(hashes: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats, and the new bounds."""
    hashes = hashes.copy()
    for a, b in zip(own[:-1].tolist(), own[1:].tolist()):
        if b - a > 1:
            hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    heads = own[:-1][np.diff(own) > 0]
    keep[heads] = True
    total = np.r_[0, np.cumsum(keep)]
    return hashes[keep], total[own]
