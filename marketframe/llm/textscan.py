"""Words and their hashes in flat UTF-8 buffers, without a Python object per word."""

from __future__ import annotations

import numpy as np

#: A-Z to a-z, all other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Bytes of words: digits, a-z and all bytes of non-ASCII characters.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        if n > 1 << 23:                          # one very long text: not kept
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit hashes over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


#: Bytes outside ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[9:14] = NOT_SPACE[32] = False


def scan_words(data: np.ndarray, offsets: np.ndarray, of: np.ndarray = WORD, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (A-Z folded, if asked), word starts, word ends, and for each row the number of its first
    word (rows + 1); ``of`` says which bytes are in words.

    ``offsets`` are those of the rows in ``data``, from 0 on; no word crosses rows.
    """
    folded = FOLD[data] if fold else data
    n = len(folded)
    inside = of[folded]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return folded, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    power, inverse = _power_tables(len(folded) + 1)
    prefix = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * power[: len(folded)], out=prefix[1:])
    return mixed((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words inside a row and each row's first shingle (rows + 1).
    A row of fewer words, but not none, has one shingle of all of them."""
    n = len(words)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    place = np.arange(n) - first[:-1][row]
    kept = place <= np.maximum(count[row] - size, 0)
    at = np.flatnonzero(kept)
    last = first[1:][row[at]]
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        there = at + k < last
        h = mixed(h * np.uint64(31) + np.where(there, words[np.minimum(at + k, n - 1)], np.uint64(k + 1))) if len(at) else h
    return h, np.concatenate([[0], np.cumsum(np.bincount(row[at], minlength=len(count)))]).astype(np.int64)
