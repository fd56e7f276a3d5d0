"""Simple-8b word-aligned integer coding in numpy.

A 64-bit word holds a selector in its top four bits and, in the other 60, as many
values of one width as fit.  Values of 61 or more bits are escapes: their word
carries only the escape selector and the value goes to a side list.  Words are
cut at block boundaries, so any block can be decoded alone.
"""

from __future__ import annotations

import numpy as np

#: Values a word and bits a value, by selector; the fixed table of the format.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = 60 // COUNTS
ESCAPE = 14
_PER_WORD = np.append(COUNTS, 1)
BLOCK = 8192


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each value; exact also where a double rounds up."""
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)


def _code_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(values)
    bits = np.zeros(n + 60, np.uint8)
    bits[:n] = _bits(values)
    choice = np.full(n, ESCAPE, np.uint8)
    spans = {1: bits}                        # widest value among the next 1, 2, 4, ... 32
    for k in (2, 4, 8, 16, 32):
        half = spans[k // 2]
        spans[k] = np.maximum(half[: len(half) - k // 2], half[k // 2:])
    for s in range(len(COUNTS) - 1, -1, -1):     # the later, the more values
        c = int(COUNTS[s])
        p = 1 << (c.bit_length() - 1)
        widest = np.maximum(spans[p][:n], spans[p][c - p: c - p + n])
        choice[widest <= WIDTHS[s]] = s
    step = _PER_WORD[choice].tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    first = np.array(starts, np.int64)
    chosen = choice[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    for s in np.unique(chosen):
        if s == ESCAPE:
            continue
        mine = np.flatnonzero(chosen == s)
        lanes = np.arange(COUNTS[s])
        shifted = padded[first[mine][:, None] + lanes] << (lanes * WIDTHS[s]).astype(np.uint64)
        words[mine] |= np.bitwise_or.reduce(shifted, axis=1)
    return words, values[first[chosen == ESCAPE]]


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[bytes, bytes, list[int], list[int]]:
    """Words, escapes, and per block of ``block`` values its first word and first escape."""
    values = np.ascontiguousarray(values, np.uint64)
    words, escapes, word_at, escape_at, w, e = [], [], [], [], 0, 0
    for i in range(0, len(values), block):
        got, extra = _code_block(values[i: i + block])
        word_at.append(w)
        escape_at.append(e)
        w, e = w + len(got), e + len(extra)
        words.append(got.astype("<u8").tobytes())
        escapes.append(extra.astype("<u8").tobytes())
    return b"".join(words), b"".join(escapes), word_at, escape_at


def decode(words: bytes, escapes: bytes, word_at: list[int], escape_at: list[int], n: int, block: int = BLOCK, blocks: tuple[int, int] | None = None) -> np.ndarray:
    """The values of all blocks, or of blocks [from, to); every word is unpacked by its selector's lanes at once."""
    total = len(word_at)
    lo, hi = blocks or (0, total)
    if lo >= hi:
        return np.zeros(0, np.uint64)
    ends = [*word_at[1:], len(words) // 8]
    w = np.frombuffer(words, "<u8")[word_at[lo]: ends[hi - 1]]
    out = np.zeros(min(n, hi * block) - lo * block, np.uint64)
    selector = (w >> np.uint64(60)).astype(np.int64)
    size = _PER_WORD[selector]
    # the last word of a block may hold fewer values than its selector says
    block_of = np.searchsorted(np.array(word_at[lo:hi], np.int64) - word_at[lo], np.arange(len(w)), side="right") - 1
    before = np.cumsum(size) - size
    first_word = np.array(word_at[lo:hi], np.int64) - word_at[lo]
    at = before - before[first_word][block_of] + block_of * block
    limit = np.minimum((block_of + 1) * block, len(out))
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        if s == ESCAPE:
            extra = np.frombuffer(escapes, "<u8")
            out[at[mine]] = extra[escape_at[lo]: escape_at[lo] + len(mine)]
            continue
        lanes = np.arange(COUNTS[s])
        values = (w[mine][:, None] >> (lanes * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << int(WIDTHS[s])) - 1)
        to = at[mine][:, None] + lanes
        inside = to < limit[mine][:, None]
        out[to[inside]] = values[inside]
    return out
