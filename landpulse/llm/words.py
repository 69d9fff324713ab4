"""Words of many texts at once: where they lie and a 64-bit hash of each."""

from __future__ import annotations

import numpy as np
import xxhash

_RANDOM = np.random.default_rng(20240501)
#: An odd multiplier for each step of a gram.
STEPS = _RANDOM.integers(1, 1 << 62, 8, np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer words are hashed one by one.
LONG = 64
#: Zeros that must follow the last word.
PADDING = b"\0" * 8


def mixed_up(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the runs of True; the last element must be False."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash, never 0, of each data[begin:end] (uint8; PADDING follows the last), eight bytes at a time.

    Every eight bytes pass a bijection before the next come in, so words of
    at most eight bytes collide only across lengths, longer ones by chance.
    """
    size = end - begin
    eight = np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))
    out = mixed_up(size.astype(np.uint64) ^ STEPS[0])
    live = np.arange(len(size))
    for at in range(0, LONG, 8):
        if at:
            live = live[size[live] > at]
        if not len(live):
            break
        x = eight[begin[live] + at] & _MASKS[np.minimum(size[live] - at, 8)]
        out[live] = mixed_up(out[live] ^ x)
    raw = memoryview(data)
    for i in live[size[live] > LONG].tolist() if len(live) else []:
        out[i] = xxhash.xxh3_64_intdigest(raw[begin[i] : end[i]], seed=LONG)
    return np.maximum(out, np.uint64(1))


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, sizes, counts): of all words between ASCII white space, in order, and how many each text has."""
    data = np.frombuffer(b"\n".join(texts) + b"\n" + PADDING, np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    inside[-len(PADDING) :] = False
    begin, end = edges(inside)
    upto = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    counts = np.diff(np.concatenate(([0], np.searchsorted(begin, upto))))
    return hashes(data, begin, end), end - begin, counts
