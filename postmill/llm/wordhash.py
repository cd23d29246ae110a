"""Hashes of words and word windows for whole batches of texts, with numpy."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over all 64 (two rounds of xor, shift and multiply)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            steps = np.full(size, _BASE, dtype=np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = inverse
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


class Words(NamedTuple):
    """Words of several texts: a hash each, and for each text its first word's place
    (one more entry at the end: the number of all words)."""

    hashes: np.ndarray
    starts: np.ndarray


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return ["" if text is None else text for text in batch.column(column).to_pylist()]


def hash_words(texts: pa.Array) -> Words:
    """Hash every word of an array of texts; null counts as empty.

    One pass over the bytes: a polynomial in each byte's place, summed up, gives
    any word's hash as a difference of two sums.
    """
    texts = texts.cast(pa.large_string())
    _, offsets_buffer, data_buffer = texts.buffers()
    first, n = texts.offset, len(texts)
    offsets = np.frombuffer(offsets_buffer, dtype=np.int64, count=first + n + 1)[first:] if n else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data_buffer, dtype=np.uint8, count=high)[low:] if data_buffer and high else np.zeros(0, np.uint8)
    bounds = offsets - low
    if texts.null_count:  # a null may still own bytes
        dead = np.flatnonzero(np.asarray(texts.is_null()))
        data = data.copy()
        for i in dead:
            data[bounds[i] : bounds[i + 1]] = 0x20
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(n + 1, np.int64))
    inside = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text's end is a word's end
    edge[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = mix((sums[stop] - sums[start]) * down[start])
    return Words(hashes, np.searchsorted(start, bounds, side="left"))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words within a text, and the text of each.

    A text with fewer words, but one at least, has a single window of them all.
    """
    hashes, starts = words
    counts = np.diff(starts)
    if not len(hashes):
        return hashes, np.zeros(0, np.int64)
    padded = np.concatenate([hashes, np.zeros(size - 1, np.uint64)])
    rolled = np.zeros(len(hashes), dtype=np.uint64)
    for place in range(size):
        rolled *= _BASE
        rolled += padded[place : place + len(hashes)]
        rolled ^= rolled >> np.uint64(29)
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.ones(1, dtype=np.uint64)  # an array of one: numpy warns of overflow in plain numbers
        for word in range(starts[text], starts[text + 1]):
            value = value * _BASE + hashes[word : word + 1]
            value ^= value >> np.uint64(29)
        rolled[starts[text]] = value[0]
    per_text = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    inside = np.arange(len(hashes)) - np.repeat(starts[:-1], counts) < np.repeat(per_text, counts)
    return mix(rolled[inside]), np.repeat(np.arange(len(counts)), per_text)


#: Texts at most that ``distinct_per_text`` can tell apart.
TEXTS_AT_ONCE = 256


def distinct_per_text(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, window) pairs sorted by text: hash, text, times. The text's number
    takes the place of eight of the hash's bits, so that one plain sort does."""
    keys = np.sort((hashes >> np.uint64(8)) | (owner.astype(np.uint64) << np.uint64(56)))
    if not len(keys):
        return hashes, owner, np.zeros(0, np.int64)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    owners = (keys[at] >> np.uint64(56)).astype(np.int64)
    return keys[at] << np.uint64(8), owners, np.diff(np.append(at, len(keys)))
