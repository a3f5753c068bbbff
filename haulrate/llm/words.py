"""Words and runs of words as 64-bit hashes, for many texts at once.

Words are the runs of bytes other than space and tab to carriage return, with A-Z in lower case.
Everything is done on one array of the UTF-8 bytes of all texts, without a loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_JOIN = np.uint64(0xD6E8FEB86659FD93)
#: Stands for a byte of value zero, so that zero bytes count.
_SHIFT = np.uint64(257)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    blank = np.zeros(256, dtype=bool)
    blank[[32, *range(9, 14)]] = True
    return lower, blank


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (nulls are empty) and the offsets of each."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, in order, and the offsets of each text among them."""
    data, offsets = text_bytes(texts)
    lower, blank = _tables()
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~blank[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    lengths = ends - starts
    # A polynomial over the bytes of a word, one byte position of all words at a time.
    lowered = lower[data].astype(np.uint64) + _SHIFT
    hashes = np.zeros(len(starts), dtype=np.uint64)
    live = np.arange(len(starts))
    at = 0
    while len(live):
        hashes[live] = hashes[live] * _BASE + lowered[starts[live] + at]
        at += 1
        live = live[lengths[live] > at]
        if at >= 24 and len(live):
            for k in live:
                h = int(hashes[k])
                for byte in lowered[starts[k] + at : ends[k]].tolist():
                    h = (h * int(_BASE) + byte) & (2**64 - 1)
                hashes[k] = h
            break
    return mix(hashes ^ mix(lengths.astype(np.uint64))), np.searchsorted(starts, offsets)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every ``size`` words in a row, over all words regardless of their texts."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    hashes = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        hashes = mix(hashes * _JOIN + words[k : k + count])
    return hashes


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct runs of ``size`` words of each text.

    A text with fewer words has its whole sequence as the only one; without words it has none.
    """
    words, offsets = word_hashes(texts)
    runs = run_hashes(words, size)
    sets = []
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if stop - start >= size:
            sets.append(np.unique(runs[start : stop - size + 1]))
        elif stop > start:
            sets.append(run_hashes(words[start:stop], stop - start))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
