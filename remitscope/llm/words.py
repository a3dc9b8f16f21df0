"""Word and shingle hashes of whole columns of texts, computed on arrays instead of word by word."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

LONG_WORD = 64
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

STEP = 0x9E3779B97F4A7C15
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


class Words(NamedTuple):
    """The words of some texts: bytes, each word's [start, end) in them, and each text's [first, last).

    ``offsets`` are the texts' own places in the bytes; a blank follows every text.
    """

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    lasts: np.ndarray


def words_of(texts: pa.ChunkedArray | pa.Array, lower: bool = False) -> Words:
    """Splits at ASCII white space (0x20 and 0x09 to 0x0D); with ``lower``, A-Z become a-z."""
    column = pc.cast(texts, pa.large_string())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    blank, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    column = pc.binary_join_element_wise(pc.fill_null(column, ""), blank, nothing)
    _, places, content = column.buffers()
    if not len(column):
        offsets = np.zeros(1, dtype=np.int64)
    else:
        offsets = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(offsets[-1] - offsets[0])
    data = np.zeros(size + 8, dtype=np.uint8)  # the end of the last word is read eight bytes at a time
    if size:
        data[:size] = np.frombuffer(content, dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    inside = np.zeros(size + 1, dtype=bool)
    inside[1:] = ~BLANK[data[:size]]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    firsts = np.searchsorted(starts, offsets[:-1])
    lasts = np.searchsorted(starts, offsets[1:])
    return Words(data, offsets, starts, ends, firsts, lasts)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes of all words at a time."""
    lengths = words.ends - words.starts
    eights = np.ndarray((len(words.data) - 7,), "<u8", words.data, 0, (1,))
    out = mixed(lengths.astype(np.uint64) * np.uint64(STEP) + np.uint64(seed))
    rest = np.arange(len(lengths))
    for at in range(0, LONG_WORD, 8):
        rest = rest[lengths[rest] > at] if at else rest
        if not len(rest):
            break
        part = eights[words.starts[rest] + at] & MASKS[np.minimum(lengths[rest] - at, 8)]
        out[rest] = mixed((out[rest] ^ part) * np.uint64(STEP) + np.uint64(seed + 1))
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(words.data[words.starts[i] : words.ends[i]].tobytes(), seed)
    return out


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n consecutive words from each place on; shorter than ``hashes`` by n - 1."""

    def join(a: np.ndarray, b: np.ndarray, by: int) -> np.ndarray:
        size = max(0, len(b) - by)
        return a[:size] + np.uint64(pow(STEP, by, 1 << 64)) * b[by : by + size]

    power, width, out, covered = hashes, 1, None, 0
    while width <= n:
        if n & width:
            out = power if out is None else join(out, power, covered)
            covered += width
        power, width = join(power, power, width), 2 * width
    return mixed(out[: max(0, len(hashes) - n + 1)])


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each ``width`` values in a row."""
    size = 1
    while 2 * size <= width:
        values, size = pick(values[:-size], values[size:]), 2 * size
    left = width - size
    return pick(values[: len(values) - left], values[left:]) if left else values
