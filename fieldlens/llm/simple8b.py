"""Simple-8b: as many equally wide integers in each 64-bit word as fit.

The top four bits of a word select how many values of how many bits it holds. Selector 0 is an escape:
the word points to a value of more than 60 bits that is stored aside. Blocks of a fixed number of values
start at a word of their own, whose place is kept, so that any part can be decoded alone.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 4096
#: Fixed values of the code: values per word and bits per value, from selector 1 on.
PACKINGS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
HEADER = struct.Struct("<4sQQIII")  # magic, values, words, blocks, escapes, values per block
MAGIC = b"S8B1"
_PAYLOAD = np.uint64((1 << 60) - 1)
_COUNTS = np.array([1, *(n for n, _ in PACKINGS)], dtype=np.int64)
_STEPS = _COUNTS.astype(np.uint8)


def _selectors(values: np.ndarray, block: int) -> np.ndarray:
    """For each position the first selector whose values all fit and stay inside the block.

    A selector that does not fit rules out all before it, which hold more and narrower values; the largest
    values of their windows come from those of the next shorter windows.
    """
    n = len(values)
    room = np.minimum(block - np.arange(n) % block, n - np.arange(n))
    fitting = np.zeros(n, dtype=np.int8)
    most, largest, size = int(values.max(initial=0)), values, 1
    if most >> 32 == 0:
        largest = values.astype(np.uint32)
    for count, bits in reversed(PACKINGS):
        if count > n:
            break
        largest = np.maximum(largest[: n - count + 1], largest[count - size :])
        size = count
        fits = room[: len(largest)] >= count
        if most >> bits:
            fits &= largest < largest.dtype.type(1 << bits)
        if not fits.any():
            break
        fitting[: len(fits)] += fits
    return np.where(fitting, len(PACKINGS) + 1 - fitting, 0).astype(np.int8)


def encode(values: np.ndarray, block: int = BLOCK) -> bytes:
    values = np.ascontiguousarray(values, dtype=np.uint64)
    chosen = _selectors(values, block)
    steps, starts, i, n = _STEPS[chosen].tobytes(), [], 0, len(values)
    while i < n:
        starts.append(i)
        i += steps[i]
    first = np.array(starts, dtype=np.int64)
    selectors = chosen[first] if n else np.zeros(0, dtype=np.int8)
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector, (count, bits) in enumerate(PACKINGS, 1):
        here = np.nonzero(selectors == selector)[0]
        if len(here):
            at, word = first[here], words[here]
            for k in range(count):
                word |= values[k:][at] << np.uint64(k * bits)
            words[here] = word
    escaped = np.nonzero(selectors == 0)[0]
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    offsets = np.searchsorted(first, np.arange(0, n, block)).astype("<u4")
    head = HEADER.pack(MAGIC, n, len(words), len(offsets), len(escaped), block)
    return b"".join([head, offsets.tobytes(), words.astype("<u8").tobytes(), values[first[escaped]].astype("<u8").tobytes()])


def decode(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Values ``start:stop``; only the blocks that hold them are read."""
    magic, n, n_words, n_blocks, n_escapes, block = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b segment")
    stop = n if stop is None else min(stop, n)
    if stop <= start:
        return np.zeros(0, dtype=np.uint64)
    offsets = np.frombuffer(data, "<u4", n_blocks, HEADER.size)
    at = HEADER.size + 4 * n_blocks
    a, b = start // block, -(-stop // block)
    low, high = int(offsets[a]), int(offsets[b]) if b < n_blocks else n_words
    words = np.frombuffer(data, "<u8", high - low, at + 8 * low)
    escapes = np.frombuffer(data, "<u8", n_escapes, at + 8 * n_words)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selectors]
    places = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), dtype=np.uint64)
    for selector, (count, bits) in enumerate(PACKINGS, 1):
        here = np.nonzero(selectors == selector)[0]
        for k in range(count if len(here) else 0):
            out[places[here] + k] = (words[here] >> np.uint64(k * bits)) & np.uint64((1 << bits) - 1)
    escaped = selectors == 0
    out[places[escaped]] = escapes[(words[escaped] & _PAYLOAD).astype(np.int64)]
    return out[start - a * block : stop - a * block]
