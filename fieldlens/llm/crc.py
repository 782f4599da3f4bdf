"""CRC-32 of many byte spans at once, from a table of what a byte adds by its distance from the end.

The checksum is linear: a byte adds (by XOR) a value that depends on itself and on how many bytes follow, and
the length adds a constant. So the contributions of all bytes are looked up and folded by one ``reduceat``.
Spans longer than the table are cut into blocks, counted from their end, and folded block by block: the state
so far enters the next block as if it were XORed to the block's first four bytes.
"""

from __future__ import annotations

import numpy as np

POLYNOMIAL = 0xEDB88320
BLOCK = 64
ALL = np.uint32(0xFFFFFFFF)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(BLOCK x 256 contributions by distance from the end, constants by length)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    rows, start, starts = [step], ALL, [ALL]
    for _ in range(BLOCK - 1):
        rows.append((rows[-1] >> 8) ^ step[rows[-1] & 255])
    for _ in range(BLOCK):
        start = (start >> np.uint32(8)) ^ step[start & 255]
        starts.append(start)
    return np.stack(rows), np.array(starts, dtype=np.uint32)


_BYTE, _START = _tables()
_FLAT = np.ascontiguousarray(_BYTE).ravel()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all spans, one span after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` for every span; spans may overlap, none may be empty."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint32)
    sizes = ends - starts
    blocks = -(-sizes // BLOCK)
    first = sizes - (blocks - 1) * BLOCK
    if blocks.max() == 1:
        at, length = starts, sizes
    else:
        number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        length = np.where(number == 0, np.repeat(first, blocks), BLOCK)
        at = np.repeat(starts, blocks) + np.where(number == 0, 0, np.repeat(first, blocks) + (number - 1) * BLOCK)
    edges = np.cumsum(length) - length
    distance = np.repeat(edges + length - 1, length) - np.arange(length.sum())
    added = np.bitwise_xor.reduceat(_FLAT[(distance << 8) + data[_ranges(at, length)]], edges)
    begin = np.cumsum(blocks) - blocks
    state = _START[first] ^ added[begin]
    longer, step = np.nonzero(blocks > 1)[0], 1
    while len(longer):
        s = state[longer]
        moved = _BYTE[BLOCK - 1, s & 255] ^ _BYTE[BLOCK - 2, (s >> 8) & 255] ^ _BYTE[BLOCK - 3, (s >> 16) & 255] ^ _BYTE[BLOCK - 4, s >> 24]
        state[longer] = moved ^ added[begin[longer] + step]
        step += 1
        longer = longer[blocks[longer] > step]
    return state ^ ALL
