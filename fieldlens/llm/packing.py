"""Packing token sequences: best fit, then local search by moves and swaps.

Documents are cut into pieces of the sequence length. Full pieces are sequences by themselves. The
others are dealt at random into pools of bounded size; in a pool, pieces are put where they fit best, and
as long as more bins are used than the tokens need, pieces move or are exchanged between underfull bins,
one for one or two for one, so that the sum of squared fills grows, until bins are empty.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import lean
from fieldlens.llm.tokens import encoder, vocabulary_file, with_end
from fieldlens.session import stage

LENGTH = 2048
END_ID = 0
POOL = 4000  # pieces that one task packs together
LOOSE = 0.95  # sequences filled less than this are packed again with those of other pools


def _cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, length: int) -> Iterator[pa.RecordBatch]:
    try:
        for batch in batches:
            doc = 0
            for counts, ids in encoder(path).encode(batch.column(1)):
                starts, ids = with_end(counts, ids, end_id)
                sizes = np.diff(starts)
                pieces = -(-sizes // length)
                owner = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = number * length
                size = np.minimum(length, sizes[owner] - first)
                view, at = memoryview(ids.tobytes()), (starts[owner] + first).tolist()
                crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(at, size.tolist(), strict=True)]
                names = batch.column(0).slice(doc, len(counts)).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(number, pa.int32()), pa.array(first), pa.array(size), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
                doc += len(counts)
    finally:  # the worker lives on, and other steps need its memory
        encoder(path).forget()


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Bins as lists of item numbers; larger items first, each where the least room is left."""
    bins: list[list[int]] = []
    gaps: list[tuple[int, int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(gaps, (sizes[i], -1))
        if at < len(gaps):
            gap, b = gaps.pop(at)
        else:
            gap, b = room, len(bins)
            bins.append([])
        bins[b].append(i)
        if gap > sizes[i]:
            insort(gaps, (gap - sizes[i], b))
    return bins


def _exchange(bins: list[list[int]], sizes: np.ndarray, fill: np.ndarray, where: np.ndarray, giver: int, room: int) -> bool:
    """Makes the exchange that fills another underfull bin from ``giver`` and adds most to the squared fills."""
    own = bins[giver]
    open_bins = np.nonzero((fill < room) & (fill > 0) & (np.arange(len(fill)) != giver))[0]
    if not len(open_bins):
        return False
    theirs = np.nonzero(np.isin(where, open_bins))[0]
    singles = [((i,), int(sizes[i])) for i in own]
    pairs = [((i, j), int(sizes[i] + sizes[j])) for k, i in enumerate(own) for j in own[k + 1 :]]
    best, choice = 0, None
    for out, size in singles + pairs:
        # 0 or 1 item comes back for 1 or 2 that go; the receiver gains ``grow`` and must have room for it.
        options = [(open_bins, np.full(len(open_bins), size), None)]
        options.append((where[theirs], size - sizes[theirs], theirs))
        for target, grow, back in options[1:] if len(out) == 2 else options:
            gain = 2 * grow * (fill[target] - fill[giver] + grow)
            gain = np.where((grow > 0) & (grow <= room - fill[target]), gain, 0)
            if len(gain) and (k := int(gain.argmax())) >= 0 and gain[k] > best:
                best, choice = int(gain[k]), (out, int(target[k]), None if back is None else int(back[k]))
    if choice is None:
        return False
    out, target, back = choice
    for i in out:
        bins[giver].remove(i)
        bins[target].append(i)
        where[i] = target
    if back is not None:
        bins[target].remove(back)
        bins[giver].append(back)
        where[back] = giver
    for b in (giver, target):
        fill[b] = sum(sizes[i] for i in bins[b])
    return True


def pack(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of items whose sizes add up to ``room`` at most.

    The search ends when no bin could be spared, or no exchange of any underfull bin adds to the squares.
    """
    bins = best_fit(sizes, room)
    size = np.asarray(sizes, dtype=np.int64)
    fill = np.array([sum(sizes[i] for i in b) for b in bins], dtype=np.int64)
    where = np.empty(len(sizes), dtype=np.int64)
    for b, items in enumerate(bins):
        where[items] = b
    least = -(-int(size.sum()) // room)
    moved = True
    while moved and np.count_nonzero(fill) > least:
        moved = False
        for giver in [b for b in np.argsort(fill, kind="stable") if 0 < fill[b] < room]:
            while 0 < fill[giver] < room and np.count_nonzero(fill) > least and _exchange(bins, size, fill, where, int(giver), room):
                moved = True
    return [b for b in bins if b]


def _pool(rows: pd.DataFrame, room: int) -> pd.DataFrame:
    rows = rows.sort_values(["length", "row", "piece"], ignore_index=True)
    sizes = rows["length"].tolist()
    sequence, offset, filled = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    for b, items in enumerate(pack(sizes, room)):
        at = 0
        for i in items:
            sequence[i], offset[i] = b, at
            at += sizes[i]
        filled[items] = at
    return pd.DataFrame({"row": rows["row"], "piece": rows["piece"], "length": rows["length"], "pool": rows["pool"], "bin": sequence, "offset": offset, "filled": filled})


def _packed(pieces: DataFrame, room: int, pool: int, seed: int) -> DataFrame:
    """Deals (row, piece, length) into pools by hash, so that a pool holds about ``pool`` pieces, and packs them."""
    pools = max(1, -(-pieces.count() // pool))
    dealt = pieces.select("row", "piece", "length", F.pmod(F.xxhash64("row", "piece", F.lit(seed)), F.lit(pools)).alias("pool"))
    schema = "row long, piece int, length long, pool long, bin long, offset long, filled long"
    return stage(dealt.groupBy("pool").applyInPandas(lambda rows: _pool(rows, room), schema), "packed")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", pool: int = POOL) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    NULL texts count as empty: one piece that holds the end id. Repeated rows and ids are packed like any
    others. An empty table gives no rows; other columns are ignored.
    """
    vocabulary = vocabulary or vocabulary_file()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    cut = rows.mapInArrow(lean(lambda batches: _cut(batches, vocabulary, end_id, length)), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    pieces = stage(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    once = _packed(pieces.where(F.col("length") < length), length, pool, 0)
    loose = F.col("filled") < LOOSE * length
    again = _packed(once.where(loose), length, pool, 1)
    place = F.struct(F.lit(1).alias("round"), "pool", "bin")
    kept = once.where(~loose).select("row", "offset", place.alias("place"))
    repacked = again.select("row", "offset", F.struct(F.lit(2).alias("round"), "pool", "bin").alias("place"))
    number = F.shiftleft(F.col("place.pool") * 2 + F.col("place.round") - 1, 20) + F.col("place.bin")  # fewer bins in a pool than 2^20
    placed = kept.unionByName(repacked).select("row", "offset", (number * 2).alias("sequence_id"))
    full = pieces.where(F.col("length") == length).select("row", F.lit(0).cast("long").alias("offset"), (F.col("row") * 2 + 1).alias("sequence_id"))
    return pieces.join(placed.unionByName(full), "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
