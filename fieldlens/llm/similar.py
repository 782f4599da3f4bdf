"""Links between texts whose sets of word shingles reach a Jaccard similarity: MinHash bands, then the sets themselves.

A set has ``BANDS`` keys of ``DEPTH`` least hashes each; sets that share a key are candidates. At a similarity
of 0.8 a pair misses all keys with a probability of 0.00006, above that less. Every link is verified by whole
sets, so none is below the similarity.

A group of copies is settled by a star: each set is verified against one centre, so that a set travels once,
however many keys and copies it has. The centre is the one that SimHash links lead to (``simhash.one_per_group``);
where there is none, or its sketch differs, the set that most often comes first in the keys. What stars leave open is looked for by
sketches, one byte for each least hash: only sets that agree often enough with a set of another star (a pair of
the similarity agrees less often with a probability of ``MISS``) are sent to be compared whole. Texts that share
a passage, but are not alike, thus cost their sketches, and no sets.

Keys with the same sets count once. A key with many sets, or with large ones, is dealt into tiles like those
of ``simhash``; a tile gives out links that join what it has not joined yet, and skips only pairs that it has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import lean
from fieldlens.session import stage

BANDS, DEPTH = 32, 6
SEED = 42
PART = 1 << 20  # shingles of one part of a crowded key, about
FAN = 1024  # sets verified against one copy of a star's centre
MISS = 1e-6

_rule = np.random.default_rng(SEED)
_MASKS = _rule.integers(0, 1 << 64, (BANDS * DEPTH, 1), dtype=np.uint64)
_FACTORS = _rule.integers(0, 1 << 64, (BANDS * DEPTH, 1), dtype=np.uint64) | np.uint64(1)


def least_hashes(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    least = np.full(BANDS * DEPTH, np.iinfo(np.uint64).max)
    for a in range(0, len(shingles), 1 << 12):
        np.minimum(least, ((shingles[None, a : a + (1 << 12)] ^ _MASKS) * _FACTORS).min(axis=1), out=least)
    return least


def keys(least: np.ndarray) -> np.ndarray:
    """One key for each band."""
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, DEPTH))], dtype=np.uint64).view(np.int64)


def sketch(least: np.ndarray) -> bytes:
    """One byte for each least hash, drawn from all of its bits."""
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()


def agreement(similarity: float) -> int:
    """The number of equal bytes that sketches of two sets of that similarity fall short of with a probability of ``MISS`` at most."""
    n, p, below = BANDS * DEPTH, similarity + (1 - similarity) / 256, 0.0
    for x in range(n):
        below += math.comb(n, x) * p**x * (1 - p) ** (n - x)
        if below > MISS:
            return x
    return n


def _sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    from fieldlens.llm.simhash import hashes

    for text in pc.fill_null(texts, "").cast(pa.binary()):
        yield np.unique(hashes(text.as_py(), words))


def with_keys(rows: DataFrame, words: int) -> DataFrame:
    """(row, id, f0, f1, size, keys, sketch, print) of (row, id, text): the digest of the set of shingles, its size, keys and SimHash; an empty set has no keys."""
    from fieldlens.llm.simhash import majority

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, found, sketches, simhashes = [], [], [], [], []
            for shingles in _sets(batch.column(2), words):
                digests.append(np.frombuffer(xxhash.xxh128_digest(shingles.tobytes()), dtype=np.int64))
                sizes.append(len(shingles))
                least = least_hashes(shingles) if len(shingles) else None
                found.append([] if least is None else keys(least))
                sketches.append(b"" if least is None else sketch(least))
                simhashes.append(majority(shingles))
            prints = np.array(digests, dtype=np.int64).reshape(-1, 2)
            arrays = [batch.column(0), batch.column(1), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.array(np.array(simhashes, dtype=np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "f0", "f1", "size", "keys", "sketch", "print"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"row long, id {kind}, f0 long, f1 long, size long, keys array<long>, sketch binary, print long")


def _with_sets(rows: DataFrame, words: int) -> DataFrame:
    """(row, shingles) of (row, text): the hashes in order, 8 bytes each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in _sets(batch.column(1), words)], pa.binary())], names=["row", "shingles"])

    return rows.mapInArrow(lean(run), "row long, shingles binary")


def _near(own: int, size: np.ndarray | int, common: np.ndarray | int, similarity: float) -> np.ndarray | bool:
    return common >= similarity * (own + size - common) - 1e-9


def join(sizes: np.ndarray, part: np.ndarray, root: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) between sets of that similarity, enough of them to connect all that such links connect.

    Sets are not empty and come in the order of their sizes, which bound what a set can be similar to. With
    ``part`` 0 and 1 a set is compared with the other part only; -1 compares with all. Sets of one ``root``
    are joined already.
    """
    n, found = len(sets), []
    group = np.unique(root, return_inverse=True)[1]
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(len(values), dtype=bool)
    for i in range(n - 1):
        j = np.arange(i + 1, np.searchsorted(sizes, sizes[i] / similarity + 1e-6, "right"))
        j = j[((part[j] < 0) | (part[j] != part[i])) & (group[j] != group[i])]
        if not len(j):
            continue
        own = ids[at[i] : at[i + 1]]
        mark[own] = True
        low, high = j[0], j[-1] + 1
        if 8 * len(j) < high - low:
            common = np.array([np.count_nonzero(mark[ids[at[x] : at[x + 1]]]) for x in j.tolist()])
        else:
            common = np.add.reduceat(mark[ids[at[low] : at[high]]], at[low:high] - at[low], dtype=np.int64)[j - low]
        mark[own] = False
        for x in j[_near(sizes[i], sizes[j], common, similarity)].tolist():
            if group[x] != group[i]:
                group[group == group[x]] = group[i]
                found.append((i, x))
    return found


def open_sets(sizes: np.ndarray, part: np.ndarray, root: np.ndarray, sketches: np.ndarray, similarity: float) -> np.ndarray:
    """Which sets may be similar to one of another root, by sketches; sizes ascend and ``part`` is that of ``join``."""
    n, least = len(sizes), agreement(similarity)
    found = np.zeros(n, dtype=bool)
    for i in range(n - 1):
        j = np.arange(i + 1, np.searchsorted(sizes, sizes[i] / similarity + 1e-6, "right"))
        j = j[((part[j] < 0) | (part[j] != part[i])) & (root[j] != root[i])]
        if len(j):
            j = j[np.count_nonzero(sketches[j] == sketches[i], axis=1) >= least]
            found[j] = True
            found[i] |= len(j) > 0
    return found


def _by_tile(batches: Iterator[pa.RecordBatch], done) -> Iterator[pa.RecordBatch]:
    """``done`` of each tile. Rows come sorted by key, tile and size; a tile that goes on in the next batch is held until it ends."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, tile = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = [0, *(np.nonzero((np.diff(key) != 0) | (np.diff(tile) != 0))[0] + 1).tolist(), len(key)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if held and (key[a], tile[a]) != last:
                yield done(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = (key[a], tile[a])
    if held:
        yield done(held)


def _column(held: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([h.column(name).to_numpy() for h in held])


def _verified(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(a0, a1, b0, b1) links of tiles of whole sets."""
    def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        size, part, root, f0, f1 = (_column(held, c) for c in ("size", "part", "root", "f0", "f1"))
        sets = [np.frombuffer(s.as_py(), dtype=np.uint64) for h in held for s in h.column("shingles")]
        pairs = np.array(join(size, part, root, sets, similarity), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(f[pairs[:, side]]) for side in (0, 1) for f in (f0, f1)], names=["a0", "a1", "b0", "b1"])

    return _by_tile(batches, done)


def _opened(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(key, row) of the sets in tiles of sketches that may have links which stars do not make."""
    def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        size, part, root, key, row = (_column(held, c) for c in ("size", "part", "root", "key", "row"))
        sketches = np.frombuffer(b"".join(s.as_py() for h in held for s in h.column("sketch")), dtype=np.uint8).reshape(len(size), BANDS * DEPTH)
        found = open_sets(size, part, root, sketches, similarity)
        return pa.RecordBatch.from_arrays([pa.array(key[found]), pa.array(row[found])], names=["key", "row"])

    return _by_tile(batches, done)


def _stars(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(row, center) of (row, center, shingles, center_shingles) where the sets are similar."""
    for batch in batches:
        near = []
        for own, other in zip(batch.column(2), batch.column(3), strict=True):
            a, b = (np.frombuffer(s.as_py(), dtype=np.uint64) for s in (own, other))
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            near.append(bool(_near(len(a), len(b), np.count_nonzero(b[at] == a), similarity)))
        yield batch.select(["row", "center"]).filter(pa.array(near, pa.bool_()))


def _alike(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(row, center, salt, turn) of (row, center, salt, turn, sketch, center_sketch) whose sketches agree."""
    least = agreement(similarity)
    for batch in batches:
        own, other = (np.frombuffer(b"".join(s.as_py() for s in batch.column(k)), dtype=np.uint8).reshape(batch.num_rows, BANDS * DEPTH) for k in (4, 5))
        yield batch.select(["row", "center", "salt", "turn"]).filter(pa.array(np.count_nonzero(own == other, axis=1) >= least))


def _beside(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``pairs`` (row, center, salt, turn) with ``name`` of the row and, as ``center_<name>``, of its centre; a copy of a centre's value for each salt."""
    copies = pairs.select("center", "salt").distinct().join(values.select(F.col("row").alias("center"), F.col(name).alias(f"center_{name}")), "center")
    return pairs.join(values.select("row", name), "row").join(copies, ["center", "salt"]).select("row", "center", "salt", "turn", name, f"center_{name}")


def _crowds(entries: DataFrame) -> DataFrame:
    """(key, n, total, head) of keys that sets share: their number, their shingles, the first row; of keys with the same sets one."""
    member = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"x{k}") for k in range(2)]
    shared = entries.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.min("row").alias("head"), *member).where("n > 1")
    return shared.groupBy("n", "total", "x0", "x1").agg(F.min("key").alias("key"), F.min("head").alias("head")).select("key", "n", "total", "head")


def _tiles(marked: DataFrame, columns: list[str]) -> DataFrame:
    from fieldlens.llm.simhash import spread

    return spread(marked, ["f0", "f1"], columns)


def links(rows: DataFrame, classes: DataFrame, near: DataFrame, words: int, similarity: float, tile: int, part: int = PART) -> DataFrame:
    """(a0, a1, b0, b1) links between distinct sets; ``rows`` has row and text, ``classes`` one row, size, keys and sketch per set.

    ``near`` (row, center) are sets that are not empty and centres to try first.
    """
    def sets(needed: DataFrame) -> DataFrame:
        return _with_sets(rows.join(needed.select("row").distinct(), "row", "left_semi").select("row", "text"), words)

    def sorted_tiles(dealt: DataFrame) -> DataFrame:
        return dealt.repartition("key", "tile").sortWithinPartitions("key", "tile", "size")

    entries = classes.select("row", "f0", "f1", "size", F.explode("keys").alias("key"))
    crowds = stage(_crowds(entries), "shared")
    members = stage(entries.join(crowds.select("key", "head", "n"), "key"), "members")

    # Stars: one centre for each set.
    heads = members.where("row <> head").groupBy("row").agg(F.mode("head", True).alias("center"))
    tried = near.select("row", "center", F.lit(0).alias("turn")).unionByName(heads.withColumn("turn", F.lit(1)))
    chosen = stage(tried.groupBy("row", "center").agg(F.min("turn").alias("turn")), "tried")
    fans = chosen.groupBy("center").agg(F.ceil(F.count("*") / FAN).alias("fans"))
    pairs = chosen.join(fans, "center").select("row", "center", F.pmod(F.xxhash64("row"), F.col("fans")).alias("salt"), "turn")
    alike = _beside(stage(pairs, "chosen"), classes, "sketch").mapInArrow(lean(lambda b: _alike(b, similarity)), "row long, center long, salt long, turn int")
    alike = stage(alike.groupBy("row").agg(F.min(F.struct("turn", "center", "salt")).alias("first")).select("row", "first.*"), "alike")
    whole = stage(sets(alike.select("row").unionByName(alike.select(F.col("center").alias("row")))), "sets")
    stars = _beside(alike, whole, "shingles").select("row", "center", "shingles", "center_shingles").mapInArrow(lean(lambda b: _stars(b, similarity)), "row long, center long")
    stars = stage(stars, "stars")

    # What may still be linked: sketches of sets under one key that have not one root.
    rooted = stage(members.join(stars, "row", "left").select("key", "n", "row", "f0", "f1", "size", F.coalesce("center", "row").alias("root")), "rooted")
    unsettled = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    unsettled = rooted.join(unsettled, "key", "left_semi").join(classes.select("row", "sketch"), "row")
    dealt = _tiles(unsettled.withColumn("parts", F.ceil(F.col("n") / tile).cast("int")), ["row", "root", "size", "sketch"])
    opened = sorted_tiles(dealt).mapInArrow(lean(lambda b: _opened(b, similarity)), "key long, row long")
    opened = stage(rooted.drop("n").join(opened.distinct(), ["key", "row"], "left_semi"), "open")

    # Those sets, whole.
    parts = F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("total") / part)).cast("int")
    dealt = _tiles(opened.join(stage(_crowds(opened), "crowds").select("key", parts.alias("parts")), "key"), ["row", "root", "size"])
    sent = dealt.join(sets(opened), "row").select("key", "tile", "part", "size", "root", "f0", "f1", "shingles")
    verified = sorted_tiles(sent).mapInArrow(lean(lambda b: _verified(b, similarity)), "a0 long, a1 long, b0 long, b1 long")
    digests = classes.select("row", "f0", "f1")
    ends = stars.join(digests.withColumnsRenamed({"f0": "a0", "f1": "a1"}), "row").join(digests.withColumnsRenamed({"row": "center", "f0": "b0", "f1": "b1"}), "center")
    return verified.unionByName(ends.select("a0", "a1", "b0", "b1"))
