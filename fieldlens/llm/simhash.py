"""SimHash near-duplicates: pigeonhole blocks, verified Hamming distance, connected components.

A fingerprint is cut into ``blocks`` blocks. Fingerprints that differ in at most ``bits`` bits agree in at
least ``blocks - bits`` blocks; with two blocks more than bits they share a pair of blocks. Distinct
fingerprints are sorted by the pairs of blocks, and rows under one key are compared in bulk.

A key with many fingerprints is dealt into tiles: the fingerprints are split at random into parts and each
pair of parts meets in one tile, so that no task holds the key. From a tile only links that join what is
not joined yet are given out, at most a few per fingerprint: the components stay the same, while groups of
copies never turn into all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm import similar
from fieldlens.llm.common import with_rows
from fieldlens.llm.components import components
from fieldlens.session import stage

WORDS = 4
BITS = 4
SEED = 42
TILE = 4096  # fingerprints of one part of a crowded key


def hashes(text: bytes, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of all shingles of a text, repeats included; of the whole sequence if it has fewer words."""
    split = text.lower().split()  # for bytes: A-Z, and white space of [\x20\x09-\x0D]
    if not split:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(split)
    ends = np.cumsum([len(w) + 1 for w in split]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(split))
    spans = zip(starts[: len(split) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in spans], dtype=np.uint64)


def majority(h: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; 0 without any."""
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(h), 1 << 16):
        part = h[a : a + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int, seeds: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "").cast(pa.binary())
        lanes = [[] for _ in seeds]
        for text in texts:
            value = text.as_py()
            for lane, seed in zip(lanes, seeds, strict=True):
                lane.append(majority(hashes(value, words, seed)))
        arrays = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in lanes]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["row", *[f"f{i}" for i in range(len(seeds))]])



def _keys(lanes: list[str], bits: int, blocks: int) -> Column:
    """One key for each pair of blocks of each lane: its number and the bits of the blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, (lane, (i, j)) in enumerate((lane, p) for lane in lanes for p in combinations(range(blocks), 2)):
        part = [F.shiftrightunsigned(F.col(lane), edges[k]).bitwiseAND((1 << (edges[k + 1] - edges[k])) - 1) for k in (i, j)]
        width = edges[j + 1] - edges[j]
        keys.append((F.lit(number) * (1 << 40)) + F.shiftleft(part[0], width) + part[1])
    return F.array(*keys)


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = parent[up]


def _join(key: np.ndarray, lanes: np.ndarray, part: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) between rows of equal keys within ``bits``, enough of them to connect all that such links connect.

    Rows are sorted by key, so row i is compared with row i + 1, i + 2, ... as long as keys agree. In a
    tile of two parts (``part`` 0 and 1) a row is compared with the other part only; -1 compares with all.
    """
    n = len(key)
    parent, found = np.arange(n), []
    i, step = np.arange(n), 1
    while len(i):
        i = i[i + step < n]
        i = i[key[i] == key[i + step]]
        j = i + step
        near = np.bitwise_count(lanes[0, i] ^ lanes[0, j]).astype(np.int32)
        for lane in lanes[1:]:
            near += np.bitwise_count(lane[i] ^ lane[j])
        ok = (near <= bits) & ((part[i] < 0) | (part[i] != part[j]))
        a, b = i[ok], j[ok]
        while len(a):
            ra, rb = _roots(parent, a), _roots(parent, b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if len(a):
                low, high = np.minimum(ra, rb), np.maximum(ra, rb)
                _, first = np.unique(high, return_index=True)
                parent[high[first]] = low[first]
                found.append((a[first], b[first]))
        step += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _links(batches: Iterator[pa.RecordBatch], n_lanes: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; a key that goes on in the next batch is held until it ends."""
    held = None

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        key = columns[0]
        change = np.concatenate([[0], np.cumsum((np.diff(key) != 0) | (np.diff(columns[1]) != 0))]) if len(key) else key
        lanes = np.stack(columns[3:]).view(np.uint64)
        a, b = _join(change, lanes, columns[2], bits)
        arrays = [pa.array(columns[3 + k][x]) for x in (a, b) for k in range(n_lanes)]
        return pa.RecordBatch.from_arrays(arrays, names=[f"{s}{k}" for s in "ab" for k in range(n_lanes)])

    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(3 + n_lanes)]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
        end = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        held = [c[end:] for c in columns]
        if end:
            yield out([c[:end] for c in columns])
    if held is not None:
        yield out(held)


def spread(marked: DataFrame, lanes: list[str], others: Sequence[str] = ()) -> DataFrame:
    """(key, tile, part, lanes..., others...): rows of a key dealt at random into its ``parts``, each pair of them a tile."""
    own = F.pmod(F.xxhash64(*lanes), F.col("parts")).cast("int")
    dealt = marked.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low == high, -1).otherwise((F.col("own") == high).cast("int"))
    return dealt.select("key", (low * F.col("parts") + high).alias("tile"), side.alias("part"), *lanes, *others)


def links(classes: DataFrame, lanes: list[str], bits: int, block_bits: int, tile: int = TILE) -> DataFrame:
    """(a0, ..., b0, ...) links between distinct fingerprints that differ in at most ``bits`` bits.

    ``block_bits`` is how many of them may lie in the lane by which a pair is found; with several lanes of
    64 bits that is ``bits`` divided by their number, rounded down.
    """
    entries = classes.select(*lanes, F.explode(_keys(lanes, block_bits, block_bits + 2)).alias("key"))
    crowded = stage(entries.groupBy("key").count().where(F.col("count") > tile).select("key", F.ceil(F.col("count") / tile).cast("int").alias("parts")), "crowded")
    if crowded.isEmpty():
        dealt = entries.select("key", F.lit(0).alias("tile"), F.lit(-1).alias("part"), *lanes)
    else:
        marked = entries.join(crowded, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        dealt = spread(marked, lanes)
    schema = ", ".join(f"{s}{k} long" for s in "ab" for k in range(len(lanes)))
    sorted_rows = dealt.repartition("key", "tile").sortWithinPartitions("key", "tile")
    n = len(lanes)
    return sorted_rows.mapInArrow(lambda b: _links(b, n, bits), schema)


def _components(printed: DataFrame, lanes: list[str], bits: int, tile: int) -> DataFrame:
    """(lanes..., root, component_id) for every distinct fingerprint; ``printed`` has row, id and lanes."""
    classes = stage(printed.groupBy(*lanes).agg(F.min("id").alias("least")), "classes")
    return _rooted(classes, stage(links(classes, lanes, bits, bits // len(lanes), tile), "pairs"), lanes)


def _rooted(classes: DataFrame, found: DataFrame, lanes: list[str]) -> DataFrame:
    """(lanes..., root, component_id) of ``classes`` (lanes..., least) under the links ``found``."""
    value = lambda side: F.struct(*[F.col(f"{side}{k}").alias(f"v{k}") for k in range(len(lanes))])
    roots = components(found.select(value("a").alias("a"), value("b").alias("b")))
    own = classes.select(*lanes, "least", F.struct(*[F.col(x).alias(f"v{k}") for k, x in enumerate(lanes)]).alias("value"))
    rooted = stage(own.join(roots, "value", "left").withColumn("root", F.coalesce("root", "value")), "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    return rooted.join(least, "root").select(*lanes, "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable by links of at most ``bits`` differing bits. NULL and
    empty texts have fingerprint zero and are linked like any other; repeated rows and ids share a
    component; a NULL id is never the smallest unless a component has no other. Other columns are ignored.
    """
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text")).transform(
        lambda d: _with_prints(d, words, (SEED,))), "prints")
    found = stage(_components(rows, ["f0"], bits, tile), "components")
    joined = rows.join(found, "f0")
    return joined.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def _with_prints(rows: DataFrame, words: int, seeds: tuple[int, ...]) -> DataFrame:
    """(row, id, f0, ...) in one pass over (row, id, text)."""
    kind = rows.schema["id"].dataType.simpleString()
    schema = ", ".join(["row long", f"id {kind}", *[f"f{i} long" for i in range(len(seeds))]])

    def run(batches):
        for batch in batches:
            for done in _fingerprints([pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["row", "text"])], words, seeds):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *done.columns[1:]], names=["row", "id", *done.schema.names[1:]])

    return rows.mapInArrow(run, schema)


def distance_for(similarity: float, width: int) -> int:
    """Expected differing bits, rounded down, of SimHashes of two shingle sets of that Jaccard similarity."""
    return int(width * np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def _centers(classes: DataFrame, tile: int) -> DataFrame:
    """(row, center) of the sets of ``classes`` whose SimHash is linked: the first row of the component."""
    sets = classes.where("size > 0").select("row", "print")
    near = stage(_components(sets.withColumnRenamed("row", "id"), ["print"], BITS, tile), "simhash")
    return sets.join(near, "print").where("row <> component_id").select("row", F.col("component_id").alias("center"))


def one_per_group(docs: DataFrame, words: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` without near copies; of each group one row with the smallest id stays.

    Near copies are texts whose sets of ``words``-word shingles have a Jaccard similarity of at least
    ``similarity``, and what chains of such pairs connect. SimHashes of the sets are linked at ``BITS`` or fewer
    differing bits, as in :func:`near_duplicates`, and each set is verified whole against the first of its component.
    Copies at that similarity may differ in more bits (about nine of 64), so what SimHash does not settle is looked
    for in ``similar``, which says how rarely a pair is not compared. Texts without words are one group, as they are equal.
    """
    rows, row = with_rows(docs, "documents")
    lanes = ["f0", "f1"]
    texts = rows.select(F.col(row).alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    printed = stage(similar.with_keys(texts, words), "prints")
    # Equal sets have equal keys, sizes, sketches and SimHashes.
    classes = stage(printed.groupBy(*lanes).agg(F.min("id").alias("least"), F.min("row").alias("row"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.first("print").alias("print")), "classes")
    links = stage(similar.links(texts, classes, _centers(classes, tile), words, similarity, tile), "pairs")
    found = stage(_rooted(classes.select(*lanes, "least"), links, lanes), "components")
    # A group's rows are many, so the one that stays is found by an aggregate, not by a sort of the group.
    best = printed.join(found, lanes).groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("best"))
    return rows.join(best.select(F.col("best.row").alias(row)), row, "left_semi").select(*docs.columns)
