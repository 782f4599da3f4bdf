"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each word shingle is hashed once. The hash's top bits choose a bin, and a bin keeps its least hash. Empty
bins are filled by optimal densification: a bin asks other bins in an order of its own, the same for every
document, and takes the value of the first that is not empty. Of every bin the low-order bits are stored,
packed into 64-bit words; the share of bins that agree, corrected for those that agree by chance,
estimates the Jaccard similarity of the shingle sets.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import WORD, whole

WORDS = 5
BIN_BITS = 8  # 256 bins
LOW_BITS = 4
PROBES = 16  # probes by 2-universal hashes before bins are asked in full order
PRIME = (1 << 31) - 1
CHUNK_BYTES = 4 << 20
CHUNKS = 50_000  # a chunk is sorted by one task and may spill; more bytes make larger chunks beyond this number

_LOW = (1 << (64 - BIN_BITS)) - 1
_BINS = 1 << BIN_BITS
_PER_WORD = 64 // LOW_BITS


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """One hash for each run of ``words`` words, or one for all words if there are fewer; empty without words."""
    hashed = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        size = F.least(F.lit(words), F.size(h))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(h) - size + 1), lambda i: F.xxhash64(F.slice(h, i, size)))
        )

    return _let(hashed, shingles)


def _least_by_bin(hashes: Column) -> Column:
    """One value per bin in the order of bins; an empty bin has all low bits set.

    A marker above every hash of its bin is sorted among the hashes, so that the first value of each bin
    is its least hash or, without one, the marker.
    """
    markers = F.array(*[F.lit(_signed((b << (64 - BIN_BITS)) | _LOW)) for b in range(_BINS)])
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - BIN_BITS)
    ordered = F.sort_array(F.concat(hashes, markers))
    return _let(ordered, lambda s: F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1)))))


def _is_empty(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_LOW)) == _LOW


def _densified(values: Column) -> Column:
    rule = random.Random(42)
    probes = [(rule.randrange(1, PRIME), rule.randrange(PRIME)) for _ in range(PROBES)]

    def fill(v: Column, filled: Column) -> Column:
        def at(p: Column) -> Column:
            asked = [F.get(v, ((p.cast("long") * a + b) % PRIME % _BINS).cast("int")) for a, b in probes]
            known = [F.when(~_is_empty(x), x) for x in asked]
            rest = F.array_min(F.transform(filled, lambda q: F.struct(F.xxhash64(p, q).alias("h"), F.get(v, q).alias("v")))).getField("v")
            # Hashed with the bin, so that bins which borrow one value do not all agree by one chance.
            return F.xxhash64(F.coalesce(*known, rest), p)

        return F.transform(v, lambda x, p: F.when(_is_empty(x), at(p)).otherwise(x))

    def maybe(v: Column) -> Column:
        filled = F.filter(F.sequence(F.lit(0), F.lit(_BINS - 1)), lambda p: ~_is_empty(F.get(v, p)))
        return _let(filled, lambda f: F.when(F.size(f) == _BINS, v).otherwise(fill(v, f)))

    return _let(values, maybe)


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """Packed low-order bits as an array of longs; an empty array for a text without words."""
    def packed(v: Column) -> Column:
        low = lambda x: x.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
        word = lambda i: F.aggregate(F.slice(v, i * _PER_WORD + 1, _PER_WORD), F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, LOW_BITS).bitwiseOR(low(x)))
        return F.transform(F.sequence(F.lit(0), F.lit(_BINS // _PER_WORD - 1)), word)

    return _let(shingle_hashes(text, words), lambda h: F.when(F.size(h) == 0, h).otherwise(_let(_densified(_least_by_bin(h)), packed)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1; two fingerprints without words are alike, one is like no other."""
    def agreeing(x: Column, y: Column) -> Column:
        differ = x.bitwiseXOR(y)
        low = F.lit(int("1" * _PER_WORD, 16))
        any_bit = F.shiftrightunsigned(differ, 2).bitwiseOR(differ)
        any_bit = F.shiftrightunsigned(any_bit, 1).bitwiseOR(any_bit).bitwiseAND(low)
        return _PER_WORD - F.bit_count(any_bit)

    matches = F.aggregate(F.zip_with(a, b, agreeing), F.lit(0), lambda acc, n: acc + n)
    chance = 1 / (1 << LOW_BITS)
    estimate = (matches / _BINS - chance) / (1 - chance)
    none = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(none, (F.size(a) == F.size(b)).cast("double")).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate)))


def in_hex(packed: Column) -> Column:
    return F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows by ``doc_id``, of the first row after the last.

    Ids are cut into chunks at quantiles, which are ids themselves. The first rows of a chunk go to the chunk
    before as well, behind its own rows, so one shuffle by chunk brings every row to its neighbour.
    """
    known = F.col("doc_id").isNotNull()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = int(min(CHUNKS, max(1, -(-size // CHUNK_BYTES))))
    shares = [i / chunks for i in range(1, chunks)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 20 * chunks).alias("cuts") if shares else F.lit(None).alias("cuts"), F.bool_or(~known).alias("unknown"), F.min("doc_id").alias("least")).first()
    cuts = sorted(set(found["cuts"] or []) - ({found["least"]} if not found["unknown"] else set()))
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    upto = lambda ids: F.size(F.filter(ids, lambda c: c <= F.col("doc_id")))
    chunk, first = F.lit(0), F.lit(False)
    if cuts:
        heads = F.array(*[F.lit(g[0]).cast("long") for g in groups])
        members = F.array(*[F.array(*[F.lit(c).cast("long") for c in g]) for g in groups])
        head = F.when(known, upto(heads)).otherwise(0)
        chunk = F.when(head == 0, 0).otherwise((head - 1) * step + upto(F.get(members, head - 1)))
        first = F.when(known & (head > 0), F.array_contains(F.get(members, head - 1), F.col("doc_id"))).otherwise(False)
    begins = ~known if found["unknown"] else (F.col("doc_id") == F.lit(found["least"]))
    role = lambda c, r: F.struct(c.cast("int").alias("chunk"), F.lit(r).alias("role"))
    placed = rows.withColumn("_chunk", chunk).withColumn("_places", F.filter(F.array(
        role(F.col("_chunk"), 0), F.when(first, role(F.col("_chunk") - 1, 1)), F.when(begins, role(F.lit(len(cuts)), 1))), lambda x: x.isNotNull()))
    copies = placed.select(*rows.columns, F.explode("_places").alias("_place")).select(*rows.columns, "_place.chunk", "_place.role")
    order = Window.partitionBy("chunk").orderBy("role", F.col("doc_id").asc_nulls_first(), "text")
    return copies.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where("role = 0").drop("chunk", "role")


def fingerprints(docs: DataFrame, words: int = WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text whose last half is replaced by as many characters from the start of the
    next document, by ascending id, NULL ids first, equal ids by text; the first follows the last. NULL
    texts count as empty. A text without words has the empty fingerprint. Ids are integers. An empty table
    gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    near = with_next(rows.withColumn("packed", fingerprint(F.col("text"), words)), ["text", "packed"])
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = near.select("doc_id", length.alias("n_chars"), "packed", "next_packed", F.concat(F.substr("text", F.lit(1), length - half), F.substr("next_text", F.lit(1), half)).alias("edited"))
    both = edited.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "packed", "next_packed", fingerprint(F.col("edited"), words).alias("edited_packed"))
    return both.select(
        "doc_id", "n_chars", "edited_sha256", in_hex(F.col("packed")).alias("fingerprint"), in_hex(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"), likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )
