"""Importance resampling of documents towards a target distribution.

A document's features are its runs of up to ``most`` words, hashed into buckets by CRC-32 (see ``crc``). A
bucket's gain is the rounded logarithm of how much likelier it is among the target's features than among the
corpus's; a document's weight adds up the gains. With Gumbel noise drawn from the id, the documents with the
highest scores are a sample without replacement in proportion to exp(weight).

Two passes read the texts: one counts buckets, of which a task sends one row each at most, and one weighs. Only
ids and numbers are shuffled, in one range sort. A task holds a batch of texts and some 30 bytes per byte of the
slice or, if longer, the single text that it works on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import fresh, total_before, whole, with_rows
from fieldlens.llm.crc import _ranges, crc32
from fieldlens.session import stage

MOST_WORDS = 1  # of a feature
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20  # of a document that may be drawn
PERCENT = 10
SLICE_BYTES = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of a word: digits, letters, and all of UTF-8 beyond ASCII.
_WORD = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122))


def slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lower-cased bytes, offsets) of a few texts at a time; offsets are those of the texts and the end."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
        yield _LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
        a = b


def features(data: np.ndarray, offsets: np.ndarray, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature); features come text by text for each run length."""
    word = np.append(_WORD[data], False)
    cut = np.zeros(len(word), dtype=bool)
    cut[offsets] = True
    before = np.append(False, word[:-1]) & ~cut
    starts = np.nonzero(word & ~before)[0]
    after = np.append(word[1:], False) & ~np.append(cut[1:], True)
    ends = np.nonzero(word & ~after)[0] + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(text, minlength=len(offsets) - 1)
    owners, found = [text], [crc32(data, starts, ends)]
    if most > 1 and len(starts):
        sizes = ends - starts  # words of one space each, so that a run of words is one span
        begin = np.cumsum(sizes + 1) - sizes - 1
        joined = np.full(begin[-1] + sizes[-1] + 1, 32, dtype=np.uint8)
        joined[_ranges(begin, sizes)] = data[_ranges(starts, sizes)]
        for k in range(2, most + 1):
            same = np.nonzero(text[: len(text) - k + 1] == text[k - 1 :])[0]
            owners.append(text[same])
            found.append(crc32(joined, begin[same], (begin + sizes)[same + k - 1]))
    return counts, np.concatenate(owners), np.concatenate(found).astype(np.int64) % buckets


def bucket_counts(docs: DataFrame, most: int = MOST_WORDS, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket; at most ``buckets`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for data, offsets in slices(batch.column(0)):
                total += np.bincount(features(data, offsets, most, buckets)[2], minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = docs.select(whole(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(ratio of smoothed shares)) of each bucket."""
    s, t = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighed(rows: DataFrame, gain: np.ndarray, most: int = MOST_WORDS) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight) of (row, doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts, sums = [], [], []
            for data, offsets in slices(batch.column(2)):
                n, owner, bucket = features(data, offsets, most, len(gain))
                words.append(n)
                counts.append(np.bincount(owner, minlength=len(n)))
                total = np.zeros(len(n), dtype=np.int64)
                np.add.at(total, owner, gain[bucket])
                sums.append(total)
            arrays = [pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)) for x in (words, counts, sums)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["row", "doc_id", "n_words", "n_features", "weight"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, doc_id {kind}, n_words long, n_features long, weight long")


def _scored(rows: DataFrame, target: DataFrame, target_text: str, most: int, buckets: int, seed: int) -> DataFrame:
    gain = gains(bucket_counts(rows, most, buckets), bucket_counts(target, most, buckets, target_text))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return stage(weighed(rows, gain, most).withColumn("score", F.col("weight") + noise), "scores")


def _ranked(scores: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Adds ``rank``; NULL for what is not drawn."""
    fit = scores.where(F.col("n_words") >= least_words)
    drawn = fit.count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    placed = total_before(fit, order, {"before": F.lit(1).cast("long")}, "ranked")
    ranked = placed.select(*scores.columns, F.when(F.col("before") < drawn, F.col("before") + 1).alias("rank"))
    return ranked.unionByName(scores.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", most: int = MOST_WORDS,
             buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score, rank.

    ``percent`` of the documents with at least ``least_words`` words are drawn and ranked from the highest score
    down, equal scores by the smaller id. NULL texts, empty ones and those without words have no features and
    weight 0; a NULL id draws its noise as an empty one and ranks last among equal scores; repeated rows are weighed
    and ranked each. An empty target gives every bucket a target count of 0; an empty table gives no rows. Other
    columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    return _ranked(_scored(rows, target, target_text, most, buckets, seed), percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def sample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", most: int = MOST_WORDS,
           buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn documents with all their columns."""
    numbered, row = with_rows(docs, "documents")
    rows = numbered.select(F.col(row).alias("row"), F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    drawn = _ranked(_scored(rows, target, target_text, most, buckets, seed), percent, least_words).where("rank IS NOT NULL")
    name = fresh(numbered, "drawn")
    return numbered.join(drawn.select(F.col("row").alias(name)), F.col(row) == F.col(name), "left_semi").select(*docs.columns)
