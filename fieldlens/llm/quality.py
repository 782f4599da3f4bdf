"""Quality of documents from weak labels: labellers, their accuracies by EM, and a hashed linear scorer.

Heuristic labellers vote good, bad or abstain. Expectation-maximisation over the counts of all vote
patterns in the corpus estimates how each labeller votes on good and on bad documents and gives every
pattern a posterior. A linear model over hashed word features is trained on the posteriors of a sample
and scores every document; it sees what no labeller counts.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import whole

BUCKETS = 1 << 16
SAMPLE_DOCS = 2000  # documents that the linear model is trained on, about
ROUNDS = 60
TRUST = (9.0, 1.0)  # votes, right and wrong, that each labeller is credited with beforehand
CACHED = 200_000
SLICE_BYTES = 4 << 20
REPEATED, BIAS = 0, 1  # buckets of their own


LABELLERS = ("marks", "bars", "capitals", "loud", "repeats", "length", "sentences", "letters", "word length")
_MARKS = frozenset("#$%&*<>{}[]^~=_\\")


class WordSums:
    """For batches of texts, sums over their words of a vector that depends on the word alone.

    What a distinct word gives is computed once and kept, within a bound. Two more columns count the words
    and those that equal the word before them.
    """

    def __init__(self, width: int, vector_of):
        self.width, self.vector_of, self.known = width, vector_of, {}

    def _slice(self, texts: pa.Array) -> np.ndarray:
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        if len(self.known) > CACHED:
            self.known.clear()
        distinct = coded.dictionary.to_pylist()
        for w in distinct:
            if w not in self.known:
                self.known[w] = self.vector_of(w)
        vectors = np.array([self.known[w] for w in distinct], dtype=float).reshape(-1, self.width)
        real = np.array([bool(w) for w in distinct], dtype=bool)  # the split leaves empty words at the ends
        codes, owner = coded.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
        codes, owner = codes[real[codes]], owner[real[codes]]
        same = np.append((codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1]), False) if len(codes) else np.zeros(0)
        columns = [vectors[codes, k] for k in range(self.width)] + [np.ones(len(codes)), same]
        return np.stack([np.bincount(owner, c, len(texts)) for c in columns], axis=1)

    def sums(self, texts: pa.Array) -> np.ndarray:
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        cuts = [0, *(np.nonzero(np.diff((np.cumsum(sizes) - sizes) // SLICE_BYTES))[0] + 1).tolist(), len(texts)]
        parts = [self._slice(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
        return np.concatenate(parts) if parts else np.zeros((0, self.width + 2))


def _word_facts(w: str) -> list[int]:
    return [len(w), sum(map(str.isalpha, w)), sum(map(str.isupper, w)), sum(c in _MARKS for c in w), w.count("|"), "!!" in w, w.endswith((".", "!", "?"))]


def votes(sums: np.ndarray) -> np.ndarray:
    """Rows of votes of LABELLERS: 1 good, -1 bad, 0 abstains.

    Each of the first five looks for one kind of junk and never votes good. The others vote good on texts
    that are calm in all these respects, so they overlap; all abstain on texts of fewer than five words.
    """
    chars, letters, upper, marks, bars, loud, ends, words, again = sums.T
    long, never = words >= 5, np.zeros(len(words), dtype=bool)
    calm = (marks * 200 <= chars) & (bars * 50 <= words) & (upper * 4 <= letters) & (loud * 50 <= words) & (again * 20 <= words)
    good_bad = {
        "marks": (never, marks * 50 > chars), "bars": (never, bars * 10 > words), "capitals": (never, upper * 2 > letters),
        "loud": (never, loud * 10 > words), "repeats": (never, again * 5 > words),
        "length": (calm & (words >= 15), never), "sentences": (calm & (ends * 60 >= words) & (ends * 2 < words), never),
        "letters": (calm & (letters * 10 >= chars * 9), letters * 2 < chars),
        "word length": (calm & (chars >= words * 3) & (chars <= words * 11), (chars < words * 2) | (chars > words * 20)),
    }
    return np.stack([np.where(bad & long, -1, np.where(good & long, 1, 0)) for good, bad in (good_bad[n] for n in LABELLERS)], axis=1).astype(np.int32)


def accuracies(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """EM for two classes: every labeller's votes are right with a probability of its own, abstentions say nothing.

    Gives the posterior of good for each pattern (row of ``votes``), the accuracies, and the share of good.
    Bad documents are bad in different ways, each seen by few labellers, so it starts from "bad if any
    labeller says so"; how far each is to be trusted then comes out of their overlaps. The classes count as
    equally likely beforehand: abstentions being silent, a larger class would else outvote single labellers.
    """
    weight = counts.astype(float)
    posterior = np.where((votes < 0).any(axis=1), 0.05, 0.95)
    accuracy = np.full(votes.shape[1], 0.9)
    for _ in range(rounds):
        agree = np.where(votes > 0, posterior[:, None], np.where(votes < 0, 1 - posterior[:, None], 0))
        accuracy = (weight @ agree + TRUST[0]) / (weight @ (votes != 0) + sum(TRUST))
        odds = votes @ np.log(accuracy / (1 - accuracy))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return posterior, accuracy, float((weight @ posterior + 1) / (weight.sum() + 2))


def _kind(c: str) -> str:
    return "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c


_ASCII_KINDS = {i: _kind(chr(i)) for i in range(128)}
_RUN = re.compile(r"(.)\1+")


def _bucket(feature: str) -> int:
    return 2 + zlib.crc32(feature.encode()) % (BUCKETS - 2)


_few = functools.lru_cache(1 << 14)(_bucket)  # words share shapes and endings


def word_features(word: str) -> list[int]:
    """Buckets of the word, its shape (runs of capitals, letters, digits and marks) and its last two characters."""
    kinds = word.translate(_ASCII_KINDS) if word.isascii() else "".join(map(_kind, word))
    return [_bucket("w" + word.lower()), _few("s" + _RUN.sub(r"\1", kinds)), _few("e" + word[-2:])]


def document_features(text: str) -> tuple[list[int], list[float]]:
    """Buckets and values; counts are divided by the number of words."""
    words = text.encode().split()
    seen: dict[int, float] = {BIAS: 1.0, REPEATED: sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, len(words))}
    for w in words:
        for f in word_features(w.decode()):
            seen[f] = seen.get(f, 0.0) + 1 / len(words)
    return list(seen), list(seen.values())


def train(rows: list[tuple[list[int], list[float]]], target: np.ndarray, steps: int = 150, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft targets by gradient steps scaled per weight."""
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    bucket, value = (np.array([x for r in rows for x in r[k]], dtype=t) for k, t in ((0, np.int64), (1, float)))
    used, bucket = np.unique(bucket, return_inverse=True)
    weight, size = np.zeros(len(used)), np.full(len(used), 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, value * weight[bucket], len(rows)), -50, 50)))
        grad = np.bincount(bucket, value * (p - target)[owner], len(used)) / len(rows) + decay * weight
        size += grad**2
        weight -= rate * grad / np.sqrt(size)
    out = np.zeros(BUCKETS)
    out[used] = weight
    return out


@dataclass(frozen=True)
class Model:
    weight: np.ndarray
    accuracy: dict[str, float]  # of each labeller's votes
    share: float
    posterior: dict[tuple[int, ...], float]


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Votes of all documents, EM over their patterns, and a linear model from about ``sample_docs`` documents."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = WordSums(len(_word_facts("")), _word_facts)
        for batch in batches:
            pattern, counts = np.unique(votes(facts.sums(batch.column(0))), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pattern.tolist(), pa.list_(pa.int32())), pa.array(counts)], names=["votes", "n"])

    counted = rows.select("text").mapInArrow(count, "votes array<int>, n long").groupBy("votes").agg(F.sum("n")).orderBy("votes")
    patterns = counted.collect()  # at most 3 ^ labellers rows
    if not patterns:
        return Model(np.zeros(BUCKETS), {}, 0.5, {})
    pattern, counts = np.array([list(r[0]) for r in patterns]), np.array([r[1] for r in patterns])
    posterior, accuracy, share = accuracies(pattern, counts)
    rate = min(1.0, sample_docs / counts.sum())
    known = {tuple(v): float(p) for v, p in zip(pattern.tolist(), posterior, strict=True)}
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) < int(rate * (1 << 30))).select("text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = WordSums(len(_word_facts("")), _word_facts)
        for batch in batches:
            found = [document_features(t) for t in batch.column(0).to_pylist()]
            voted = votes(facts.sums(batch.column(0))).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(voted, pa.list_(pa.int32())), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["votes", "bucket", "value"])

    sample = sorted((list(r.votes), list(r.bucket), list(r.value)) for r in chosen.mapInArrow(extract, "votes array<int>, bucket array<long>, value array<double>").collect())
    target = np.array([known[tuple(s[0])] for s in sample])
    weight = train([(s[1], s[2]) for s in sample], target) if sample else np.zeros(BUCKETS)
    return Model(weight, dict(zip(LABELLERS, accuracy.tolist(), strict=True)), share, known)


def scores(weight: np.ndarray, sums: WordSums, texts: pa.Array) -> np.ndarray:
    adds, words, again = sums.sums(texts).T
    margin = (adds + weight[REPEATED] * again) / np.maximum(1, words) + weight[BIAS]
    return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def rate(docs: DataFrame, model: Model, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1) and keep.

    NULL and empty texts have no words and score what the bias gives, but are never kept; repeated rows get
    equal scores; a model that was fitted on nothing scores 0.5. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = model.weight.tolist()

        def of_word(w: str) -> list[float]:
            word, shape, end = word_features(w)
            return [weight[word] + weight[shape] + weight[end]]

        sums = WordSums(1, of_word)
        for batch in batches:
            score = scores(model.weight, sums, batch.column(1))
            full = pc.match_substring_regex(batch.column(1), r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(score, 12)), pa.array((score >= threshold) & full)], names=["doc_id", "score", "keep"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double, keep boolean")
