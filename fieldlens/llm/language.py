"""Language identification by unigram models whose segmentations are summed out.

A language gives every piece of a fixed public vocabulary a probability. The likelihood of a word is the sum
over all ways to write it as a sequence of pieces, found by a forward pass over its characters; a text is
its words. Piece probabilities are learned by expectation-maximisation over the same segmentations.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import lean, whole
from fieldlens.llm.tokens import vocabulary_file
from fieldlens.session import stage

SAMPLE_DOCS = 1000  # labelled documents per language that the fit reads, about
ROUNDS = 3
UNKNOWN = "und"
LETTERS = r"\p{L}+"  # the same in the fit and in Python, where the regex library reads it
RUN = 32  # the longest piece; longer runs of letters are summed in logarithms
CELLS = 1 << 21  # numbers of such runs at a time
START = "▁"  # begins a word, as in the vocabulary
CACHED = 200_000
BLOCK = 1 << 14  # new words that are scored together
SLICE_BYTES = 2 << 20
FLOOR = 1e-7  # of a character without a piece, and of pieces that a language does not use


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str):
    """An automaton that finds pieces in a text, and the pieces' lengths; lower-cased, special pieces left out."""
    import ahocorasick
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    pieces = sorted({p for i in ids if START not in (p := model.id_to_piece(i).lower())[1:] and len(p) <= RUN})
    automaton = ahocorasick.Automaton()
    for i, piece in enumerate(pieces):
        automaton.add_word(piece, i)
    automaton.make_automaton()
    return automaton, np.array([len(p) for p in pieces])


@functools.lru_cache(maxsize=1)
def _letters():
    import regex

    return regex.compile(LETTERS)


def _runs(word: str) -> list[str]:
    """The runs of letters of a word, each marked as the start of a word."""
    return [START + run for run in _letters().findall(word)]


def _steps(runs: list[str], path: str):
    """Matched pieces as (end, length, run numbers, piece numbers), by ascending end; characters without a piece have number -1."""
    automaton, length = _vocabulary(path)
    sizes = np.array([len(r) for r in runs])
    starts = np.cumsum(sizes + 1) - sizes - 1
    found = np.fromiter(chain.from_iterable(automaton.iter("\n".join(runs))), dtype=np.int64).reshape(-1, 2)
    run = np.searchsorted(starts, found[:, 0], "right") - 1
    end, piece = found[:, 0] - starts[run] + 1, found[:, 1]
    width = int(sizes.max()) + 1
    single = (run * width + end)[length[piece] == 1]
    every = np.repeat(np.arange(len(runs)), sizes) * width + 1 + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    missing = np.setdiff1d(every, single)
    run, end = np.concatenate([run, missing // width]), np.concatenate([end, missing % width])
    size = np.concatenate([length[piece], np.ones(len(missing), dtype=np.int64)])
    piece = np.concatenate([piece, np.full(len(missing), -1)])
    key = end * (RUN + 1) + size
    order = np.argsort(key, kind="stable")
    cuts = np.concatenate([[0], np.nonzero(np.diff(key[order]))[0] + 1, [len(order)]])
    groups = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
    return sizes, [(int(end[g[0]]), int(size[g[0]]), run[g], piece[g]) for g in groups]


def _forward(sizes: np.ndarray, steps, prob: np.ndarray) -> np.ndarray:
    alpha = np.zeros((len(sizes), int(sizes.max()) + 1, prob.shape[1]))
    alpha[:, 0] = 1
    for end, size, run, piece in steps:
        alpha[run, end] += alpha[run, end - size] * prob[piece]
    return alpha


def _log_forward(sizes: np.ndarray, steps, logs: np.ndarray, kept: int) -> np.ndarray:
    """The forward sums in logarithms: runs x places x languages, for the last ``kept`` places, by place modulo ``kept``.

    Behind a run's end stands what its end had.
    """
    alpha = np.full((len(sizes), kept, logs.shape[1]), -np.inf)
    alpha[:, 0] = 0
    ends = np.array([s[0] for s in steps])
    bounds = np.searchsorted(ends, np.arange(1, int(sizes.max()) + 2))
    for end in range(1, int(sizes.max()) + 1):
        here = np.full((len(sizes), logs.shape[1]), -np.inf)
        for _, size, run, piece in steps[bounds[end - 1] : bounds[end]]:
            here[run] = np.logaddexp(here[run], alpha[run, (end - size) % kept] + logs[piece])
        over = sizes < end
        here[over] = alpha[over, (end - 1) % kept]
        alpha[:, end % kept] = here
    return alpha


def _parts(runs: list[str], width: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Numbers of runs that are worked on together, by length, and whether they are long."""
    lengths = np.array([len(r) for r in runs], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    short = int(np.searchsorted(lengths[order], RUN, "right"))
    chunk = max(256, 32768 // max(1, width))
    for a in range(0, short, chunk):
        yield order[a : min(a + chunk, short)], False
    a = short
    while a < len(order):
        b = a + 1
        while b < len(order) and (b + 1 - a) * int(lengths[order[b]]) * width <= CELLS:
            b += 1
        yield order[a:b], True
        a = b


def likelihoods(runs: list[str], prob: np.ndarray, path: str) -> np.ndarray:
    """Log likelihood of each run (rows) in each language (columns); the last row of ``prob`` is for characters without a piece."""
    out = np.zeros((len(runs), prob.shape[1]))
    for part, long in _parts(runs, prob.shape[1]):
        sizes, steps = _steps([runs[i] for i in part], path)
        if long:
            out[part] = _log_forward(sizes, steps, np.log(prob), RUN + 1)[:, int(sizes.max()) % (RUN + 1)]
        else:
            out[part] = np.log(_forward(sizes, steps, prob)[np.arange(len(part)), sizes])
    return out


def expected(runs: list[str], weight: np.ndarray, prob: np.ndarray, path: str) -> np.ndarray:
    """How often each piece is used, summed over the runs' segmentations by their posterior; ``weight``: runs x languages."""
    out = np.zeros_like(prob)
    for part, long in _parts(runs, prob.shape[1]):
        sizes, steps = _steps([runs[i] for i in part], path)
        rows = np.arange(len(sizes))
        if long:
            logs = np.log(prob)
            alpha = _log_forward(sizes, steps, logs, int(sizes.max()) + 1)
            whole_run, beta = alpha[rows, sizes], np.full_like(alpha, -np.inf)
            beta[rows, sizes] = 0
            for end, size, run, piece in reversed(steps):
                flow = logs[piece] + beta[run, end]
                beta[run, end - size] = np.logaddexp(beta[run, end - size], flow)
                np.add.at(out, piece, weight[part][run] * np.exp(alpha[run, end - size] + flow - whole_run[run]))
            continue
        alpha, beta = _forward(sizes, steps, prob), np.zeros((len(sizes), int(sizes.max()) + 1, prob.shape[1]))
        beta[rows, sizes] = weight[part] / alpha[rows, sizes]
        for end, size, run, piece in reversed(steps):
            flow = prob[piece] * beta[run, end]
            beta[run, end - size] += flow
            np.add.at(out, piece, alpha[run, end - size] * flow)
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prob: np.ndarray  # pieces and one row for unknown characters x languages
    vocabulary: str


def _normalised(counts: np.ndarray) -> np.ndarray:
    return np.maximum((counts + 0.01) / (counts + 0.01).sum(axis=0), FLOOR)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, vocabulary: str | None = None, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learns from about ``sample_docs`` documents of each language, chosen by a hash of the id.

    Only documents with text and language whose id is not held out are read. Counts of words are gathered and
    segmented on the executors; the driver gets one row per piece of the vocabulary.
    """
    vocabulary = vocabulary or vocabulary_file("piece_bpe_32k.model")
    labelled = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL").where(~held_out())
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    languages = sorted(sizes)
    n_pieces = len(_vocabulary(vocabulary)[1])
    if not languages:
        return Model([], np.zeros((n_pieces + 1, 0)), vocabulary)
    rate = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, sample_docs / sizes[name]))])
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < rate[F.col("lang")] * (1 << 30))
    words = chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0))).alias("word"))
    counted = words.groupBy("word").agg(F.array(*[F.count_if(F.col("lang") == name).cast("double") for name in languages]).alias("counts"))
    counted = stage(counted, "words")
    width = len(languages)

    def step(batches: Iterator[pa.RecordBatch], prob: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(prob)
        for batch in batches:
            pieces = [_runs(w) for w in batch.column(0).to_pylist()]
            weight = batch.column(1).flatten().to_numpy().reshape(-1, width)
            total += expected([r for p in pieces for r in p], np.repeat(weight, [len(p) for p in pieces], axis=0), prob, vocabulary)
        used = np.nonzero(total.sum(axis=1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, k]) for k in range(width)]], names=["piece", *[f"n{k}" for k in range(width)]])

    prob = np.full((n_pieces + 1, width), 1 / (n_pieces + 1))
    schema = ", ".join(["piece long", *[f"n{k} double" for k in range(width)]])
    for _ in range(rounds):
        sums = counted.mapInArrow(lean(lambda b, prob=prob: step(b, prob)), schema).groupBy("piece").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(width)])
        counts = np.zeros_like(prob)
        for r in sums.collect():
            counts[r[0]] = r[1:]
        prob = _normalised(np.round(counts, 6))
    return Model(languages, prob, vocabulary)


class Scorer:
    """Predictions for batches of texts; distinct words are scored once and kept, within a bound.

    They are kept as Arrow text: as Python's strings in a dictionary they took more memory than all else of a task.
    """

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.known = np.zeros((0, len(self.model.languages) + 1))

    def _score(self, words: list[str]) -> np.ndarray:
        """For each word its log likelihoods and the number of its runs of letters."""
        pieces = [_runs(w) for w in words]
        owner = np.repeat(np.arange(len(words)), [len(p) for p in pieces])
        sums = np.zeros((len(words), self.known.shape[1]))
        if len(owner):
            number: dict[str, int] = {}
            which = [number.setdefault(r, len(number)) for p in pieces for r in p]
            np.add.at(sums[:, :-1], owner, likelihoods(list(number), self.model.prob, self.model.vocabulary)[which])
            np.add.at(sums[:, -1], owner, 1)
        return sums

    def _look_up(self, words: pa.Array) -> np.ndarray:
        """Where in ``known`` each of the distinct ``words`` stands."""
        if len(self.words) > CACHED:
            self._forget()
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(place))
        place = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        if len(new):
            place[place < 0] = len(self.known) + np.arange(len(new))
            scored = [self._score(new.slice(a, BLOCK).to_pylist()) for a in range(0, len(new), BLOCK)]
            self.words = pa.concat_arrays([self.words, new])
            self.known = np.concatenate([self.known, *scored])
        return place

    def _slice(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        coded = words.flatten().dictionary_encode()
        place = self._look_up(coded.dictionary.cast(pa.string()))
        values = self.known[place[coded.indices.to_numpy()]]
        at = words.offsets.to_numpy() - words.offsets[0].as_py()
        total = np.zeros((len(texts), values.shape[1]))
        full = np.nonzero(np.diff(at))[0]
        if len(full):
            total[full] = np.add.reduceat(values, at[full], axis=0)
        logs, letters = total[:, :-1], total[:, -1] > 0
        if not self.model.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        odds = np.exp(logs - logs.max(axis=1, keepdims=True))
        best = odds.argmax(axis=1)
        score = np.where(letters, 1 / odds.sum(axis=1), 0.0)
        return [self.model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)], score

    def predict(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
        cuts = [0, *(np.nonzero(np.diff((np.cumsum(sizes) - sizes) // SLICE_BYTES))[0] + 1).tolist(), len(texts)]
        names, scores = [], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                found, score = self._slice(texts.slice(a, b - a))
                names += found
                scores.append(score)
        return pa.array(names, pa.string()), np.concatenate(scores) if scores else np.zeros(0)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    ``score`` is the posterior of the predicted language among those learned, all alike beforehand. A text
    that is NULL or has no letter is ``und`` with score 0, as is every text if no language was learned; of
    equally likely languages the first by name is taken. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), whole(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            names, score = scorer.predict(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), names, pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(lean(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are in one of the model's languages with a score of ``least`` or more."""
    at = docs.columns.index(text)

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            names, score = scorer.predict(batch.column(at).cast(pa.string()))
            yield batch.filter(pc.and_(pc.not_equal(names, UNKNOWN), pa.array(score >= least)))

    return docs.mapInArrow(lean(run), docs.schema)
