"""Quality rules from the repeats inside each text, found by a suffix array over its words.

The words of a batch of texts form one array, in which a word stands for itself only within its text, so suffixes of
different texts share no prefix. Prefix doubling sorts the suffixes: only groups that still agree are sorted again.
The classes of all rounds give the longest common prefix (LCP) of neighbours in the order by binary lifting. An LCP
interval whose suffixes differ in the word before them is a maximal repeated substring. The spans of those of at
least ``LEAST`` words are united: a text fails when they cover too much of it, or when one of them is too long.

A text of n words needs some 60 * n bytes and, beyond that, 4 * n for each time its longest repeat doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import whole

WINDOW = 3  # words of the base rule
LEAST = 10  # words of a repeat that counts for the verdict
COVERED = 30  # percent of the words that such repeats may cover
LONGEST = 100  # words of the longest repeat allowed
FEWEST = 50  # words of a text that may stay
REPEATED = 50  # percent of the words that repeated windows may cover
SYMBOLS = r"[#*$%&|<>]"
SLICE_BYTES = 1 << 21


@dataclass(frozen=True)
class Suffixes:
    """Suffixes in order, and the common prefix of each with the one before, 0 at the border of texts."""

    order: np.ndarray
    lcp: np.ndarray


def suffixes(codes: np.ndarray, texts: np.ndarray) -> Suffixes:
    """Of the words ``codes``, where ``texts`` numbers the text of each word, ascending."""
    n = len(codes)
    # A mark that occurs once ends every text.
    last = np.append(np.diff(texts) != 0, True) if n else np.zeros(0, dtype=bool)
    at = np.arange(n) + np.cumsum(last) - last
    size = n + int(last.sum())
    key = np.arange(size, dtype=np.int64) - size
    key[at] = texts.astype(np.int64) * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    first = np.append(True, key[order][1:] != key[order][:-1]) if size else np.zeros(0, dtype=bool)

    def ranks(first: np.ndarray) -> np.ndarray:
        """Each suffix's class: where the class begins in the order."""
        out = np.empty(size, dtype=np.int32)
        out[order] = np.maximum.accumulate(np.where(first, np.arange(size), 0))
        return out

    levels, step = [ranks(first)] if size else [], 1
    while size:
        shared = ~(first & np.append(first[1:], True))
        where = np.nonzero(shared)[0]
        if not len(where):
            break
        rank, part = levels[-1], order[where]
        # A shared class has no end mark inside, so the second half begins inside the text.
        pair = rank[part].astype(np.int64) * size + rank[part + step]
        turn = np.argsort(pair, kind="stable")
        order[where] = part[turn]
        pair = pair[turn]
        first[where] = np.append(True, pair[1:] != pair[:-1])
        levels.append(ranks(first))
        step *= 2
    lcp = np.zeros(size, dtype=np.int64)
    pairs = np.nonzero(~_differs(levels[0], order))[0] if size else np.zeros(0, np.int64)
    a, b = order[pairs - 1].copy(), order[pairs].copy()
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a] == levels[k][b]
        a[same] += 1 << k
        b[same] += 1 << k
    lcp[pairs] = a - order[pairs - 1]
    back = np.full(size, -1, dtype=np.int64)
    back[at] = np.arange(n)
    words = back[order] >= 0
    # End marks sort before all words, so that no word follows one of them in the order but the first.
    return Suffixes(back[order][words], lcp[words])


def _differs(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    return np.append(True, rank[order[1:]] != rank[order[:-1]])


def intervals(found: Suffixes, codes: np.ndarray, texts: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Maximal repeated substrings of at least ``least`` words: (first, last, words), places in the suffix order.

    An interval is as wide as its common prefix allows; it is maximal to the left when the words before its
    suffixes differ or one of them begins its text.
    """
    order, lcp = found.order, found.lcp
    begins = np.append(True, texts[1:] != texts[:-1]) if len(texts) else np.zeros(0, dtype=bool)
    before = np.where(begins[order], -1 - order, codes[order - 1])
    changes = np.cumsum(np.append(0, before[1:] != before[:-1])) if len(order) else order
    out = []
    where = np.nonzero(lcp >= least)[0]
    for run in np.split(where, np.nonzero(np.diff(where) > 1)[0] + 1) if len(where) else []:
        open_: list[tuple[int, int]] = []
        values = lcp[run].tolist()
        for i, value in zip(range(int(run[0]), int(run[-1]) + 2), [*values, 0], strict=True):
            left = i - 1
            while open_ and open_[-1][1] > value:
                left, length = open_.pop()
                if changes[i - 1] > changes[left]:
                    out.append((left, i - 1, length))
            if value and (not open_ or open_[-1][1] < value):
                open_.append((left, value))
    return out


def longest_at(found: Suffixes, n: int) -> np.ndarray:
    """Words of the longest repeat that begins at each word: the length of the innermost interval of its suffix."""
    out = np.zeros(n, dtype=np.int64)
    out[found.order] = np.maximum(found.lcp, np.append(found.lcp[1:], 0))
    return out


def covered(repeat: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least ``least`` words: the union of the spans."""
    until = np.where(repeat >= least, np.arange(len(repeat)) + repeat, 0)
    return np.maximum.accumulate(until) > np.arange(len(repeat)) if len(repeat) else np.zeros(0, dtype=bool)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code of each word, number of its text)."""
    lists = pc.ascii_split_whitespace(texts)
    flat, owner = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    codes = flat.filter(real).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, owner.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)


def _per_text(values: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(texts, values, n).astype(np.int64)


def _again(line_lists: list[list[str]]) -> list[int]:
    """Lines with a word that are equal to an earlier line of the text."""
    out = []
    for lines in line_lists:
        kept = [line for line in lines if line.strip(" \t\n\r\x0b\x0c")]
        out.append(len(kept) - len(set(kept)))
    return out


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeats", "n_covered", "longest_repeat"]


def measures(texts: pa.Array, least: int = LEAST) -> list[np.ndarray]:
    """The columns MEASURES of some texts."""
    n = len(texts)
    codes, owner = _words(texts)
    found = suffixes(codes, owner)
    repeat = longest_at(found, len(codes))
    spans = intervals(found, codes, owner, least)
    spaces = pc.count_substring_regex(texts, r"[\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    longest = np.zeros(n, dtype=np.int64)
    np.maximum.at(longest, owner, repeat)
    starts = np.array([s[0] for s in spans], dtype=np.int64)
    return [
        np.bincount(owner, minlength=n).astype(np.int64), pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) - spaces,
        pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64),
        np.array(_again([t.split("\n") if "\n" in t else [] for t in texts.to_pylist()]), dtype=np.int64),
        _per_text(covered(np.minimum(repeat, WINDOW), WINDOW), owner, n), np.bincount(owner[found.order[starts]], minlength=n).astype(np.int64),
        _per_text(covered(repeat, least), owner, n), longest,
    ]


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """A few texts at a time."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + SLICE_BYTES, "right")))
        yield texts.slice(a, b - a)
        a = b


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per input row: doc_id and MEASURES, all long; see :func:`rules` for the odd cases."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                columns = measures(part, least)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", *MEASURES])
                at += len(part)

    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, percent: int = COVERED, longest: int = LONGEST) -> DataFrame:
    """One row per input row: doc_id, MEASURES, ``base_failed`` and ``kept``.

    ``n_repeats`` counts maximal repeated substrings of at least ``least`` words, ``n_covered`` the words that they
    cover, first occurrences included; ``longest_repeat`` is the longest repeat of any length. A text stays when
    the base rules hold, ``n_covered`` is at most ``percent`` of the words and no repeat is longer than ``longest``.
    NULL and empty texts have no words and fail the base rules; rows are judged one by one, so repeated rows and
    NULL ids do not matter; an empty table gives no rows. Other columns are ignored.
    """
    base_failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    good = (100 * F.col("n_covered") <= percent * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return measured(docs, doc_id, text, least).select("doc_id", *MEASURES, base_failed.alias("base_failed"), (~base_failed & good).alias("kept"))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that stay."""
    from fieldlens.llm.common import with_rows

    rows, row = with_rows(docs, "documents")
    kept = rules(rows.select(F.col(row).alias("row"), F.col(text).alias("text")), "row", "text", **limits).where("kept")
    return rows.join(kept.select(F.col("doc_id").alias(row)), row, "left_semi").select(*docs.columns)
