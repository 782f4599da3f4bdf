"""Token ids of whole texts by the tokenizers library, with words that repeat encoded once."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
CACHED_WORDS = 300_000
CACHED_PIECES = 300_000
BLOCK = 1 << 12  # new words that are encoded together
#: A word of letters of the first 256 code points, then marks of ASCII: one piece each for the tokenizer.
PLAIN = "\\A(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\\[-`{-~]*)\\z"
IDS = pa.list_(pa.uint32())


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Known:
    """Texts and their ids, each encoded when first seen and kept as Arrow lists; the empty text has none.

    Of more than ``most`` texts, those found again since the last such drop stay, the newest half of ``most`` if they are more.
    """

    def __init__(self, encode: Callable[[list[str]], pa.ListArray]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.texts, self.ids, self.again = pa.array([""], pa.string()), pa.array([[]], IDS), np.ones(1, bool)

    def _drop(self, most: int) -> None:
        stay = pa.array(np.concatenate([[0], np.nonzero(self.again)[0][1:][-(most // 2) :]]))
        self.texts, self.ids = self.texts.take(stay), self.ids.take(stay)
        self.again = np.arange(len(stay)) == 0

    def find(self, texts: pa.Array, most: int) -> np.ndarray:
        """The place of each text; places hold until the next call."""
        if len(self.texts) > most:
            self._drop(most)
        coded = texts.dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.texts)
        new = coded.dictionary.filter(pc.is_null(place))
        place = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        known = place >= 0
        self.again[place[known]] = True
        if len(new):
            place[~known] = len(self.texts) + np.arange(len(new))
            self.ids = pa.concat_arrays([self.ids, *(self.encode(new.slice(a, BLOCK).to_pylist()) for a in range(0, len(new), BLOCK))])
            self.texts = pa.concat_arrays([self.texts, new])
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        return place[coded.indices.to_numpy()]


def _lists(ids: Sequence[list[int]]) -> pa.ListArray:
    return pa.array(ids, IDS)


class Encoder:
    """Ids of many texts at once; the same ids as ``Tokenizer.encode(text, add_special_tokens=False)``.

    It is meant for the word tokenizer, whose pieces never cross white space and which lower-cases.
    Texts are split at ASCII white space and each distinct word of a slice is looked up or encoded: the letters and the
    marks of plain words by the tokenizer's BPE model, many in a call, all others by the whole tokenizer. What is kept
    is bounded and held as Arrow text and lists of ids: as Python objects in a dictionary it took several times the memory.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [chr(c) for c in range(33, 256) if re.fullmatch("[!-/:-@\\[-~ß-öø-ÿ]", chr(c))]
        self.bytes_of = str.maketrans({c: alphabet.pre_tokenize_str(c)[0][0] for c in plain})
        self.joined = Tokenizer(self.model)
        self.joined.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix, names = self.model.end_of_word_suffix, self.tokenizer.get_vocab()
        self.is_last = np.zeros(max(names.values()) + 1, dtype=bool)
        self.is_last[[i for name, i in names.items() if suffix and name.endswith(suffix)]] = True
        self.pieces, self.words = Known(self._pieces), Known(self._words)

    def forget(self) -> None:
        """Drops the words that are kept, and their ids."""
        self.pieces.forget()
        self.words.forget()

    def _pieces(self, pieces: list[str]) -> pa.ListArray:
        line = " ".join(pieces).translate(self.bytes_of)
        ids = np.array(self.joined.encode_batch_fast([line], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.nonzero(self.is_last[ids])[0] + 1
        if len(ends) != len(pieces) or ends[-1] != len(ids):  # a vocabulary that does not mark the ends of words
            return _lists([[t.id for t in self.model.tokenize(p)] for p in line.split(" ")])
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))

    def _words(self, words: list[str]) -> pa.ListArray:
        return _lists([self.tokenizer.encode(w, add_special_tokens=False).ids for w in words])

    def _ids_of(self, words: pa.Array) -> pa.ListArray:
        """The ids of each of the distinct ``words``."""
        parts = pc.extract_regex(words, PLAIN)
        plain = pc.is_valid(parts)
        letters, marks = parts.filter(plain).flatten()
        n = len(letters)
        places = self.pieces.find(pa.concat_arrays([pc.utf8_lower(letters), marks]), CACHED_PIECES)
        pairs = self.pieces.ids.take(pa.array(places.reshape(2, n).T.ravel()))
        of_plain = pa.ListArray.from_arrays(pairs.offsets[::2], pairs.values)
        places = self.words.find(words.filter(pc.invert(plain)), CACHED_WORDS)
        of_others = self.words.ids.take(pa.array(places))
        plain = plain.to_numpy(zero_copy_only=False)
        return pa.concat_arrays([of_plain, of_others]).take(pa.array(np.where(plain, np.cumsum(plain) - 1, n + np.cumsum(~plain) - 1)))

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        ids = self._ids_of(coded.dictionary.cast(pa.string())).take(coded.indices)
        at = ids.offsets.to_numpy().astype(np.int64)[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return np.diff(at), ids.values.to_numpy()

    def encode(self, texts: pa.Array):
        """Yields (number of ids of each text, all ids) for consecutive slices of ``texts``; NULL is empty."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
        parts = (np.cumsum(sizes) - sizes) // SLICE_BYTES
        cuts = [0, *(np.nonzero(np.diff(parts))[0] + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield self._slice(texts.slice(a, b - a))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and tokenizer."""
    return Encoder(path)


def with_end(counts: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Appends ``end_id`` to the ids of each text; gives the new starts, with the end of the last, and ids."""
    starts = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.empty(starts[-1], dtype="<u4")
    last = np.zeros(len(out), dtype=bool)
    last[starts[1:] - 1] = True
    out[last], out[~last] = end_id, ids
    return starts, out
