"""How often the tokenizer is asked, and that the ids stay those of the library when few words are kept."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from fieldlens.llm import simple8b, tokens
from fieldlens.llm.tokens import Encoder, vocabulary_file


@pytest.fixture
def asked(monkeypatch):
    """An encoder, and the pieces and whole words that its tokenizer was asked for."""
    found: list[str] = []
    for name in ("_pieces", "_words"):
        def counted(self, texts, run=getattr(Encoder, name)):
            found.extend(texts)
            return run(self, texts)

        monkeypatch.setattr(Encoder, name, counted)
    return Encoder(vocabulary_file()), found


def ids(encoder, texts):
    parts = list(encoder.encode(pa.array(texts, pa.string())))
    return [c for p, _ in parts for c in p.tolist()], [i for _, p in parts for i in p.tolist()]


def wanted(encoder, texts):
    found = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    return [len(f) for f in found], [i for f in found for i in f]


def test_letters_are_encoded_once_whatever_their_case_and_marks(asked):
    encoder, found = asked
    words = ["straße", "marks", "été"]
    texts = [" ".join(w + m for w in (x, x.title(), x.capitalize()) for m in ("", ".", ",", "!!")) for x in words]
    assert ids(encoder, texts) == wanted(encoder, texts)
    assert sorted(found) == sorted([*words, ".", ",", "!!"])


def test_words_that_come_again_stay_when_others_are_dropped(asked, monkeypatch):
    encoder, found = asked
    monkeypatch.setattr(tokens, "SLICE_BYTES", 1000)
    monkeypatch.setattr(tokens, "CACHED_PIECES", 200)
    monkeypatch.setattr(tokens, "CACHED_WORDS", 200)
    rule = random.Random(3)
    often, seldom = ["common", "frequent", "usual", "12.5", "it's"], lambda: "".join(rule.choices("aeinrst", k=12))
    texts = [" ".join([*often, *(seldom() for _ in range(30)), *often]) for _ in range(200)]
    assert ids(encoder, texts) == wanted(encoder, texts)
    assert all(found.count(w) == 1 for w in often)
    assert len(encoder.pieces.texts) < 400


@pytest.mark.parametrize("most", [0, 1, 7, 10**6])
def test_odd_words_with_few_kept(monkeypatch, most):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 300)
    monkeypatch.setattr(tokens, "BLOCK", 5)
    monkeypatch.setattr(tokens, "CACHED_PIECES", most)
    monkeypatch.setattr(tokens, "CACHED_WORDS", most)
    rule, encoder = random.Random(9), Encoder(vocabulary_file())
    letters = "aabcdeéÀÖ×ß÷ÿµªKİıſΩжé中'’.,-|<>/_0 9 \u0085\x1c\x00\n\t w"
    texts = ["".join(rule.choices(letters, k=rule.randrange(60))) for _ in range(1500)]
    texts += [None, "", " ", "<|endoftext|> a<|startoftext|>", "</w> w</w>x", "'s 'S's ''", "x" * 5000, "|" * 5000]
    assert ids(encoder, texts) == wanted(encoder, texts)


def test_a_vocabulary_that_does_not_mark_the_ends_of_words():
    encoder = Encoder(vocabulary_file())
    texts = ["some words, and others. Straße", "words again"]
    right = ids(encoder, texts)
    encoder.forget()
    encoder.is_last[:] = False
    assert ids(encoder, texts) == right


def test_selectors_are_the_first_that_fit():
    rule = np.random.default_rng(8)
    for _ in range(200):
        n, block = int(rule.integers(1, 150)), int(rule.choice([1, 7, 64, 4096]))
        values = rule.integers(0, 1 << 62, n, dtype=np.uint64) >> rule.integers(0, 62, n, dtype=np.uint64)
        found = simple8b._selectors(values, block)
        for i in range(n):
            room = min(block - i % block, n - i)
            fits = [s for s, (k, bits) in enumerate(simple8b.PACKINGS, 1) if k <= room and all(int(v) < 1 << bits for v in values[i : i + k])]
            assert found[i] == (fits[0] if fits else 0)
