"""What a Python worker needs while it works on many different words, and what it keeps when a task is over."""

from __future__ import annotations

import random
import tracemalloc
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pytest

from fieldlens.llm import language, packing, tokens
from fieldlens.llm.tokens import vocabulary_file

VOCABULARY = vocabulary_file("piece_bpe_32k.model")


def different_words(n: int) -> pa.Array:
    rule = random.Random(11)
    return pa.array([" ".join("".join(rule.choices("abcdeilmnorstu", k=9)) + "," * (i % 2) for i in range(500)) for _ in range(n // 500)])


@contextmanager
def traced():
    """The MB that Python objects and Arrow took at most, and what they still take at the end."""
    found, arrow = [], pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        yield found
        left, most = tracemalloc.get_traced_memory()
        found += [(most + pa.total_allocated_bytes() - arrow) / 1e6, (left + pa.total_allocated_bytes() - arrow) / 1e6]
    finally:
        tracemalloc.stop()


@pytest.fixture(scope="module")
def model():
    pieces = len(language._vocabulary(VOCABULARY)[1])
    prob = np.random.default_rng(4).random((pieces + 1, 4))
    return language.Model(list("abcd"), prob / prob.sum(axis=0), VOCABULARY)


def test_scoring_different_words_takes_little_memory(model):
    texts = different_words(80_000)
    scorer = language.Scorer(model)
    scorer.predict(texts[:1])
    with traced() as mb:
        scorer.predict(texts)
    assert mb[0] < 30


def test_encoding_different_words_takes_little_memory():
    texts = different_words(80_000)
    encoder = tokens.Encoder(vocabulary_file())
    with traced() as mb:
        for _ in encoder.encode(texts):
            pass
    assert mb[0] < 20


def test_packing_leaves_no_words_in_its_worker():
    path = vocabulary_file()
    tokens.encoder(path)
    texts = different_words(20_000)
    batch = pa.record_batch([pa.array(range(len(texts))), texts], names=["doc_id", "text"])
    with traced() as mb:
        for _ in packing._cut(iter([batch]), path, 0, 2048):
            pass
    assert mb[1] < 1


def test_words_that_are_dropped_are_found_again(model, monkeypatch):
    texts = pa.concat_arrays([different_words(3000), pa.array([None, "", " ,, ", "Straße ½ ab"]), different_words(3000)])
    names, scores = language.Scorer(model).predict(texts)
    ids = [(c.tolist(), i.tolist()) for c, i in tokens.Encoder(vocabulary_file()).encode(texts)]
    for module, most in ((language, "CACHED"), (tokens, "CACHED_WORDS")):
        monkeypatch.setattr(module, most, 1500)
        monkeypatch.setattr(module, "BLOCK", 100)
        monkeypatch.setattr(module, "SLICE_BYTES", 7000)
    monkeypatch.setattr(tokens, "CACHED_PIECES", 50)
    again = language.Scorer(model).predict(texts)
    assert again[0] == names and (again[1] == scores).all()
    parts = [(c.tolist(), i.tolist()) for c, i in tokens.Encoder(vocabulary_file()).encode(texts)]
    assert len(parts) > 5
    assert (sum((c for c, _ in parts), []), sum((i for _, i in parts), [])) == (sum((c for c, _ in ids), []), sum((i for _, i in ids), []))
