from __future__ import annotations

import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from fieldlens.llm import language
from fieldlens.llm.tokens import vocabulary_file
from tests.llm import samples

VOCABULARY = vocabulary_file("piece_bpe_32k.model")
SPEECH = {"aa": ["kalo", "mira", "tenu", "salo"], "bb": ["strong", "ghost", "winter", "sharp"], "cc": ["øvre", "ångst", "fjäll", "blå"]}


def corpus(n=90):
    rule = random.Random(5)
    return [(i, " ".join(rule.choices(SPEECH[lang], k=rule.choice([3, 20]))), lang, "s", 0) for i in range(n) for lang in [rule.choice(list(SPEECH))]]


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(samples.clashing(samples.frame(spark, corpus())))


def test_forward_sums_all_segmentations():
    automaton, lengths = language._vocabulary(VOCABULARY)
    rule = np.random.default_rng(1)
    prob = rule.random((len(lengths) + 1, 2)) / 10
    run = language.START + "thes"

    def value(piece, k):
        if piece in automaton:
            return prob[automaton.get(piece), k]
        return prob[-1, k] if len(piece) == 1 else 0.0

    for k in range(2):
        total = 0.0
        for cuts in product([0, 1], repeat=len(run) - 1):
            edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(run)]
            total += np.prod([value(run[a:b], k) for a, b in zip(edges, edges[1:], strict=False)])
        assert language.likelihoods([run, "a"], prob, VOCABULARY)[0, k] == pytest.approx(np.log(total))
    weight = np.array([[2.0, 0.0], [1.0, 3.0]])
    used = language.expected([run, "ab"], weight, prob, VOCABULARY)
    size = np.append(lengths, 1)
    assert (used * size[:, None]).sum(axis=0) == pytest.approx([2 * 5 + 2, 3 * 2])  # expected pieces cover every character


def test_long_runs_sum_all_segmentations_too():
    automaton, lengths = language._vocabulary(VOCABULARY)
    rule = np.random.default_rng(2)
    prob = rule.random((len(lengths) + 1, 2)) / 10 + 1e-6
    alphabet = "thesandingor日ü"
    runs = [language.START + "".join(rule.choice(list(alphabet), size=n)) for n in (5, 31, 32, 100, 33, 700)]
    found = language.likelihoods(runs, prob, VOCABULARY)
    for i, run in enumerate(runs):
        for k in range(2):
            logs = [0.0] + [-np.inf] * len(run)
            for end in range(1, len(run) + 1):
                for size in range(1, min(end, language.RUN) + 1):
                    piece = run[end - size : end]
                    p = prob[automaton.get(piece), k] if piece in automaton else prob[-1, k] if size == 1 else 0.0
                    if p:
                        logs[end] = np.logaddexp(logs[end], logs[end - size] + np.log(p))
            assert found[i, k] == pytest.approx(logs[-1], rel=1e-9)
    weight = rule.random((len(runs), 2))
    used = language.expected(runs, weight, prob, VOCABULARY)
    size = np.append(lengths, 1)
    assert (used * size[:, None]).sum(axis=0) == pytest.approx((weight * np.array([[len(r)] for r in runs])).sum(axis=0))
    alone = sum(language.expected([r], weight[i : i + 1], prob, VOCABULARY) for i, r in enumerate(runs))
    assert used == pytest.approx(alone)
    # A run is not scored as its parts: a piece across the 32nd character counts.
    assert found[3, 0] > language.likelihoods([runs[3][:32]], prob, VOCABULARY)[0, 0] + language.likelihoods([runs[3][32:]], prob, VOCABULARY)[0, 0]


@pytest.mark.parametrize("text", ["½ ²", "ⅷ", "③ 12 ½kg"[:6], "١٢٣", "_ -", "😀"])
def test_texts_without_a_letter_have_no_language(spark, model, text):
    import unicodedata

    assert not any(unicodedata.category(c).startswith("L") for c in text)
    row = language.identify(samples.frame(spark, [(1, text, None, None, 0)]), model).first()
    assert (row.lang_pred, row.score) == (language.UNKNOWN, 0.0)


def test_held_out_accuracy(spark, model):
    found = language.identify(samples.clashing(samples.frame(spark, corpus())), model).collect()
    truth = {r[0]: r[2] for r in corpus()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert held and all(r.lang_pred == truth[r.doc_id] and 0.5 < r.score <= 1 for r in held)


def test_odd_texts(spark, model):
    found = language.identify(samples.clashing(samples.frame(spark, samples.rows(3))), model).collect()
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 8))
    assert all(by_id[i].lang_pred in SPEECH and 0 <= by_id[i].score <= 1 for i in (4, 6, 7, 9))
    assert language.identify(samples.frame(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    none = language.fit(samples.frame(spark, []))
    assert {r.lang_pred for r in language.identify(samples.frame(spark, samples.rows(3)), none).collect()} == {"und"}
    assert language.accepted(samples.frame(spark, samples.rows(3)), none).collect() == []


def test_accepted_keeps_rows_whole(spark, model):
    docs = samples.clashing(samples.frame(spark, corpus() + [(500, "123", "aa", "s", 3), (501, None, None, None, None)]))
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(corpus())


def test_long_batches_are_cut(model):
    texts = pa.array(["kalo mira " * 50_000, None, "strong ghost", "x" * 300_000])
    names, scores = language.Scorer(model).predict(texts)
    assert names.to_pylist()[:3] == ["aa", "und", "bb"] and len(scores) == 4
