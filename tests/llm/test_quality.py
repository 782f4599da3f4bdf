from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from fieldlens.llm import quality
from tests.llm import samples


def corpus(n=300):
    rule, rows = random.Random(2), []
    for i in range(n):
        words = rule.choices(samples.WORDS, k=rule.choice([30, 100]))
        good = i % 6 < 4
        if i % 6 == 4:
            words = [w + rule.choice(["***", "$$$", "&&&"]) for w in words]
        elif i % 6 == 5:
            words = [w for w in words[:8] for _ in range(12)]
        else:
            words = [w + "." if k % 9 == 8 else w for k, w in enumerate(words)]
        rows.append((i, " ".join(words), "en", "good" if good else "bad", 0))
    return rows


def test_scores_follow_what_the_labellers_see(spark):
    docs = samples.clashing(samples.frame(spark, corpus()))
    model = quality.fit(docs)
    found = {r.doc_id: r for r in quality.rate(docs, model).collect()}
    right = sum(found[d].keep == (source == "good") for d, _, _, source, _ in corpus())
    assert right >= 0.97 * len(corpus()) and all(0 <= r.score <= 1 for r in found.values())
    assert set(model.accuracy) == set(quality.LABELLERS)
    other = quality.rate(samples.frame(spark, corpus(30)), model).collect()
    assert all(found[r.doc_id].score == r.score for r in other)


def test_em_finds_a_labeller_that_is_often_wrong():
    rule = np.random.default_rng(4)
    truth = rule.random(4000) < 0.7
    rates = [0.95, 0.9, 0.9, 0.85, 0.6]
    votes = np.stack([np.where(rule.random(4000) < 0.3, 0, np.where(rule.random(4000) < a, 1, -1) * np.where(truth, 1, -1)) for a in rates], axis=1)
    pattern, counts = np.unique(votes, axis=0, return_counts=True)
    _, accuracy, share = quality.accuracies(pattern, counts)
    assert np.abs(accuracy - rates).max() < 0.06 and abs(share - 0.7) < 0.06


def test_odd_texts(spark):
    docs = samples.frame(spark, samples.rows(5))
    model = quality.fit(docs)
    found = quality.rate(samples.clashing(docs), model).collect()
    assert len(found) == docs.count()
    assert not any(r.keep for r in found if r.doc_id in (1, 2, 3))
    empty = quality.fit(samples.frame(spark, []))
    assert quality.rate(samples.frame(spark, []), empty).collect() == []
    assert {r.score for r in quality.rate(docs, empty).collect()} == {0.5}


def test_word_sums_count_words_and_repeats():
    sums = quality.WordSums(1, lambda w: [len(w)]).sums(pa.array(["", " a a  bb ", "bb bb bb"]))
    assert sums.tolist() == [[0, 0, 0], [4, 3, 1], [6, 3, 2]]


def test_word_features_are_those_of_each_character():
    import re
    import zlib

    for word in ("", "a", "Hello", "HELLO!!", "aa11--", "x²³", "ÄÖÜß", "ﬁn", "日本語", "A" * 600 + "b", "\x1cA"):
        shape = re.sub(r"(.)\1+", r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))
        wanted = [2 + zlib.crc32(x.encode()) % (quality.BUCKETS - 2) for x in ("w" + word.lower(), "s" + shape, "e" + word[-2:])]
        assert quality.word_features(word) == wanted
