from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm import simhash, similar
from tests.llm import samples


def shingles(text, words=5):
    split = text.split()
    return {tuple(split[i : i + words]) for i in range(max(1, len(split) - words + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def changed(rule, words, n, at=None):
    """``words`` with ``n`` changes far apart, each of which changes five shingles."""
    out = list(words)
    for k in range(n):
        out[10 * k + 5 if at is None else at + 10 * k] = f"w{rule.getrandbits(40)}"
    return out


def corpus():
    rule, texts = random.Random(5), []
    for k in range(40):  # pairs on either side of 0.8
        base = [f"p{k}x{rule.getrandbits(30)}" for _ in range(304)]
        texts += [" ".join(base), " ".join(changed(rule, base, [5, 6, 7, 8][k % 4]))]
    for n in (0, 1, 2):  # groups of a template with passages of their own: pairs at 0.6 or so
        base = [f"t{n}x{rule.getrandbits(30)}" for _ in range(204)]
        texts += [" ".join(changed(rule, base, 5, at=rule.randrange(5, 120))) for _ in range(30)]
    line = "one line that comes again and again in this text and in others"
    texts += [" ".join([*[line] * 60, *[f"own{k}x{i}" for i in range(200)]]) for k in range(6)]  # most of a text, few of its shingles
    return texts


def groups(texts, similarity=0.8):
    sets, group = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if group[i] != group[j] and jaccard(sets[i], sets[j]) >= similarity:
                group = [group[j] if g == group[i] else g for g in group]
    return group


@pytest.mark.parametrize("tile", [7, 4096])
def test_groups_equal_those_of_all_pairs(spark, tile):
    texts = corpus()
    rows = [(k, t, "en", "a", 0) for k, t in enumerate(texts)]
    kept = {r.doc_id for r in simhash.one_per_group(samples.frame(spark, rows), tile=tile).collect()}
    group = groups(texts)
    assert kept == {min(k for k, g in enumerate(group) if g == h) for h in set(group)}
    assert len(texts) - len(kept) == 20


def kept_of(spark, texts, **options):
    rows = [(k, t, "en", "a", 0) for k, t in enumerate(texts)]
    return {r.doc_id for r in simhash.one_per_group(samples.frame(spark, rows), **options).collect()}


@pytest.mark.parametrize("tile", [7, 4096])
def test_groups_of_copies_that_one_star_does_not_settle(spark, monkeypatch, tile):
    """Copies of one text, each with changes of its own: about half of the pairs are similar, and chains connect them."""
    monkeypatch.setattr(similar, "FAN", 3)
    rule = random.Random(8)
    base = [f"b{rule.getrandbits(30)}" for _ in range(404)]
    texts = [" ".join(changed(rule, base, n, at=rule.randrange(5, 300))) for n in rule.choices((3, 4, 5, 6), k=60)]
    sets = [shingles(t) for t in texts]
    assert 0.1 < np.mean([jaccard(a, b) >= 0.8 for a in sets for b in sets]) < 0.99
    group = groups(texts)
    assert kept_of(spark, texts, tile=tile) == {min(k for k, g in enumerate(group) if g == h) for h in set(group)}


def test_sketches_of_similar_sets_agree():
    rule, limit = np.random.default_rng(3), similar.agreement(0.8)
    assert 110 < limit < 140
    for size in (4, 9, 40, 400):
        for _ in range(250):
            own = rule.integers(0, 1 << 63, size + size // 4, dtype=np.uint64)
            a, b = (np.frombuffer(similar.sketch(similar.least_hashes(s)), np.uint8) for s in (own, own[: size]))
            assert len(a) == similar.BANDS * similar.DEPTH and np.count_nonzero(a == b) >= limit


def test_a_passage_of_many_texts_sends_no_sets(spark, monkeypatch):
    """Texts that share half of their words have keys in common; copies are found among them, and only copies travel whole."""
    counts, write = {}, similar.stage

    def counted(df, name):
        out = write(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(similar, "stage", counted)
    rule = random.Random(9)
    passage = [f"p{rule.getrandbits(30)}" for _ in range(250)]
    texts = [" ".join([*passage, *[f"o{rule.getrandbits(30)}" for _ in range(120)]]) for _ in range(400)]
    texts += [t + " and more" for t in texts[:3]]
    assert kept_of(spark, texts) == set(range(400))
    assert counts["members"] > 1000 and counts["sets"] <= 12 and counts["open"] <= 12 * similar.BANDS


def test_empty_missing_and_repeated_texts(spark):
    assert kept_of(spark, []) == set()
    assert kept_of(spark, [None, "", " ", "one", "one", "one two"]) == {0, 3, 5}
    docs = samples.frame(spark, [(None, "a b c d e f", "en", "a", 0), (4, "a b c d e f", "en", "a", 0), (4, "a b c d e f", "en", "a", 0)])
    assert [r.doc_id for r in simhash.one_per_group(docs.withColumn("row", F.lit(1)).withColumn("sketch", F.lit("x"))).collect()] == [4]
