"""Shares, distances and leading terms against plain Python, and the plan."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from fieldlens.llm import divergence
from tests.llm.samples import clashing, frame, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(data, least_docs, smoothing=5, top=50):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in data]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= least_docs)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}

        counts = {s: Counter(t for d in own if d[1] == s for t in d[2]) for s in {d[1] for d in own}}
        p, q = {s: shares(c) for s, c in counts.items()}, shares(Counter(t for d in own for t in d[2]))
        for s in counts:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def made(n=300):
    rule = random.Random(4)
    words = ["Alpha", "beta", "über", "ÜBER", "gamma", "naïve", "x", "日本", "a:b", "re-do", "42"]
    data = [(" ".join(rule.choices(words, weights=range(1, 12), k=rule.randint(0, 25))), rule.choice(["en", "de", None, "d:e"]), rule.choice(["s1", "s2", "", None, "S:3"])) for _ in range(n)]
    return data + [(None, "en", "none"), ("", "fr", "only"), ("alpha beta", "it", "one"), ("", "it", "two")]


@pytest.mark.parametrize("least_docs", [1, 5, 60])
@pytest.mark.parametrize("block", [(1, 1), (7, 2), (1 << 21, 256)])
def test_rows_against_plain_python(spark, least_docs, block):
    data = made()
    docs = frame(spark, [(i, t, lang, source, 0) for i, (t, lang, source) in enumerate(data)])
    out = divergence.audit(clashing(docs).withColumns({"terms": divergence.F.lit(1), "vector": divergence.F.lit(2)}), least_docs=least_docs, cells=block[0], block_terms=block[1], top=4)
    assert dict(out.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert sorted(map(tuple, out.collect())) == plain(data, least_docs, top=4)


def test_odd_rows(spark):
    odd = rows(90)
    out = divergence.audit(frame(spark, odd), least_docs=3)
    assert sorted(map(tuple, out.collect())) == plain([(r[1], r[2], r[3]) for r in odd], 3)


def test_no_documents_and_no_terms(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    nothing = frame(spark, [(1, None, "en", "a", 0), (2, "12 ...", "en", "b", 0)])
    assert sorted(map(tuple, divergence.audit(nothing).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_sums_stay_exact_beyond_64_bits(spark):
    big = spark.range(1).select(divergence._share(divergence.F.lit(9 * 10**17), divergence.F.lit(9 * 10**17 + 10), divergence.F.lit(3), 5).alias("p"))
    assert big.first().p == 1 + 10**9 * (9 * 10**17 + 5) // (9 * 10**17 + 10 + 15)
