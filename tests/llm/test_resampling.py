"""CRC table against zlib; weights, scores and ranks against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from fieldlens.llm import resampling
from fieldlens.llm.crc import BLOCK, crc32
from tests.llm.samples import clashing, frame, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def plain(data, target, most=1, buckets=10_000, percent=10, least=20, seed=2024):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, t in data for f in runs(t, most)[1])
    t = Counter(place(f) for x in target for f in runs(x, most)[1])
    n_s, n_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * n_s / ((s[b] + 1.0) * n_t)))
    out = []
    for doc_id, text in data:
        words, found = runs(text, most)
        weight = sum(gain(place(f)) for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(fit[: len(fit) * percent // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in out]


def test_crc_of_spans_of_every_length():
    data = np.frombuffer(random.Random(1).randbytes(20_000), dtype=np.uint8)
    sizes = np.array([*range(1, 4 * BLOCK + 3), 1000, 9_999, 19_000])
    starts = np.array([i * 37 % (20_000 - n + 1) for i, n in enumerate(sizes.tolist())])  # they overlap
    wanted = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
    assert crc32(data, starts, starts + sizes).tolist() == wanted
    assert crc32(data, starts[:0], sizes[:0]).tolist() == []


def test_rows_against_plain_python(spark):
    data = [(r[0], r[1]) for r in rows(200)]
    target = ["the of and to", None, "", "before through years " * 9, "Straße 😀 12"]
    docs, wished = frame(spark, [(d, t, "en", "s", 0) for d, t in data]), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    for most in (1, 3):
        out = resampling.resample(clashing(docs), wished, most=most)
        assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in out.dtypes} == {"bigint"}
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, plain(data, target, most)))
    drawn = resampling.sample(clashing(docs), wished)
    assert drawn.columns == clashing(docs).columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r[0] for r in plain(data, target) if r[4])


def test_ties_and_repeated_rows(spark):
    text = "one two three " * 10
    data = [(7, text)] * 30 + [(None, text)] * 3
    out = resampling.resample(frame(spark, [(d, t, "en", "s", 0) for d, t in data]), frame(spark, []))
    found = out.collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3]
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in found) == Counter(x[:4] for x in plain(data, []))


def test_empty_table(spark):
    assert resampling.resample(frame(spark, []), frame(spark, rows(5))).collect() == []
