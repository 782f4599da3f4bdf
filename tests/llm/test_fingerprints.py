from __future__ import annotations

import hashlib
import random
import struct

import xxhash
from pyspark.sql import functions as F

from fieldlens.llm import fingerprints
from tests.llm import samples


def shingles(text):
    w = text.encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def hashed(*values):
    """XXH64 chained over bytes, 64-bit numbers (as int) and 32-bit numbers (as a tuple of one), as signed number."""
    h = 42
    for v in values:
        raw = v if isinstance(v, bytes) else struct.pack("<i", *v) if isinstance(v, tuple) else struct.pack("<q", v)
        h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def plain_fingerprint(text):
    """Bins as a table; an empty bin asks 16 hashed places, then the filled one that its own order puts first."""
    words = [hashed(w) for w in text.encode().split()]
    if not words:
        return ""
    size, bins = min(5, len(words)), {}
    for i in range(len(words) - size + 1):
        h = hashed(*words[i : i + size])
        place = (h >> 56) + 128
        bins[place] = min(h, bins.get(place, h))
    rule = random.Random(42)
    probes = [(rule.randrange(1, fingerprints.PRIME), rule.randrange(fingerprints.PRIME)) for _ in range(16)]
    digits = []
    for p in range(256):
        value = bins.get(p)
        if value is None:
            asked = [q for a, b in probes if (q := (p * a + b) % fingerprints.PRIME % 256) in bins]
            giver = asked[0] if asked else min(bins, key=lambda q: hashed((p,), (q,)))
            value = hashed(bins[giver], (p,))
        digits.append(f"{value & 15:x}")
    return "".join(digits)


def test_fingerprints_equal_plain_ones(spark):
    texts = {r[1] or "" for r in samples.rows(60)}
    found = spark.createDataFrame([(t,) for t in texts], "text string").select("text", fingerprints.in_hex(fingerprints.fingerprint(F.col("text"))).alias("made"))
    assert {r.text: r.made for r in found.collect()} == {t: plain_fingerprint(t) for t in texts}


def test_texts_and_estimates(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CHUNK_BYTES", 20_000)  # several chunks
    rows = [r for r in samples.rows()]
    found = fingerprints.fingerprints(samples.clashing(samples.frame(spark, rows)))
    by_hash = {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    wanted = []
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        wanted.append((str(r[0]), len(text), hashlib.sha256(edited.encode()).hexdigest()))
        by_hash[wanted[-1]] = (jaccard(shingles(text), shingles(edited)), jaccard(shingles(text), shingles(after)), text)
    got = found.collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(wanted)
    prints, errors = {}, []
    for r in got:
        near_edited, near_next, text = by_hash[(str(r.doc_id), r.n_chars, r.edited_sha256)]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == "") == (not text.split()) and len(r.fingerprint) in (0, 256)
        errors += [r.near_edited - near_edited, r.near_next - near_next]
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.2


def test_one_row_is_its_own_next(spark):
    one = fingerprints.fingerprints(samples.frame(spark, [(5, "a b c d e f", "en", "a", 11)])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"a b c a b c").hexdigest()
    assert fingerprints.fingerprints(samples.frame(spark, [])).collect() == []


def test_plan_is_native(spark):
    plan = fingerprints.fingerprints(samples.frame(spark, samples.rows(5)).where(F.lit(True)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
