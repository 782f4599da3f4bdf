from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldlens.llm import simhash, similar
from fieldlens.llm.components import components
from tests.llm import samples


def plain_print(text, words=4):
    split = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(split[i : i + words]), 42) for i in range(max(1, len(split) - words + 1))] if split else []
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def classes(prints, bits):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                parent[find(a)] = find(b)
    return [find(a) for a in range(len(prints))]


def test_near_duplicates_equal_a_plain_version(spark):
    rows = samples.rows()
    found = simhash.near_duplicates(samples.clashing(samples.frame(spark, rows))).collect()
    prints = [plain_print(r[1]) for r in rows]
    group = classes(prints, 4)
    least = {g: min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None) for g in set(group)}
    wanted = sorted((str(r[0]), f"{p:016x}", str(least[g])) for r, p, g in zip(rows, prints, group, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == wanted


@pytest.mark.parametrize("tile", [3, 4096])
@pytest.mark.parametrize("lanes", [1, 2])
def test_links_connect_what_close_pairs_connect(spark, tile, lanes):
    rule = random.Random(tile + lanes)
    width, bits = 64 * lanes, 4 * lanes
    centres = [rule.getrandbits(width) for _ in range(6)]
    prints = list({c ^ sum(1 << b for b in rule.sample(range(width), rule.choice([0, 2, 4, 5]))) for c in centres for _ in range(12)})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    values = [tuple(signed((p >> (64 * k)) & ((1 << 64) - 1)) for k in range(lanes)) for p in prints]
    table = spark.createDataFrame(values, ", ".join(f"f{k} long" for k in range(lanes)))
    links = simhash.links(table, [f"f{k}" for k in range(lanes)], bits, 4, tile).collect()
    place = {v: i for i, v in enumerate(values)}
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for r in links:
        a, b = place[tuple(r)[:lanes]], place[tuple(r)[lanes:]]
        assert (prints[a] ^ prints[b]).bit_count() <= bits
        group[find(a)] = find(b)
    close = classes(prints, bits)
    assert len({(find(i), close[i]) for i in range(len(prints))}) == len(set(close)) == len({find(i) for i in range(len(prints))})


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    found = components(spark.createDataFrame([*chain, *star, (200, 200)], "a long, b long")).collect()
    roots = {r.value: r.root for r in found}
    assert len({roots[i] for i in range(41)}) == 1 and len({roots[i] for i in range(100, 130)}) == 1 and roots[0] != roots[100]
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_per_group(spark):
    base = " ".join(random.Random(1).choices(samples.WORDS, k=200))
    near = base.replace(base.split()[100], "changed", 1)
    rows = [(7, near, "en", "a", 0), (3, base, "en", "a", 0), (9, "quite another text of its own with many different words in it", "en", "a", 0), (3, base, "en", "a", 0), (None, None, None, None, None), (None, "", None, None, None)]
    docs = samples.clashing(samples.frame(spark, rows))
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "9", "None"]
    assert simhash.one_per_group(docs.where(F.lit(False))).collect() == []


def test_distance_for_a_similarity():
    assert simhash.distance_for(0.8, 64) == 9 and simhash.distance_for(1.0, 64) == 0
    h = simhash.hashes(b"a b c d e", 4)
    assert h.tolist() == [xxhash.xxh64_intdigest(b"a b c d", 42), xxhash.xxh64_intdigest(b"b c d e", 42)]
    assert simhash.majority(np.zeros(0, dtype=np.uint64)) == 0


def test_near_copies_of_the_pipeline_are_found_by_simhash(spark, monkeypatch):
    """Links of the SimHashes of shingle sets decide which sets are compared first, and whole sets whether they are linked."""
    rule = np.random.default_rng(7)
    base = [f"w{x}" for x in rule.integers(0, 1 << 40, 2000)]
    texts = [" ".join(base), " ".join([*base[:-1], "end"]), " ".join(["begin", *base[1:]]), " ".join(f"v{x}" for x in rule.integers(0, 1 << 40, 300)), "", None]
    prints = [simhash.majority(np.unique(simhash.hashes((t or "").encode(), 5))) for t in texts]
    assert max((prints[0] ^ p).bit_count() for p in prints[1:3]) <= simhash.BITS < (prints[0] ^ prints[3]).bit_count()
    seen, search = [], similar.links

    def watched(rows, classes, near, *others):
        seen.extend(map(tuple, near.collect()))
        return search(rows, classes, near, *others)

    monkeypatch.setattr(similar, "links", watched)
    docs = samples.frame(spark, [(k, t, "en", "a", 0) for k, t in enumerate(texts)])
    assert {r.doc_id for r in simhash.one_per_group(docs).collect()} == {0, 3, 4}
    assert len(seen) == 2 and len({center for _, center in seen}) == 1


def test_a_simhash_link_is_verified_by_whole_sets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "majority", lambda h: 0)  # all fingerprints agree
    texts = [f"a{k} b{k} c{k} d{k} e{k} f{k}" for k in range(5)]
    docs = samples.frame(spark, [(k, t, "en", "a", 0) for k, t in enumerate([*texts, texts[0]])])
    assert {r.doc_id for r in simhash.one_per_group(docs).collect()} == set(range(5))
