from __future__ import annotations

import zlib
from collections import Counter

import pytest

from fieldlens.llm import sharding
from tests.llm import samples


def least_capacity(sizes, shards):
    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("points", [3, 40, 50_000])
def test_cuts_are_minimax(spark, points):
    import random

    rule = random.Random(points)
    sizes = [rule.choice([1, 2, 5, 30, 200]) for _ in range(150)]
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append((total,))
    capacity, cuts = sharding.minimax_cuts(spark.createDataFrame(ends, "end long"), total, max(sizes), 7, points)
    assert capacity == least_capacity(sizes, 7)
    edges = [0, *cuts]
    assert edges[-1] == total and all(b - a <= capacity for a, b in zip(edges, edges[1:], strict=False))
    assert {c for c in cuts} <= {e[0] for e in ends}


def test_shards(spark):
    rows = samples.rows()
    found = sharding.shard(samples.clashing(samples.frame(spark, rows))).collect()
    assert len(found) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert len({(r.text_crc32, r.shard) for r in found}) == len({r.text_crc32 for r in found})
    for s in range(16):
        slots = sorted(r.slot for r in found if r.shard == s)
        assert slots == list(range(len(slots)))
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(t or "", [[], 0])
        groups[t or ""][0].append(d)
        groups[t or ""][1] += len((t or "").encode()) + 1
    order = sorted(groups.values(), key=lambda g: min([x for x in g[0] if x is not None], default=-1))
    largest = max(Counter({s: sum(r.size for r in found if r.shard == s) for s in range(16)}).values())
    assert largest == least_capacity([g[1] for g in order], 16)


def test_empty_table(spark):
    assert sharding.shard(samples.frame(spark, [])).collect() == []
