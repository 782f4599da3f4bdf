from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from fieldlens.llm import mixing
from tests.llm import samples


def plain_targets(sizes, share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target, active = share * sum(sizes.values()), {}, set(order)
    while active:
        total = sum(weight[s] for s in active)
        over = {s for s in active if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in active})
            break
        target.update({s: float(2 * sizes[s]) for s in over})
        left -= sum(2 * sizes[s] for s in over)
        active -= over
    return target


def test_targets_and_words_taken(spark):
    rows = samples.rows()
    found = mixing.taken(samples.clashing(samples.frame(spark, rows))).collect()
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    targets = plain_targets(sizes)
    by_source = defaultdict(int)
    sources = defaultdict(list)
    for d, text, _, source, _ in rows:
        sources[(d, len((text or "").split()))].append(source)
    assert len(found) == len(rows)
    for r in found:
        source = sources[(r.doc_id, r.size)][0]
        assert r.source_size == sizes[source] and r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 2 * r.size
        by_source[source] += r.taken
    for source, words in by_source.items():
        assert abs(words - targets[source]) <= 1


def plain_mix(rows):
    """Times that each row is taken, from the queues that ``taken`` orders: in order of turn and shuffle, whole if it still fits."""
    size = lambda r: len((r[1] or "").split())
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r)
    left = {s: int(t) for s, t in plain_targets(sizes).items()}
    shuffled = lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:1".encode()).hexdigest()
    words, rest = Counter(), defaultdict(list)
    for source in sizes:
        queue = sorted((r for r in rows if r[3] == source and size(r)), key=shuffled) * 2
        for place, r in enumerate(queue):
            if size(r) > left[source]:
                rest[source] = queue[place:]
                break
            left[source] -= size(r)
            words[source] += size(r)
    return words, left, rest, size


def words_of(rows, size):
    out = Counter()
    for r in rows:
        out[r[3]] += size(r)
    return out


def giant_rows():
    rule = random.Random(4)
    rows = [(i, " ".join(["w"] * rule.randint(1, 60)), "en", f"s{i % 3}", 0) for i in range(1, 90)]
    return rows + [(1000 + i, " ".join(["g"] * 5000), "en", "giants" if i else "s1", 0) for i in range(3)] + [(2000 + i, "a b c", "en", "giants", 0) for i in range(7)]


def test_reruns_agree_and_mix_repeats_whole_documents(spark):
    docs = samples.clashing(samples.frame(spark, samples.rows()))
    once = mixing.mix(docs)
    assert once.columns == docs.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))


@pytest.mark.parametrize("rows", [giant_rows(), samples.rows()])
def test_words_left_go_to_later_documents_that_fit(spark, rows):
    got = mixing.mix(samples.frame(spark, rows)).collect()
    words, left, rest, size = plain_mix(rows)
    taken, counts = Counter(), Counter()
    for r in got:
        taken[r.source] += size((r.doc_id, r.text))
        counts[(r.doc_id, r.text, r.source)] += 1
    copies = Counter((r[0], r[1], r[3]) for r in rows)
    assert all(n <= 2 * copies[k] for k, n in counts.items())
    for source, budget in left.items():
        assert words[source] <= taken[source] <= words[source] + budget
        over = words[source] + budget - taken[source]
        never = [size(r) for r in rest[source] if counts[(r[0], r[1], r[3])] < 2 * copies[(r[0], r[1], r[3])]]
        assert not never or over < min(never) or over <= mixing.NEAR * plain_targets(words_of(rows, size))[source]


def test_a_source_whose_documents_are_mostly_too_long_stays(spark):
    got = Counter(r.doc_id for r in mixing.mix(samples.frame(spark, giant_rows())).collect())
    assert any(d >= 2000 for d in got) and sum(n for d, n in got.items() if 1 <= d < 1000)


def test_empty_table(spark):
    assert mixing.taken(samples.frame(spark, [])).collect() == []
    assert mixing.mix(samples.frame(spark, [(1, None, None, None, None)])).collect() == []
