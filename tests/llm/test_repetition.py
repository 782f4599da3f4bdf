"""Repeats by suffix array against all pairs of places; base counts against plain Python; odd texts."""

from __future__ import annotations

import random

import pyarrow as pa

from fieldlens.llm import repetition
from fieldlens.llm.repetition import MEASURES, measures
from tests.llm.samples import clashing, frame, rows, texts

SPACE = " \t\n\r\x0b\x0c"


def common(words, i, j):
    k = 0
    while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
        k += 1
    return k


def split(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain(text, least):
    words = split(text or "")
    n = len(words)
    at = [max((common(words, i, j) for j in range(n) if j != i), default=0) for i in range(n)]
    covered = {i + d for i in range(n) if at[i] >= least for d in range(at[i])}
    again = {i + d for i in range(n) if at[i] >= 3 for d in range(3)}
    places: dict[tuple, list[int]] = {}
    for i in range(n):
        for size in range(least, at[i] + 1):
            places.setdefault(tuple(words[i : i + size]), []).append(i)
    maximal = 0
    for part, found in places.items():
        left = {words[i - 1] if i else -1 for i in found}
        right = {words[i + len(part)] if i + len(part) < n else -1 for i in found}
        maximal += len(found) > 1 and len(left) > 1 and len(right) > 1
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    return [n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again), maximal, len(covered), max(at, default=0)]


def found(some, least):
    columns = measures(pa.array(some, pa.string()), least)
    return [list(row) for row in zip(*[c.tolist() for c in columns], strict=True)]


def test_small_alphabets_against_all_pairs():
    rule = random.Random(5)
    some = [rule.choice([" ", "\n", " \t"]).join(rule.choices("abc"[: rule.randint(1, 3)], k=rule.randint(0, 45))) for _ in range(150)]
    for least in (1, 3, 5):
        assert found(some, least) == [plain(t, least) for t in some]


def test_texts_do_not_see_each_other():
    one = "a b c d e f g h i j k"
    assert found([one, one, one + " " + one], 3) == [plain(one, 3), plain(one, 3), plain(one + " " + one, 3)]
    assert found([one, one], 3)[0][5:] == [0, 0, 0]


def test_intervals_are_maximal_on_both_sides():
    # "x b c d" never ends in d twice with the same left side, so "b c d" is maximal and "c d" is not.
    words = "a b c d z b c d y".split()
    codes, owner = repetition._words(pa.array([" ".join(words)]))
    order = repetition.suffixes(codes, owner)
    spans = [(sorted(order.order[a : b + 1].tolist()), size) for a, b, size in repetition.intervals(order, codes, owner, 2)]
    assert spans == [([1, 5], 3)]


def test_long_texts():
    many = found(["spam " * 70_000], repetition.LEAST)[0]
    assert many[0] == 70_000 and many[4] == many[6] == 70_000 and many[7] == 69_999 and many[5] == 69_990
    rule = random.Random(2)
    words = [str(rule.randrange(10**6)) for _ in range(60_000)]
    passage = words[100:400]
    row = found([" ".join(words[:50_000] + passage + words[50_000:])], 10)[0]
    assert row[7] >= 300 and row[6] >= 600 and row[5] >= 1


def test_rows_and_verdict(spark):
    data = [(r[0], r[1]) for r in rows(60) if r[0] != 9]
    repeated = " ".join(f"w{i}" for i in range(60))
    odd = [(500, repeated + "\n" + " ".join(f"v{i}" for i in range(200))), (501, repeated + "\n" + repeated), (502, repeated),
           (503, " ".join(f"w{i}" for i in range(101)) + " " + " ".join(f"v{i}" for i in range(500)) + " " + " ".join(f"w{i}" for i in range(101)))]
    docs = frame(spark, [(d, t, "en", "a", 0) for d, t in data + odd if t is None or len(t) < 20_000])
    wanted = []
    for doc_id, text in [(d, t) for d, t in data + odd if t is None or len(t) < 20_000]:
        m = plain(text, 10)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        wanted.append((doc_id, *m, failed, not failed and 100 * m[6] <= 30 * m[0] and m[7] <= 100))
    out = repetition.rules(clashing(docs))
    assert out.columns == ["doc_id", *MEASURES, "base_failed", "kept"]
    assert sorted(map(str, [tuple(r) for r in out.collect()])) == sorted(map(str, wanted))
    verdict = {r.doc_id: r.kept for r in out.where("doc_id >= 500").collect()}
    assert verdict == {500: True, 501: False, 502: True, 503: False}
    kept = repetition.clean(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in wanted if w[-1])


def test_empty_table_and_slices(spark):
    assert repetition.rules(frame(spark, [])).collect() == []
    some = [t or "" for t in texts(50)]
    parts = list(repetition.slices(pa.array(some)))
    assert sum((p.to_pylist() for p in parts), []) == some
