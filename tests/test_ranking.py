"""Ranks and quantiles against brute force, with ranges forced on and one value or group hot."""

from __future__ import annotations

import math
import random
import statistics as st

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import ranking, statistics

FORCED = {"rows_per_range": 50}
CASES = [{}, FORCED]


@pytest.fixture(scope="module")
def values():
    generator = random.Random(7)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"g{i % 7}")
        value = None if i % 31 == 0 else (5.0 if i % 3 == 1 else round(generator.expovariate(0.1), 2))
        rows.append((group, value, i % 4))
    return rows


def by_group(rows):
    groups = {}
    for group, value, weight in rows:
        groups.setdefault(group, []).append((value, weight))
    return groups


def average_quantile(xs, num, den):
    xs, n = sorted(xs), len(xs)
    low = max(-(-n * num // den), 1)
    high = min(n * num // den + 1, n)
    return (xs[low - 1] + xs[high - 1]) / 2


def linear_quantile(xs, num, den):
    xs = sorted(xs)
    h = (len(xs) - 1) * num / den
    low = math.floor(h)
    return xs[low] + (h - low) * (xs[min(low + 1, len(xs) - 1)] - xs[low])


@pytest.mark.parametrize("options", CASES)
@pytest.mark.parametrize("kind, expected", [("average", average_quantile), ("linear", linear_quantile)])
def test_group_statistics(spark, values, options, kind, expected):
    probabilities = {"a": (0, 1), "b": (1, 4), "c": (1, 2), "d": (19, 20), "e": (1, 1)}
    df = spark.createDataFrame(values, "g string, v double, w int").repartition(5)
    out = ranking.group_statistics(df, ["g"], "v", probabilities, kind, carry={"w_sum": F.col("w")}, **options).collect()
    groups = by_group(values)
    assert len(out) == len(groups)
    for row in out:
        pairs = groups[row.g]
        xs = [v for v, _ in pairs if v is not None]
        assert (row.doc_count, row.n, row.w_sum) == (len(pairs), len(xs), sum(w for _, w in pairs))
        assert row["mean"] == pytest.approx(st.fmean(xs))
        assert row["sd"] == pytest.approx(st.stdev(xs))
        for name, p in probabilities.items():
            assert row[name] == pytest.approx(expected(xs, *p)), (row.g, name)


def test_group_of_one_and_group_without_values(spark):
    df = spark.createDataFrame([("one", 3.0), ("none", None)], "g string, v double")
    out = {r.g: r for r in ranking.group_statistics(df, ["g"], "v", {"q": (1, 2)}).collect()}
    assert out["one"].q == 3.0 and out["one"].sd is None
    assert out["none"].q is None and out["none"]["mean"] is None and out["none"].doc_count == 1


def test_average_quantiles_of_one_to_eight(spark):
    df = spark.range(1, 9).select(F.col("id").cast("double").alias("v"))
    row = ranking.group_statistics(df, [], "v", {"q25": (1, 4), "q50": (1, 2), "q75": (3, 4)}, "average").first()
    assert (row.q25, row.q50, row.q75) == (2.5, 4.5, 6.5)


@pytest.mark.parametrize("options", CASES)
def test_distribution(spark, values, options):
    df = spark.createDataFrame(values, "g string, v double, w int")
    xs = sorted(v for _, v, _ in values if v is not None)
    out = ranking.distribution(df, "v", **options).collect()
    assert len(out) == len(set(xs))
    for row in out:
        assert row.ecdf == pytest.approx(sum(x <= row.v for x in xs) / len(xs))


@pytest.mark.parametrize("options", CASES)
def test_row_numbers_follow_the_whole_order(spark, options):
    rows = [(float(i % 3), f"s{i:04d}") for i in range(900)]
    df = spark.createDataFrame(rows, "r double, s string").repartition(6)
    out = ranking.row_numbers(df, ["r", "s"], **options).orderBy("idx").collect()
    assert [(x.r, x.s) for x in out] == sorted(rows)
    assert [x.idx for x in out] == list(range(1, 901))


@pytest.mark.parametrize("options", CASES)
def test_spearman_with_ties(spark, values, options):
    df = spark.createDataFrame([(v, w) for _, v, w in values], "x double, y int")

    def ranks(xs):
        order = sorted(xs)
        first = {x: order.index(x) for x in set(xs)}
        return [first[x] + (order.count(x) + 1) / 2 for x in xs]

    pairs = [(v, w) for _, v, w in values if v is not None]
    expected = st.correlation(ranks([p[0] for p in pairs]), ranks([p[1] for p in pairs]))
    assert statistics.spearman(df, "x", "y", **options).first()[0] == pytest.approx(expected)


@pytest.mark.parametrize("options", CASES)
def test_nearest_below(spark, options):
    generator = random.Random(3)
    marks = sorted({(f"m{generator.randrange(3)}", generator.randrange(5000)) for _ in range(400)})
    points = sorted({("m0" if i % 3 else f"m{i % 5}", generator.randrange(-5, 6000)) for i in range(1500)} | {("m1", marks[200][1])})
    mark_df = spark.createDataFrame([(m, s, f"{m}@{s}") for m, s in marks], "m string, start bigint, name string")
    point_df = spark.createDataFrame(points, "m string, at bigint")
    out = {(r.m, r["at"]): r.name for r in
           ranking.nearest_below(point_df, mark_df, ["m"], "at", "start", "name", **options).collect()}
    assert len(out) == len(points)
    for m, at in points:
        below = [s for k, s in marks if k == m and s <= at]
        assert out[m, at] == (f"{m}@{max(below)}" if below else None)


@pytest.mark.parametrize("missing", [0, 2, 50])
@pytest.mark.parametrize("groups", [1, 20000])
def test_ranges_stay_even(spark, missing, groups):
    """One hot group, or many groups with missing values: a group has one row without a value at most."""
    value = F.when((F.col("id") % 100 < missing) & F.lit(groups > 1), None).otherwise(F.col("id").cast("double"))
    df = spark.range(20000).select((F.col("id") % groups).alias("g"), value.alias("v"), F.lit(1).alias("n"))
    cut = ranking.cut_into_ranges(df, ["v"], ["g"], 500)
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert sum(sizes) == 20000 and len(sizes) >= 30 and max(sizes) < 3 * 20000 / len(sizes)
    assert ranking.cut_into_ranges(df, ["v"]).select("_range").distinct().count() == 1


def test_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 1, 1000, 1001, 2000, 30000, 31000)], "v double")
    out = {(r.lower, r.upper): r.n for r in statistics.bins(df, [], "v", 0, 30000, 1000).collect()}
    assert out == {(-1.0, 0.0): 2, (0.0, 1000.0): 2, (1000.0, 2000.0): 2, (29000.0, 30000.0): 1, (30000.0, 31000.0): 1}


def test_kernel_density_has_unit_area(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"))
    out = statistics.kernel_density(df, "v").orderBy("i").collect()
    step = out[1].x - out[0].x
    assert len(out) == 512 and sum(r.density for r in out) * step == pytest.approx(1.0, abs=2e-3)


def test_nan_is_missing_for_all_statistics(spark):
    from fieldlens.operators import statistics

    nan = float("nan")
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("a", nan, 5.0), ("a", 3.0, 1.0), ("a", None, 1.0), ("b", nan, nan)], "g string, x double, y double")
    six = {r["g"]: r for r in statistics.six_numbers(rows, ["g"], "x").collect()}
    assert (six["a"]["n_values"], six["a"]["max"], six["a"]["mean"], six["a"]["missing"]) == (2, 3.0, 2.0, 2)
    assert (six["b"]["n_values"], six["b"]["mean"], six["b"]["missing"]) == (0, None, 1)
    assert sum(r["n"] for r in statistics.bins(rows, [], "x", 0, 10, 1).collect()) == 2
    assert sorted(r["x"] for r in ranking.distribution(rows, "x").collect()) == [1.0, 3.0]
    assert statistics.spearman(rows, "x", "y").first()[0] == pytest.approx(-1.0)
    assert statistics.kernel_density(rows, "x", points=16).where("density is null or isnan(density)").count() == 0


def test_no_values_give_no_curve(spark):
    from fieldlens.operators import statistics

    rows = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert statistics.kernel_density(rows, "x").collect() == [] and statistics.kernel_density(rows.limit(0), "x").collect() == []


def test_ranges_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MOST_RANGES", 3)
    rows = ranking.row_numbers(spark.range(500).select("id"), ["id"], rows_per_range=10)
    assert [(r["id"], r["idx"]) for r in rows.orderBy("id").collect()] == [(i, i + 1) for i in range(500)]
