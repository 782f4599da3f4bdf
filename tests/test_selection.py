"""Selection by brackets against sorted lists, the number behind a double, and the plan."""

from __future__ import annotations

import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import selection
from fieldlens.operators.selection import ordered_bits, selected_quantiles

QUANTILES = {"least": (0, 1), "q25": (1, 4), "half": (1, 2), "q95": (19, 20), "most": (1, 1)}


def test_ordered_bits_are_those_of_the_double(spark):
    rule = random.Random(1)
    values = [0.0, -0.0, 5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, float("inf"), float("-inf"), None, float("nan")]
    values += [2.0**k * (1 + j * 2.0**-52) for k in range(-1000, 1000, 41) for j in (0, 1)] + [struct.unpack("d", rule.randbytes(8))[0] for _ in range(2000)]
    values += [-v for v in values if v is not None]
    for value, bits in spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v"))).collect():
        if value is None or value != value:
            assert bits is None
        else:
            size = struct.unpack("q", struct.pack("d", abs(value)))[0]
            assert bits == (-size if value < 0 else size)


def plain(values, p, kind):
    values, (num, den) = sorted(values), p
    if not values:
        return None
    n = len(values)
    if kind == "average":
        low, high, share = max(-(-n * num // den), 1), min(n * num // den + 1, n), 0.5
    else:
        at = Fraction((n - 1) * num, den)
        low, high, share = int(at) + 1, min(int(at) + 2, n), float(at - int(at))
    return values[low - 1] + (values[high - 1] - values[low - 1]) * share


@pytest.mark.parametrize("kind", ["linear", "average"])
def test_quantiles_of_odd_groups(spark, kind):
    rule = random.Random(3)
    data = [("hot", 0.1 + rule.choice([0, 2.0**-50, 2.0**-45, 1e-3])) for _ in range(900)]
    data += [(f"g{i % 7}", rule.choice([rule.uniform(-1e300, 1e300), rule.uniform(-1, 1), -0.0, 0.0, 3.0])) for i in range(400)]
    data += [(None, 1.0), (None, 5.0), ("none", None), ("none", float("nan")), ("one", 7.0), ("some", None), ("some", 2.0)]
    rows = spark.createDataFrame([(g, v, 2**62) for g, v in data], "g string, v double, c bigint").withColumns({"place": F.lit(1), "n_": F.lit(2), "before": F.lit(3)})
    found = {r["g"]: r for r in selected_quantiles(rows, ["g"], "v", QUANTILES, kind, {"c": F.col("c")}).collect()}
    assert set(found) == {g for g, _ in data}
    for g, row in found.items():
        values = [v + 0.0 for k, v in data if k == g and v is not None and v == v]
        assert row["doc_count"] == sum(k == g for k, _ in data) and row["n"] == len(values) and int(row["c"]) == row["doc_count"] * 2**62
        for name, p in QUANTILES.items():
            assert row[name] == plain(values, p, kind)


def test_without_keys_and_without_rows(spark):
    rows = spark.range(1, 1001).select(F.col("id").alias("v"))
    row = selected_quantiles(rows, [], "v", QUANTILES).first()
    assert (row["n"], row["least"], row["half"], row["most"]) == (1000, 1.0, 500.5, 1000.0)
    assert selected_quantiles(rows.where("v < 0"), [], "v", QUANTILES).collect() == []
    assert selected_quantiles(rows.where("v < 0"), ["v"], "v", QUANTILES).collect() == []


def test_values_are_neither_sorted_nor_shuffled(spark, monkeypatch):
    plans = []
    stage = selection.stage
    monkeypatch.setattr(selection, "stage", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or stage(df, name))
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 0.37).alias("v"))
    selected_quantiles(rows, ["g"], "v", QUANTILES).collect()
    assert [n for n, _ in plans if n == "brackets"] and not [p for _, p in plans if "rangepartitioning" in p]
    for name, text in plans:
        if name == "narrow":
            assert "Exchange" not in text
        if name == "brackets":  # counts are partial before they are shuffled; only the window over them sorts
            assert "partial_count" in text and "BroadcastHashJoin" in text
