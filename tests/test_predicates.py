from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import documents as docs
from fieldlens.functions import predicates as pred
from fieldlens.functions import scalars as sf
from tests.test_histograms import frame

DOCUMENT = {
    "histograms": {"H": {"values": {"1": 5, "400": 0, "x": 1}, "sum": 300}, "odd": "text"},
    "simpleMeasurements": {"m": 1000, "gone": None, "H": 1},
    "info": {"OS": "Linux", "cpus": 4, "flag": True, "none": None, "m": "shadowed", "it's": "q"},
}


@pytest.mark.parametrize("key, sub, op, value, expected", [
    ("H", None, ">", 300, True), ("H", "values", ">", 400, False), ("H", None, "=", 400, True), ("H", None, "=", 5, False),
    ("H", None, "<=", 1, True), ("H", None, "!=", "null", True), ("H", None, "=", "null", False), ("H", "sum", "=", 300, True),
    ("H", "sum", ">=", 301, False), ("H", "sum", "!=", 300, False), ("H", "missing", "=", "null", True), ("H", "missing", "=", 1, False),
    ("odd", None, ">", 0, False), ("m", None, "=", 1000, True), ("m", None, "!=", 999, True), ("m", None, "!=", "null", True),
    ("gone", None, "=", "null", True), ("gone", None, ">", 0, False), ("OS", None, "=", "Linux", True), ("OS", None, "!=", "Linux", False),
    ("OS", None, "!=", "null", True), ("cpus", None, "<", 5, True), ("flag", None, "=", True, True), ("flag", None, "!=", True, False),
    ("none", None, "=", "null", True), ("it's", None, "=", "q", True), ("nowhere", None, "=", "null", False), ("nowhere", None, "=", 1, False),
    ("m", None, ">", "text", False),
])
def test_compare(spark, key, sub, op, value, expected):
    row = docs.parse_whole(frame(spark, DOCUMENT)).select(pred.compares(key, op, value, sub)).first()
    assert row[0] is expected


def test_parts_may_be_missing(spark):
    rows = docs.parse_whole(frame(spark, {"info": {"OS": "Linux"}}, {"simpleMeasurements": {"m": 1}}, None, "{"))
    assert [r.k for r in pred.where_all(rows, [("OS", None, "=", "Linux")]).collect()] == ["k0"]
    assert [r.k for r in pred.where_all(rows, [("m", None, ">", 0), ("m", None, "<", 2)]).collect()] == ["k1"]
    assert pred.where_all(rows, []).count() == 4


def test_unknown_operator():
    with pytest.raises(ValueError):
        pred.compares("a", "~", 1)


def test_drop_incomplete_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert pred.drop_incomplete(df).collect() == [(1.0, "a")]
    assert pred.drop_incomplete(df, ["s"]).count() == 3


def texts(spark, function, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def test_versions(spark):
    assert texts(spark, sf.os_version, ["12.2.0", "6.1", "abc", "3.0.31-g1", None, ""]) == ["12", "6.1", "abc", "3.0", None, ""]
    assert texts(spark, sf.kernel_version, ["12.2.0", "3.0.31-g1", "x"]) == ["12.2", "3.0.31", "x"]
    assert texts(spark, sf.major_version, ["10.0a1", "7", "x.1", None]) == [10, 7, None, None]


def test_kernel_releases(spark):
    inputs = ["2.6.27.1", "2.6.29", "2.6.32.9", "2.6.35", "2.6.36", "2.6.39.4", "3.0.15", "3.0.8", "3.0.31", "3.1.10", "9-Cyanogen", "9-cyanogen", "3.4", None]
    assert texts(spark, sf.kernel_release, inputs) == [
        "1.5", "1.6/2.0.x/2.1", "2.2.x", "2.3.x", "3.x", "4.0.x", "4.0.x", "4.0.x", "4.1.x", "4.1.x", "CyanogenMod", "CyanogenMod",
        "Unknown (3.4)", None]


def test_null_safe_helpers(spark):
    assert texts(spark, sf.null_default, ["a", None]) == ["a", "NA"]
    assert texts(spark, lambda v: sf.flag(v == "true"), ["true", "TRUE", None]) == [1, 0, 0]
    row = spark.createDataFrame([(1, 0)], "a int, b int").select(sf.ratio(F.col("a"), F.col("b")), sf.ratio(F.col("b"), F.col("a"))).first()
    assert tuple(row) == (None, 0.0)


def test_clamps(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([None, -5.0, 0.0, 30000.0, 30001.0])], "i int, v double").orderBy("i")
    assert [r[0] for r in rows.select(sf.clamp_low_high(F.col("v"), 30000, 31000)).collect()] == [-1.0, -1.0, 0.0, 30000.0, 31000.0]


def test_sample_is_repeatable_and_near_its_rate(spark):
    rows = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    share = rows.where(sf.in_sample(F.col("k"), 0.1)).count() / 20000
    assert abs(share - 0.1) < 0.01
    assert rows.where(sf.in_sample(F.col("k"), 1.0)).count() == 20000 and rows.where(sf.in_sample(F.col("k"), 0.0)).count() == 0
    assert 0 < spark.range(400_000).where(sf.in_sample(F.col("id").cast("string"), 0.00004)).count() < 60
    both = rows.where(sf.in_sample(F.col("k"), 0.1) & sf.in_sample(F.col("k"), 0.1, "other")).count() / 20000
    assert abs(both - 0.01) < 0.004


def test_fingerprint_separates_absent_from_empty(spark):
    rows = docs.parse(frame(spark, {"info": {"OS": "a"}}, {"info": {"OS": "a", "arch": ""}}, {"info": {"OS": "", "appID": "a"}}, {"info": {"OS": "a", "x": 1}}), "info")
    marks = [r[0] for r in rows.orderBy("k").select(sf.fingerprint(docs.info)).collect()]
    assert len(set(marks)) == 3 and marks[0] == marks[3] and all(len(m) == 32 for m in marks)
