from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import documents as docs
from fieldlens.functions import scalars as sf
from fieldlens.operators import histograms as h


def frame(spark, *documents):
    texts = [d if d is None or isinstance(d, str) else json.dumps(d) for d in documents]
    return spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "k string, json string")


def histogram(**changes):
    base = {"values": {"1": 2, "5": 3}, "sum": 17, "bucket_count": 4, "range": [1, 9], "histogram_type": 1}
    base.update(changes)
    return {name: value for name, value in base.items() if value != "absent"}


def parsed(spark, *documents):
    return docs.parse(frame(spark, *documents), "histograms", "simpleMeasurements")


def name_rows(spark, *documents):
    return {(r.k, r.hist_name): r for r in h.by_name(parsed(spark, *documents), ["k"]).collect()}


def value_rows(spark, *documents):
    rows = h.by_value(h.entries(parsed(spark, *documents), ["k"])).collect()
    return {(r.k, r.hist_name, r.v): r for r in rows}


def test_complete_histogram_gives_all_fields(spark):
    row = name_rows(spark, {"histograms": {"A": histogram()}})["k0", "A"]
    assert tuple(row)[1:] == ("A", 17, 4, 1, 9, 1, 1)


@pytest.mark.parametrize("field", ["values", "sum", "bucket_count", "range", "histogram_type"])
@pytest.mark.parametrize("value", ["absent", None])
def test_histogram_without_a_required_part_is_skipped(spark, field, value):
    found = name_rows(spark, {"histograms": {"BAD": histogram(**{field: value}), "GOOD": histogram()}})
    assert set(found) == {("k0", "GOOD")}


@pytest.mark.parametrize("bad", ["text", 5, [1], True, None])
def test_value_that_is_no_histogram_costs_only_itself(spark, bad):
    found = name_rows(spark, {"histograms": {"BAD": bad, "GOOD": histogram()}, "simpleMeasurements": {"uptime": 4}})
    assert set(found) == {("k0", "GOOD"), ("k0", "SIMPLE_MEASURES_UPTIME")}


@pytest.mark.parametrize("field, value", [("sum", "17"), ("sum", True), ("bucket_count", "x"), ("histogram_type", [1]), ("range", 3)])
def test_wrongly_typed_leaf_drops_its_histogram(spark, field, value):
    found = name_rows(spark, {"histograms": {"BAD": histogram(**{field: value}), "GOOD": histogram()}})
    assert set(found) == {("k0", "GOOD")}


@pytest.mark.parametrize("valid, expected", [("true", 1), ("TRUE", 1), ("false", 0), ("", 0), (None, 0), (True, 1)])
def test_validity_leaf(spark, valid, expected):
    assert name_rows(spark, {"histograms": {"A": histogram(valid=valid)}})["k0", "A"].is_valid == expected


@pytest.mark.parametrize("limits, expected", [([1, 9], (1, 9)), ([4], (0, 0)), ([], (0, 0)), (["a", 9], (0, 9)), ([1, 2, 3], (1, 2))])
def test_range(spark, limits, expected):
    row = name_rows(spark, {"histograms": {"A": histogram(range=limits)}})["k0", "A"]
    assert (row.min_range, row.max_range) == expected


def test_unusable_buckets_are_skipped_one_by_one(spark):
    values = {"1": 2, "x": 1, "1.5": 1, "-3": 4, "7": "8", "8": True, "9": None, "10": 1.5, " 11": 2}
    found = value_rows(spark, {"histograms": {"A": histogram(values=values)}})
    assert {key[2]: row["count"] for key, row in found.items()} == {1: 2.0, -3: 4.0, 10: 1.5}


def test_last_of_repeated_names_counts(spark):
    text = '{"histograms": {"A": %s, "A": %s}}' % (json.dumps(histogram(sum=1)), json.dumps(histogram(sum=2)))
    assert name_rows(spark, text)["k0", "A"].sum == 2


def test_documents_that_are_no_objects_give_nothing(spark):
    assert name_rows(spark, None, "", "{", "[1]", "null", '{"histograms": {"A": ', {"histograms": []}) == {}


def test_measures(spark):
    measures = {
        "uptime": 4, "startupInterrupted": 7, "startupCrashDetectionEnd": 31000, "savedPings": 50, "firstPaint": 1999,
        "js": {"e4x": 3, "bad": "x"}, "text": "5", "flag": True, "gone": None, "list": [1],
    }
    found = value_rows(spark, {"simpleMeasurements": measures})
    short = {name.removeprefix("SIMPLE_MEASURES_"): (v, r["sum"], r.bucket_count, r.min_range, r.max_range, r.hist_type)
             for (_, name, v), r in found.items()}
    assert short == {
        "UPTIME": (0, 4, 30, 0, 2880, 0), "STARTUPINTERRUPTED": (7, 7, 2, 0, 1, 2),
        "STARTUPCRASHDETECTIONEND": (30000, 31000, 30, 30000, 90000, 1), "SAVEDPINGS": (50, 50, 51, 0, 50, 0),
        "FIRSTPAINT": (1000, 1999, 31, 0, 30001, 1), "JS_E4X": (3, 3, 2, 0, 1, 2),
    }
    assert all(r["count"] == 1.0 and r.is_valid == 1 for r in found.values())


def column_values(spark, function, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v bigint")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def test_uptime_buckets(spark):
    inputs = [-1, 0, 4, 5, 14, 15, 29, 30, 59, 60, 89, 90, 119, 120, 179, 180, 1439, 1440, 2879, 2880, 9999, None]
    assert column_values(spark, sf.uptime_bucket, inputs) == [
        2880, 0, 0, 5, 5, 15, 15, 30, 30, 60, 60, 90, 90, 120, 120, 180, 1380, 1440, 1440, 2880, 2880, None]


def test_grid_buckets(spark):
    def other(v):
        return sf.grid_bucket(v, 0, 30001, 1000)

    def crash(v):
        return sf.grid_bucket(v, 30000, 90000, 2000)

    assert column_values(spark, other, [-1, 0, 999, 1000, 30999, 31000, 31001, None]) == [-1, 0, 0, 1000, 30000, 0, 0, None]
    assert column_values(spark, crash, [29999, 30000, 31999, 91999, 92000]) == [0, 30000, 30000, 90000, 0]
    assert column_values(spark, lambda v: sf.grid_bucket(v, 0, 50, 1), [50, 51]) == [50, 0]
    with pytest.raises(ValueError):
        sf.grid_bucket(F.lit(1), 0, 1, 0)


def test_single_histogram_drops_empty_buckets(spark):
    whole = docs.parse_whole(frame(spark, {"histograms": {"A": histogram(values={"1": 0, "2": 5})}}, {"histograms": {"B": histogram()}}))
    rows = docs.select_fields(whole, ["histograms.A"]).collect()
    assert [(r.k, r.v, r["count"]) for r in rows] == [("k0", 2, 5.0)]


def dims(**changes):
    about = {"reason": "idle-daily", "appName": "P", "appVersion": "1", "appUpdateChannel": "c", "arch": "a", "OS": "o",
             "version": "6.1", "appBuildID": "b", "platformBuildID": "p"}
    about.update(changes)
    return {name: value for name, value in about.items() if value is not None}


def daily_rows(spark, *documents):
    rows = frame(spark, *documents).withColumn("k", F.concat(F.lit("s20240101"), "k"))
    parsed_rows = docs.parse(rows, "info", "histograms", "simpleMeasurements")
    return h.entries(parsed_rows, docs.dimension_columns())


def test_daily_totals_equal_the_join_of_both_totals(spark):
    documents = [{"info": dims(arch=None if i % 4 == 3 else "a"), "histograms": {"A": histogram(sum=i), "E": histogram(values={})},
                  "simpleMeasurements": {"uptime": i}} for i in range(12)]
    rows = daily_rows(spark, *documents).cache()
    joined = h.join_name_value(h.name_totals(rows.drop("buckets")), h.value_totals(h.by_value(rows)))
    one_pass = h.daily_totals(rows).select(*joined.columns)
    assert sorted(map(str, one_pass.collect())) == sorted(map(str, joined.collect()))
    assert one_pass.where("hist_name = 'E'").count() == 0
    assert one_pass.where("arch is null").count() == 0
    total = rows.where("arch is not null").select(F.inline("buckets")).agg(F.sum("count")).first()[0]
    assert one_pass.agg(F.sum("sum_count")).first()[0] == total


def test_aggregate_document(spark):
    documents = [{"info": dims(appUpdateChannel=None), "histograms": {"A": histogram(), "B": histogram(values={"3": 1})}} for _ in range(3)]
    documents.append({"info": dims(appUpdateChannel=None), "histograms": {"A": histogram(valid="false")}})
    out = {r.is_valid: json.loads(r.agg_json) for r in h.aggregate_documents(h.daily_totals(daily_rows(spark, *documents))).collect()}
    assert set(out) == {0, 1}
    good = out[1]
    assert good["date"] == "20240101" and good["info"]["appUpdateChannel"] == "NA" and good["info"]["valid"] is True
    assert good["histogram_names"] == ["A", "B"]
    assert good["histograms"]["A"] == {
        "values": [[1, 6], [5, 9]], "count": 3, "sum": 51, "bucket_count": 4, "range": [1, 9], "histogram_type": 1}


def test_names_list_everything(spark):
    rows = h.names(parsed(spark, {"histograms": {"A": 1, "B": None}, "simpleMeasurements": {"js": {"x": 1}}}), ["k"]).collect()
    assert sorted(r.hist_name for r in rows) == ["A", "B", "SIMPLE_MEASURES_JS"]


def test_sums_beyond_64_bits_do_not_fail_the_job(spark):
    documents = [{"info": dims(), "histograms": {"A": histogram(sum=2**63 - 1), "B": histogram(sum=2**70)},
                  "simpleMeasurements": {"uptime": 2**62, "x": -(2**63)}} for _ in range(3)]
    out = {r.hist_name: r.hist_name_sum for r in h.daily_totals(daily_rows(spark, *documents)).collect()}
    assert out == {"A": None, "SIMPLE_MEASURES_UPTIME": None, "SIMPLE_MEASURES_X": None}
