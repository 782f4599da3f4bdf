from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import validation
from fieldlens.plans import jobs
from fieldlens.schema import SPEC_DDL
from fieldlens.sources.submissions import read_specs
from tests.test_histograms import frame, histogram

GOOD = {"values": {"0": 1, "1": 0}, "sum": 3, "bucket_count": 3, "range": [1, 2], "histogram_type": 1}


@pytest.fixture(scope="module")
def spec(spark):
    rows = [
        ("default", "A", "1", "2", "1", "3", [0, 1, 2]), ("16", "A", "1", "2", "1", "3", [0, 1, 2]),
        ("16.1", "A", "1", "9", "1", "3", [0, 1, 2]), ("17", "A", "1", "2", "1", "3", None),
        ("17", "N", None, "2", "1", "3", [0]),
    ]
    return spark.createDataFrame(rows, SPEC_DDL)


def doc(version="16.0", **hists):
    return {"info": {"appVersion": version, "appName": "P"}, "histograms": hists, "extra": [1, "1", None, {"a": 1.5}]}


def validated(spark, spec, *documents):
    rows = validation.validate(frame(spark, *documents), spec).collect()
    return {r.k: json.loads(r.json) for r in rows}


@pytest.mark.parametrize("change, ok", [
    ({}, True), ({"histogram_type": 2}, False), ({"range": [2, 2]}, False), ({"range": [1, 3]}, False), ({"range": [1]}, False),
    ({"bucket_count": 4}, False), ({"bucket_count": "3"}, True), ({"values": {}}, False), ({"values": None}, False),
    ({"values": {"5": 1}}, False), ({"values": {"x": 1}}, False), ({"values": [1]}, False), ({"sum": "odd"}, True),
])
def test_checks(spark, spec, change, ok):
    out = validated(spark, spec, doc(A={**GOOD, **change}))["k0"]
    text = "true" if ok else "false"
    assert out["histograms"]["A"]["valid"] == text and out["info"]["validForSchema"] == text


def test_everything_else_stays(spark, spec):
    before = doc(A={**GOOD, "valid": "old", "log_sum": 1.25}, B={"odd": [None]}, C="text")
    after = validated(spark, spec, before)["k0"]
    before["histograms"]["A"]["valid"] = "true"
    before["info"]["validForSchema"] = "true"
    assert after == before


def test_incomplete_documents(spark, spec):
    out = validated(
        spark, spec, {"info": {"appName": "P"}, "histograms": {}}, {"histograms": {}}, doc() | {"histograms": None},
        {"info": "text"}, None, "{", "[1]", {"info": {"appVersion": "16"}, "histograms": {}},
    )
    assert {k: d["info"]["validForSchema"] for k, d in out.items()} == {
        "k0": "false", "k1": "false", "k2": "false", "k3": "false", "k7": "true"}


def test_version_choice(spark, spec):
    rows = spark.createDataFrame([("16.0",), ("16.1",), ("a17b",), ("9",), (None,)], "product_version string")
    out = {r.product_version: r.spec_key for r in validation.match_versions(rows, spec).collect()}
    assert out == {"16.0": "16", "16.1": "16.1", "a17b": "17", "9": "default", None: None}
    without = spec.where("version_key <> 'default'")
    assert validation.match_versions(rows, without).where("product_version = '9'").first().spec_key is None


def test_spec_without_buckets_or_limits(spark, spec):
    out = validated(spark, spec, doc("17", A={**GOOD, "values": {"77": 1}}, N=GOOD))["k0"]["histograms"]
    assert out["A"]["valid"] == "true" and out["N"]["valid"] == "false"


def test_a_large_specification_and_repeating_change_nothing(spark, spec):
    documents = [doc(["16.0", "16.1", "17", "9"][i % 4], A={**GOOD, "bucket_count": 3 + i % 2}, Z=histogram()) for i in range(40)]
    once = validated(spark, spec, *documents)
    more = spark.range(1200).select(
        F.concat(F.lit("x"), F.col("id")).alias("version_key"), F.lit("A").alias("hist_name"), *[F.lit("1").alias(c) for c in ("min", "max", "hist_type", "bucket_count")],
        F.sequence(F.lit(0), F.lit(500)).alias("buckets"),
    )
    large = spec.unionByName(more.select(spec.columns)).unionByName(
        spark.range(2000).select(F.lit("16").alias("version_key"), F.concat(F.lit("H"), F.col("id")).alias("hist_name"), *[F.lit("1").alias(c) for c in ("min", "max", "hist_type", "bucket_count")],
                                 F.array(F.lit(1)).alias("buckets")).select(spec.columns))
    for joined in ("10MB", "-1"):  # sent to all tasks, and joined by key
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joined)
        try:
            assert once == validated(spark, large, *documents)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    twice = validated(spark, spec, *once.values())
    assert sorted(map(json.dumps, twice.values())) == sorted(map(json.dumps, once.values()))


def test_a_repeated_key_does_not_mix_documents(spark, spec):
    rows = frame(spark, doc(A=GOOD), doc(A={**GOOD, "bucket_count": 9})).withColumn("k", F.lit("same"))
    assert sorted(r.is_valid for r in validation.validate(rows, spec).collect()) == [False, True]


def test_report_counts_each_document_once(spark, spec):
    row = validation.report(frame(spark, doc(A=GOOD, B=GOOD), doc(A={**GOOD, "bucket_count": 9}), doc(), {"info": {}}, None, "{"), spec).first()
    assert (row.documents, row.meta_data_invalid, row.invalid_json_structure, row.submissions_evaluated) == (6, 1, 1, 3)
    assert (row.known_histograms, row.unknown_histograms, row.valid_histogram, row.invalid_histogram) == (2, 1, 1, 1)
    assert row.invalid_histogram_bucket_count == 1


def test_write_back_keeps_all_rows(spark, spec):
    rows = frame(spark, doc(A=GOOD), "{", None).withColumn("d", F.lit("20240101"))
    out = {r.k: r.json for r in jobs.validate_submissions(rows, spec).collect()}
    assert set(out) == {"k0", "k1", "k2"} and out["k1"] == "{" and out["k2"] is None
    counts = jobs.count_valid_invalid(jobs.validate_submissions(rows, spec)).first()
    assert tuple(counts) == (3, 1, 0)


def test_specs_from_files(spark, spec, tmp_path):
    path = tmp_path / "spec.json"
    path.write_text(json.dumps({"histograms": {"A": {"min": 1, "max": 2, "kind": 1, "bucket_count": 3, "buckets": [0, 1, 2]}}}))
    found = read_specs(spark, {"default": str(path), "16": str(path)})
    wanted = spec.where("version_key in ('default', '16')")
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_counters_come_from_the_pass_that_writes(spark, spec, tmp_path):
    from fieldlens.sources.submissions import read_store, write_store

    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    odd = frame(spark, doc(A=GOOD, B=GOOD), doc(A={**GOOD, "bucket_count": 9}), doc(), {"info": {}}, None, "{", "7", doc("9", A=GOOD), {"info": {"appVersion": "16.0"}})
    write_store(odd.withColumns({"d": F.concat(F.lit("2024010"), F.col("k").substr(2, 1)), "k": F.col("k")}), source)
    rows = read_store(spark, source)
    counted = jobs.validate_store(rows, spec, target)
    assert counted.collect() == validation.report(rows, spec).collect() and counted.columns == validation.report(rows, spec).columns
    written = sorted((r.k, r.json) for r in read_store(spark, target).collect())
    assert written == sorted((r.k, r.json) for r in jobs.validate_submissions(rows, spec).collect()) and len(written) == 9
    nothing = jobs.validate_store(rows.where("k = 'none'"), spec, str(tmp_path / "none"))
    assert set(nothing.first()) == {0}


def test_the_pass_that_counts_reads_once_and_does_not_shuffle(spark, spec, tmp_path):
    from fieldlens.sources.submissions import read_store, write_store

    source = str(tmp_path / "source")
    write_store(frame(spark, doc(A=GOOD)).withColumn("d", F.lit("20240101")), source)
    judged, _ = validation.observed(read_store(spark, source), spec)
    text = judged._jdf.queryExecution().executedPlan().toString()
    documents = text.split("Subquery")[0]
    assert "CollectMetrics" in text and documents.count("json#") > 0 and text.count("FileScan parquet [k") == 1
    assert "Exchange hashpartitioning" not in documents and text.count("from_json") <= 2  # typed parts, and all members
