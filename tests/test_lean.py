"""Work that a document needs once is not done for each of its parts, whatever the parts are."""

from __future__ import annotations

import glob
import re

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import documents as docs
from fieldlens.operators import histograms, slowsql, validation
from fieldlens.plans import jobs
from fieldlens.schema import FINGERPRINT_FIELDS, SPEC_DDL
from fieldlens.sources import submissions as store
from fieldlens.testbed import queries

ODD = [
    '{"info":{"OS":"x","cpucount":4,"hasSSE":true,"arch":null,"version":[1,"a"],"locale":{"b":1.50},"hasSSE4_1":""},"histograms":{}}',
    '{"info":{"OS":"a","OS":"b"},"histograms":[1]}', '{"info":[1]}', '{"info":"x"}', '{"info":{}}', "{}", " {}", "{", "[1]", "3", "", None,
    '{"info":{"OS":"x"},"extra":' + "9" * 1200 + "}", '{"info":{"OS":"x"},"extra":-0.' + "5" * 1200 + "e3}", '{"extra":{"a":1,}}', '{"info":{"OS":"x"}',
    '{"info":{"OS":"x"}} rest', '{"extra":NaN}', '{"extra":"\\q"}',
]


def odd(spark):
    return spark.createDataFrame([(f"s20240101{i:02}", t) for i, t in enumerate(ODD)], "k string, json string")


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def events(spark, path, n=40):
    rows = spark.range(n).select(
        F.col("id").alias("event_id"), F.lit("2024-01-05 10:00:00").cast("timestamp").alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"), (F.col("id") % 9 / 2).alias("value"), F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props"))
    rows.write.parquet(f"{path}/events.parquet")
    return str(path)


def test_the_range_is_taken_apart_once(spark):
    rows = docs.parse(odd(spark), "info", "histograms", "simpleMeasurements")
    assert optimized(histograms.entries(rows, ["k"])).count(".range") == 1


def test_warnings_do_not_carry_dimensions(spark):
    rows = docs.parse(odd(spark), "info", "histograms", "simpleMeasurements")
    text = optimized(histograms.warnings(rows, docs.dimension_columns()))
    assert not [line for line in text.split("inline(")[0].splitlines() if "plat_build_id" in line]


def test_equal_statements_are_gathered_once(spark):
    json = """{"slowSQL":{"otherThreads":{"a 'x'":[1,2,"no"],"a 'y'":[4,8],"a ":[1,1],"b 'z'":[3]}}}"""
    changed = slowsql.scrub(spark.createDataFrame([("k", json)], "k string, json string"))
    assert changed.first().json == '{"slowSQL":{"otherThreads":{"a ":[1,1],"a :private":[5,10],"b :private":[3]}}}'
    assert len(re.findall(r"filter\(\S*_pairs", optimized(changed))) == 1


@pytest.mark.parametrize("buckets, keys, bad", [
    ([0, 1, 2], ["0", "2"], False), ([0, 1, 2], ["12"], True), ([10, 20], ["1"], True), ([10, 20], ["+10", "020"], False), ([0], ["x"], True),
    ([-1], ["x"], False), ([], ["1"], True), (None, ["1"], False), ([0, None], ["0"], False), ([0, None], ["5"], False), ([0], [], False),
    ([-10], ["10"], True), ([2147483647], ["2147483648"], True),
])
def test_edges(spark, buckets, keys, bad):
    spec = spark.createDataFrame([("default", "A", "1", "2", "1", "3", buckets)], SPEC_DDL)
    values = ",".join(f'"{k}":1' for k in keys)
    json = '{"info":{"appVersion":"1"},"histograms":{"A":{"values":{%s},"range":[1,2],"bucket_count":3,"histogram_type":1,"sum":1}}}' % values
    checked = validation.check_rows(spark.createDataFrame([("k", json)], "k string, json string"), spec)
    row = checked.first()
    assert row.bad_bucket is bad and row.no_buckets is (not keys) and not row.bad_min and not row.bad_max
    assert "array_contains" not in optimized(checked).lower().replace("arraycontains", "array_contains")


def test_a_store_is_validated_in_small_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "VALIDATION_SPLIT", 500, raising=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = spark.range(400).selectExpr("concat('s20240101', id) as k", "'20240101' as d", """concat('{"info":{"appVersion":"', id, '"}}') as json""")
    store.write_store(rows.repartition(40), f"{tmp_path}/from", rebalance=False)
    spec = spark.createDataFrame([("default", "A", "1", "2", "1", "3", [0])], SPEC_DDL)
    assert jobs.validate_store(store.read_store(spark, f"{tmp_path}/from"), spec, f"{tmp_path}/to").first().documents == 400
    assert len(glob.glob(f"{tmp_path}/to/d=20240101/*.parquet")) >= 40 and store.read_store(spark, f"{tmp_path}/to").count() == 400
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_info_fields_are_those_of_info(spark):
    parsed = docs.parse(odd(spark), "info")
    fields = docs.once(parsed, "info", docs.info_fields(FINGERPRINT_FIELDS).alias("_info"))
    alone = fields.select(*[docs.info(n).alias(n) for n in FINGERPRINT_FIELDS]).collect()
    assert fields.select(*[F.col("_info")[n].alias(n) for n in FINGERPRINT_FIELDS]).collect() == alone
    assert any(r.version for r in alone) and any(r.hasSSE == "true" for r in alone)


def test_fingerprints_pass_the_members_once(spark, tmp_path):
    text = optimized(queries.REGISTRY["config_fingerprint"](spark, events(spark, tmp_path)))
    assert 0 < len(re.findall(r"variant_get\(\S*info", text)) <= 2


def test_report_reads_again_only_in_doubt(spark):
    parsed = docs.parse(odd(spark), "info", "histograms", unread="_unread")
    rows = parsed.select("k", validation._readable_after("_unread", "json").alias("new"), validation.readable().alias("old"), "_unread").orderBy("k").collect()
    assert [r.new for r in rows] == [r.old for r in rows] and {True, False} == {r.old for r in rows}
    assert rows[0]["_unread"] is None and rows[1]["_unread"] == ODD[1] and rows[1].new
    with_column = docs.parse(odd(spark), "info", "histograms").select("k", "info", "histograms").orderBy("k")
    assert with_column.select(F.to_json("info"), F.to_json("histograms")).collect() == parsed.orderBy("k").select(F.to_json("info"), F.to_json("histograms")).collect()
