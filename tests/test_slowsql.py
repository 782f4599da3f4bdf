from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import documents as docs
from fieldlens.functions import scalars as sf
from fieldlens.operators import slowsql
from fieldlens.plans import jobs
from tests.test_histograms import frame


def slow(main=None, other=None, **more):
    return {"slowSQL": {"mainThread": main or {}, "otherThreads": other or {}}, "info": {"appName": "P"}, **more}


def scrubbed(spark, *documents, compat=False):
    return {r.k: json.loads(r.json) for r in slowsql.scrub(frame(spark, *documents), compat).collect()}


@pytest.mark.parametrize("text, masked", [
    ("a = 'x'", "a = :private"), ("a = 'it\\'s' AND b", "a = :private AND b"), ('a = "x y"', "a = :private"),
    ("a = 'x' OR b = \"y\" OR c = 'z'", "a = :private OR b = :private OR c = :private"), ("a = 1", "a = 1"), ("open 'x", "open 'x"),
])
def test_masking(spark, text, masked):
    row = spark.createDataFrame([(text,)], "s string").select(sf.mask_literals(F.col("s"))).first()
    assert row[0] == masked


def test_compat_masking_leaves_double_quotes(spark):
    row = spark.createDataFrame([('a = "x" b \'y\'',)], "s string").select(sf.mask_literals(F.col("s"), compat=True)).first()
    assert row[0] == 'a = "x" b :private'


def test_scrub_changes_only_other_threads(spark):
    out = scrubbed(
        spark, slow(main={"m = 'secret'": [1, 2]}, other={"a = 'one'": [1, 10], "plain": [9, 9]}, keep={"n": None, "x": [1.5, "2"]}),
        slow(other={"plain": [1, 2]}), {"info": {}}, None, "{", slow(main={"m = 'x'": [1, 1]}),
    )
    assert set(out) == {"k0"}
    assert out["k0"]["slowSQL"] == {"mainThread": {"m = 'secret'": [1, 2]}, "otherThreads": {"a = :private": [1, 10], "plain": [9, 9]}}
    assert out["k0"]["keep"] == {"n": None, "x": [1.5, "2"]}


def test_colliding_statements_are_added_up(spark):
    other = {"a = 'one'": [1, 10], "a = 'two'": [2, 5_000_000_000], "a = :private": [4, 7], "b": [1, 1]}
    out = scrubbed(spark, slow(other=other))["k0"]["slowSQL"]["otherThreads"]
    assert out == {"a = :private": [7, 5_000_000_017], "b": [1, 1]}


def test_added_up_numbers_may_pass_64_bits(spark):
    other = {"a = 'one'": [1, 2**63 - 5], "a = 'two'": [1, 100]}
    assert scrubbed(spark, slow(other=other))["k0"]["slowSQL"]["otherThreads"] == {"a = :private": [2, 2**63 + 95]}


def test_scrubbing_twice_changes_nothing(spark):
    first = scrubbed(spark, slow(other={"a = 'x'": [1, 2], 'b = "y"': [3, 4]}))
    assert scrubbed(spark, *first.values()) == {}


def test_no_literal_survives(spark):
    other = {"INSERT INTO t VALUES ('sitea.example', 'siteb.example')": [1, 2], "q = 'sitea.example' -- x": [3, 4]}
    assert "example" not in json.dumps(scrubbed(spark, slow(other=other)))


def test_statement_rows(spark):
    document = slow(main={"SELECT\t *\n FROM  t ": [2, 9, 7], "a\u0001b": [1, None, 3], "none": [], "bad": "x", "mixed": ["5", 4]})
    rows = slowsql.statements(docs.parse(frame(spark, document), "slowSQL"), ["k"], ["mainThread"]).collect()
    assert {r.sql: (r["count"], r.t) for r in rows} == {
        "SELECT * FROM t": (2, 9), "a\\u0001b": (1, 3), "none": (None, None), "mixed": (4, None)}


def test_report_threshold_order_and_zero_counts(spark):
    documents = [slow(main={"often": [2, 4 + i], "zero": [0, 5]}, other={"rare": [1, 1]} if i < 2 else {}) for i in range(4)]
    rows = frame(spark, *documents).withColumn("k", F.concat(F.lit("s20240101"), "k")).withColumn("d", F.lit("20240101"))
    out = jobs.slow_sql_report(rows, 2).collect()
    assert [(r.thread, r.sql, r.doc_count, r.sum_count) for r in out] == [("mainThread", "often", 4, 8), ("mainThread", "zero", 4, 0)]
    assert (out[0].q0, out[0].q50, out[0].q100) == (2.0, 2.75, 3.5) and out[1].q50 is None
    assert jobs.slow_sql_report(rows, 2, rows_per_range=2).collect() == out


def test_write_back_keeps_all_rows(spark):
    rows = frame(spark, slow(other={"a = 'x'": [1, 2]}), "{", None).withColumn("d", F.lit("20240101"))
    out = {r.k: r.json for r in jobs.scrub_submissions(rows).collect()}
    assert "'x'" not in out["k0"] and out["k1"] == "{" and out["k2"] is None


def test_rows_masked_on_the_way_equal_those_of_scrubbed_documents(spark):
    documents = [
        slow(main={"a = 'kept'": [1, 2]}, other={"a = 'one'": [1, 10], "a = 'two'": [2, 5_000_000_000], "a = :private": [4, 7], "b": [1, 1]}),
        slow(other={"a = 'x'": "text", "a = 'y'": [3], "c = \"q\"": [1, None, 2], "d": []}), slow(other={}), slow(main={"m": [1, 1]}), {"info": {}}, "{", None,
        slow(other={"a": [5, 6], " a ": [7, 8]}),
    ]
    rows = frame(spark, *documents).withColumn("k", F.concat(F.lit("s20240101"), "k")).withColumn("d", F.lit("20240101"))
    wanted = jobs.slow_sql_rows(jobs.scrub_submissions(rows))
    found = jobs.slow_sql_rows(rows, scrub=True)
    assert found.columns == wanted.columns
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, wanted.collect()))) and found.count() == 9
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "to_json" not in plan and plan.count("from_json") == 1


def test_totals_are_lost_only_when_they_do_not_fit(spark):
    rows = spark.createDataFrame([("m", "x", 2**62, 1), ("m", "x", 2**62, 2), ("m", "x", -(2**62), 3), ("m", "y", 2**62, 1), ("m", "y", 2**62, 1)], "thread string, sql string, count bigint, t bigint")
    for report in (slowsql.quantile_report, slowsql.selected_report, slowsql.approximate_report):
        assert {r["sql"]: r["sum_count"] for r in report(rows, ["thread", "sql"]).collect()} == {"x": 2**62, "y": None}
