"""The SQL functions give what the column functions give."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import documents as docs
from fieldlens.functions import scalars as sf
from fieldlens.functions import sql
from fieldlens.operators import slowsql


@pytest.fixture(scope="module")
def session(spark):
    assert set(sql.register(spark)) >= {"os_version", "mask_literals", "slow_sql_entries"}
    return spark


TEXTS = ["6.1", "12.2.0", "abc", "", None, "3.0.31-g1", "2.6.39.4x", "2.6.35.7-Cyanogen", "x cyanogen", "3.0.15", "3.0.8", "4.9'\\n", " \x01a\t\tb\n\x0b c\x00 ", "\x02", "a = 'x\\'y' and \"z\"",
         "'\"q\"' 'r", "INSERT ('a','b') \"c\\\"d\"", "x20240105abcd", "ünï 😀  "]
ONE = {"salt_from_key": sf.salt_from_key, "day_from_key": sf.day_from_key, "uuid_from_key": sf.uuid_from_key, "null_default": sf.null_default, "os_version": sf.os_version,
       "kernel_version": sf.kernel_version, "kernel_release": sf.kernel_release, "text_size": sf.text_size, "normalize_sql": sf.normalize_sql, "mask_literals": sf.mask_literals,
       "mask_literals_compat": lambda c: sf.mask_literals(c, compat=True)}


@pytest.mark.parametrize("name", sorted(ONE))
def test_text_functions(session, name):
    rows = session.createDataFrame([(t,) for t in TEXTS], "v string")
    both = rows.select(ONE[name](F.col("v")).alias("a"), F.expr(f"{name}(v)").alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both] and rows.select(F.expr(f"{name}(v)")).schema[0].dataType == rows.select(ONE[name](F.col("v"))).schema[0].dataType


def test_number_functions(session):
    rows = session.createDataFrame([(v,) for v in [None, -5, -1, 0, 4, 5, 14, 15, 29, 30, 119, 120, 1439, 1440, 2879, 2880, 30001, 31001, 31002, 2**40]], "t bigint")
    pairs = [(sf.uptime_bucket(F.col("t")), "uptime_bucket(t)"), (sf.grid_bucket(F.col("t"), 0, 30001, 1000), "grid_bucket(t, 0, 30001, 1000)"),
             (sf.grid_bucket(F.col("t"), 30, 90, 7), "grid_bucket(t, 30, 90, 7)"), (sf.ratio(F.col("t"), F.col("t") - 5), "time_ratio(t, t - 5)")]
    for column, text in pairs:
        both = rows.select(column.alias("a"), F.expr(text).alias("b")).collect()
        assert [r.a for r in both] == [r.b for r in both]


def test_statement_rows(session):
    slow = {"mainThread": {"SELECT\t *\n FROM  t ": [2, 9, 7], "a\x01b": [1, None, 3], "none": [], "bad": "x", "mixed": ["5", 4.0, 2.5]}, "otherThreads": {"d": [2**62, True, 1]}}
    texts = [json.dumps({"slowSQL": slow}), json.dumps({"slowSQL": {"mainThread": {}}}), json.dumps({"slowSQL": 3}), "[1]", "{", None, "  " + json.dumps({"slowSQL": {"otherThreads": {"x": [1, 1]}}})]
    rows = session.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, json string")
    wanted = slowsql.statements(docs.parse(rows, "slowSQL"), ["k"])
    found = session.sql("""SELECT k, e.* FROM (SELECT k, slow_sql_entries(json) AS entries FROM {rows})
                           LATERAL VIEW OUTER inline(entries) e WHERE e.thread IS NOT NULL""", rows=rows)
    assert sorted(map(str, map(tuple, found.select(wanted.columns).collect()))) == sorted(map(str, map(tuple, wanted.collect()))) and found.count() == 6
    plan = session.sql("SELECT k, e.* FROM (SELECT k, slow_sql_entries(json) AS entries FROM {rows}) LATERAL VIEW OUTER inline(entries) e", rows=rows)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1 and "Join" not in text and "Exchange" not in text
