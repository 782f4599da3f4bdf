"""Accepted and rejected lines, and one file from many tasks."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from fieldlens.sources import delimited
from fieldlens.sources import submissions as store

SCHEMA = "name string, n bigint, x double"
LINES = {
    "a\t1\t2.5": ("a", 1, 2.5), "b\t\t": ("b", None, None), "\t\t": (None, None, None), '"q\tr"\t3\t1e3': ("q\tr", 3, 1000.0), "é 😀\t-4\t0": ("é 😀", -4, 0.0),
    "c\t1": "fields", "c\t1\t2\t3": "fields", "c": "fields", "": "empty", "  ": "empty", "c\tone\t2": "value: n", "c\t1\ttwo": "value: x", "c\tone\ttwo": "value: n",
    "c\t1.5\t2": "value: n", "c\t9223372036854775808\t2": "value: n",
}


def lines(spark, some):
    return spark.createDataFrame([(x,) for x in some], "value string")


def test_every_line_is_accepted_or_rejected(spark):
    checked = delimited.check_lines(lines(spark, LINES), SCHEMA)
    good, bad = delimited.accepted(checked), delimited.rejected(checked)
    assert good.columns == ["name", "n", "x"] and bad.columns == ["reason", "line"]
    assert sorted(map(str, map(tuple, good.collect()))) == sorted(str(v) for v in LINES.values() if isinstance(v, tuple))
    assert {r["line"]: r["reason"] for r in bad.collect()} == {k: v for k, v in LINES.items() if isinstance(v, str)}
    assert good.count() + bad.count() == len(LINES)


def test_the_columns_asked_for_do_not_decide_what_is_rejected(spark):
    checked = delimited.check_lines(lines(spark, LINES), SCHEMA)
    n = sum(isinstance(v, tuple) for v in LINES.values())
    for columns in (["name"], ["x"], ["n"]):
        assert len(delimited.accepted(checked).select(*columns).collect()) == n
    assert delimited.rejected(checked).select("reason").distinct().count() == 4


def test_header_and_missing_marks(spark):
    some = ["name\tn\tx", "a\t1\tNA", '"name"\t"n"\t"x"', "NA\tNA\t2"]
    checked = delimited.check_lines(lines(spark, some), SCHEMA, header=True, missing="NA")
    assert sorted(map(str, map(tuple, delimited.accepted(checked).collect()))) == sorted(map(str, [("a", 1, None), (None, None, 2.0)]))
    assert delimited.rejected(checked).count() == 0


def test_rejects_are_kept_by_kind(spark, tmp_path):
    path, rejects = str(tmp_path / "in"), str(tmp_path / "rejects")
    lines(spark, LINES).write.text(path)
    good = delimited.split_rejected(spark, path, SCHEMA, rejects)
    back = spark.read.parquet(rejects)
    assert good.count() + back.count() == len(LINES)
    assert {r["kind"] for r in back.select("kind").distinct().collect()} == {"fields", "empty", "value"}
    none = str(tmp_path / "none")
    lines(spark, []).write.text(none)
    assert delimited.split_rejected(spark, none, SCHEMA, str(tmp_path / "no-rejects")).collect() == []


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_one_file_equals_that_of_one_task(spark, tmp_path, compression):
    rows = spark.range(0, 5000, 1, 7).select("id", F.concat(F.lit('say "'), "id", F.lit("\", é")).alias("text"), F.when(F.col("id") % 3 == 0, F.lit("x")).alias("gap"))
    name = "report.csv" + ".gz" * (compression == "gzip")
    path, whole = str(tmp_path / "out" / name), str(tmp_path / "whole")
    delimited.write_single_file(rows, path, header=True, compression=compression)
    store.write_delimited(rows, whole, header=True, single_file=True)
    expected = b"".join(open(os.path.join(whole, f), "rb").read() for f in sorted(os.listdir(whole)) if f.startswith("part-"))
    found = open(path, "rb").read()
    assert (gzip.decompress(found) if compression == "gzip" else found) == expected
    assert [f for f in os.listdir(tmp_path / "out") if not f.startswith(".")] == [name]
    back = store.read_delimited(spark, path, "id bigint, text string, gap string", ",", header=True)
    assert back.count() == 5000
    with pytest.raises(FileExistsError):
        delimited.write_single_file(rows, path)


def test_a_file_without_rows(spark, tmp_path):
    path = str(tmp_path / "empty.tsv")
    delimited.write_single_file(spark.range(0).select("id"), path, sep="\t", header=True)
    assert open(path).read() == "id\n"
