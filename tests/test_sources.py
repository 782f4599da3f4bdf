from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from fieldlens.plans import jobs
from fieldlens.session import fresh_path, shared_dir, stage
from fieldlens.sources import catalog
from fieldlens.sources import submissions as store
from tests.test_histograms import frame, histogram


def keyed(spark, days, per_day=3):
    rows = [(f"s{d}{i:036d}", d, json.dumps({"i": i, "t": "a\tb"})) for d in days for i in range(per_day)]
    return spark.createDataFrame(rows, "k string, d string, json string")


def same(a, b):
    columns = sorted(a.columns)
    return sorted(map(str, a.select(*columns).collect())) == sorted(map(str, b.select(*columns).collect()))


def test_store_by_day_prunes_and_rewrites_single_days(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = keyed(spark, ["20240101", "20240102", "20240103"])
    store.write_store(rows, path)
    assert same(store.read_store(spark, path), rows)
    changed = rows.where("d = '20240102'").limit(1)
    store.write_store(changed, path)
    store.write_store(changed, path)
    assert store.read_store(spark, path).groupBy("d").count().orderBy("d").collect() == [("20240101", 3), ("20240102", 1), ("20240103", 3)]
    ranged = store.in_date_range(store.read_store(spark, path), "20240102", "20240103")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and ranged.count() == 4


@pytest.mark.parametrize("write, read", [
    (store.write_archive, store.read_archive), (store.write_sequence_archive, store.read_sequence_archive),
])
def test_archives(spark, tmp_path, write, read):
    rows = keyed(spark, ["20240101", "20240105"])
    write(rows, str(tmp_path / "a"))
    assert same(read(spark, str(tmp_path / "a")), rows)


def test_key_json_lines_split_at_the_first_tab(spark, tmp_path):
    (tmp_path / "x.txt").write_text('k1\t{"a":"b\\tc"}\nk2\tp\tq\nno tab here\n')
    rows = store.read_key_json_lines(spark, str(tmp_path / "x.txt")).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("k1", '{"a":"b\\tc"}'), ("k2", "p\tq")]


def test_ping_files(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"ping{i}").write_text(json.dumps({"slug": "s", "payload": json.dumps({"i": i})}, indent=1))
    (tmp_path / "broken").write_text("{")
    rows = store.read_ping_payloads(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == [("dummy", '{"i": 0}'), ("dummy", '{"i": 1}')]


def test_ping_lines(spark, tmp_path):
    pings = [json.dumps({"slug": "s", "payload": json.dumps({"i": i}, indent=1)}) for i in range(3)]
    (tmp_path / "pings").write_text("\n".join([*pings, "{"]))
    rows = store.read_ping_payloads(spark, str(tmp_path), lines=True).collect()
    assert sorted(tuple(r) for r in rows) == [("dummy", json.dumps({"i": i}, indent=1)) for i in range(3)]


def test_overlay(spark):
    base = keyed(spark, ["20240101"], 3)
    first = base.orderBy("k").first().k
    new = "s20240109" + "9" * 36
    updates = spark.createDataFrame([(first, "new"), (new, "added"), (new, "adde")], "k string, json string")
    out = {r.k: (r.d, r.json) for r in store.overlay(base, updates).collect()}
    assert len(out) == 4 and out[first] == ("20240101", "new") and out[new] == ("20240109", "added")


def test_upsert_reads_and_replaces_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "s")
    store.write_store(keyed(spark, ["20240101", "20240102"], 3), path)
    untouched = glob.glob(path + "/d=20240101/*.parquet")
    first = store.read_store(spark, path).where("d = '20240102'").orderBy("k").first().k
    updates = spark.createDataFrame([(first, "new")], "k string, json string")
    text = store.overlay(store.read_store(spark, path), updates)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in text or "PartitionFilters: [d" in text
    store.upsert(spark, path, updates)
    assert glob.glob(path + "/d=20240101/*.parquet") == untouched
    out = {r.k: r.json for r in store.read_store(spark, path).collect()}
    assert len(out) == 6 and out[first] == "new"


def test_ordered_write_covers_the_key_range_in_order(spark, tmp_path):
    store.write_ordered(keyed(spark, ["20240101"], 200), str(tmp_path / "o"), 4)
    files = sorted(glob.glob(str(tmp_path / "o" / "*.parquet")))
    keys = [[r.k for r in spark.read.parquet(f).select("k").collect()] for f in files]
    assert all(k == sorted(k) for k in keys) and sum(keys, []) == sorted(sum(keys, []))


@pytest.mark.parametrize("options", [{"sep": ","}, {"sep": "\x01"}, {"sep": "\t", "header": True}])
def test_delimited(spark, tmp_path, options):
    rows = spark.createDataFrame([("a,b", 1), ('say "x"', 2), ("t\tu", 3)], "s string, n int")
    path = str(tmp_path / "d")
    store.write_delimited(rows, path, compression="gzip", single_file=True, **options)
    assert len(glob.glob(path + "/*.csv.gz")) == 1
    back = store.read_delimited(spark, path, "s string, n int", options["sep"], options.get("header", False))
    assert same(back.select("n"), rows.select("n"))


def test_json_payloads_in_tab_files_stay_as_they_are(spark, tmp_path):
    rows = keyed(spark, ["20240101"]).select("k", F.lit('{"a":"b c"}').alias("json"))
    store.write_delimited(rows, str(tmp_path / "j"), sep="\t", quote="")
    text = "".join(open(f).read() for f in glob.glob(str(tmp_path / "j" / "*.csv")))
    assert '\t{"a":"b c"}\n' in text
    assert same(store.read_delimited(spark, str(tmp_path / "j"), "k string, json string", "\t", quote=""), rows)


def test_documents_by_month_and_day(spark, tmp_path):
    rows = spark.createDataFrame([('{"a":1}', "202401", "20240101"), ('{"a":2}', "202401", "20240102"), ('{"a":3}', "202402", "20240201")], "agg_json string, month string, d string")
    for days in ("d <= '20240102'", "d >= '20240102'"):  # a second day in the month, and a day again
        store.write_documents(rows.where(days), str(tmp_path / "m"))
    assert sorted(os.path.basename(p) for p in glob.glob(str(tmp_path / "m" / "month=*"))) == ["month=202401", "month=202402"]
    assert same(store.read_documents(spark, str(tmp_path / "m")).select(F.col("value").alias("agg_json"), "month", "d"), rows)


def test_export_buckets(spark):
    documents = [{"info": {"appUpdateChannel": c} if c else {}} for c in ["nightly", "aurora", "beta", "release", "other", None]]
    full = {r.k: r.bucket for r in store.export_buckets(frame(spark, *documents), 1.0).collect()}
    assert full == {"k0": "prerelease", "k1": "prerelease", "k2": "prerelease", "k3": "release"}
    assert store.export_buckets(frame(spark, *documents), 0.0).where("bucket = 'release'").count() == 0


def test_retention(spark):
    rows = spark.createDataFrame([("agg_valid_202301",), ("agg_202306",), ("agg_202307",), ("other",), ("agg_202313",)], "name string")
    out = {r.name: r.expired for r in catalog.retention(rows, "2023-12-15").collect()}
    assert out == {"agg_valid_202301": True, "agg_202306": True, "agg_202307": False, "other": False, "agg_202313": False}


def test_audit(spark):
    found = spark.createDataFrame([("a", "20240103", 5), ("a", "20240102", 0), ("b", "20240103", 1)], "dataset string, d string, n bigint")
    out = sorted(tuple(r) for r in catalog.audit(found, ["a", "b"], "2024-01-04", 2).collect())
    assert out == [("20240102", "a", "EMPTY"), ("20240102", "b", "MISSING")]


def test_staged_tables_lie_in_the_shared_folder(spark):
    staged = stage(spark.range(5), "t")
    assert staged.count() == 5 and shared_dir(spark).split(":")[-1] in staged.inputFiles()[0]
    assert fresh_path(spark, "t") != fresh_path(spark, "t")


def test_adhoc_query_combines_all_steps(spark):
    documents = [{"info": {"OS": "x"}, "simpleMeasurements": {"m": i}, "histograms": {"H": histogram(values={"1": i})}} for i in range(6)]
    rows = frame(spark, *documents).withColumn("d", F.format_string("2024010%s", F.substring("k", 2, 1)))
    out = jobs.adhoc_query(rows, "20240101", "20240104", [("m", None, ">", 1)], None, ["info.OS", "histograms.H"])
    assert sorted((r.k, r.OS, r.v, r["count"]) for r in out.collect()) == [(f"k{i}", "x", 1, float(i)) for i in (2, 3, 4)]
    assert sorted(r.k for r in jobs.adhoc_query(rows, "20240101", "20240104", [("m", None, ">", 1)]).collect()) == ["k2", "k3", "k4"]


def test_validated_aggregates_follow_validation(spark):
    from tests.test_histograms import dims
    from tests.test_validation import GOOD
    from fieldlens.schema import SPEC_DDL

    spec = spark.createDataFrame([("default", "A", "1", "2", "1", "3", [0, 1])], SPEC_DDL)
    documents = [{"info": dims(), "histograms": {"A": {**GOOD, "bucket_count": 3 + i % 2}}, "simpleMeasurements": {}} for i in range(4)]
    rows = frame(spark, *documents).withColumn("k", F.concat(F.lit("s20240101"), "k"))
    out = {r.is_valid: json.loads(r.agg_json)["histograms"]["A"]["count"] for r in jobs.validated_aggregates(rows, spec, ["P"]).collect()}
    assert out == {0: 2, 1: 2}
