"""States kept by day: months equal one pass, a day run again replaces itself only, the view prunes directories."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import histograms
from fieldlens.plans import jobs, kept
from fieldlens.sources import submissions as store
from fieldlens.testbed import data

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
DAY = "20240110"


def files(path):
    return {os.path.join(top, f): os.path.getmtime(os.path.join(top, f)) for top, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def rows(spark):
    return data.submissions(spark, SF_DIR).persist()


@pytest.fixture()
def path(spark, rows, tmp_path):
    where = str(tmp_path / "states")
    kept.update(rows.where((F.col("d") != DAY) | (F.length("json") % 3 == 0)), data.ALL_PRODUCTS, where)
    return where


def as_text(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(*columns).collect()))


def test_a_day_run_again_replaces_its_state_only(spark, rows, path):
    before = files(path)
    kept.update(store.in_date_range(rows, DAY, DAY), data.ALL_PRODUCTS, path)
    after = files(path)
    others = {f: t for f, t in before.items() if DAY not in f}
    assert others and others == {f: t for f, t in after.items() if DAY not in f}
    assert {f for f in before if DAY in f}.isdisjoint(after)
    daily = kept.totals(kept.read_states(spark, path), by=["month", "d"]).drop("month")
    assert as_text(daily) == as_text(jobs.daily_aggregates(rows, data.ALL_PRODUCTS))


def test_months_equal_one_pass_over_all_documents(spark, rows, path):
    kept.update(store.in_date_range(rows, DAY, DAY), data.ALL_PRODUCTS, path)
    kept.create_view(spark, path, "months")
    whole = jobs.histogram_rows(rows, data.ALL_PRODUCTS).withColumn("d", F.substring("d", 1, 6))
    wanted = histograms.daily_totals(whole).withColumnRenamed("d", "month")
    assert as_text(spark.table("months")) == as_text(wanted)
    made = [json.loads(r["agg_json"]) for r in kept.documents(kept.read_states(spark, path)).collect()]
    again = [json.loads(r["agg_json"]) for r in histograms.aggregate_documents(histograms.daily_totals(whole)).collect()]
    assert sorted(map(json.dumps, made)) == sorted(map(json.dumps, again)) and {m["date"] for m in made} == {"202401"}


def test_the_view_sees_later_days_and_prunes(spark, rows, path):
    kept.create_view(spark, path, "months")
    before = spark.table("months").agg(F.sum("sum_count")).first()[0]
    kept.update(rows.where("d = '20240111' and length(json) % 3 = 0"), data.ALL_PRODUCTS, path)
    kept.create_view(spark, path, "months")
    assert spark.table("months").agg(F.sum("sum_count")).first()[0] < before
    plan = spark.sql("SELECT * FROM months WHERE month = '202401' AND product = 'Surf'")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("202401" in line.split("PartitionFilters:")[1] and "EqualTo(product,Surf)" in line for line in scans)


def test_sums_beyond_64_bits_merge_exactly(spark, rows, tmp_path):
    where = str(tmp_path / "large")
    entries = jobs.histogram_rows(rows, data.ALL_PRODUCTS).where("sum > 0").withColumn("sum", F.lit(2**62))
    kept.states(entries).write.partitionBy("month", "d").parquet(where)
    found = kept.merged(kept.read_states(spark, where), []).where("v is null and hist_name_doc_count > 2").collect()
    assert found and all(int(r["hist_name_sum"]) == r["hist_name_doc_count"] * 2**62 for r in found)
    assert kept.totals(kept.read_states(spark, where), []).where("hist_name_doc_count > 2 and hist_name_sum is not null").count() == 0
    assert kept.totals(kept.read_states(spark, where).limit(0)).collect() == []
