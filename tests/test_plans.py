"""What the plans must look like at scale."""

from __future__ import annotations

import os

import pytest

from fieldlens.functions import documents as docs
from fieldlens.operators.histograms import combined_totals
from fieldlens.plans import jobs, tables
from fieldlens.schema import DEFAULT_REASONS
from fieldlens.session import drop_staged, stage
from fieldlens.sources import submissions as store
from fieldlens.testbed import data

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "store")
    store.write_store(data.submissions(spark, SF_DIR), path)
    return store.in_date_range(store.read_store(spark, path), "20240103", "20240105")


def test_daily_aggregates_parse_once_and_shuffle_totals_only(spark, stored):
    text = plan(combined_totals(jobs.histogram_rows(stored, data.ALL_PRODUCTS)))
    assert text.count("from_json") == 1 and text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text.split("Exchange hashpartitioning")[1]
    joined = plan(jobs.daily_aggregates(stored, data.ALL_PRODUCTS))
    assert "Window" not in joined and "from_json" not in joined
    assert "PartitionFilters: [isnotnull(d" in text


def test_the_text_is_not_carried_beside_its_parts(spark, stored):
    text = plan(jobs.count_by_version(stored, [data.DESKTOP]))
    assert text.count("from_json") == 1
    assert not [line for line in text.splitlines() if "Generate" in line and "json#" in line.split("_row")[0].replace("from_json", "")]
    union = plan(store.export_union(store.export_buckets(stored)))
    assert union.count("from_json") == 1 and union.count("FileScan") == 1


def test_filters_do_not_parse_again(spark, stored):
    text = plan(jobs.flash_versions(stored, [data.DESKTOP], os="WINNT"))
    assert text.count("from_json") == 1
    adhoc = plan(jobs.adhoc_query(stored, "20240103", "20240104", [("firstPaint", None, ">", 10), ("OS", None, "=", "WINNT")]))
    assert adhoc.count("parseJson") == 1


def test_rewriting_documents_needs_no_shuffle(spark, stored):
    validated = plan(jobs.validate_submissions(stored, data.specification(spark)))
    assert "Exchange hashpartitioning" not in validated.split("Subquery")[0] and "BroadcastHashJoin" in validated
    assert "Exchange" not in plan(jobs.scrub_submissions(stored))


def test_hang_filter_reads_stored_rows_without_a_shuffle(spark, stored):
    assert "Exchange" not in plan(jobs.hang_submissions(stored))


def test_stored_tables_take_filters_into_the_scan(spark, tmp_path):
    path = str(tmp_path / "tables")
    rows = data.submissions(spark, SF_DIR)
    tables.write_tables(rows, path)
    docs = tables.read_table(spark, path, "docs")
    out = tables.flash_versions(docs.where("d between '20240103' and '20240105'"), [data.DESKTOP], DEFAULT_REASONS, "WINNT")
    text = plan(out)
    assert "EqualTo(os,WINNT)" in text and "PartitionFilters: [isnotnull(d" in text and "json" not in text
    whole = tables.flash_versions(docs, [data.DESKTOP], DEFAULT_REASONS, "WINNT")
    direct = jobs.flash_versions(rows, [data.DESKTOP], os="WINNT")
    assert sorted(map(str, whole.collect())) == sorted(map(str, direct.collect()))
    stored = tables.read_table(spark, path, "slow_sql").drop("k").select("thread", "sql", "count", "t", "d")
    made = jobs.slow_sql_rows(rows).select("thread", "sql", "count", "t", "d")
    assert sorted(map(str, stored.collect())) == sorted(map(str, made.collect()))


def test_staged_files_can_be_dropped(spark):
    staged = stage(spark.range(3), "gone")
    assert staged.count() == 3
    folder = staged.inputFiles()[0].split(":")[-1].replace("//", "/").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    drop_staged(spark)
    assert not os.path.isdir(folder)


def test_stored_variants_are_read_by_path(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "variants")
    rows = data.submissions(spark, SF_DIR)
    tables.write_variants(rows, path)
    stored = tables.read_variants(spark, path)
    text = plan(docs.select_fields(stored.where("d between '20240103' and '20240105'"), ["info.OS", "ver"]))
    assert "doc:struct<0:string,1:string>" in text and "parse_json" not in text and "PartitionFilters: [isnotnull(d" in text

    def column_bytes(wanted):
        total = 0
        for name in stored.inputFiles():
            meta = pq.ParquetFile(name.removeprefix("file:").replace("///", "/")).metadata
            for group in range(meta.num_row_groups):
                chunks = [meta.row_group(group).column(c) for c in range(meta.num_columns)]
                total += sum(c.total_compressed_size for c in chunks if wanted(c.path_in_schema))
        return total

    # What a query of one field has to read: its own columns and what holds fields that have none.
    one = column_bytes(lambda p: p.startswith("doc.typed_value.info.typed_value.OS.") or p in ("doc.metadata", "doc.value", "doc.typed_value.info.value"))
    assert one * 3 < column_bytes(lambda p: True)
    whole = docs.parse_whole(rows)
    fields = ["info.OS", "simpleMeasurements.js", "histograms.PAUSE_MS", "ver"]
    assert sorted(map(str, docs.select_fields(stored, fields).collect())) == sorted(map(str, docs.select_fields(whole, fields).collect()))
    odd = spark.createDataFrame([("s20240101x", "20240101", t) for t in ("[1]", "3", "{", None, '{"a":1,"a":2}', '{"info":"x"}')], "k string, d string, json string")
    tables.write_variants(odd, path)
    found = [r[0] for r in tables.read_variants(spark, path).where("d = '20240101'").select(docs.get("a", "int").alias("a")).collect()]
    assert len(found) == 6 and [a for a in found if a is not None] == [2]
