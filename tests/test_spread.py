"""Work that must not gather in one task, in the driver or in 64 bits, whatever the layout of the tables."""

from __future__ import annotations

import glob
import hashlib

from pyspark.sql import functions as F

from fieldlens.operators import slowsql
from fieldlens.plans import jobs
from fieldlens.sources import submissions as store
from fieldlens.testbed import data, queries


def events(spark, n, day="2024-01-05"):
    return spark.range(n, numPartitions=4).select(
        F.col("id").alias("event_id"), F.lit(f"{day} 10:00:00").cast("timestamp").alias("ts"), (F.col("id") % 50).alias("user_id"),
        F.lit("view").alias("event_type"), (F.col("id") % 900 / 10).alias("value"), F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props"))


def test_a_large_row_group_is_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(data, "EVENTS_PER_TASK", 100, raising=False)
    cores = spark.sparkContext.defaultParallelism
    rows = events(spark, 4000)
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    for k in range(2 * cores):  # more pieces than cores, of which one has nearly all rows
        rows.limit(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", 128 << 20)
    try:
        facts = data.facts(spark, str(tmp_path))
        assert max(r[1] for r in facts.groupBy(F.spark_partition_id()).count().collect()) < 200
        assert facts.count() == 4000 + 2 * cores
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_repeated_and_missing_ids_are_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(data, "EVENTS_PER_TASK", 100, raising=False)
    events(spark, 2000).withColumn("event_id", F.lit(None).cast("bigint")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    facts = data.facts(spark, str(tmp_path))
    assert max(r[1] for r in facts.groupBy(F.spark_partition_id()).count().collect()) < 1000


def test_digests_beyond_64_bits(spark, tmp_path):
    events(spark, 80_000).write.parquet(f"{tmp_path}/events.parquet")
    found = {r.sink: r for r in queries.REGISTRY["delimited_sink"](spark, str(tmp_path)).collect()}
    assert found["tab"].n == 80_000 and found["tab"].digest is None and found["single"].digest is not None
    rows = store.decode_keys(data.submissions(spark, str(tmp_path))).select("k", "d", "uuid").collect()
    wanted = sum(int(hashlib.md5("|".join(r).encode()).hexdigest()[:12], 16) for r in rows)
    whole = {r.sink: r.digest for r in queries.REGISTRY["delimited_sink_digests"](spark, str(tmp_path)).collect()}
    assert wanted >= 1 << 63 and [whole[s] for s in ("comma", "control-a", "tab")] == [str(wanted)] * 3
    assert whole["single"] == str(found["single"].digest)


def test_ping_files_lie_in_a_folder_per_task(spark, tmp_path):
    pings = spark.range(20, numPartitions=3).select(F.concat(F.lit('{"payload": "p'), "id", F.lit('"}')).alias("value"))
    store.write_ping_files(pings, f"{tmp_path}/pings")
    files = glob.glob(f"{tmp_path}/pings/*/part-*")
    assert len(files) == 20 and len({f.rsplit("/", 1)[0] for f in files}) == 3 and not glob.glob(f"{tmp_path}/pings/*/.*.crc")
    back = store.read_ping_payloads(spark, f"{tmp_path}/pings")
    assert back.columns == ["k", "json"] and sorted(r.json for r in back.collect()) == sorted(f"p{i}" for i in range(20))


def test_statements_are_read_from_documents_once(spark, tmp_path):
    events(spark, 50).write.parquet(f"{tmp_path}/events.parquet")
    report = slowsql.selected_report(jobs.slow_sql_rows(data.submissions(spark, str(tmp_path))))
    assert "from_json" not in report._jdf.queryExecution().optimizedPlan().toString()
    assert report.count() > 0
