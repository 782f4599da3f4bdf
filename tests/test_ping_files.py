"""Saved pings as files of one ping each: none is lost, whatever the number of files, and what a failed job leaves is not read."""

from __future__ import annotations

import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from fieldlens.session import small_files
from fieldlens.sources import submissions as store
from fieldlens.testbed import queries
from tests.test_lean import events


def numbered(spark, n, tasks=3):
    return spark.range(n, numPartitions=tasks).select(F.concat(F.lit('{"payload": "p'), "id", F.lit('"}')).alias("value"))


def payloads(spark, path):
    return sorted(r.json for r in store.read_ping_payloads(spark, path).collect())


def processes() -> int:
    """Processes and threads that were started on this machine so far."""
    with open("/proc/stat") as lines:
        return next(int(line.split()[1]) for line in lines if line.startswith("processes "))


@pytest.mark.skipif(not os.path.exists("/proc/stat"), reason="counts processes as Linux does")
def test_no_process_for_each_file(spark, tmp_path):
    store.write_ping_files(numbered(spark, 10), f"{tmp_path}/first")
    before = processes()
    store.write_ping_files(numbered(spark, 2000), f"{tmp_path}/pings")
    assert processes() - before < 1000
    assert payloads(spark, f"{tmp_path}/pings") == sorted(f"p{i}" for i in range(2000))


def test_many_small_files_share_a_task(spark, tmp_path):
    store.write_ping_files(numbered(spark, 2000), f"{tmp_path}/pings")
    files = store.read_ping_payloads(spark, f"{tmp_path}/pings")
    with small_files(spark):
        few = store.read_ping_payloads(spark, f"{tmp_path}/pings").rdd.getNumPartitions()
    assert few <= 2 * spark.sparkContext.defaultParallelism < files.rdd.getNumPartitions()


def test_documents_are_not_built_where_events_are_read(spark, tmp_path, monkeypatch):
    seen, write = [], store.write_ping_files
    monkeypatch.setattr(store, "write_ping_files", lambda pings, path: (seen.append(pings), write(pings, path)))
    assert queries.REGISTRY["saved_ping_files"](spark, events(spark, tmp_path)).count() == 39  # one has no document
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "simpleMeasurements" not in plan.split("RepartitionByExpression")[1]


def test_files_hold_what_the_rows_hold(spark, tmp_path):
    values = ["", "{", None, "ä\n€\U0001f600", '{"payload":\n "x"}', '{"payload":\n "x"}']
    path = f"{tmp_path}/with blank %20"
    store.write_ping_files(spark.createDataFrame([(v,) for v in values], "value string").repartition(4), path)
    files = [open(f, "rb").read() for f in glob.glob(f"{glob.escape(path)}/folder=*/part-*")]
    assert sorted(files) == sorted(f"{v or ''}\n".encode() for v in values)
    assert os.path.exists(f"{path}/_SUCCESS") and not os.path.exists(f"{path}/_temporary")
    assert payloads(spark, path) == ["x", "x"]


def test_no_pings(spark, tmp_path):
    store.write_ping_files(numbered(spark, 0), f"{tmp_path}/pings")
    assert payloads(spark, f"{tmp_path}/pings") == []


def test_a_failed_job_leaves_no_pings(spark, tmp_path):
    bad = numbered(spark, 50).withColumn("value", F.when(F.col("value").contains("p49"), F.raise_error(F.lit("bad"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="bad"):
        store.write_ping_files(bad, f"{tmp_path}/pings")
    assert not [f for f in glob.glob(f"{tmp_path}/pings/**", recursive=True) if "part-" in f or "_SUCCESS" in f]


def test_a_folder_that_is_there_is_an_error(spark, tmp_path):
    store.write_ping_files(numbered(spark, 3), f"{tmp_path}/pings")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.write_ping_files(numbered(spark, 3), f"{tmp_path}/pings")
    assert payloads(spark, f"{tmp_path}/pings") == ["p0", "p1", "p2"]


def test_compressed_files_beside_others(spark, tmp_path):
    whole = [json.dumps({"payload": f"p{i}"}, indent=1) for i in range(4)]
    (tmp_path / "below").mkdir()
    for name, text in (("a", whole[0].encode()), ("b.gz", gzip.compress(whole[1].encode())), ("below/c.txt", whole[2].encode()), ("below/d.gz", gzip.compress(whole[3].encode())), ("gz", b"{"), ("_hidden", whole[0].encode())):
        (tmp_path / name).write_bytes(text)
    assert payloads(spark, str(tmp_path)) == ["p0", "p1", "p2", "p3"]


def test_stores_other_than_a_disk(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pings.link./in", f"file://{tmp_path}")
    store.write_ping_files(numbered(spark, 5), "viewfs://pings/in/pings")
    assert len(glob.glob(f"{tmp_path}/pings/folder=*/part-*")) == 5
    assert payloads(spark, "viewfs://pings/in/pings") == [f"p{i}" for i in range(5)]


@pytest.mark.parametrize("n", [0, 3, 700])
def test_folders_are_read_in_turn(spark, tmp_path, n):
    store.write_ping_files(numbered(spark, n, 7), f"{tmp_path}/pings")
    seen = []
    rows = store.stage_pings(spark, f"{tmp_path}/pings", lambda p: (seen.append(p.count()), p.select("json"))[1])
    assert sorted(r.json for r in rows.collect()) == sorted(f"p{i}" for i in range(n))
    assert sum(seen) == n and max(seen) <= 200
