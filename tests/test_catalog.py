"""Retention and completeness from what lies on disk."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from fieldlens.sources import catalog


def test_storage_is_listed_with_rows_and_sizes(spark, tmp_path):
    root = str(tmp_path)
    spark.range(10).withColumn("d", F.lit("20240129")).repartition(3).write.partitionBy("d").parquet(f"{root}/a")
    spark.range(0).coalesce(1).write.parquet(f"{root}/a/d=20240128")
    spark.range(4).write.parquet(f"{root}/b/d=20240130")
    files = catalog.stored_files(spark, root, ["a", "b", "none"])
    found = {(r["dataset"], r["d"]): (r["files"], r["n"]) for r in files.groupBy("dataset", "d").agg(F.count("*").alias("files"), F.sum("n").alias("n")).collect()}
    assert {k: v[1] for k, v in found.items()} == {("a", "20240129"): 10, ("a", "20240128"): 0, ("b", "20240130"): 4} and found[("a", "20240129")][0] == 3
    for row in files.collect():
        assert row["bytes"] == os.path.getsize(row["path"].removeprefix("file:").replace("//", "/"))
    missing = {(r["d"], r["dataset"]): r["status"] for r in catalog.audit_storage(spark, root, ["a", "b", "none"], "2024-01-31", 3).collect()}
    assert missing == {("20240128", "a"): "EMPTY", ("20240130", "a"): "MISSING", ("20240128", "b"): "MISSING", ("20240129", "b"): "MISSING",
                       **{(d, "none"): "MISSING" for d in ("20240128", "20240129", "20240130")}}


def test_nothing_stored(spark, tmp_path):
    assert catalog.stored_files(spark, str(tmp_path / "nowhere"), ["a"]).collect() == []
    assert catalog.audit_storage(spark, str(tmp_path / "nowhere"), ["a"], "2024-01-31", 2).count() == 2
    assert catalog.apply_retention(spark, str(tmp_path / "nowhere"), "2024-01-31").collect() == []


def test_retention_deletes_only_when_told_and_only_old_months(spark, tmp_path):
    for name in ("agg_202301", "agg_202307", "agg_202401", "other", "month=202212"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "data").write_text("x")
    dry = {r["name"]: (r["expired"], r["deleted"]) for r in catalog.apply_retention(spark, str(tmp_path), "2024-01-31").collect()}
    assert dry == {"agg_202301": (True, False), "agg_202307": (True, False), "agg_202401": (False, False), "other": (False, False), "month=202212": (True, False)}
    assert len(os.listdir(tmp_path)) == 5
    done = {r["name"]: r["deleted"] for r in catalog.apply_retention(spark, str(tmp_path), "2024-01-31", dry_run=False).collect()}
    assert done == {name: expired for name, (expired, _) in dry.items()} and sorted(os.listdir(tmp_path)) == ["agg_202401", "other"]
