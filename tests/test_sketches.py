"""States kept by day: replaced alone, merged without the rows, within the stated rank error."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from fieldlens.operators import sketches

NAMES = ["q0", "q25", "q50", "q75", "q95", "q100"]


def statements(spark, days=("20240101", "20240102", "20240103"), n=3000, seed=1):
    rule = random.Random(seed)
    rows = [("mainThread", d, "P", "1", "beta", f"S{0 if rule.random() < 0.6 else rule.randint(1, 40)}", rule.choice([0, 1, 2, 3]), rule.randint(1, 10**6))
            for d in days for _ in range(n)]
    return spark.createDataFrame(rows, "thread string, d string, product string, product_version string, product_channel string, sql string, count bigint, t bigint")


def files(path):
    return {os.path.join(top, f): os.path.getmtime(os.path.join(top, f)) for top, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merged_ranges_stay_within_the_bound(spark, tmp_path):
    path, rows = str(tmp_path / "states"), statements(spark).persist()
    sketches.write_daily_states(rows, path)
    report = sketches.merged_report(sketches.read_daily_states(spark, path), "20240102", "20240103").persist()
    wanted = rows.where("d >= '20240102'").withColumn("a", F.try_divide("t", "count")).groupBy("sql").agg(
        F.count("*").alias("docs"), F.sum("count").alias("runs"), F.count("a").alias("n"), F.min("a").alias("least"), F.max("a").alias("most"))
    found = {r["sql"]: (r["doc_count"], int(r["sum_count"]), r["n"], r["q0"], r["q100"]) for r in report.collect()}
    assert found == {r["sql"]: tuple(r)[1:] for r in wanted.collect()}
    averaged = rows.where("d >= '20240102'").withColumn("avg_time", F.try_divide("t", "count"))
    off = sketches.rank_errors(averaged, report, ["sql"], "avg_time").collect()
    assert len(off) == 6 * len(found) and max(r["off"] for r in off) <= sketches.rank_error()
    exact = [r["off"] for r in off if found[r["sql"]][2] <= 200]
    assert exact and max(exact) < 0.01  # few values are all kept


def test_a_day_written_again_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "states")
    sketches.write_daily_states(statements(spark), path)
    before = files(path)
    sketches.write_daily_states(statements(spark, ["20240102"], n=10, seed=2), path)
    after = files(path)
    assert {f for f in before if "20240102" not in f} == {f for f in after if "20240102" not in f}
    assert all(before[f] == after[f] for f in after if "20240102" not in f)
    assert not {f for f in before if "20240102" in f} & set(after)
    states = sketches.read_daily_states(spark, path)
    assert {r["d"]: r["s"] for r in states.groupBy("d").agg(F.sum("doc_count").alias("s")).collect()} == {"20240101": 3000, "20240102": 10, "20240103": 3000}
    plan = sketches.merged_report(states, "20240102", "20240103")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and plan.count("FileScan") == 1


def test_groups_without_values_and_large_sums(spark, tmp_path):
    path = str(tmp_path / "states")
    rows = spark.createDataFrame(
        [("otherThreads", "20240101", None, "1", None, None, 0, 5), ("otherThreads", "20240101", None, "1", None, None, None, None),
         *[("mainThread", "20240101", "P", "1", "beta", "x", 2**62, 2**62)] * 3, ("mainThread", "20240102", "P", "1", "beta", "x", 5, 0)], statements(spark, n=1).schema)
    sketches.write_daily_states(rows, path)
    report = {r["sql"]: r for r in sketches.merged_report(sketches.read_daily_states(spark, path), "20240101", "20240102").collect()}
    assert report[None]["n"] == 0 and [report[None][q] for q in NAMES] == [None] * 6 and report[None]["doc_count"] == 2
    assert int(report["x"]["sum_count"]) == 3 * 2**62 + 5 and report["x"]["q0"] == 0.0 and report["x"]["q100"] == 1.0
    nothing = sketches.merged_report(sketches.read_daily_states(spark, path), "20250101", "20250102")
    assert nothing.collect() == []


def test_nan_is_no_value(spark):
    rows = spark.createDataFrame([("a", float("nan"), 1), ("a", 2.0, 1), ("b", float("nan"), 1)], "g string, v double, c int")
    found = {r["g"]: r for r in sketches.read_quantiles(sketches.sketch_values(rows, ["g"], "v", "c"), ["g"]).collect()}
    assert found["a"]["n"] == 1 and found["a"]["q50"] == 2.0 and found["b"]["n"] == 0 and found["b"]["q50"] is None
