"""Quantile sketches that are kept by day and merged over any range of days, without the documents.

A stored row is one day's state of a group: its rows, the sum of its run counts and a KLL sketch of the average
times. Sketches are built with partial aggregation, so a hot group is sketched where its rows lie and only
sketches are shuffled; merging them again reads a few kilobytes per group and day. A day written again replaces
its own state and no other's.

The sketch keeps the least and the greatest value exactly, and all values while there are no more than about its
size. Beyond that a quantile's rank is off by a random share; :func:`rank_error` states the bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.slowsql import REPORT_KEYS, with_average
from fieldlens.schema import SLOW_SQL_QUANTILES
from fieldlens.session import stage

SIZE = 400
STATES = "doc_count bigint, sum_count decimal(38,0), n bigint, sketch binary"
RANGE_KEYS = [k for k in REPORT_KEYS if k != "d"]


def rank_error(size: int = SIZE, deviations: float = 3.0) -> float:
    """Share of the rows by which a quantile's rank may be off.

    ``2.296 / size ** 0.9723`` is the published single-sided error of a sketch of this size at 99 % confidence
    (fixed values); ``deviations`` times that leaves no practical chance of more.
    """
    return deviations * 2.296 / size**0.9723


def _value(value: str):
    return F.when(~F.isnan(value), F.col(value))


def sketch_values(rows: DataFrame, keys: Sequence[str], value: str, count: str, size: int = SIZE) -> DataFrame:
    """One state per group: rows, summed ``count``, rows with a value, and the sketch of ``value`` (NULL without any).

    NaN counts as no value. Sums are exact beyond 64 bits.
    """
    return rows.groupBy(*keys).agg(
        F.count("*").alias("doc_count"), F.sum(F.col(count).cast("decimal(28,0)")).alias("sum_count"), F.count(_value(value)).alias("n"),
        F.kll_sketch_agg_double(_value(value), F.lit(size)).alias("sketch"),
    )


def merge_states(states: DataFrame, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """States of coarser groups, from states alone."""
    return states.groupBy(*keys).agg(
        F.sum("doc_count").alias("doc_count"), F.sum("sum_count").cast("decimal(38,0)").alias("sum_count"), F.sum("n").alias("n"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch")), F.lit(size)).alias("sketch"),
    )


def read_quantiles(states: DataFrame, keys: Sequence[str], quantiles: Mapping[str, tuple[int, int]] = SLOW_SQL_QUANTILES) -> DataFrame:
    """The quantiles of each state; NULL where a group has no value."""
    at = lambda p: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p[0] / p[1])))
    return states.select(*keys, "doc_count", "sum_count", "n", *[at(p).alias(name) for name, p in quantiles.items()])


def write_daily_states(statements: DataFrame, path: str, size: int = SIZE) -> None:
    """Sketch the average times of statement rows by day and statement; only the days present are replaced."""
    states = sketch_values(with_average(statements), REPORT_KEYS, "avg_time", "count", size)
    (
        states.select(*RANGE_KEYS, "doc_count", F.col("sum_count").cast("decimal(38,0)"), "n", "sketch", "d").hint("rebalance", "d")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(path)
    )


def read_daily_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{k} string" for k in RANGE_KEYS) + f", {STATES}, d string").parquet(path)


def merged_report(states: DataFrame, start: str, end: str, min_docs: int = 0, keys: Sequence[str] = RANGE_KEYS,
                  quantiles: Mapping[str, tuple[int, int]] = SLOW_SQL_QUANTILES, size: int = SIZE) -> DataFrame:
    """The slow statement report of the days ``start`` to ``end``, merged from their stored states.

    Only the directories of those days are read. Statements of up to ``min_docs`` rows in the range are left out.
    """
    merged = merge_states(states.where(F.col("d").between(start, end)), keys, size)
    return read_quantiles(merged.where(F.col("doc_count") > min_docs), keys, quantiles)


def rank_errors(rows: DataFrame, report: DataFrame, keys: Sequence[str], value: str,
                quantiles: Mapping[str, tuple[int, int]] = SLOW_SQL_QUANTILES) -> DataFrame:
    """How far each reported quantile's rank is from the one asked for: keys, quantile, off (share of the group's rows).

    Rows shrink to distinct values with counts before they meet the report. A value stands for all ranks of
    the rows that have it, so ``off`` is 0 where the wanted rank lies among these.
    """
    asked = [F.struct(F.lit(name).alias("quantile"), F.lit(p[0] / p[1]).alias("p"), F.col(name).alias("estimate")) for name, p in quantiles.items()]
    wanted = stage(report.where("n > 0").select(F.struct(*keys).alias("_group"), "n", F.inline(F.array(*asked))), "estimates")
    counts = rows.where(_value(value).isNotNull()).groupBy(F.struct(*keys).alias("_group"), F.col(value).alias("_value")).agg(F.count("*").alias("_count"))
    joined = counts.join(wanted, "_group")
    ranks = joined.groupBy("_group", "quantile").agg(
        F.first("p").alias("p"), F.first("n").alias("n"),
        F.sum(F.when(F.col("_value") < F.col("estimate"), F.col("_count")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("_value") <= F.col("estimate"), F.col("_count")).otherwise(0)).alias("through"),
    )
    off = F.greatest(F.lit(0.0), F.col("below") / F.col("n") - F.col("p"), F.col("p") - F.col("through") / F.col("n"))
    return ranks.select("_group.*", "quantile", off.alias("off"))
