"""What several operators share: whole-text columns, row numbers and distributed running totals."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.session import stage

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession) -> None:
    """Texts reach Python in batches of a few megabytes, so that two tasks of an executor need little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``; after a task's last batch its worker, which lives on, returns the memory that is free."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return task


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: str = "text") -> Column:
    """The text column; NULL counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rows(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once with a row number, so that equal rows can be told apart; and that column's name."""
    row = fresh(df, "row")
    return stage(df.withColumn(row, F.monotonically_increasing_id()), name), row


def total_before(df: DataFrame, order: Sequence[Column], amounts: dict[str, Column], name: str) -> DataFrame:
    """Adds, for each entry of ``amounts``, its sum over all rows that come earlier in ``order``.

    ``order`` must tell rows apart. Rows are cut into ranges and written with their range's number;
    sums run inside ranges, and a table with one row per range carries what the ranges before hold.
    """
    ranged = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in amounts.items()])
    starts = per_range.select("_range", *[F.coalesce(F.sum(f"_sum_{k}").over(upto), F.lit(0)).alias(f"_start_{k}") for k in amounts])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_inside_{k}") for k, v in amounts.items()])
    # One row per range, however large the input is: small enough to send.
    joined = summed.join(F.broadcast(starts), "_range")
    return joined.select(*df.columns, *[(F.col(f"_start_{k}") + F.col(f"_inside_{k}")).alias(k) for k in amounts])
