"""Histogram aggregates that are kept up to date: partial states by day, months put together on reading.

A state holds one day's totals of a name or of one of its buckets, in a directory of its month and day. Running a
day again replaces that day's state and touches no other; a month is never rewritten, it is the merge of its days'
states, behind one view for all months. Sums, counts, minima and maxima merge exactly, so the months equal one
pass over all documents. States are some thousandths of the documents, and filters on the month or the day prune
directories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators import histograms
from fieldlens.plans import jobs
from fieldlens.schema import DIMENSIONS, DIMS_VALUE

KEYS = [k for k in DIMS_VALUE if k != "d"]
STATE_DDL = ", ".join([
    *[f"{k} string" for k in DIMENSIONS if k != "d"], "is_valid int, hist_name string, v bigint", "bucket_count int", "min_range bigint", "max_range bigint",
    "hist_type int", "sum_count double", "hist_name_sum decimal(38,0)", "hist_name_doc_count bigint", "month string", "d string",
])


def states(rows: DataFrame) -> DataFrame:
    """Totals per day of the histogram rows, from one aggregation; rows without a bucket hold those of the name."""
    totals = histograms.combined_totals(rows, exact=True)
    return totals.withColumn("month", F.substring("d", 1, 6)).to(rows.sparkSession.createDataFrame([], STATE_DDL).schema)


def update(submissions: DataFrame, products: Sequence[str], path: str) -> None:
    """Replace the states of the days that ``submissions`` holds, whole days each.

    A day whose submissions give no rows keeps no new state: delete its directory to empty it.
    """
    made = states(jobs.histogram_rows(submissions, products))
    (
        made.hint("rebalance", "month", "d")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "d").parquet(path)
    )


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE_DDL).parquet(path)


def merged(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """States of coarser groups, from states alone; ``by`` names the keys beside name, bucket and dimensions."""
    return stored.groupBy(*by, *KEYS).agg(
        F.max("bucket_count").alias("bucket_count"), F.min("min_range").alias("min_range"), F.max("max_range").alias("max_range"),
        F.max("hist_type").alias("hist_type"), F.sum("sum_count").alias("sum_count"),
        F.sum("hist_name_sum").cast("decimal(38,0)").alias("hist_name_sum"), F.sum("hist_name_doc_count").alias("hist_name_doc_count"),
    )


def totals(stored: DataFrame, by: Sequence[str] = ("month",)) -> DataFrame:
    """Bucket totals with those of their name per month, or per what ``by`` names.

    A sum of a name beyond 64 bits is NULL; :func:`merged` has it as a decimal.
    """
    found = merged(stored, by)
    keys = [*by, *[k for k in KEYS if k != "v"]]
    named = found.where("v IS NULL").select(*keys, F.col("hist_name_sum").try_cast("bigint").alias("hist_name_sum"), "hist_name_doc_count")
    return found.where("v IS NOT NULL").drop("hist_name_sum", "hist_name_doc_count").join(named, keys)


def documents(stored: DataFrame) -> DataFrame:
    """One aggregate document per month and dimension set, as the daily ones with the month for their date."""
    return histograms.aggregate_documents(totals(stored).withColumnRenamed("month", "d"))


def create_view(spark: SparkSession, path: str, name: str) -> None:
    """One name for the totals of all months. Spark lists files when the view is made: make it again after an update."""
    totals(read_states(spark, path)).createOrReplaceTempView(name)
