"""Normal-form tables: documents stored by day in columns, so that later queries need no JSON.

Each table is written by a pass of its own that parses the parts it needs; where only the presence of a
part counts, its content is not read.

``docs`` holds one row per submission with the dimensions as real columns, so that filters reach the
Parquet scan. ``hist`` holds one row per histogram or measure with its buckets, ``slow_sql`` one row
per recorded statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldlens.functions import scalars as sf
from fieldlens.functions.documents import PRESENCE, dimension_columns, info, is_complete, parse, parse_whole
from fieldlens.operators import histograms, slowsql
from fieldlens.schema import DIMENSIONS, INFO_FIELDS

TABLES = ("docs", "hist", "slow_sql")


def docs_table(submissions: DataFrame) -> DataFrame:
    parsed = parse(submissions, "info", **PRESENCE)
    return parsed.select(
        "k", *dimension_columns(), info(INFO_FIELDS["os_version"]).alias("raw_version"),
        info("flashVersion").alias("flash_version"), info("validForSchema").alias("valid_for_schema"),
        is_complete().alias("is_complete"), sf.text_size(F.col("json")).alias("json_size"),
    )


def hist_table(submissions: DataFrame) -> DataFrame:
    """Rows of complete submissions; product and reason stay as columns to filter on."""
    parsed = parse(submissions, "info", "histograms", "simpleMeasurements", keep=["k"]).where(is_complete())
    return histograms.entries(parsed, ["k", *dimension_columns()])


def slow_sql_table(submissions: DataFrame) -> DataFrame:
    carry = ["k", sf.day_from_key(F.col("k")).alias("d"), info("appName").alias("product"),
             info("appVersion").alias("product_version"), info("appUpdateChannel").alias("product_channel")]
    return slowsql.statements(parse(submissions, "info", "slowSQL", keep=["k"]), carry)


def write_tables(submissions: DataFrame, path: str) -> None:
    """Write the three tables by day; a day written again replaces only itself."""
    for name, make in zip(TABLES, (docs_table, hist_table, slow_sql_table)):
        (
            make(submissions).hint("rebalance", "d")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(f"{path}/{name}")
        )


def write_variants(submissions: DataFrame, path: str) -> None:
    """Store documents parsed, as VARIANT, by day; a day written again replaces only itself.

    Spark shreds them: members that most documents of a file have become columns of their own, so that a query of
    ``info.OS`` reads that column and not the documents. Other members stay reachable. Text that is not JSON is NULL.
    """
    parsed = parse_whole(submissions.select("k", "json", F.coalesce("d", sf.day_from_key(F.col("k"))).alias("d")))
    (
        parsed.select("k", "doc", "d").hint("rebalance", "d")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(path)
    )


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """Stored documents, for :func:`jobs.query_parsed` and the accessors of :mod:`documents`.

    The paths that a query asks for are read by the scan; nothing stands between, as :func:`once` would.
    """
    return spark.read.schema("k string, doc variant, d string").parquet(path)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a table with the day as text; left to inference it would be a number and need a cast."""
    where = f"{path}/{name}"
    fields = [StructField("d", StringType()) if f.name == "d" else f for f in spark.read.parquet(where).schema.fields]
    return spark.read.schema(StructType(fields)).parquet(where)


def daily_aggregates(hist: DataFrame, products, reasons) -> DataFrame:
    """Daily totals from the stored histogram rows."""
    kept = hist.where(F.col("product").isin(*products) & F.col("reason").isin(*reasons))
    return histograms.daily_totals(kept.select(*DIMENSIONS, *histograms.NAME_ROW, "buckets"))


def flash_versions(docs: DataFrame, products, reasons, os: str | None = None) -> DataFrame:
    kept = docs.where(F.col("is_complete") & F.col("product").isin(*products) & F.col("reason").isin(*reasons))
    if os:
        kept = kept.where(F.col("os") == os)
    keys = ["product", "product_version", "product_channel", "os", "os_version"]
    return kept.groupBy(*keys, sf.null_default(F.col("flash_version")).alias("flash_version")).agg(F.count("*").alias("cnt"))
