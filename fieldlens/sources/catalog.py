"""Housekeeping of stored datasets: retention and completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def retention(datasets: DataFrame, as_of: str, days: int = 180, name: str = "name") -> DataFrame:
    """Mark datasets whose name ends in a month (yyyyMM) that began more than ``days`` days ago."""
    month = F.try_to_date(F.concat(F.regexp_extract(name, r"([0-9]{6})$", 1), F.lit("01")), "yyyyMMdd")
    age = F.datediff(F.lit(as_of).cast("date"), month)
    return datasets.select(
        name, age.alias("age_days"), F.coalesce(age > days, F.lit(False)).alias("expired")
    )


def audit(found: DataFrame, datasets: Sequence[str], as_of: str, days_back: int = 30) -> DataFrame:
    """Report each day and dataset that is missing or empty in the ``days_back`` days before ``as_of``.

    ``found`` has ``(dataset, d, n)``: one row per stored partition with its number of rows.
    """
    spark = found.sparkSession
    until = F.date_sub(F.lit(as_of).cast("date"), 1)
    since = F.date_sub(F.lit(as_of).cast("date"), days_back)
    calendar = spark.range(1).select(
        F.explode(F.sequence(since, until)).alias("day")
    ).select(F.date_format("day", "yyyyMMdd").alias("d"), F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset"))
    totals = found.groupBy("dataset", "d").agg(F.sum("n").alias("n"))
    checked = calendar.join(totals, ["dataset", "d"], "left")
    status = F.when(F.col("n").isNull(), "MISSING").when(F.col("n") == 0, "EMPTY")
    return checked.select("d", "dataset", status.alias("status")).where(F.col("status").isNotNull())


# The same on real storage: root/<dataset>/d=<yyyyMMdd>/*.parquet, and root/<name that ends in yyyyMM>

def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _children(spark: SparkSession, root: str) -> list[str]:
    """Names of the directories under ``root``, none if it does not exist."""
    fs, where = _file_system(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []


def stored_files(spark: SparkSession, root: str, datasets: Sequence[str]) -> DataFrame:
    """(dataset, d, path, bytes, n) of every Parquet file; sizes from the listing, rows from the footers.

    Spark lists the directories, in parallel where they are many; contents are not read.
    """
    there = set(_children(spark, root))
    out = spark.createDataFrame([], "dataset string, d string, path string, bytes bigint, n bigint")
    for dataset in datasets:
        if dataset not in there:
            continue
        where = f"{root}/{dataset}"
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(where)
        listed = listed.select("path", F.col("length").alias("bytes"))
        rows = spark.read.schema("d string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(where)
        counts = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
        day = F.regexp_extract("path", "/d=([0-9]{8})/", 1)
        found = listed.join(counts, "path", "left").select(F.lit(dataset).alias("dataset"), day.alias("d"), "path", "bytes", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
        out = out.unionByName(found)
    return out


def audit_storage(spark: SparkSession, root: str, datasets: Sequence[str], as_of: str, days_back: int = 30) -> DataFrame:
    """As :func:`audit`, from what lies under ``root``: a day without directory is missing, one without rows empty."""
    return audit(stored_files(spark, root, datasets), datasets, as_of, days_back)


def apply_retention(spark: SparkSession, root: str, as_of: str, days: int = 180, dry_run: bool = True) -> DataFrame:
    """Delete the directories under ``root`` whose month began more than ``days`` days ago; only said in a dry run.

    One row per directory: name, age_days, expired, deleted. Names without a month never expire. The directories
    of a dataset are its months, so their names fit the driver.
    """
    names = spark.createDataFrame([(n,) for n in _children(spark, root)], "name string")
    judged = retention(names, as_of, days).collect()
    done = []
    for name, age, expired in judged:
        deleted = False
        if expired and not dry_run:
            fs, where = _file_system(spark, f"{root}/{name}")
            deleted = bool(fs.delete(where, True))
        done.append((name, age, expired, deleted))
    return spark.createDataFrame(done, "name string, age_days int, expired boolean, deleted boolean")
