"""Delimited text with a channel for what cannot be read, and one report file written by many tasks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldlens.functions.documents import once
from fieldlens.session import fresh_path
from fieldlens.sources.submissions import write_delimited

LINE, REASON = "_line", "_reason"
_BROKEN = "_broken"


def check_lines(lines: DataFrame, schema: str, sep: str = "\t", quote: str = '"', header: bool = False, missing: str = "") -> DataFrame:
    """Every line of ``lines`` (value) with its typed columns, the line itself and the reason for which it is rejected.

    ``_reason`` is NULL for accepted lines, else ``empty``, ``fields`` (too few or too many) or ``value: column`` with
    the first column whose text is not of its type; the typed columns of a rejected line are NULL. An unquoted
    ``missing`` is a missing value in any column. With ``header`` lines that repeat the column names are left out.
    """
    names = StructType.fromDDL(schema).fieldNames()
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE", "nullValue": missing, "columnNameOfCorruptRecord": _BROKEN}

    def parsed(ddl: str) -> Column:
        return F.from_csv("value", f"{ddl}, {_BROKEN} string", options)

    kept = lines.where(~F.col("value").isin(sep.join(names), sep.join(f"{quote}{n}{quote}" for n in names))) if header else lines
    # Both readings are made whole, so that which columns are asked for later does not decide what is rejected.
    read = once(kept, "value", parsed(schema).alias("_typed"), parsed(", ".join(f"`{n}` string" for n in names)).alias("_texts"))
    bad_value = [F.when(F.col("_texts")[n].isNotNull() & F.col("_typed")[n].isNull(), F.lit(f"value: {n}")) for n in names]
    reason = (
        F.when(F.trim("value") == "", "empty").when(F.col("_texts")[_BROKEN].isNotNull(), "fields")
        .when(F.col("_typed")[_BROKEN].isNotNull(), F.coalesce(*bad_value, F.lit("line")))
    )
    ready = once(read, F.col("value").alias(LINE), "_typed", reason.alias(REASON))
    return ready.select(*[F.when(F.col(REASON).isNull(), F.col("_typed")[n]).alias(n) for n in names], LINE, REASON)


def read_checked(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """The lines of the files under ``path``, checked; see :func:`check_lines`."""
    return check_lines(spark.read.text(path), schema, **options)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(LINE, REASON)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull()).select(F.col(REASON).alias("reason"), F.col(LINE).alias("line"))


def split_rejected(spark: SparkSession, path: str, schema: str, rejects: str, mode: str = "error", **options) -> DataFrame:
    """The accepted rows; rejected lines are written to ``rejects`` as Parquet, by reason."""
    checked = read_checked(spark, path, schema, **options)
    kind = F.regexp_extract("reason", "^[a-z]+", 0).alias("kind")
    rejected(checked).select("reason", "line", kind).write.mode(mode).partitionBy("kind").parquet(rejects)
    return accepted(checked)


def _join_files(spark: SparkSession, parts: Sequence[str], target: str) -> None:
    """One file of the parts' bytes in order; by the file system alone where it can, else streamed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(target).getFileSystem(conf)
    try:
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
        for i, part in enumerate(parts[1:]):
            array[i] = at(part)
        fs.concat(at(parts[0]), array)
        fs.rename(at(parts[0]), at(target))
    except Exception as error:  # most file systems cannot
        if "UnsupportedOperation" not in type(error).__name__ + str(error):
            raise
        out = fs.create(at(target), False)
        try:
            for part in parts:
                source = fs.open(at(part))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                finally:
                    source.close()
        finally:
            out.close()


def write_single_file(df: DataFrame, path: str, sep: str = ",", header: bool = False, compression: str = "none", quote: str = '"') -> None:
    """One delimited file at ``path``, its rows in the order of ``df``, written by as many tasks as ``df`` has.

    The parts are joined afterwards: on file systems that can (HDFS) without moving a byte, else the driver
    streams them in blocks of a megabyte. Compressed parts stay compressed: a file of several gzip members is
    one gzip file. The file appears under its name only when it is whole; an existing one is an error.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(conf)
    if fs.exists(at(path)):
        raise FileExistsError(path)
    folder = f"{path}.{fresh_path(spark, 'parts').rsplit('/', 1)[1]}"  # beside it, so that a rename is enough
    try:
        options = {"sep": sep, "compression": compression, "quote": quote}
        if header:
            first = spark.createDataFrame([tuple(df.columns)], ", ".join(f"_{i} string" for i in range(len(df.columns)))).coalesce(1)
            write_delimited(first, f"{folder}/0-header", **options)
        write_delimited(df, f"{folder}/1-rows", **options)
        parts = []
        for part in (["0-header"] if header else []) + ["1-rows"]:
            found = [str(s.getPath()) for s in fs.listStatus(at(f"{folder}/{part}"))]
            parts += sorted(p for p in found if re.search(r"/part-[^/]*$", p))
        _join_files(spark, parts, f"{folder}/whole")
        fs.mkdirs(at(path).getParent())
        if not fs.rename(at(f"{folder}/whole"), at(path)):
            raise OSError(f"{path} could not be written")
    finally:
        fs.delete(at(folder), True)
