"""Reading and writing of submissions: archives, key/JSON lines, write-back, delimited files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions.documents import info, parse
from fieldlens.functions.scalars import day_from_key, in_sample, salt_from_key, salt_matches, uuid_from_key
from fieldlens.schema import PRERELEASE_CHANNELS, RELEASE_CHANNEL, SPEC_DDL, SUBMISSION_DDL
from fieldlens.session import fresh_path, small_files, stage


# Submission store: Parquet, one directory per day

def write_store(df: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = True) -> None:
    """Store submissions by day. Only the days present in ``df`` are replaced, so a day can be re-run.

    Rows are rebalanced by day: small days share a task and a large day is split over many. Without that each
    task writes its own rows, for rows that lie together by day.
    """
    out = df.select("k", "json", F.coalesce("d", day_from_key(F.col("k"))).alias("d"))
    (
        (out.hint("rebalance", "d") if rebalance else out)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(path)
    )


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUBMISSION_DDL).parquet(path).select("k", "d", "json")


def in_date_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Submissions of the days ``start`` to ``end`` (yyyyMMdd), both included; prunes day directories."""
    return df.where(F.col("d").between(start, end))


def decode_keys(df: DataFrame) -> DataFrame:
    k = F.col("k")
    return df.select(
        "k", salt_from_key(k).alias("salt"), day_from_key(k).alias("d"), uuid_from_key(k).alias("uuid"),
        salt_matches(k).alias("salt_ok"),
    )


# Archives of key and JSON

def write_archive(df: DataFrame, path: str, compression: str = "zstd", mode: str = "error") -> None:
    df.select("k", "json").write.mode(mode).option("compression", compression).parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("k string, json string").parquet(path)
    return rows.select("k", day_from_key(F.col("k")).alias("d"), "json")


def write_sequence_archive(df: DataFrame, path: str) -> None:
    """Key and JSON as a SequenceFile of two texts, for exchange with such archives."""
    df.select("k", "json").rdd.map(lambda r: (r["k"], r["json"])).saveAsSequenceFile(path)


def read_sequence_archive(spark: SparkSession, path: str) -> DataFrame:
    pairs = spark.sparkContext.sequenceFile(path, "org.apache.hadoop.io.Text", "org.apache.hadoop.io.Text")
    rows = spark.createDataFrame(pairs, "k string, json string")
    return rows.select("k", day_from_key(F.col("k")).alias("d"), "json")


def export_buckets(df: DataFrame, rate: float = 0.1, prerelease: Sequence[str] = PRERELEASE_CHANNELS,
                   release: str = RELEASE_CHANNEL) -> DataFrame:
    """Prerelease submissions in full and a repeatable sample of release ones, marked by ``bucket``.

    One read gives both outputs; write them with ``partitionBy("bucket")``.
    """
    channel = info("appUpdateChannel")
    bucket = F.when(channel.isin(*prerelease), "prerelease").when(
        (channel == release) & in_sample(F.col("k"), rate), "release"
    )
    marked = parse(df, "info").select("k", "json", bucket.alias("bucket"))
    return marked.where(F.col("bucket").isNotNull())


def export_union(marked: DataFrame, buckets: Sequence[str] = ("prerelease", "release")) -> DataFrame:
    """The submissions of several buckets together, from the one read that marked them."""
    return marked.where(F.col("bucket").isin(*buckets)).select("k", "json")


# Write-back

def touched_days(updates: DataFrame) -> list[str]:
    """Days of the updates' keys; one row per day reaches the driver."""
    return sorted(r[0] for r in updates.select(day_from_key(F.col("k"))).distinct().collect() if r[0] is not None)


def overlay(base: DataFrame, updates: DataFrame) -> DataFrame:
    """The days that the updates touch: new JSON replaces that of the same key, new keys are added, other rows stay.

    The day is part of the key, so only those days of ``base`` are read. A key given twice among the updates
    counts once, with the greater JSON text. Jobs that rewrite the rows they read replace the document in
    place instead and need no join.
    """
    new = updates.select("k", "json").groupBy(day_from_key(F.col("k")).alias("d"), "k").agg(
        F.max("json").alias("_new"), F.lit(True).alias("_updated")
    )
    old = base.where(F.col("d").isin(touched_days(updates))).select("d", "k", "json")
    joined = old.join(new, ["d", "k"], "full_outer")
    return joined.select("k", "d", F.when(F.col("_updated"), F.col("_new")).otherwise(F.col("json")).alias("json"))


def upsert(spark: SparkSession, path: str, updates: DataFrame) -> None:
    """Overlay updates on a store; the days they touch are made aside and then replaced, others are not read."""
    fixed = stage(updates.select("k", "json"), "updates")
    write_store(stage(overlay(read_store(spark, path), fixed), "overlay"), path)


def import_archive(spark: SparkSession, archive: str, path: str) -> None:
    """Bring the submissions of an archive into a store, over those of the same keys."""
    upsert(spark, path, read_archive(spark, archive))


def write_ordered(df: DataFrame, path: str, partitions: int | None = None, mode: str = "error") -> None:
    """Write with rows in key order across and inside the files."""
    ranged = df.repartitionByRange(partitions, "k") if partitions else df.repartitionByRange("k")
    ranged.sortWithinPartitions("k").write.mode(mode).parquet(path)


# Text forms

def parse_key_json_lines(lines: DataFrame) -> DataFrame:
    """Lines ``key <tab> json``; only the first tab separates."""
    at = F.instr("value", "\t")
    return lines.where(at > 0).select(
        F.expr("left(value, instr(value, '\t') - 1)").alias("k"),
        F.expr("substring(value, instr(value, '\t') + 1)").alias("json"),
    )


def read_key_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_key_json_lines(spark.read.text(path))


def write_key_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    """One line per row; a line break in JSON can only be layout, so a blank stands for it."""
    one_line = F.translate("json", "\r\n", "  ")
    df.select(F.concat_ws("\t", "k", one_line).alias("value")).write.mode(mode).text(path)


def ping_payloads(files: DataFrame, key: str = "dummy") -> DataFrame:
    """Payload text of saved pings, one whole file per row, in key/JSON form."""
    parsed = parse(files, "payload", json="value")
    return parsed.select(F.lit(key).alias("k"), F.col("payload").alias("json")).where(F.col("json").isNotNull())


def write_ping_files(pings: DataFrame, path: str) -> None:
    """Saved pings (value) as files of one ping each, in a folder for each writing task.

    A task's folder is moved to its place as one; files beside each other would be moved one by one by the driver.
    On a local disk Hadoop starts a process for each file it creates, to set its permissions, which takes longer than
    the ping itself; there tasks create the files themselves.
    """
    spark = pings.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        _write_local_pings(pings, fs, fs.makeQualified(where))
    else:
        (
            pings.select("value", F.spark_partition_id().alias("folder")).write.partitionBy("folder")
            .option("maxRecordsPerFile", 1).text(path)
        )


def _write_local_pings(pings: DataFrame, fs, where) -> None:
    """Each attempt of a task writes to a folder of its own; those of the attempts that count are moved at the end."""
    at = pings.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    # Makes the folder, or says what Spark's writer says of one that is there or of a value that is no text.
    unmarked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    pings.limit(0).select("value", F.lit(0).alias("folder")).write.options(**unmarked).partitionBy("folder").text(where.toString())
    aside = at(where, "_temporary")
    local = aside.toUri().getPath()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, folder, n = TaskContext.get().partitionId(), f"{local}/{uuid.uuid4().hex}", 0
        for batch in batches:
            os.makedirs(folder, exist_ok=True)
            for value in batch.column(0):
                with open(f"{folder}/part-{n:06}.txt", "wb") as file:
                    if value.is_valid:
                        file.write(value.as_buffer())
                    file.write(b"\n")
                n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "folder": [folder]})

    try:
        for part, folder in pings.select(F.col("value").cast("binary")).mapInArrow(write, "part int, folder string").collect():
            if not fs.rename(at(aside, os.path.basename(folder)), at(where, f"folder={part}")):
                raise OSError(f"{where}/folder={part} could not be written")
    finally:
        fs.delete(aside, True)
    fs.create(at(where, "_SUCCESS")).close()


def _whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The whole text (value) of each file; compressed files, by their names, as what they hold.

    Spark's text reader copies the settings and gathers the codecs anew for each file, which takes several times as
    long as to read a ping. Files that need no codec are read as bytes.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    ends = [hadoop.util.ReflectionUtils.newInstance(codec, conf).getDefaultExtension() for codec in codecs]
    compressed = reduce(or_, [F.col("_metadata.file_name").endswith(end) for end in ends])
    files = reader.format("binaryFile").load(path)
    value = F.col("content").cast("string").alias("value")
    if files.where(compressed).isEmpty():  # the listing tells, no file is opened
        return files.select(value)
    texts = reader.schema("value string").text(path, wholetext=True)
    return files.where(~compressed).select(value).unionByName(texts.where(compressed).select("value"))


def read_ping_payloads(spark: SparkSession, path: str | list[str], key: str = "dummy", lines: bool = False) -> DataFrame:
    """Pings saved as a file each or, with ``lines``, as a line each; in the folder itself or in folders below it.

    Spark lists all files in the driver, some 800 bytes for each; :func:`stage_pings` is for very many.
    """
    if lines:
        files = spark.read.option("recursiveFileLookup", True).schema("value string").text(path)
    else:
        files = _whole_files(spark, path)
    return ping_payloads(files, key)


def stage_pings(spark: SparkSession, path: str, make: Callable[[DataFrame], DataFrame], at_once: int = 2) -> DataFrame:
    """What ``make`` does with the payloads of all files that :func:`write_ping_files` wrote to ``path``, written once.

    The folders are read ``at_once`` a job, and the next ones are listed meanwhile, so that the driver never holds the
    names of all files.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    folders = sorted(str(s.getPath()) for s in listed if s.getPath().getName().startswith("folder="))
    groups = [folders[i : i + at_once] for i in range(0, len(folders), at_once)] or [[path]]
    staged = fresh_path(spark, "pings-read")
    with small_files(spark), ThreadPoolExecutor(1) as lister:
        ahead = lister.submit(lambda: make(read_ping_payloads(spark, groups[0])))
        for following in [*groups[1:], None]:
            rows = ahead.result()
            if following:
                ahead = lister.submit(lambda paths=following: make(read_ping_payloads(spark, paths)))
            rows.write.mode("append").parquet(staged)
    return spark.read.schema(rows.schema).parquet(staged)


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t", header: bool = False,
                   quote: str = '"') -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).option("header", header).option("quote", quote).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False, compression: str = "none",
                    single_file: bool = False, quote: str = '"', mode: str = "error") -> None:
    """Delimited text. ``single_file`` is for small final reports only: one task writes it."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode(mode).option("sep", sep).option("header", header).option("compression", compression)
        .option("quote", quote).csv(path)
    )


def write_documents(df: DataFrame, path: str, json: str = "agg_json", month: str = "month", day: str = "d") -> None:
    """One JSON document per line, in a directory per month and day; a day written again replaces only itself."""
    (
        df.select(F.col(json).alias("value"), F.col(month).alias("month"), F.col(day).alias("d"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "d").text(path)
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, month string, d string").text(path)


# Specifications

def specs_from_documents(documents: DataFrame) -> DataFrame:
    """Specification rows from ``(version_key, json)`` documents with a ``histograms`` object."""
    parsed = parse(documents, "histograms")
    rows = parsed.select("version_key", F.explode("histograms").alias("hist_name", "value"))

    def leaf(name, as_type="string"):
        return F.try_variant_get("value", F.lit(f"$.{name}"), as_type)

    return rows.select(
        "version_key", "hist_name", leaf("min").alias("min"), leaf("max").alias("max"),
        leaf("kind").alias("hist_type"), leaf("bucket_count").alias("bucket_count"),
        leaf("buckets", "array<int>").alias("buckets"),
    )


def read_specs(spark: SparkSession, lookup: Mapping[str, str]) -> DataFrame:
    """Specifications named by version key; ``lookup`` maps each key to the path of its JSON file."""
    parts = [
        spark.read.text(path, wholetext=True)
        .select(F.lit(version).alias("version_key"), F.col("value").alias("json"))
        for version, path in lookup.items()
    ]
    if not parts:
        return spark.createDataFrame([], SPEC_DDL)
    documents = parts[0]
    for part in parts[1:]:
        documents = documents.unionByName(part)
    return specs_from_documents(documents)
