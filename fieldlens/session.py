"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the jobs rely on.

    JSON objects may repeat a key; the last one wins, as in most JSON mappers, instead of the whole
    document being treated as unparsable.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    for name in ("writeShredding.enabled", "inferShreddingSchema", "allowReadingShredded", "pushVariantIntoScan"):
        spark.conf.set(f"spark.sql.variant.{name}", "true")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where the cluster names one.

    In local mode the one machine's temporary folder will do; a cluster without a named folder is an
    error, as executors would each write to a disk of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fieldlens-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scopes: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never reused, so a re-run cannot read an older run's files."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return "/".join([shared_dir(spark), "fieldlens", spark.sparkContext.applicationId, *_scopes])


def _delete(spark: SparkSession, where: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it once all results are written."""
    _delete(spark, _own_dir(spark))


class Scope:
    """Intermediate tables made inside ``with`` lie together, until :meth:`drop` deletes them and no others.

    A job whose result is read later keeps its scope until that result is written.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.name = spark, f"scope-{uuid.uuid4().hex}"

    def __enter__(self) -> Scope:
        _scopes.append(self.name)
        self.where = _own_dir(self.spark)
        return self

    def __exit__(self, *_) -> None:
        _scopes.remove(self.name)

    def drop(self) -> None:
        _delete(self.spark, self.where)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end, others stay; write the results inside."""
    with Scope(spark) as scope:
        try:
            yield
        finally:
            scope.drop()


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def splits_of(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Files that are read by actions inside are split at ``size`` bytes, at row groups; for work that is long by byte."""
    return _set(spark, "spark.sql.files.maxPartitionBytes", str(size))


def small_files(spark: SparkSession) -> AbstractContextManager[None]:
    """A task of actions inside reads files by the thousand, if they are small; else each counts as four megabytes at least."""
    return _set(spark, "spark.sql.files.openCostInBytes", "16k")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches need the same rows: they must not be computed twice, and they must
    agree exactly, also when an executor is lost between two reads.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
