"""Token ids as Simple-8b segments in ascending order of the document ids.

A file set is a Parquet folder: each row is one segment, a Simple-8b byte image (header, block offsets,
words, escapes) with the ids and lengths of its documents. Segments are bounded, but for a document that
is longer by itself. Rows are numbered by range and place inside the range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm import simple8b
from fieldlens.llm.tokens import encoder, vocabulary_file, with_end

SEGMENT_IDS = 1 << 18
END_ID = 1


def _segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int, segment_ids: int) -> Iterator[pa.RecordBatch]:
    part, place, before = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        doc, names = 0, batch.column(0)
        for counts, ids in encoder(path).encode(batch.column(1)):
            starts, ids = with_end(counts, ids, end_id)
            a = 0
            while a < len(counts):
                b = max(a + 1, int(np.searchsorted(starts, starts[a] + segment_ids, "right")) - 1)
                n = int(starts[b] - starts[a])
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([place], pa.int64()), pa.array([before], pa.int64()), pa.array([n], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), names.slice(doc + a, b - a)),
                    pa.array([np.diff(starts[a : b + 1])], pa.list_(pa.int64())), pa.array([simple8b.encode(ids[starts[a] : starts[b]])], pa.binary()),
                ], names=["part", "place", "before", "n_ids", "doc_ids", "counts", "data"])
                place, before, a = place + 1, before + n, b
            doc += len(counts)


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Writes the ids of every whole text, each followed by ``end_id``, to ``path``.

    Documents are put in ascending order of id, NULL ids first, equal ids by their texts. NULL texts are
    empty, so they hold the end id alone. An empty table gives an empty folder; other columns are ignored.
    """
    vocabulary = vocabulary or vocabulary_file()
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType()),
    ])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lambda batches: _segments(batches, vocabulary, end_id, segment_ids), schema).write.parquet(path)


def _segments_with_start(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.parquet(path)
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = ranges.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("first"))
    # One row per range, however large the input is: small enough to send.
    joined = files.join(F.broadcast(starts), "part")
    return joined.select("doc_ids", "counts", "data", (F.col("first") + F.col("before")).alias("start"))


def _read(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            names, counts = batch.column(0)[i].values, batch.column(1)[i].values.to_numpy()
            ids = simple8b.decode(batch.column(2)[i].as_py()).astype("<u4")
            ends = np.cumsum(counts)
            starts = ends - counts
            if digest:
                view = memoryview(ids.tobytes())
                last = pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64())
            else:
                last = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]), pa.int32()), pa.array(ids, pa.int64()))
            yield pa.RecordBatch.from_arrays([names, pa.array(starts + batch.column(3)[i].as_py()), pa.array(counts), last], names=["doc_id", "start", "n_tokens", "last"])


def _rows(spark: SparkSession, path: str, last: str, kind: T.DataType, digest: bool) -> DataFrame:
    segments = _segments_with_start(spark, path)
    schema = T.StructType([
        T.StructField("doc_id", segments.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("last", kind),
    ])
    return segments.mapInArrow(lambda batches: _read(batches, digest), schema).withColumnRenamed("last", last)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of every document in the files."""
    return _rows(spark, path, "ids", T.ArrayType(T.LongType()), False)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit integers."""
    return _rows(spark, path, "ids_crc32", T.LongType(), True)
