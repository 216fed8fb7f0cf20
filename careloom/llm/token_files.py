"""Token ids in ORC files."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careloom.llm.encoding import TextIds, of_worker
from careloom.llm.runtime import ddl_type, map_batches, prepare, stage, text_bytes

OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(64 << 20),
    "compression": "zstd",
}


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``(doc_id, ids)`` of every row as ORC files in ascending order of the id.

    Ids are integer columns with run-length encoding; stripes are read by tasks of their own; row indexes and Bloom
    filters on the id let a reader skip stripes and groups of rows.  Texts are dealt by ranges of the id and sorted
    before they are encoded, so ids are moved nowhere.  A null text has the end id only; null ids come first;
    repeated rows are written each; an empty table gives files without rows.
    """
    prepare(docs.sparkSession)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = of_worker(TextIds, path)
        end = encoder.pack([end_id])
        found = [encoder.ids(t) + end for t in batch.column(1).to_pylist()]
        values = np.frombuffer(b"".join(found), f"<u{encoder.width}").astype(np.int32)
        offsets = np.append(0, np.cumsum([len(f) // encoder.width for f in found])).astype(np.int32)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_bytes(text_col).alias("text"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    encoded = map_batches(dealt, encode, f"doc_id {ddl_type(docs, id_col)}, ids ARRAY<INT>")
    encoded.write.options(**OPTIONS).orc(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.orc(folder)


def lookup(spark: SparkSession, folder: str, ids: Sequence) -> DataFrame:
    """The rows of some ids; the filter reaches the files' statistics, row indexes and Bloom filters."""
    return read_token_files(spark, folder).where(F.col("doc_id").isin(list(ids)))


def describe(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every row, read from the files.

    ``start`` counts the ids of all rows before it: sums within a file, on top of those of earlier files.
    """
    prepare(spark)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(1)
        values, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
        sums = [zlib.crc32(values[i:j].tobytes()) for i, j in zip(ends[:-1], ends[1:])]
        sizes = np.diff(ends).astype(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes), pa.array(sums, pa.int64())], names)

    names = ["doc_id", "file", "n_tokens", "ids_crc32"]
    rows = read_token_files(spark, folder)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint")
    measured = map_batches(rows.select("doc_id", "ids", number.alias("file")), measure, f"doc_id {ddl_type(rows, 'doc_id')}, file BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
    measured = stage(measured, "measured")
    files = measured.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    before = Window.partitionBy("file").orderBy("doc_id", "ids_crc32", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    within = measured.withColumn("within", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return within.join(files, "file").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
