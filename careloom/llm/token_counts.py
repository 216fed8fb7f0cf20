"""Token counts of whole texts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.llm.encoding import TextLengths, of_worker
from careloom.llm.runtime import ddl_type, map_batches, prepare, text_bytes

def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row.

    The library encodes batches balanced by bytes, long texts in parts cut before white space, where the
    tokenizer's pieces end in any case; only lengths leave it.  A null text counts as empty: 0 and 0.  Repeated
    rows are counted each; a null id stays null; other columns are not looked at.
    """
    prepare(docs.sparkSession)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = of_worker(TextLengths, path)
        texts = [t or b"" for t in batch.column(1).to_pylist()]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(lengths.count(texts), pa.int64())], ["id", "n_bytes", "n_tokens"])

    schema = f"id {ddl_type(docs, id_col)}, n_bytes BIGINT, n_tokens BIGINT"
    counted = map_batches(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), count, schema)
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
