"""Files of a partner as they arrive.

The table jobs without row-collapsing steps are stateless, so the same plan runs
on a file stream; each trigger takes what has come since the last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, folder: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """Headed text files of a folder, all columns text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.readStream.schema(schema).options(header=True, sep=sep, quote='"', escape='"').csv(folder)


def append_arrivals(
    stream: DataFrame, job: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Run a stateless job over everything that has arrived and append to a stage table."""
    writer = job(stream).writeStream.format("parquet").outputMode("append")
    return writer.options(path=path, checkpointLocation=checkpoint).trigger(availableNow=True).start()
