"""What the operators share: staged tables, Arrow batches, and words of bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# texts of one batch are in a worker's memory at once
ROWS_PER_BATCH = 256
# a text is taken apart in pieces of about this many bytes
SEGMENT_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive plans, and Arrow batches of few rows, since rows hold whole texts."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="careloom-"))


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/careloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here and the size is known."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stages(spark: SparkSession) -> None:
    """Delete all staged tables below the shared folder; results that read them must have been written before."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/careloom")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(column: str) -> Column:
    """A text column as UTF-8 bytes."""
    return F.col(f"`{column}`").cast("string").cast("binary")


def ddl_type(df: DataFrame, column: str) -> str:
    return df.select(F.col(f"`{column}`")).schema[0].dataType.simpleString()


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function to every Arrow batch that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def _between_words(text: bytes, k: int) -> bool:
    """Whether a white space at ``k`` follows a printed character (of ASCII, or a letter of Latin-1)."""
    return k > 1 and (0x20 < text[k - 1] < 0x7F or text[k - 2] == 0xC3)


def _cut(text: bytes, start: int, size: int) -> int:
    """The last white space in reach that follows a word, else the first beyond; -1: none."""
    for space in (b" ", b"\n"):
        k = text.rfind(space, start + 1, start + size)
        while k > start and not _between_words(text, k):
            k = text.rfind(space, start + 1, k)
        if k > start:
            return k
    later = []
    for space in (b" ", b"\n"):
        k = text.find(space, start + size)
        while k > 0 and not _between_words(text, k):
            k = text.find(space, k + 1)
        later += [k] * (k > 0)
    return min(later, default=-1)


def segments(text: bytes, size: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """A text cut before white space that follows a word, in pieces of about ``size`` bytes; a run without any stays whole."""
    start = 0
    while len(text) - start > size:
        cut = _cut(text, start, size)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split() if text else []
