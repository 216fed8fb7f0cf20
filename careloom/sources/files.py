"""Partner files and stage tables.  Every delimited column is read as text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careloom.operators.result import DROPPED, TOUCHED, Result, from_judged


@dataclass(frozen=True)
class Layout:
    """One way a partner may write a table.

    ``required`` columns prove that the separator is right.  ``also`` adds a column
    the header lacks: a copy of another one, or NULL.
    """

    sep: str = "\t"
    required: tuple[str, ...] = ()
    also: dict[str, str | None] = field(default_factory=dict)


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], sep: str = "\t", *, blank_is_null: bool = True
) -> DataFrame:
    """A headed text file, a folder or a glob of them, as all-text columns.

    The header is matched by name (``enforceSchema`` off), so files of one table
    may not silently swap columns.
    """
    reader = _reader(spark, sep)
    header = reader.load(path).schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in header])
    df = _reader(spark, sep).schema(text).option("enforceSchema", False).load(path)
    if blank_is_null:
        return df
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


BAD_RECORD, FILE = "_corrupt_record", "__file"


def read_checked(spark: SparkSession, path: str | Sequence[str], sep: str = "\t", *, blank_is_null: bool = True) -> Result:
    """``read_delimited`` with lines of too few or too many fields kept apart instead of being padded or cut.

    ``good`` has the other rows; ``rejects`` the fields that could be read of a bad line, its ``file`` and the whole
    ``record``; the report counts bad lines per file.  Every line is in one of both.  Settled, files are parsed once.
    """
    header = _reader(spark, sep).load(path).schema
    names = [f.name for f in header]
    if {BAD_RECORD, FILE} & set(names):
        raise ValueError(f"{path} has a column named {BAD_RECORD} or {FILE}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD_RECORD]])
    # with fewer columns asked for, the parser would not look at the others, nor miss them
    options = {"enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD, "columnPruning": False}
    df = _reader(spark, sep).schema(text).options(**options).load(path)
    # asks for a field as well, since a plan that asks for the record only is refused
    bad = F.col(BAD_RECORD).isNotNull() & F.coalesce(F.length(F.col(f"`{names[0]}`")) >= 0, F.lit(True))
    fields = [F.col(f"`{n}`") if blank_is_null else F.coalesce(F.col(f"`{n}`"), F.when(~bad, F.lit(""))).alias(n) for n in names]
    judged = df.select(*fields, BAD_RECORD, F.col("_metadata.file_path").alias(FILE), bad.alias(TOUCHED), bad.alias(DROPPED))
    counted = lambda touched: touched.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("count"))
    return from_judged(judged, names, {FILE: "file", BAD_RECORD: "record"}, counted)


def _reader(spark: SparkSession, sep: str):
    options = {"header": True, "inferSchema": False, "sep": sep, "quote": '"', "escape": '"', "multiLine": False}
    return spark.read.format("csv").options(**options)


def choose_layout(spark: SparkSession, path: str | Sequence[str], layouts: Sequence[Layout]) -> Layout:
    """The first layout whose required columns the header has, whatever their case.

    Only headers are looked at.
    """
    tried = []
    for layout in layouts:
        names = {c.lower() for c in _reader(spark, layout.sep).load(path).columns}
        if {c.lower() for c in layout.required} <= names:
            return layout
        tried.append(f"{layout.sep!r}: {sorted(names)[:5]}")
    raise ValueError(f"no declared layout fits {path}: {tried}")


def list_files(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """The files that match any of the patterns, each once, in the file system that the paths name."""
    conf, found = spark.sparkContext._jsc.hadoopConfiguration(), {}
    for pattern in patterns:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        for status in path.getFileSystem(conf).globStatus(path) or []:
            found[status.getPath().toString()] = None
    if not found:
        raise FileNotFoundError(f"no file matches {list(patterns)}")
    return sorted(found)


def read_layout(spark: SparkSession, path: str | Sequence[str], layout: Layout) -> DataFrame:
    df = read_delimited(spark, path, layout.sep)
    names = {c.lower() for c in df.columns}
    for new, old in layout.also.items():
        if new.lower() not in names:
            present = old is not None and old.lower() in names
            df = df.withColumn(new, F.col(old) if present else F.lit(None).cast("string"))
    return df


def read_variants(spark: SparkSession, path: str | Sequence[str], layouts: Sequence[Layout]) -> DataFrame:
    """Read with whichever declared layout fits."""
    return read_layout(spark, path, choose_layout(spark, path, layouts))


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table that an earlier stage wrote; one that was dealt to folders needs its schema."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_code_list(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """A one-column list."""
    df = spark.read.schema("code STRING").options(header=header, quote='"').csv(path)
    return df.where(F.col("code").isNotNull())
