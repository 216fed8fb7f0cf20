"""From raw documents to packed windows of tokens, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careloom.llm import decontaminate, language, line_dedup, queries, simhash
from careloom.llm.runtime import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null texts, those without a letter, and uncertain ones.

    Rows stay as they are, repeated ones each; null ids do not matter; an empty table stays empty.
    """
    return language.keep_identified(docs, language.fit(docs.where(~queries.held_out())))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that many documents share; ``n_chars``, where there is one, follows the text.

    All rows stay, repeated ones each, and all other columns as they are, whatever their names; a null text becomes
    an empty one; a null id is a document of its own; an empty table stays empty.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    cut = line_dedup.dedup_lines(docs.toDF(*names), id_col=own["doc_id"], text_col=own["text"]).select(names)
    if "n_chars" in own:
        cut = cut.withColumn(own["n_chars"], F.length(own["text"]).cast(docs.schema["n_chars"].dataType))
    return cut.toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id: four-word shingles, at most four bits apart.

    Texts without words, null ones too, are copies of each other.  Null ids come last; of rows that repeat a group's
    smallest id one stays; rows of one id with different texts are judged each; an empty table stays empty.
    """
    return simhash.keep_one(docs, queries.NEAR_SHINGLE_WORDS, radius=queries.NEAR_RADIUS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go, with all rows of their id; null ids are one document here.

    Null and empty texts contain nothing; other columns stay, whatever their names; an empty table, or one of test
    items, changes nothing.
    """
    return decontaminate.without_leaks(docs, decontaminate.find_leaks(docs, queries.table(spark, sf_dir, "benchmark")))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in windows, with their ids; a null text has the end id only; no rows give none."""
    return queries.packed(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_windows),
]
# token ids and fingerprints are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder before the next."""
    docs = queries.documents(spark, sf_dir)
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
