"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careloom.llm import conversations, decontaminate, language, licenses, line_dedup, packing, quality_rules, ranked_search, simhash, token_counts, token_files, url_graph, warc
from careloom.llm.runtime import stage_path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
END_ID = 2
NEAR_SHINGLE_WORDS, NEAR_RADIUS = 4, 4
WINDOW_TOKENS = 4096
TOKEN_LIMIT = 512
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), NEAR_SHINGLE_WORDS, radius=NEAR_RADIUS)
    return found.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), TOKEN_LIMIT)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM parts),
keyed AS (SELECT *, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, shared.key IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN shared ON keyed.key = shared.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), END_ID, WINDOW_TOKENS)


def op4_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir)).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).drop("spans")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = stage_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), folder, public_tokenizers.path(WORD_BPE), END_ID)
    return token_files.describe(spark, folder)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.identify(docs, language.fit(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge_quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
    FROM documents),
docs AS (SELECT doc_id, row, terms, len(terms) AS n FROM words WHERE len(terms) > 0),
total AS (SELECT count(*) AS rows, sum(n)::BIGINT AS terms FROM docs),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
held AS (SELECT doc_id, row, n, term, count(*) AS tf FROM (SELECT doc_id, row, n, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * rows + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total),
shares AS (SELECT doc_id, row, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * rows) // total.terms))) AS share FROM held JOIN weights USING (term), total),
scores AS (SELECT item_id, doc_id, row, sum(share)::BIGINT AS score FROM asked JOIN shares USING (term) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 50
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversations.Repairs(conversations.damaged(rows)).summary()
    every = rows.select("conv_id").distinct()
    joined = every.join(found.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id")
    joined = joined.na.fill(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).na.fill("", ["audit"])
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))


def op13_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_pages(table(spark, sf_dir, "pages"), stage_path(spark, "archives"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP13_SQL = """
WITH sizes AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS size FROM pages),
firsts AS (SELECT page_id, payload, size, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first FROM sizes)
SELECT page_id, size AS payload_bytes, sha256(payload) AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_token_counts, op3_line_dedup, op4_window_packing, op5_benchmark_leaks, op6_license_scan,
        op7_token_files, op8_language_id, op9_url_filter, op10_quality_rules, op11_ranked_search, op12_conversation_repair, op13_warc_archive,
    )
}
ORACLES = {"op3_line_dedup": OP3_SQL, "op11_ranked_search": OP11_SQL, "op13_warc_archive": OP13_SQL}
