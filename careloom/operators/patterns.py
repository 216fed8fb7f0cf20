"""Which texts contain a text of a list, whatever its case, for lists of any length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.operators.keys import SPREAD, left_join_grouped, spread

# texts of a list that one expression tries on every row
MOST_TRIED = 1000
# listed texts without so many ASCII characters in a row are not looked up
RUN = 4
# characters by which the start of a listed text is looked up: the most that it has
STARTS = (4, 8, 16, 32, 64)
# places of a text that are looked at together
STEP = 256
# bits of a table of hashes: so many for each, up to so many altogether, in rows of eight words of 64
BITS_EACH = 16
MOST_BITS = 1 << 28
ROW_WORDS = 8
# What matches ASCII letters besides their other case, and the letters.
FOLDED_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\u0130\u0131\u017f\u212a"
FOLDED_TO = "abcdefghijklmnopqrstuvwxyziisk"


def text_hits(df: DataFrame, column: str, patterns: DataFrame) -> tuple[DataFrame, Column]:
    """The rows, and whether their text contains one of the first column of ``patterns``; null and empty ones are none.

    A short list becomes one quoted expression that a filter tries on every row.  A longer one is looked up, place by
    place of the rows' different texts: by the start of the listed texts first, then by all of them that are as long,
    both in tables of bits of a bounded size.  Only what passes is shuffled, and joined with the listed texts by the hash of
    the whole, so that the pairs are those that match.  That join and that of the texts found with the rows are split where
    a key is hot.  Listed texts without four ASCII characters in a row are tried as in a short list, ``MOST_TRIED`` at a time.
    """
    listed = patterns.select(F.col(patterns.columns[0]).cast("string").alias("pattern")).where("pattern <> ''").distinct()
    if listed.limit(MOST_TRIED + 1).count() <= MOST_TRIED:
        return df, F.rlike(F.col(column), one_pattern(listed))
    texts = df.select(F.col(column).cast("string").alias("text")).where("text <> ''").distinct()
    has_run = F.rlike(_folded("pattern"), F.lit(rf"[\x00-\x7f]{{{RUN}}}"))
    sizes = listed.groupBy(has_run.alias("run"), F.length("pattern").alias("long")).count().collect()  # two for a length of listed texts
    found = _looked_up(texts, listed.where(has_run), {r["long"]: r["count"] for r in sizes if r["run"]})
    number = F.pmod(F.xxhash64("pattern"), F.lit(1 + sum(r["count"] for r in sizes if not r["run"]) // max(1, MOST_TRIED // 2)))
    parts = listed.where(~has_run).groupBy(number.alias("part")).agg(_alternatives().alias("tried")).select("tried")
    for row in parts.collect():  # one for hundreds of listed texts
        found = found.union(texts.where(F.rlike("text", F.lit(row["tried"]))).select(_name("text")))
    hits = found.distinct().select(F.col("name").alias("__text"), F.lit(True).alias("__hit"))
    return left_join_grouped(df, hits, _name(column), "__text"), F.col("__hit")


def _alternatives() -> Column:
    text = F.col("pattern")
    # a text that holds the closing mark of a quotation is quoted around it
    quoted = F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    joined = F.array_join(F.sort_array(F.collect_set(quoted)), "|")
    return F.concat(F.lit("(?iu)(?:"), F.nullif(joined, F.lit("")), F.lit(")"))


def one_pattern(listed: DataFrame) -> Column:
    return listed.agg(_alternatives().alias("p")).scalar()


def _name(column: str) -> Column:
    """The bytes of a text, or their digest where that is shorter: 32 bytes, which no text has that goes by itself."""
    text = F.col(column).cast("string")
    return F.when(F.octet_length(text) < 32, text.cast("binary")).otherwise(F.unhex(F.sha2(text, 256))).alias("name")


def _ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _folded(column: str) -> Column:
    """ASCII letters, and what matches them, in one case; one sign for all characters beyond ASCII."""
    text = F.col(column)
    beyond = F.regexp_replace(F.translate(text, FOLDED_FROM, FOLDED_TO), r"[^\x00-\x7f]", "\ufffd")
    return F.when(_ascii(text), F.lower(text)).otherwise(beyond)


def _bits(keys: DataFrame, rows: int) -> DataFrame:
    """A table of bits, one for each key but for those that share it, in as many rows at most."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _place("key"))
    words = [F.bit_or(F.when(_word("key") == k, bit)).alias(f"word{k}") for k in range(ROW_WORDS)]
    return keys.groupBy(F.pmod(F.col("key"), F.lit(rows)).alias("row")).agg(*words)


def _word(key: str) -> Column:
    return F.shiftrightunsigned(F.col(key), 61)


def _place(key: str) -> Column:
    return F.shiftrightunsigned(F.col(key), 55).bitwiseAND(F.lit(63)).cast("int")


def _perhaps(df: DataFrame, keys: DataFrame, rows: int) -> DataFrame:
    """The rows whose key is one of the keys, and a few others."""
    joined = df.withColumn("row", F.pmod(F.col("key"), F.lit(rows))).join(F.broadcast(_bits(keys, rows)), "row")
    word = F.coalesce(*[F.when(_word("key") == k, F.col(f"word{k}")) for k in range(ROW_WORDS)])
    return joined.where(F.getbit(word, _place("key")) == 1).select(df.columns)


def _looked_up(texts: DataFrame, listed: DataFrame, lengths: dict[int, int]) -> DataFrame:
    """The names of the texts that contain a listed one; ``lengths``: how many of these have which length."""
    if not lengths:
        return texts.where(F.lit(False)).select(_name("text"))
    rows = max(1, min(MOST_BITS, 1 << (BITS_EACH * sum(lengths.values())).bit_length()) // (ROW_WORDS * 64))
    shortest, longest = min(lengths), max(lengths)
    step = max(STEP, longest)
    groups = [(a, [n for n in sorted(lengths) if a <= n and (n < b or not b)]) for a, b in zip(STARTS, (*STARTS[1:], 0))]
    kinds = F.array(*[F.struct(F.lit(a).alias("start"), F.array(*map(F.lit, ns)).alias("lengths")) for a, ns in groups if ns])

    starting = listed.select(_folded("pattern").alias("folded"))
    fitting = [a for a, ns in groups if ns]
    start = F.greatest(*[F.when(F.length("folded") >= a, a) for a in fitting], F.lit(0))
    starting = starting.select(F.xxhash64(F.substring("folded", F.lit(1), start)).alias("key"))
    whole = listed.select("pattern", F.xxhash64(_folded("pattern")).alias("key"))

    # pieces overlap by all but one character of the longest
    piece = F.transform(
        F.sequence(F.lit(0), F.floor((F.length("text") - shortest) / step)), lambda k: F.substring("text", (k * step + 1).cast("int"), F.lit(step + longest - 1))
    )
    pieces = texts.where(F.length("text") >= shortest).select(_name("text"), F.explode(piece).alias("piece"))
    kind = pieces.select("name", "piece", _folded("piece").alias("folded"), F.explode(kinds).alias("kind")).select("name", "piece", "folded", "kind.*")
    places = F.sequence(F.lit(1), F.least(F.lit(step), F.length("folded") - F.col("start") + 1))
    placed = kind.where(F.length("folded") >= F.col("start")).select("*", F.explode(places).alias("at"))
    begun = _perhaps(placed.withColumn("key", F.xxhash64(F.substring("folded", F.col("at"), F.col("start")))), starting, rows)
    sized = begun.select("name", "piece", "folded", "at", F.explode("lengths").alias("long")).where(F.col("at") + F.col("long") - 1 <= F.length("folded"))
    ended = sized.withColumn("key", F.xxhash64(F.substring("folded", F.col("at"), F.col("long"))))
    met = _perhaps(ended, whole, rows).select("name", F.substring("piece", F.col("at"), F.col("long")).alias("part"), "key")

    sides = [side.withColumn(SPREAD, spread(F.col("key"))) for side in (met, whole)]
    # sizes of what was exploded are not known beforehand, so neither side is sent to all tasks
    pairs = sides[0].join(sides[1].hint("merge"), ["key", SPREAD])
    quoted = F.concat(F.lit(r"(?iu)\Q"), F.replace("pattern", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    folded = _folded("part")
    return pairs.where((folded == _folded("pattern")) & (_ascii(folded) | F.rlike("part", quoted))).select("name")
