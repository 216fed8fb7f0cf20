"""Language of texts by naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.llm.runtime import ddl_type, map_batches, prepare, stage, text_bytes

UNKNOWN = "und"
BUCKETS = 1 << 15
# rows of each language that the classifier learns from, about
ROWS_PER_LANGUAGE = 2000
# languages whose log-probabilities are in memory at a time
LANGUAGES_AT_ONCE = 500
# characters whose n-grams are in memory at a time
CHUNK_CHARS = 1 << 18
SMOOTHING = 0.1
# a row's draw is one of so many
STEPS = 1 << 30
_SPACE = 32
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Lower-case letter, or a space, for every character of the basic plane."""
    if not _FOLD:
        table = np.full(1 << 16, _SPACE, np.uint32)
        for c in range(1 << 16):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def letters_of(text: str) -> np.ndarray:
    """Characters as numbers, all but letters as spaces; letters beyond the basic plane stand for themselves."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    low = codes < 1 << 16
    return np.where(low, _fold()[np.where(low, codes, 0)], codes)


def buckets_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the two- and three-grams that begin at each character but the last two; without letters: ``BUCKETS``."""
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    two = a * _FACTORS[0] + b * _FACTORS[1]
    three = (two ^ (two >> np.uint32(15))) * _FACTORS[2] + c * _FACTORS[0]
    two = ((two ^ (two >> np.uint32(13))) * _FACTORS[2] >> shift).astype(np.int64)
    three = ((three ^ (three >> np.uint32(13))) * _FACTORS[1] >> shift).astype(np.int64)
    blank = (a == _SPACE) & (b == _SPACE)
    two[blank] = BUCKETS
    three[blank & (c == _SPACE)] = BUCKETS
    return two, three


def _chunks(texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Texts in runs of ``CHUNK_CHARS``: their numbers, where each begins, and all characters.

    Two spaces stand between texts, so no n-gram reaches from one into the next; a long text comes in parts that
    share the two characters at the cut.
    """
    owners, starts, parts, held = [], [], [], 0
    for k, text in enumerate(texts):
        codes = np.concatenate([[_SPACE], letters_of(text), [_SPACE, _SPACE]]).astype(np.uint32)
        for i in range(0, max(1, len(codes) - 2), CHUNK_CHARS):
            part = codes[i : i + CHUNK_CHARS + 2]
            owners.append(k)
            starts.append(held)
            parts.append(part)
            held += len(part)
            if held >= CHUNK_CHARS:
                yield owners, np.array(starts), np.concatenate(parts)
                owners, starts, parts, held = [], [], [], 0
    if owners:
        yield owners, np.array(starts), np.concatenate(parts)


def _grams(starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a run, without those that reach from one part into the next."""
    two, three = buckets_of(np.append(codes, np.uint32([_SPACE, _SPACE])))
    ends = np.append(starts[1:], len(codes))
    for back in (1, 2):
        two[ends - back] = three[ends - back] = BUCKETS
    return two, three


class Model:
    """Log-probabilities of every bucket in every language; the last row, for blanks, is zero.

    ``total`` is the number of rows of all languages, if these are not all.
    """

    def __init__(self, languages: list[str], counts: np.ndarray, rows: np.ndarray, total: float | None = None):
        self.languages = languages
        smooth = counts + SMOOTHING
        table = np.log(smooth / smooth.sum(0, keepdims=True)) if languages else smooth
        self.table = np.vstack([table, np.zeros((1, len(languages)))])
        self.prior = np.log(rows / (total or rows.sum())) if languages else rows

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-probability of every text in every language."""
        out = np.tile(self.prior, (len(texts), 1))
        for owners, starts, codes in _chunks(texts):
            two, three = _grams(starts, codes)
            for language in range(len(self.languages)):
                column = self.table[:, language]
                np.add.at(out[:, language], owners, np.add.reduceat(column[two] + column[three], starts))
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and its probability given the text; unknown for null, for a text without letters, and untaught."""
        made = [(UNKNOWN, 0.0)] * len(texts)
        known = [k for k, t in enumerate(texts) if t is not None and self.languages and any(map(str.isalpha, t))]
        scores = self.scores([texts[k] for k in known])
        for k, row in zip(known, scores):
            best = int(np.argmax(row))
            made[k] = (self.languages[best], float(1.0 / np.exp(row - row[best]).sum()))
        return made

    def improve(self, texts: list[str | None], names: list[str | None], tops: np.ndarray, masses: np.ndarray) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Best language so far, its log-probability and the sum of all in its terms, with these languages added."""
        names, tops, masses = list(names), tops.copy(), masses.copy()
        known = [k for k, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
        for k, row in zip(known, self.scores([texts[k] for k in known])):
            best = int(np.argmax(row))
            top = max(tops[k], row[best])
            masses[k] = masses[k] * np.exp(tops[k] - top) + np.exp(row - top).sum()
            if row[best] > tops[k]:
                names[k], tops[k] = self.languages[best], row[best]
        return names, tops, masses


@dataclass(frozen=True)
class ModelInBlocks:
    """More languages than are held at once: blocks of them in order of name, each learned when its turn comes."""

    taught: DataFrame
    totals: dict[str, int]
    rows_per_language: int

    def __iter__(self) -> Iterator[Model]:
        names = sorted(self.totals)
        for i in range(0, len(names), LANGUAGES_AT_ONCE):
            yield _learn(self.taught, names[i : i + LANGUAGES_AT_ONCE], self.totals, self.rows_per_language)


def fit(
    docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Model | ModelInBlocks:
    """Learn from the rows that have a text and a language.

    Rows are counted per language over the whole table, and about ``rows_per_language`` of each, chosen by a hash
    of the id, or of the text if the id is null, give the n-gram counts: the sample is bounded.  Of any number of
    languages the driver holds names and row counts; n-gram counts and log-probabilities are those of at most
    ``LANGUAGES_AT_ONCE`` at a time.  Repeated rows count each.
    """
    prepare(docs.sparkSession)
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")
    marked = docs.where(text.isNotNull() & lang.isNotNull())
    key = F.when(F.col(f"`{id_col}`").isNull(), F.xxhash64(text)).otherwise(F.xxhash64(f"`{id_col}`"))
    taught = marked.select(lang.alias("lang"), text_bytes(text_col).alias("text"), F.pmod(key, F.lit(STEPS)).alias("draw"))
    totals = {r["lang"]: r["count"] for r in taught.groupBy("lang").count().collect()}
    if len(totals) > LANGUAGES_AT_ONCE:
        return ModelInBlocks(taught, totals, rows_per_language)
    return _learn(taught, sorted(totals), totals, rows_per_language)


def _learn(taught: DataFrame, languages: list[str], totals: dict[str, int], rows_per_language: int) -> Model:
    """The model of some of the languages, from ``(lang, text, draw)``."""
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, int(STEPS * min(1.0, rows_per_language / totals[k])))])
    sample = taught.where(F.col("draw") < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                for _, starts, codes in _chunks([t.decode("utf-8", "replace")]):
                    for grams in _grams(starts, codes):
                        own += np.bincount(grams, minlength=BUCKETS + 1)
        for name, own in sums.items():
            at = np.flatnonzero(own[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at])], ["lang", "bucket", "n"])

    summed = sample.mapInArrow(count, "lang STRING, bucket INT, n BIGINT").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    found = summed.toPandas()
    counts[found["bucket"].to_numpy(), found["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()] = found["n"].to_numpy()
    return Model(languages, counts, np.array([totals[k] for k in languages], float), float(sum(totals.values())))


def _texts(column: pa.Array) -> list[str | None]:
    return [None if t is None else t.decode("utf-8", "replace") for t in column.to_pylist()]


def _by_blocks(plain: DataFrame, names: list[str], model: ModelInBlocks) -> DataFrame:
    """The named columns, language and score of rows with ``bytes``: one written pass for each block of languages.

    A pass carries the texts and the best so far, so a task holds one block's table; the result is that of a table
    of all languages.
    """
    held = [*names, "bytes", "best", "top", "mass"]
    start = {"best": F.lit(None).cast("string"), "top": F.lit(float("-inf")), "mass": F.lit(0.0)}
    state = plain.select(*names, "bytes", *[c.alias(k) for k, c in start.items()])
    schema = ", ".join(f"{c} {ddl_type(state, c)}" for c in held)
    for block in model:
        shared = plain.sparkSession.sparkContext.broadcast(block)

        def improve(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            best, top, mass = (batch.column(len(names) + k) for k in (1, 2, 3))
            made = shared.value.improve(_texts(batch.column(len(names))), best.to_pylist(), top.to_numpy(zero_copy_only=False), mass.to_numpy(zero_copy_only=False))
            arrays = [pa.array(made[0], pa.string()), pa.array(made[1], pa.float64()), pa.array(made[2], pa.float64())]
            return pa.RecordBatch.from_arrays([*batch.columns[: len(names) + 1], *arrays], held)

        state = stage(map_batches(state, improve, schema), "languages")
        shared.unpersist()
    found = F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred")
    return state.select(*names, found, F.when(F.col("mass") > 0, 1 / F.col("mass")).otherwise(0.0).alias("score"))


def identify(docs: DataFrame, model: Model | ModelInBlocks, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, lang_pred, score)`` of every row, from its text alone, and the columns to keep.

    The table of log-probabilities is broadcast; its size is bounded by buckets and ``LANGUAGES_AT_ONCE``; of more
    languages, one block after the other.  Null texts, those
    without a letter, and all texts if nothing was learned from, are ``und`` with score 0.  Equal scores: the first
    language by name.  Null ids stay null; repeated rows come out each.
    """
    spark = prepare(docs.sparkSession)
    selected = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col).alias("bytes"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)])
    wanted = [F.col("id").alias(id_col), "lang_pred", "score", *[F.col(f"c{k}").alias(c) for k, c in enumerate(keep)]]
    if isinstance(model, ModelInBlocks):
        return _by_blocks(selected, ["id", *[f"c{k}" for k in range(len(keep))]], model).select(*wanted)
    shared = spark.sparkContext.broadcast(model)
    names = ["id", "lang_pred", "score", *[f"c{k}" for k in range(len(keep))]]

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.predict(_texts(batch.column(1)))
        made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
        return pa.RecordBatch.from_arrays([batch.column(0), *made, *[batch.column(2 + k) for k in range(len(keep))]], names)

    kinds = "".join(f", c{k} {ddl_type(docs, c)}" for k, c in enumerate(keep))
    found = map_batches(selected, predict, f"id {ddl_type(docs, id_col)}, lang_pred STRING, score DOUBLE{kinds}")
    return found.select(*wanted)


def keep_identified(docs: DataFrame, model: Model | ModelInBlocks, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose text has a language of at least this probability, as they are; unknown ones go."""
    spark = prepare(docs.sparkSession)
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], text_bytes(text_col).alias("bytes"))
    if isinstance(model, ModelInBlocks):
        known = _by_blocks(plain, names, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
        return known.select(*names).toDF(*docs.columns)
    shared = spark.sparkContext.broadcast(model)

    def sift(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = [name != UNKNOWN and score >= min_score for name, score in shared.value.predict(_texts(batch.column(len(names))))]
        return batch.select(names).filter(pa.array(known))

    schema = ", ".join(f"{n} {ddl_type(docs, c)}" for n, c in zip(names, docs.columns))
    return map_batches(plain, sift, schema).toDF(*docs.columns)
