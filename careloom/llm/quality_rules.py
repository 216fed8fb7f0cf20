"""Quality of texts by a learned list of rules over their statistics."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.llm.runtime import ddl_type, map_batches, prepare, stage, text_bytes

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# labelled rows that rules are learned from, about
SAMPLE_ROWS = 20_000
THRESHOLDS = 24
MOST_RULES = 12
MOST_CONDITIONS = 4
# a rule must be this right about rows it has not grown on
MIN_PRECISION = 0.98
MIN_COVERED = 5
_SYMBOLS, _MARKS, _UPPER = b"#*$%&|<>", b"!?\"'()-_=+~^`@{}[]/\\:;.,", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NOT_START = re.compile(rb"[\x80-\xbf]")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper", "n_distinct"]


def _without(text: bytes, some: bytes) -> int:
    return len(text) - len(text.translate(None, some))


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a run of ``WINDOW`` words found at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n]
    _, inverse, counts = np.unique(rolled, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    runs = [tuple(words[k : k + WINDOW]) for k in again.tolist()]  # equal hashes are looked at word by word
    found = Counter(runs)
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.array([k for k, run in zip(again.tolist(), runs) if found[run] > 1], np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def statistics_of(text: bytes | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS``."""
    text = text or b""
    words, lines = text.split(), text.split(b"\n")
    held = [line for line in lines if line.split()]
    letters = b"".join(words)
    chars = len(letters) - len(_NOT_START.findall(letters)) if not letters.isascii() else len(letters)
    return (
        len(words), chars, _without(text, _SYMBOLS), len(held) - len(set(held)), repeat_words(words), len(held),
        _without(text, _MARKS), _without(text, _UPPER), len(set(words)),
    )


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, *COUNTS)`` of every row; a null text has no words."""
    prepare(docs.sparkSession)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [statistics_of(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in zip(*rows)]], ["id", *COUNTS])

    schema = f"id {ddl_type(docs, id_col)}, " + ", ".join(f"{c} BIGINT" for c in COUNTS)
    return map_batches(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), measure, schema).withColumnRenamed("id", id_col)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def features() -> dict[str, Column]:
    """What conditions are about; shares of nothing are 0."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "word_chars"),
        "marks": share("n_marks", "word_chars"),
        "upper": share("n_upper", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "distinct": share("n_distinct", "n_words"),
    }


Condition = tuple[str, str, float]


def _holds(rows: pd.DataFrame, rule: list[Condition]) -> np.ndarray:
    out = np.ones(len(rows), bool)
    for name, side, value in rule:
        out &= (rows[name] <= value if side == "<=" else rows[name] > value).to_numpy()
    return out


def _grow(rows: pd.DataFrame, bad: np.ndarray) -> list[Condition]:
    """Add the condition of the largest information gain for the bad rows until only those are covered."""
    rule: list[Condition] = []
    inside = np.ones(len(rows), bool)
    while len(rule) < MOST_CONDITIONS and (inside & ~bad).any() and (inside & bad).any():
        p, n = (inside & bad).sum(), inside.sum()
        best, choice = 1e-9, None
        for name in rows.columns:
            values = rows[name].to_numpy()
            for value in np.unique(np.quantile(values[inside & bad], np.linspace(0, 1, THRESHOLDS))).tolist() + np.unique(np.quantile(values[inside & ~bad], np.linspace(0, 1, THRESHOLDS))).tolist():
                low = inside & (values <= value)
                for side, cover in (("<=", low), (">", inside & ~low)):
                    p1, n1 = (cover & bad).sum(), cover.sum()
                    if p1:
                        gain = p1 * (np.log2(p1 / n1) - np.log2(p / n))
                        if gain > best:
                            best, choice = gain, (name, side, float(value))
        if choice is None:
            break
        rule.append(choice)
        inside &= _holds(rows, [choice])
    return rule


def _prune(rows: pd.DataFrame, bad: np.ndarray, rule: list[Condition]) -> list[Condition]:
    """The shortest beginning of the rule that is as right as any about rows it has not seen."""
    best, choice = -2.0, rule
    for k in range(1, len(rule) + 1):
        cover = _holds(rows, rule[:k])
        if cover.sum() >= 1:
            worth = (2 * (cover & bad).sum() - cover.sum()) / cover.sum()
            if worth > best + 1e-9:
                best, choice = worth, rule[:k]
    return choice


def learn_rules(rows: pd.DataFrame, bad: np.ndarray, min_precision: float = MIN_PRECISION) -> list[list[Condition]]:
    """Rules for bad rows by sequential covering: each is grown on two thirds of the rows that no rule covers yet,
    pruned on the others, and accepted if it is right there; learning ends with the first that is not."""
    rules: list[list[Condition]] = []
    hold_out = np.arange(len(rows)) % 3 == 2
    left = np.ones(len(rows), bool)
    while len(rules) < MOST_RULES and (left & bad & ~hold_out).sum() >= MIN_COVERED:
        grown = _grow(rows[left & ~hold_out], bad[left & ~hold_out])
        if not grown:
            break
        rule = _prune(rows[left & hold_out], bad[left & hold_out], grown)
        cover = _holds(rows, rule)
        seen = cover & left & hold_out
        if (seen & bad).sum() < max(1, min_precision * seen.sum()) or (cover & left & bad).sum() < MIN_COVERED:
            break
        rules.append(rule)
        left &= ~cover
    return rules


def verdict(rules: list[list[Condition]], columns: dict[str, Column]) -> Column:
    """The rules as one ordered conditional: the number of the first that holds, from 1 on; 0 if none does."""
    out = None
    for number, rule in enumerate(rules, 1):
        holds = reduce(lambda a, b: a & b, [columns[name] <= value if side == "<=" else columns[name] > value for name, side, value in rule])
        out = F.when(holds, number) if out is None else out.when(holds, number)
    return F.lit(0) if out is None else out.otherwise(0)


def judge_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``(id, *COUNTS, base_failed, rule, kept)`` of every row.

    Words stand between ASCII white space.  Rows of fewer than ten words, or with over 20 percent of their words
    in runs of five that the text repeats, fail; of the others a decision list drops those that its rules are
    about.  It is learned from the statistics of about ``sample_rows`` labelled rows (all, if fewer), chosen by a
    hash of the id, label 0 meaning bad, and applied as one conditional expression.  Without labels nothing more
    is dropped.  Null labels are no labels; an id with several labels counts with each.  Null and empty texts have
    no words and fail; null ids stay null; repeated rows come out each.
    """
    prepare(docs.sparkSession)
    stats = stage(text_statistics(docs, id_col, text_col), "statistics")
    key = F.col(f"`{id_col}`")
    label = F.col(f"`{label_col}`").cast("int")
    known = labels.select(key.alias("labelled_id"), label.alias("label")).where("label IS NOT NULL AND labelled_id IS NOT NULL")
    steps, total = 1 << 30, known.count()
    known = known.where(F.pmod(F.xxhash64("labelled_id"), F.lit(steps)) < int(steps * min(1.0, sample_rows / max(1, total))))
    columns = features()
    taught = stats.where(~base_failed()).join(known, key == F.col("labelled_id")).select("labelled_id", "label", *[c.alias(n) for n, c in columns.items()])
    rows = taught.toPandas()
    rows = rows.iloc[np.lexsort([rows[c].to_numpy() for c in ["label", *columns]] + [pd.util.hash_array(rows["labelled_id"].to_numpy())])] if len(rows) else rows
    rules = learn_rules(rows[list(columns)], (rows["label"] == 0).to_numpy())
    rule = verdict(rules, columns)
    return stats.withColumn("base_failed", base_failed()).withColumn("rule", rule).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
