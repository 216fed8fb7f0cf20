"""License notices in texts, found by votes on diagonals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careloom.llm.runtime import ddl_type, map_batches, prepare, stage, text_bytes

# fixed values: phrases that have to be found, with their labels
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# fixed values: the usual notices of public licenses
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by-4.0",
    "this work is licensed under a creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
GRAM = 2
# share of a notice's grams that one place must have, if it has many; licenses of one family differ by a word
MIN_SHARE = 0.8
MANY_GRAMS = 10
# diagonals this far apart may belong to one place
NEAR = 2
_WORDS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(GRAM)], np.uint64)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of ASCII letters and digits and all other characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_WORDS).split() if text else []


class Templates:
    """Grams of all templates: where they stand, and their words."""

    def __init__(self, texts: list[str]):
        self.hashes: dict[bytes, int] = {}
        self.grams: dict[int, tuple[bytes, ...]] = {}
        self.places: list[tuple[int, int, int]] = []
        for number, text in enumerate(texts):
            words = words_of(text.encode())
            for at, h in enumerate(self.rolled(words).tolist()):
                self.grams[h] = tuple(words[at : at + GRAM])
                self.places.append((h, number, at))
        self.known = np.array(sorted(self.grams), np.int64)

    def rolled(self, words: list[bytes]) -> np.ndarray:
        """Rolling hashes of runs of ``GRAM`` words."""
        hashes, digest = self.hashes, xxhash.xxh64_intdigest
        if len(hashes) > 1 << 18:
            hashes.clear()
        for w in set(words).difference(hashes):
            hashes[w] = digest(w)
        each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        total = np.zeros(max(0, len(words) - GRAM + 1), np.uint64)
        for k in range(GRAM):
            total += each[k : k + len(total)] * _FACTORS[k]
        return total.view(np.int64)

    def hits(self, words: list[bytes]) -> list[dict]:
        """Places whose gram some template has, word by word."""
        rolled = self.rolled(words)
        found = np.searchsorted(self.known, rolled)
        at = np.flatnonzero(self.known[np.minimum(found, len(self.known) - 1)] == rolled)
        return [{"at": k, "h": h} for k, h in zip(at.tolist(), rolled[at].tolist()) if tuple(words[k : k + GRAM]) == self.grams[h]]


def scan_licenses(docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans)`` of every row.

    All runs of two words of all rows are hashed; those that some template has, compared word by word, are joined
    with the places of the templates, and each match votes for a diagonal: its place in the row less that in the
    template.  A base phrase, or a short notice, stands where its diagonal has every vote, so all places are counted.
    A long notice may differ a little: neighbouring diagonals are merged into one span, which counts if it has at
    least ``MIN_SHARE`` of the notice's votes within one and a half times its length.

    ``score`` is the best share of votes, 0 without a label; ``spans`` lists ``(label, first, last, share)``.  Rows
    without any have null places and empty labels; null and empty texts have no words; rows that repeat an id are
    scanned each by their own text; null ids stay null.  Templates have two words at least.
    """
    spark = prepare(docs.sparkSession)
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices
    texts = [*base, *notices]
    lengths = [len(words_of(t.encode())) for t in texts]
    if min(lengths, default=GRAM) < GRAM:
        raise ValueError(f"a template needs at least {GRAM} words")
    templates = Templates(texts)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        totals, marks, found = [], [], []
        for text in batch.column(1).to_pylist():
            words = words_of(text)
            totals.append(len(words))
            marks.append(xxhash.xxh3_128_digest(text or b""))
            found.append(templates.hits(words))
        hits = pa.array(found, pa.list_(pa.struct([("at", pa.int64()), ("h", pa.int64())])))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.binary()), pa.array(totals, pa.int64()), hits], ["id", "mark", "n_words", "hits"])

    schema = f"id {ddl_type(docs, id_col)}, mark BINARY, n_words BIGINT, hits ARRAY<STRUCT<at: BIGINT, h: BIGINT>>"
    rows = stage(map_batches(docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col)), scan, schema), "grams")
    places = spark.createDataFrame(templates.places, "h BIGINT, template INT, t BIGINT")
    about = [(k, n - GRAM + 1, k < len(base), [*base.values(), *notices.values()][k]) for k, n in enumerate(lengths)]
    about = spark.createDataFrame(about, "template INT, grams INT, is_base BOOLEAN, label STRING")

    hit = rows.where("size(hits) > 0").select("id", "mark", F.explode("hits").alias("hit")).select("id", "mark", "hit.at", "hit.h").distinct()
    votes = hit.join(F.broadcast(places), "h").withColumn("diagonal", F.col("at") - F.col("t"))
    voted = votes.groupBy("id", "mark", "template", "diagonal").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high"))
    voted = voted.join(F.broadcast(about), "template")

    exact = f"(is_base OR grams < {MANY_GRAMS})"
    whole = voted.where(f"{exact} AND n = grams").select("id", "mark", "label", "is_base", F.col("diagonal").alias("first"), F.expr("diagonal + grams").alias("last"), F.lit(1.0).alias("share"))
    order = Window.partitionBy("id", "mark", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order) > NEAR
    island = F.sum(F.coalesce(gap, F.lit(True)).cast("int")).over(order)
    merged = voted.where(f"NOT {exact}").withColumn("island", island).groupBy("id", "mark", "template", "island", "label", "is_base", "grams")
    merged = merged.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    fuzzy = merged.where(f"n >= {MIN_SHARE} * grams AND high - low < 1.5 * grams + 1").select("id", "mark", "label", "is_base", F.col("low").alias("first"), F.expr(f"high + {GRAM - 1}").alias("last"), F.least(F.lit(1.0), F.col("n") / F.col("grams")).alias("share"))
    spans = whole.unionByName(fuzzy)
    in_base = F.when(F.col("is_base"), F.col("first"))
    found = spans.groupBy("id", "mark").agg(
        F.count(in_base).alias("n_base"), F.min(in_base).alias("first_word"), F.max(in_base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.struct("first", "last", "label", "share"))).alias("spans"),
    )
    found = found.withColumnsRenamed({"id": "found_id", "mark": "found_mark"})
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("mark") == F.col("found_mark")), "left")
    return joined.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "spans",
    )
