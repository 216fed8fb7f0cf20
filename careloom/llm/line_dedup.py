"""Lines that many documents share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.llm.runtime import ddl_type, map_batches, prepare, stage, text_bytes

ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The normalised line, if it is long enough to be compared."""
    key = line.strip(ASCII_SPACE)
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key.lower()


def _digests(lines: list[bytes], min_chars: int) -> list[bytes | None]:
    keys = [line_key(line, min_chars) for line in lines]
    return [xxhash.xxh3_128_digest(k) if k is not None else None for k in keys]


def _shared_lines(docs: DataFrame, min_chars: int, min_docs: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, dropped)``: for every document the 16-byte digests of the lines it loses, one after another."""

    def explode(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found = [], []
        for text in batch.column(1).to_pylist():
            own = set(_digests(text.split(b"\n"), min_chars)) - {None} if text else ()
            counts.append(len(own))
            found.extend(own)
        halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
        return pa.RecordBatch.from_arrays([ids, pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["id", "h", "g"])

    selected = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col))
    lines = stage(map_batches(selected, explode, f"id {ddl_type(docs, id_col)}, h BIGINT, g BIGINT"), "lines")
    each = lines.distinct()  # rows that repeat an id are one document
    shared = each.groupBy("h", "g").agg(F.count("*").alias("n"), F.max("id").alias("last")).where(F.col("n") >= min_docs)
    shared = stage(shared.select("h", "g", "last"), "shared-lines")
    lost = lines.join(shared, ["h", "g"]).where(~F.col("id").eqNullSafe(F.col("last")))
    return lost.groupBy("id").agg(F.collect_set(F.struct("h", "g")).alias("dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with shared lines taken out of their text, and ``n_lines`` and ``n_dropped``.

    A text is split at line ends; null or empty, it is one empty line.  A line's key is the line without ASCII
    white space at both ends, A-Z lower-cased.  A key of ``min_chars`` code points or more in ``min_docs``
    documents or more loses its lines in all of them but that of the largest id.  What stays is joined as it was.

    Keys travel as 128-bit digests, once for each document, and are counted with partial sums; only documents
    that lose lines get digests back.  Rows that repeat an id are one document and lose the same lines.  A null id
    is a document too, smaller than any other; the text comes back as a text, never null.
    """
    prepare(docs.sparkSession)
    lost = stage(_shared_lines(docs, min_chars, min_docs, id_col, text_col), "lost-lines")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, totals, gone = [], [], []
        for text, dropped in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            lines = (text or b"").split(b"\n")
            totals.append(len(lines))
            if dropped:
                dropped = {int(d["h"]).to_bytes(8, "little", signed=True) + int(d["g"]).to_bytes(8, "little", signed=True) for d in dropped}
                lines = [line for line, digest in zip(lines, _digests(lines, min_chars)) if digest not in dropped]
            gone.append(totals[-1] - len(lines))
            texts.append(b"\n".join(lines))
        made = [pa.array(texts, pa.binary()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64())]
        rest = [batch.column(k) for k in range(3, batch.num_columns)]
        return pa.RecordBatch.from_arrays([batch.column(0), *made, *rest], names)

    others = [c for c in docs.columns if c not in (id_col, text_col)]
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col).alias("text"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)])
    joined = plain.join(lost.withColumnRenamed("id", "lost_id"), F.col("id").eqNullSafe(F.col("lost_id")), "left")
    joined = joined.select("id", "text", "dropped", *[f"c{k}" for k in range(len(others))])
    names = ["id", "text", "n_lines", "n_dropped", *[f"c{k}" for k in range(len(others))]]
    kinds = "".join(f", c{k} {ddl_type(docs, c)}" for k, c in enumerate(others))
    done = map_batches(joined, cut, f"id {ddl_type(docs, id_col)}, text BINARY, n_lines BIGINT, n_dropped BIGINT{kinds}")
    back = {id_col: F.col("id"), text_col: F.col("text").cast("string")} | {c: F.col(f"c{k}") for k, c in enumerate(others)}
    found = {c: F.col(c) for c in ("n_lines", "n_dropped")}
    return done.select(*[back[c].alias(c) for c in docs.columns if c not in found], *[found[c] for c in found])
