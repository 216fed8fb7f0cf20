"""Ranked lexical search: documents whose item terms are the same bag are scored once, and their members ranked by id."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careloom.llm.runtime import ddl_type, map_batches, prepare, segments, stage, text_bytes

# items and bytes of item text that one index holds; more of them are searched for in several rounds
INDEX_ITEMS = 4096
INDEX_BYTES = 8 << 20
# terms found, and candidates held, before they are summed up or cut down to the best
HELD_TERMS = 1 << 20
HELD_CANDIDATES = 1 << 18
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all that is not ASCII; A-Z count as a-z."""
    return text.translate(_TERMS).split()


def bags_of(texts: list[bytes | None], number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and its bag of known terms: where it begins, and pairs of term and count in the terms' order."""
    sizes, keys, counts, found, rows = [], [], [], [], []
    known, wide = number.get, max(1, len(number))

    def sum_up() -> None:
        key, n = np.unique(np.repeat(*np.array(rows, np.int64).reshape(-1, 2).T) * wide + np.array(found, np.int64), return_counts=True)
        keys.append(key)
        counts.append(n)
        found.clear()
        rows.clear()

    for row, text in enumerate(texts):
        size = 0
        for part in segments(text or b""):
            words = terms_of(part)
            size += len(words)
            before = len(found)
            found += [k for k in map(known, words) if k is not None]
            rows.append((row, len(found) - before))
            if len(found) >= HELD_TERMS:
                sum_up()
        sizes.append(size)
    sum_up()
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(inverse, np.concatenate(counts), len(key)).astype(np.int64)
    starts = np.searchsorted(key, np.arange(len(texts) + 1) * wide)
    return np.array(sizes, np.int64), starts, np.stack([key % wide, n], axis=1).astype("<u4")


def _bags(docs: DataFrame, number, id_col: str, text_col: str) -> DataFrame:
    """``(id, n, bag)`` of every row, from a broadcast numbering of the terms."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, starts, pairs = bags_of(batch.column(1).to_pylist(), number.value)
        packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((starts * 8).astype("<i4")), pa.py_buffer(np.ascontiguousarray(pairs))])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), packed], ["id", "n", "bag"])

    selected = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col))
    return map_batches(selected, make, f"id {ddl_type(docs, id_col)}, n BIGINT, bag BINARY")


def _frequency(bags: DataFrame, terms: int) -> np.ndarray:
    """In how many rows each term stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(terms, np.int64)
        for batch in batches:
            sums += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")[::2], minlength=terms)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], ["term", "n"])

    summed = bags.select("bag").mapInArrow(count, "term INT, n BIGINT").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(terms, np.int64)
    for r in summed.collect():
        out[r["term"]] = r["n"]
    return out


class Index:
    """Weights of the terms, and the sets of terms that hold each of them."""

    def __init__(self, sets: list[list[int]], weights: np.ndarray):
        self.weights, self.sets = weights, len(sets)
        term = np.array([t for s in sets for t in s], np.int64)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(term, kind="stable")
        self.owner = owner[order]
        self.first = np.searchsorted(term[order], np.arange(len(weights) + 1))

    def scores(self, bags: list[bytes], m: np.ndarray) -> np.ndarray:
        """Scores of each bag for each set, in whole numbers."""
        pairs = np.frombuffer(b"".join(bags), "<u4").reshape(-1, 2).astype(np.int64)
        row = np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags])
        term, tf = pairs[:, 0], pairs[:, 1]
        share = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
        size = self.first[term + 1] - self.first[term]
        entry = np.repeat(self.first[term] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
        out = np.zeros(len(bags) * self.sets, np.int64)
        np.add.at(out, np.repeat(row, size) * self.sets + self.owner[entry], np.repeat(share, size))
        return out.reshape(len(bags), self.sets)


class Best:
    """The ``limit`` best classes of each set so far, of equal scores those that came first."""

    def __init__(self, sets: int, limit: int):
        self.limit, self.held, self.seen = limit, 0, 0
        self.bar = np.zeros(sets, np.int64)
        self.parts: list[tuple] = []

    def add(self, scores: np.ndarray, classes: np.ndarray, ids: pa.Array) -> None:
        # a later class of the same score stands behind those that a full list holds
        row, owner = np.nonzero(scores > self.bar)
        if len(row):
            self.parts.append((owner, scores[row, owner], self.seen + row, classes[row], ids.take(pa.array(row))))
            self.held += len(row)
        self.seen += len(classes)
        if self.held >= HELD_CANDIDATES:
            self.cut()

    def cut(self) -> tuple:
        owner, score, place, classes = (np.concatenate([p[k] for p in self.parts]) for k in range(4))
        ids = pa.concat_arrays([p[4] for p in self.parts])
        order = np.lexsort((place, -score, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        last = order[rank == self.limit - 1]
        self.bar[owner[last]] = score[last]
        order = order[rank < self.limit]
        self.parts = [(owner[order], score[order], place[order], classes[order], ids.take(pa.array(order)))]
        self.held = len(order)
        return self.parts[0]


def _item_sets(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, terms, digest)`` of every item with terms: its different terms, sorted."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [sorted(set(terms_of(t or b""))) for t in batch.column(1).to_pylist()]
        digests = [xxhash.xxh3_128_digest(b" ".join(s)) for s in sets]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.binary())), pa.array(digests, pa.binary())], ["item", "terms", "digest"])

    selected = items.select(F.col(f"`{item_col}`").alias("item"), text_bytes(text_col))
    return map_batches(selected, make, f"item {ddl_type(items, item_col)}, terms ARRAY<BINARY>, digest BINARY").where("size(terms) > 0")


def search(
    docs: DataFrame, items: DataFrame, limit: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(item, rank, id, score)``: for every item its ``limit`` best rows of ``docs`` with a score above 0.

    Scores are whole numbers: a term weighs ``floor(1000 ln((2N+2)/(2df+1)))``, and a row of ``n`` terms in which it
    stands ``tf`` times gets that times ``10^9 tf div (1000 tf + 20 m)`` with ``m = 50 + 50 n N div L``; ``N`` counts
    the rows with a term, ``L`` their terms.  Equal scores stand by ascending id, null ids last.

    A row is cut down to the bag of its terms that any item has.  Rows whose bag and ``m`` are the same are one class,
    found by their hash and told apart by the bags themselves; a class is scored once, and its members, of which no
    ranking needs more than the ``limit`` first by id, are laid out by id at the end.  Each task keeps the best classes
    of each item only, so neither a term that all rows have nor a class of very many rows makes more than that.

    Items with the same terms are one set.  Sets are broadcast in blocks of ``INDEX_ITEMS`` and ``INDEX_BYTES``; more of
    them are searched for block by block.  Null and empty texts have no terms; repeated rows and items come out each;
    no rows or items with terms give no rows; other columns are not looked at.
    """
    spark = prepare(docs.sparkSession)
    names = {"item": item_col, "id": id_col}
    held = stage(_item_sets(items, item_col, item_text_col), "item-sets")
    sets = held.groupBy("digest").agg(F.first("terms").alias("terms"))
    sets = stage(sets.withColumn("bytes", F.expr("aggregate(terms, 0L, (n, t) -> n + octet_length(t) + 1)")), "sets")
    size = sets.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    blocks = max(-(-size["n"] // INDEX_ITEMS), -(-(size["bytes"] or 0) // INDEX_BYTES))
    found = None
    for block in range(blocks):
        own = sets.where(F.pmod(F.xxhash64("digest"), F.lit(blocks)) == block).select("digest", "terms").orderBy("digest").collect()
        if own:
            part = _search_block(docs, [(bytes(r["digest"]), [bytes(t) for t in r["terms"]]) for r in own], limit, id_col, text_col)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"item {ddl_type(items, item_col)}, rank INT, id {ddl_type(docs, id_col)}, score BIGINT").withColumnsRenamed(names)
    return held.select("item", "digest").join(found, "digest").select("item", "rank", "id", "score").withColumnsRenamed(names)


def _search_block(docs: DataFrame, own: list[tuple[bytes, list[bytes]]], limit: int, id_col: str, text_col: str) -> DataFrame:
    """``(digest, rank, id, score)`` of some sets of terms."""
    spark = docs.sparkSession
    number = {t: k for k, t in enumerate(sorted({t for _, terms in own for t in terms}))}
    bags = stage(_bags(docs, spark.sparkContext.broadcast(number), id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "bags")
    total = bags.where("n > 0").agg(F.count("*").alias("rows"), F.sum("n").alias("terms")).first()
    rows = total["rows"]
    weights = np.array([math.floor(1000 * math.log((2 * rows + 2) / (2 * df + 1))) for df in _frequency(bags, len(number)).tolist()], np.int64)
    index = spark.sparkContext.broadcast(Index([[number[t] for t in terms] for _, terms in own], weights))
    digests = spark.sparkContext.broadcast(pa.array([d for d, _ in own], pa.binary()))

    # a class is what has the same bag and m; it is known by its first row
    m = F.expr(f"cast(50 + (cast(50 * n as decimal(20, 0)) * {rows}BD) div {total['terms'] or 1}BD as bigint)")
    classed = bags.where("length(bag) > 0").withColumn("m", m).withColumn("hash", F.xxhash64("bag", "m"))
    same = Window.partitionBy("hash", "m", "bag").orderBy(F.asc_nulls_last("id"), "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = classed.withColumn("place", F.row_number().over(same)).withColumn("class", F.first("row").over(same)).where(F.col("place") <= limit)
    members = stage(members.select("class", "place", "id", "m", "bag"), "members")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(index.value.sets, limit)
        for batch in batches:
            if batch.num_rows:
                found = index.value.scores(batch.column(2).to_pylist(), batch.column(1).to_numpy())
                best.add(found, batch.column(0).to_numpy(), batch.column(3))
        if best.parts:
            owner, scores, _, classes, ids = best.cut()
            yield pa.RecordBatch.from_arrays([digests.value.take(pa.array(owner)), pa.array(scores), pa.array(classes), ids], ["digest", "score", "class", "id"])

    first = members.where("place = 1").select("class", "m", "bag", "id").sortWithinPartitions(F.asc_nulls_last("id"), "class")
    candidates = first.mapInArrow(score, f"digest BINARY, score BIGINT, class BIGINT, id {ddl_type(docs, id_col)}")
    by_score = Window.partitionBy("digest").orderBy(F.desc("score"), F.asc_nulls_last("id"), "class")
    winners = candidates.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= limit)
    winners = stage(winners.select("digest", "score", "class"), "winners")
    ranked = winners.join(members.select("class", "id"), "class").withColumn("rank", F.row_number().over(by_score))
    return ranked.where(F.col("rank") <= limit).select("digest", "rank", "id", "score")
