"""Passages of training documents that contain test items, found by BM25 with block maxima and checked word by word."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.llm.runtime import ddl_type, fresh_name, map_batches, prepare, stage, text_bytes

K1, B = 1.2, 0.75
# items, and bytes of test text, that one index holds, and indexes that one pass over the documents searches
INDEX_ITEMS = 1024
INDEX_BYTES = 1 << 20
INDEXES = 4
# neighbouring items whose postings share a maximum
BLOCK_ITEMS = 4
# words searched at a time, in whole documents, and cells of the table of passages and terms they are put in
CHUNK_WORDS = 1 << 17
CELLS = 1 << 24
# words that a passage has at least
PASSAGE_WORDS = 64
# runs of words compared in the check
RUN = 3
_LETTERS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))
_SENTENCE_END = re.compile(rb"[.!?]+\s+|\n+")


def terms_of(text: bytes | None) -> list[bytes]:
    """Words of letters and digits, lower-cased."""
    if not text:
        return []
    return text.decode("utf-8", "replace").lower().encode().translate(_LETTERS).split()


def question_and_answer(text: bytes | None) -> tuple[list[bytes], list[bytes]]:
    """An item's words up to its last sentence, and those of the last sentence; of a single sentence, its last third."""
    parts = [p for p in map(terms_of, _SENTENCE_END.split(text or b"")) if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def _runs(words: list[bytes]) -> set[tuple]:
    if not words:
        return set()
    k = min(RUN, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def overlap(part: list[bytes], runs_by_length: dict[int, set]) -> float:
    """Share of the part's runs of words that the passage has; an empty part is there in full."""
    runs = _runs(part)
    return sum(r in runs_by_length[len(r)] for r in runs) / len(runs) if runs else 1.0


class Index:
    """Postings of items, in order of the items, with the largest impact per term and per block of neighbouring items.

    Impacts are BM25 weights as shares of the item's own total, so that a passage with all words of an item
    scores 1 for it.
    """

    def __init__(self, items: pa.Array, texts: list[bytes], total: int, mean_words: float, frequency: dict[bytes, int]):
        self.items = items
        self.parts = [question_and_answer(text) for text in texts]
        self.term: dict[bytes, int] = {}
        postings: list[tuple[int, int, float]] = []
        longest = 1
        for k, text in enumerate(texts):
            words = terms_of(text)
            longest = max(longest, len(words))
            weights = {}
            for t, tf in Counter(words).items():
                idf = math.log1p((total - frequency[t] + 0.5) / (frequency[t] + 0.5))
                weights[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            own = sum(weights.values())
            postings += [(self.term.setdefault(t, len(self.term)), k, w / own) for t, w in weights.items()]
        self.stride = max(PASSAGE_WORDS, longest)
        self.blocks = (len(texts) + BLOCK_ITEMS - 1) // BLOCK_ITEMS
        postings.sort()
        term, self.item = (np.array([p[k] for p in postings], np.int64) for k in (0, 1))
        self.impact = np.array([p[2] for p in postings])
        self.maxima = np.zeros((len(self.term), self.blocks), np.float32)
        np.maximum.at(self.maxima, (term, self.item // BLOCK_ITEMS), self.impact)
        # where the postings of a term in a block are
        self.entry, self.entry_start = np.unique(term * self.blocks + self.item // BLOCK_ITEMS, return_index=True)
        self.entry_end = np.append(self.entry_start[1:], len(term))

    def search(self, documents: list[list[bytes]], threshold: float) -> dict[tuple[int, int], list[tuple[int, float]]]:
        """For every document and item, the passages that score for it at the threshold or above, with their scores.

        Passages are pairs of neighbouring strides of words, so any run as long as an item lies within one.  All
        passages of the documents stand one below the other, with an empty stride after each document.
        """
        sizes = np.array([len(d) for d in documents], np.int64)
        strides = np.maximum(1, -(-sizes // self.stride))
        first = np.append(0, np.cumsum(strides + 1))
        ids = np.fromiter(map(self.term.get, chain.from_iterable(documents), repeat(-1)), np.int32, int(sizes.sum()))
        at = np.flatnonzero(ids >= 0)
        word_start = np.append(0, np.cumsum(sizes))
        owner = np.searchsorted(word_start, at, "right") - 1
        stride, term = first[owner] + (at - word_start[owner]) // self.stride, ids[at]
        # the last stride of several makes no passage of its own
        begins = np.zeros(first[-1], bool)
        begins[np.concatenate([np.arange(f, f + max(1, s - 1)) for f, s in zip(first.tolist(), strides.tolist())])] = True
        found: dict[tuple[int, int], list[tuple[int, float]]] = defaultdict(list)
        step = max(1, CELLS // max(1, len(self.term)))
        for low in range(0, int(first[-1]), step):
            high = min(low + step, int(first[-1]))
            i, j = np.searchsorted(stride, [low, high + 1])
            for passage, item, score in self._pivots(stride[i:j] - low, term[i:j], begins[low:high], threshold):
                document = int(np.searchsorted(first, passage + low, "right")) - 1
                found[document, item].append((passage + low - int(first[document]), score))
        return found

    def _pivots(self, stride: np.ndarray, term: np.ndarray, begins: np.ndarray, threshold: float):
        """Block-max WAND for many passages at once.

        A passage's pivots are the blocks of items where the maxima of its terms' postings reach the threshold
        together; it jumps from one pivot to the next over all items between them, and scores the items of a pivot's
        block from their postings.
        """
        held = np.zeros((len(begins), len(self.term)), bool)
        own = stride < len(begins)
        held[stride[own], term[own]] = True
        held[stride[stride > 0] - 1, term[stride > 0]] = True
        held[~begins] = False
        passage, term = np.nonzero(held)
        if not len(passage):
            return
        start = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
        end = np.append(start[1:], len(passage))
        # the maxima are in single precision
        row, block = np.nonzero(np.add.reduceat(self.maxima[term], start, axis=0) >= threshold - 1e-4)
        if not len(row):
            return
        size = end[row] - start[row]
        pair = np.repeat(np.arange(len(row)), size)
        wanted = term[_runs_from(start[row], size)] * self.blocks + block[pair]
        entry = np.minimum(np.searchsorted(self.entry, wanted), len(self.entry) - 1)
        there = self.entry[entry] == wanted
        pair, entry = pair[there], entry[there]
        size = self.entry_end[entry] - self.entry_start[entry]
        posting = _runs_from(self.entry_start[entry], size)
        hit = np.repeat(pair, size) * BLOCK_ITEMS + self.item[posting] % BLOCK_ITEMS
        score = np.bincount(hit, self.impact[posting], len(row) * BLOCK_ITEMS)
        for k in np.flatnonzero(score >= threshold - 1e-9).tolist():
            p, slot = divmod(k, BLOCK_ITEMS)
            yield int(passage[start[row[p]]]), int(block[p]) * BLOCK_ITEMS + slot, float(score[k])

    def leaks(self, documents: list[list[bytes]], threshold: float, min_overlap: float) -> list[tuple]:
        """``(document, item, score, question overlap, answer overlap, passages)`` of the items that the documents have.

        Question and answer are looked for in one passage; the one that has most of them counts.
        """
        out = []
        for (document, item), passages in sorted(self.search(documents, threshold).items()):
            words, best = documents[document], (-1.0, 0.0, 0.0)
            for p, _ in passages:
                window = words[p * self.stride : (p + 2) * self.stride]
                runs = {n: set(zip(*(window[i:] for i in range(n)))) for n in range(1, RUN + 1)}
                question, answer = (overlap(part, runs) for part in self.parts[item])
                best = max(best, (min(question, answer), question, answer))
            if best[0] >= min_overlap:
                out.append((document, item, min(max(s for _, s in passages), 1.0), best[1], best[2], len(passages)))
        return out


def _runs_from(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    return np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())


def find_leaks(
    docs: DataFrame, items: DataFrame, threshold: float = 0.5, min_overlap: float = 0.6, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(id, item id, score, question_overlap, answer_overlap, n_passages)`` for every row that contains a test item.

    Every passage of every row is a query to an inverted index of the items.  It retrieves all items whose BM25
    score is at least ``threshold`` of what the whole item would score; maxima by term and block of items spare the
    rest.  An item counts as found if one passage has at least ``min_overlap`` of the runs of three words of both its
    question and its answer (its last sentence, or the last third of a single one); ``score`` is that of its best
    passage and ``n_passages`` counts those that scored.

    Indexes are broadcast, and bounded: items are dealt to indexes of up to about ``INDEX_ITEMS`` items and
    ``INDEX_BYTES`` of text, whatever their text, of which one pass over the rows searches ``INDEXES``, with term
    statistics over all items.  Null and empty texts contain nothing and items without words are never found; null ids are kept as they
    are; repeated rows and items are each reported; with no rows or no items there are none.  If both id columns have
    one name, that of the items gets ``test_`` before it.
    """
    spark = prepare(docs.sparkSession)
    tests = items.select(F.col(f"`{item_col}`").alias("item"), text_bytes(item_text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    tests = stage(tests, "tests")

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [terms_of(t) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.binary()))], ["words"])

    terms = map_batches(tests.select("text"), words, "words ARRAY<BINARY>").where("size(words) > 0")
    totals = terms.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean")).first()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    schema = f"id {ddl_type(docs, id_col)}, item {ddl_type(items, item_col)}, score DOUBLE, question_overlap DOUBLE, answer_overlap DOUBLE, n_passages BIGINT"
    blocks = max(-(-totals["n"] // INDEX_ITEMS), -(-size // INDEX_BYTES))
    block = F.pmod(F.xxhash64("row"), F.lit(max(1, blocks)))
    frequency = stage(terms.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").count(), "item-terms")
    out = None
    for low in range(0, blocks if totals["n"] else 0, INDEXES):
        indexes = []
        for number in range(low, min(low + INDEXES, blocks)):
            own = tests.where(block == number).orderBy("item", "text", "row").select("item", "text").toArrow().combine_chunks()
            texts = [t or b"" for t in own.column("text").to_pylist()]
            known = [k for k, t in enumerate(texts) if terms_of(t)]
            if known:
                held = map_batches(tests.where(block == number).select("text"), words, "words ARRAY<BINARY>").select(F.explode("words").alias("term")).distinct()
                counts = {bytes(r["term"]): r["count"] for r in frequency.join(held, "term", "left_semi").collect()}
                ids = own.column("item").combine_chunks().take(pa.array(known, pa.int64()))
                indexes.append(Index(ids, [texts[k] for k in known], totals["n"], totals["mean"], counts))
        if indexes:
            shared = spark.sparkContext.broadcast(indexes)
            selected = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col))
            found = map_batches(selected, lambda batch, shared=shared: _leaks_of(batch, shared.value, threshold, min_overlap), schema)
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_col, "item": item_col if item_col != id_col else f"test_{item_col}"})


def _leaks_of(batch: pa.RecordBatch, indexes: list[Index], threshold: float, min_overlap: float) -> pa.RecordBatch | None:
    """The leaks of a batch of texts, some whole documents at a time."""
    parts, documents, rows, held = [], [], [], 0
    texts = batch.column(1).to_pylist()
    for row, text in enumerate(texts):
        words = terms_of(text)
        if words:
            documents.append(words)
            rows.append(row)
            held += len(words)
        if documents and (held >= CHUNK_WORDS or row == len(texts) - 1):
            for index in indexes:
                found = index.leaks(documents, threshold, min_overlap)
                if found:
                    document, item, *numbers = zip(*found)
                    columns = [batch.column(0).take(pa.array([rows[d] for d in document])), index.items.take(pa.array(item))]
                    columns += [pa.array(n, pa.float64() if k < 3 else pa.int64()) for k, n in enumerate(numbers)]
                    parts.append(pa.RecordBatch.from_arrays(columns, ["id", "item", "score", "question_overlap", "answer_overlap", "n_passages"]))
            documents, rows, held = [], [], 0
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if parts else None


def without_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that contain no test item; a row with a null id stays only if no row with a null id has one."""
    name = fresh_name(docs, "leaked")
    found = stage(leaks.select(F.col(f"`{id_col}`").alias(name)).distinct(), "leaked")
    return docs.join(found, F.col(f"`{id_col}`").eqNullSafe(F.col(name)), "left_anti")
