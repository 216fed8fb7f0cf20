"""Packing token sequences into windows with little padding."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careloom.llm.encoding import TextIds, of_worker
from careloom.llm.runtime import ddl_type, prepare, stage, text_bytes

# ids that one Arrow batch of pieces holds
BATCH_IDS = 1 << 20


def fill(target: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths whose sum is closest to the target from below.

    Subset sums are the set bits of one number.  Lengths are offered from the longest on, each as often as it is
    there, by powers of two; a stage keeps the sums reached before it, so that the counts can be traced back from
    the largest sum.  It ends as soon as the target is reached.
    """
    mask = (1 << target + 1) - 1
    sums, stages = 1, []
    for length in sorted((n for n in counts if n <= target), reverse=True):
        left, copies = min(counts[length], target // length), 1
        while left:
            take = min(copies, left)
            stages.append((length, take, sums))
            sums |= sums << length * take & mask
            left, copies = left - take, copies * 2
        if sums >> target & 1:
            break
    reached, used = sums.bit_length() - 1, Counter()
    for length, take, before in reversed(stages):
        if not before >> reached & 1:
            reached -= length * take
            used[length] += take
    return dict(used)


def plan_windows(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, dict[int, int], int]], dict[int, int]]:
    """Windows that are filled exactly, as ``(first window, {length: pieces in it}, number of such windows)``.

    The longest length is set first and the rest of the window filled by ``fill``; the same filling is repeated as
    often as the counts allow.  A length that cannot lead to a full window is set aside.  Also returns the counts
    that are left.  Work and result are bounded by the capacity, however many pieces there are.
    """
    left, aside, windows, made = dict(counts), {}, [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fill(capacity - longest, {n: c for n, c in left.items() if c})
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        if sum(n * c for n, c in used.items()) < capacity:
            aside[longest] = left.pop(longest)
            continue
        times = min(left[n] // c for n, c in used.items())
        windows.append((made, used, times))
        made += times
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return windows, aside


class Places:
    """Where the k-th piece of a length goes."""

    def __init__(self, counts: dict[int, int], capacity: int, first_window: int):
        self.capacity = capacity
        windows, aside = plan_windows(counts, capacity)
        runs: dict[int, list[tuple[int, int, int, int, int]]] = {}
        taken: Counter = Counter()
        for first, used, times in windows:
            offset = 0
            for length in sorted(used, reverse=True):
                # piece taken + k of the length is the (k % copies)-th in window first + k // copies
                runs.setdefault(length, []).append((taken[length], first_window + first, used[length], offset))
                taken[length] += used[length] * times
                offset += length * used[length]
        self.runs = {n: np.array(r, np.int64) for n, r in runs.items()}
        self.line_window = first_window + sum(times for _, _, times in windows)
        self.line: dict[int, tuple[int, int]] = {}
        position = 0
        for length in sorted(aside, reverse=True):  # laid end to end, cut at window ends
            self.line[length] = (taken[length], position)
            position += length * aside[length]
        self.taken = dict(taken)

    def of(self, length: int, k: int) -> list[tuple[int, int, int, int]]:
        """``(start, length, window, offset)`` of each part of the piece."""
        if k < self.taken.get(length, 0):
            runs = self.runs[length]
            first, window, copies, offset = runs[np.searchsorted(runs[:, 0], k, side="right") - 1].tolist()
            nth, place = divmod(k - first, copies)
            return [(0, length, window + nth, offset + place * length)]
        before, position = self.line[length]
        at, parts, start = position + (k - before) * length, [], 0
        while start < length:
            window, offset = divmod(at + start, self.capacity)
            size = min(length - start, self.capacity - offset)
            parts.append((start, size, self.line_window + window, offset))
            start += size
        return parts


def _encoded(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Ids of every row with its task, its rest beyond full windows, and its number among the task's rows of this rest."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, full, seen = of_worker(TextIds, path), TaskContext.get().partitionId(), 0, Counter()
        end = encoder.pack([end_id])
        for batch in batches:
            ids = [encoder.ids(t) + end for t in batch.column(1).to_pylist()]
            rows = []
            for each in ids:
                tokens = len(each) // encoder.width
                rest = tokens % capacity
                rows.append((part, tokens, rest, seen[rest], full, encoder.width))
                seen[rest] += 1
                full += tokens // capacity
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(ids, pa.binary())], names)

    names = ["id", "part", "tokens", "rest", "nth", "full_before", "width", "ids"]
    selected = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col))
    kinds = ", ".join(f"{n} BIGINT" for n in names[1:-1])
    return stage(selected.mapInArrow(encode, f"id {ddl_type(docs, id_col)}, {kinds}, ids BINARY"), "encoded")


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces ``(id, start, length, ids, doc_tokens, sequence_id, offset)`` of every document's ids and its end id.

    Documents are cut into full windows and a rest.  Rests fill windows exactly where subset sums allow; the few
    that are left over are laid end to end and cut at window ends, so only the very last window is padded.

    The windows are planned on the counts of the ``capacity`` possible rests alone, whatever the number of
    documents, and every task then places its own rows: documents of a common length are never gathered.  ``ids``
    are little-endian unsigned 32-bit integers.  A null text is empty and has the end id only; repeated rows are
    documents of their own; null ids stay null; an empty table gives no pieces.
    """
    spark = prepare(docs.sparkSession)
    rows = _encoded(docs, path, end_id, capacity, id_col, text_col)
    # the rest 0 stands for full windows, counted as they come
    per_part = rows.where("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n"))
    windows = rows.groupBy("part").agg(F.sum(F.expr(f"tokens DIV {capacity}")).alias("n")).select("part", F.lit(0).cast("bigint").alias("rest"), "n")
    per_part = stage(per_part.unionByName(windows), "rest-counts")
    totals = {r["rest"]: r["n"] for r in per_part.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places({n: c for n, c in totals.items() if n}, capacity, totals.get(0, 0)))

    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    base = stage(base, "rest-bases")
    of_full = base.where("rest = 0").select("part", F.col("base").alias("full_base"))
    of_rest = base.where("rest > 0").select("part", "rest", F.col("base").alias("rest_base"))
    based = rows.join(of_full, "part").join(of_rest, ["part", "rest"], "left")
    ready = based.select("id", "tokens", "rest", "width", "ids", (F.col("full_base") + F.col("full_before")).alias("full"), (F.coalesce("rest_base", F.lit(0)) + F.col("nth")).alias("k"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = places.value
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(1, 7)]
            rows, pieces, held = [], [], 0
            for row, (tokens, rest, width, ids, full, k) in enumerate(zip(*columns)):
                parts = [(n * capacity, capacity, full + n, 0) for n in range(tokens // capacity)]
                parts += [(tokens - rest + start, size, window, offset) for start, size, window, offset in (at.of(rest, k) if rest else ())]
                for start, size, window, offset in parts:
                    own = np.frombuffer(ids, f"<u{width}", size, start * width).astype("<u4").tobytes()
                    rows.append(row)
                    pieces.append((start, size, own, tokens, window, offset))
                    held += size
                    if held >= BATCH_IDS:
                        yield made(batch, rows, pieces)
                        rows, pieces, held = [], [], 0
            if rows:
                yield made(batch, rows, pieces)

    def made(batch: pa.RecordBatch, rows: list[int], pieces: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.binary() if k == 2 else pa.int64()) for k, c in enumerate(zip(*pieces))]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns], ["id", *names])

    names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = ", ".join(f"{n} {'BINARY' if n == 'ids' else 'BIGINT'}" for n in names)
    return ready.mapInArrow(place, f"id {ddl_type(docs, id_col)}, {kinds}").withColumnRenamed("id", id_col)
