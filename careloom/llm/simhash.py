"""Near duplicates by SimHash fingerprints, compared in bit planes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careloom.llm.components import components
from careloom.llm.runtime import ddl_type, map_batches, prepare, stage, text_bytes, words_of

SEED = 42
# words of a shingle, 64-bit words of a fingerprint, and bits that linked fingerprints may differ in
SHINGLE_WORDS, WORDS64, RADIUS = 4, 1, 4
# shingles whose bits are summed at a time
SUM_ROWS = 1 << 14
# fingerprints of one bucket that are compared within one task; a larger bucket is dealt out as pairs of chunks
CHUNK = 4096
# fingerprints a bucket should hold at most, as far as more key bits can bring that about
BUCKET = 64
# rows compared in one go; whole buckets
COMPARED_ROWS = 1 << 15
COMPARED_BYTES = 32 << 20
PLANES_PER_STEP = 8


def _hashes(text: bytes | None, shingle_words: int) -> np.ndarray:
    """Hashes of the shingles in order, repeats included; none for a text without words."""
    words = words_of(text)
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    starts = np.append(0, ends[:-1] + 1)
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    places = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.array([digest(joined[i:j], SEED) for i, j in places], "<u8")


def _majority(hashes: np.ndarray, words64: int) -> bytes:
    if not len(hashes):
        return bytes(8 * words64)
    out = []
    for word in range(words64):
        if word:
            hashes = _mixed(hashes)
        ones = np.zeros(64, np.int64)
        for i in range(0, len(hashes), SUM_ROWS):
            part = hashes[i : i + SUM_ROWS]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(np.packbits(2 * ones > len(hashes), bitorder="little")[::-1].tobytes())
    return b"".join(out)


def fingerprint(text: bytes | None, shingle_words: int, words64: int) -> bytes:
    """Big-endian fingerprint of ``words64`` words of 64 bits: a bit is 1 if over half the shingles' hashes have it."""
    return _majority(_hashes(text, shingle_words), words64)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Other hashes made of 64-bit hashes (the splitmix64 finaliser)."""
    h = h + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprints(docs: DataFrame, shingle_words: int, words64: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, fingerprint)`` of every row; a null text has no words."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprint(t, shingle_words, words64) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["id", "fingerprint"])

    selected = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col))
    return map_batches(selected, make, f"id {ddl_type(docs, id_col)}, fingerprint BINARY")


def covering_keys(bits: int, radius: int, rows: int) -> list[list[int]]:
    """Bit positions of keys such that any two fingerprints within the radius share a key: all are found.

    Of ``radius + s`` blocks of bits at least ``s`` are equal; each choice of ``s`` blocks is a key.  ``s`` is the
    least that leaves few rows in a bucket, so more rows get longer keys.
    """
    for s in range(1, 5):
        blocks = np.array_split(np.arange(bits), radius + s)
        if rows <= BUCKET << (s * bits // (radius + s)):
            break
    return [np.concatenate(chosen).tolist() for chosen in combinations(blocks, s)]


def _bits_of(fingerprints: list[bytes], bits: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(fingerprints), np.uint8).reshape(-1, bits // 8), axis=1)


def _keyed(classes: DataFrame, keys: list[list[int]], bits: int) -> DataFrame:
    """A row for each fingerprint and key: the key's bits and number as one hash-free long or binary value."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = batch.column(0).to_pylist()
        each = _bits_of(found, bits)
        packed, width = [], (max(map(len, keys)) + 7) // 8 + 2
        for number, key in enumerate(keys):
            block = np.zeros((len(found), width), np.uint8)
            block[:, 0], block[:, 1] = number >> 8, number & 255
            part = np.packbits(each[:, key], axis=1)
            block[:, 2 : 2 + part.shape[1]] = part
            packed.append(block)
        buckets = np.stack(packed, axis=1).reshape(-1, width)
        rows = np.repeat(np.arange(len(found)), len(keys))
        return pa.RecordBatch.from_arrays(
            [pa.array([b.tobytes() for b in buckets], pa.binary()), batch.column(0).take(pa.array(rows))], ["bucket", "fingerprint"]
        )

    return map_batches(classes.select("fingerprint"), make, "bucket BINARY, fingerprint BINARY")


def _dealt(keyed: DataFrame) -> DataFrame:
    """Buckets; one of more than ``CHUNK`` rows becomes a bucket for each pair of its chunks."""
    large = stage(keyed.groupBy("bucket").count().where(F.col("count") > CHUNK), "large-buckets")
    keyed = keyed.join(large, "bucket", "left")
    return _in_pairs(keyed, F.ceil(F.coalesce("count", F.lit(1)) / CHUNK).cast("int"), ["fingerprint"])


def _in_pairs(keyed: DataFrame, chunks: Column, columns: list[str]) -> DataFrame:
    """Each row with all pairs ``(i, j)`` of chunks of its bucket that its own chunk is in."""
    own = F.pmod(F.xxhash64(*columns[:2]), chunks).cast("int")
    pair = F.expr("explode(transform(sequence(0, chunks - 1), o -> struct(least(o, own) AS i, greatest(o, own) AS j)))")
    dealt = keyed.withColumn("chunks", chunks).withColumn("own", own)
    return dealt.select("bucket", *columns, pair.alias("pair")).select("bucket", "pair.i", "pair.j", *columns)


def _plane(bits: np.ndarray) -> np.ndarray:
    """Bits of the rows, 64 to a word."""
    padded = np.zeros((len(bits) + 63) // 64 * 64, np.uint8)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little").view("<u8")


def _add(counters: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Add two planes of differences: one carry-save step, then its carry along; returns where the top overflows."""
    half = counters[0] ^ first
    carry = (counters[0] & first) | (half & second)
    counters[0] = half ^ second
    for d in range(1, len(counters)):
        counters[d], carry = counters[d] ^ carry, counters[d] & carry
    return carry


def linked_rows(each: np.ndarray, left: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its bucket that a chain of links within the radius leads to.

    ``each``: the rows' bits; ``left``: how many rows of its bucket follow a row.  Bit planes stand vertically: one
    word holds a bit of 64 rows.  For each lag, a plane differs from itself shifted by the lag where a row and the
    one so far behind it differ, and these differences are added up for all rows at once by carry-save counters in
    planes.  A counter starts so that the first difference too many overflows it, and blocks of 64 rows that have
    all overflown are abandoned.  Rows that a chain joins already are not compared again.
    """
    rows, bits = each.shape
    root = np.arange(rows)
    planes = np.stack([_plane(each[:, b]) for b in range(bits)])
    depth = int(radius + 1).bit_length()
    start = (1 << depth) - 1 - radius
    full = ~np.uint64(0)
    left_over = np.flatnonzero(left > 0)
    lag = 0
    while len(left_over):
        lag += 1
        left_over = left_over[left[left_over] >= lag]
        open_ = left_over[root[left_over] != root[left_over + lag]]
        if not len(open_):
            continue
        at, first = np.unique(open_ >> 6, return_index=True)
        alive = np.bitwise_or.reduceat(np.uint64(1) << (open_ & 63).astype(np.uint64), first)
        whole, rest = divmod(lag, 64)
        near, far = np.minimum(at + whole, planes.shape[1] - 1), np.minimum(at + whole + 1, planes.shape[1] - 1)
        counters = [np.full(len(at), full if start >> d & 1 else 0, np.uint64) for d in range(depth)]
        for b in range(0, bits, 2):
            apart = []
            for plane in planes[b : b + 2]:
                other = plane[near]
                if rest:
                    other = (other >> np.uint64(rest)) | (plane[far] << np.uint64(64 - rest))
                apart.append(plane[at] ^ other)
            alive = alive & ~_add(counters, *apart)
            if b % PLANES_PER_STEP == PLANES_PER_STEP - 2:
                keep = alive != 0
                if not keep.any():
                    break
                if 2 * np.count_nonzero(keep) <= len(keep):
                    at, near, far, alive = at[keep], near[keep], far[keep], alive[keep]
                    counters = [c[keep] for c in counters]
        if alive.any():
            word, bit = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            found = at[word] * 64 + bit
            _join(root, found, found + lag)
    return root


def _join(root: np.ndarray, some: np.ndarray, others: np.ndarray) -> None:
    """Give linked rows one root, the smallest."""
    low, high = root[some], root[others]
    while (low != high).any():
        np.minimum.at(root, np.maximum(low, high), np.minimum(low, high))
        while not np.array_equal(root[root], root):
            root[:] = root[root]
        low, high = root[low], root[high]


def _forest(dealt: DataFrame, bits: int, radius: int) -> DataFrame:
    """Links that span the chains within each bucket: fewer than it has rows, never all its pairs."""

    def compare(buckets: list, rows: list[list[bytes]]) -> pa.RecordBatch:
        found = rows[0]
        root = linked_rows(_bits_of(found, bits), _followers(buckets), radius)
        linked = np.flatnonzero(root != np.arange(len(found)))
        pairs = [pa.array([found[k] for k in rows], pa.binary()) for rows in (linked, root[linked])]
        return pa.RecordBatch.from_arrays(pairs, ["a", "b"])

    return _by_bucket(dealt, compare)


def _followers(buckets: list) -> np.ndarray:
    """How many rows of its bucket follow each row."""
    change = np.flatnonzero([True] + [x != y for x, y in zip(buckets[1:], buckets)])
    ends = np.append(change[1:], len(buckets))
    return np.repeat(ends, np.diff(np.append(change, len(buckets)))) - np.arange(len(buckets)) - 1


def _by_bucket(dealt: DataFrame, compare: Callable[[list, list[list[bytes]]], pa.RecordBatch]) -> DataFrame:
    """Links ``(a, b)`` of whole buckets: ``compare`` gets the buckets' keys and the columns after bucket, i and j."""
    width = len(dealt.columns) - 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: list = []
        rows: list[list[bytes]] = [[] for _ in range(width)]
        held = 0
        for batch in batches:
            buckets += zip(*(batch.column(k).to_pylist() for k in range(3)))
            for k in range(width):
                rows[k] += batch.column(3 + k).to_pylist()
            held += batch.nbytes
            if len(buckets) >= COMPARED_ROWS or held >= COMPARED_BYTES:
                cut = len(buckets)
                while cut and buckets[cut - 1] == buckets[-1]:
                    cut -= 1
                if cut:  # the last bucket may go on
                    yield compare(buckets[:cut], [r[:cut] for r in rows])
                    buckets, rows = buckets[cut:], [r[cut:] for r in rows]
                    held = sum(map(len, rows[-1]))
        if buckets:
            yield compare(buckets, rows)

    grouped = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return grouped.mapInArrow(run, "a BINARY, b BINARY")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, words64: int = WORDS64, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint, component_id, root)`` of every row: the smallest id that links lead to, and the least fingerprint.

    Words stand between ASCII white space, A-Z count as a-z; shingles are runs of words, repeats included; a text of
    fewer words is one shingle; one without words, or null, has the fingerprint zero.  Fingerprints link if at most
    ``radius`` bits differ, and all such links are found.

    Equal fingerprints are one class before anything is compared, buckets of many classes are dealt out as pairs of
    chunks, and a bucket gives no more links than it has rows.  Null ids take part but are nobody's smallest id; a
    component of null ids only has a null one.  Repeated rows come out each; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    bits = 64 * words64
    rows = stage(fingerprints(docs, shingle_words, words64, id_col, text_col), "fingerprints")
    classes = stage(rows.groupBy("fingerprint").agg(F.min("id").alias("first_id")), "classes")
    keyed = stage(_keyed(classes, covering_keys(bits, radius, classes.count()), bits), "keyed")
    found = components(_forest(_dealt(keyed), bits, radius))
    # classes without links stand alone
    labelled = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    labelled = stage(labelled.withColumn("root", F.coalesce("root", "fingerprint")), "labelled")
    smallest = stage(labelled.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    member = stage(labelled.join(smallest, "root").select("fingerprint", "component_id", "root"), "members")
    return rows.join(member, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id", "root")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, words64: int = WORDS64, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``near_duplicates``, as it is: that with the smallest id, null ids last.

    Rows of one id may be in several components, and ids may be null: these rows are told apart by their own
    fingerprints; of several that have a component's smallest id, one stays.  An empty table gives no rows.
    """
    found = stage(near_duplicates(docs, shingle_words, words64, radius, id_col, text_col).withColumnRenamed(id_col, "id"), "found")
    ids = stage(found.groupBy("id").agg(F.count("*").alias("n"), F.min("component_id").alias("first")), "ids")
    kept, key = [f"c{k}" for k in range(len(docs.columns))], f"c{docs.columns.index(id_col)}"
    plain = docs.toDF(*kept)
    # mostly the fewer ids
    gone = ids.where("id IS NOT NULL AND (n > 1 OR id <> first)").select(F.col("id").alias(key))
    out = plain.where(F.col(key).isNotNull()).join(stage(gone, "gone"), key, "left_anti").select(kept)
    odd = stage(ids.where("n > 1 OR id IS NULL").select("id"), "odd-ids")
    if not odd.isEmpty():
        texts = plain.join(odd, F.col(key).eqNullSafe(F.col("id")), "left_semi")

        def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [fingerprint(t, shingle_words, words64) for t in batch.column(len(kept)).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.binary())], [*kept, "fingerprint"])

        schema = ", ".join(f"{c} {ddl_type(plain, c)}" for c in kept)
        marked = map_batches(texts.select(*kept, text_bytes(kept[docs.columns.index(text_col)]).alias("bytes")), mark, f"{schema}, fingerprint BINARY")
        firsts = found.join(odd, found["id"].eqNullSafe(odd["id"]), "left_semi").where("id = component_id OR (id IS NULL AND component_id IS NULL)")
        firsts = stage(firsts.select("id", "fingerprint", "root").distinct(), "first-rows")
        several = marked.join(firsts, ["fingerprint"]).where(F.col(key).eqNullSafe(F.col("id")))
        place = F.row_number().over(Window.partitionBy("root").orderBy("fingerprint", F.xxhash64(kept[docs.columns.index(text_col)])))
        out = out.unionByName(several.withColumn("place", place).where("place = 1").select(kept))
    return out.toDF(*docs.columns)
