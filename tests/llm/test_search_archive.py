"""Ranked search against every row's score, and archives against the pages they were made of."""

import hashlib
import math
import re
from collections import Counter
from unittest import mock

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from careloom.llm import ranked_search, runtime, warc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def ranking(docs, items, limit):
    """Every item's best rows, by scoring every row for it."""
    bags = [(i, Counter(words(t))) for i, t in docs]
    full = [(i, b) for i, b in bags if b]
    rows, total = len(full), sum(sum(b.values()) for _, b in full)
    df = Counter(w for _, b in full for w in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in full:
            n = sum(b.values())
            m = 100 - 50 + 50 * n * rows // total
            score = sum(math.floor(1000 * math.log((2 * rows + 2) / (2 * df[w] + 1))) * (10**9 * b[w] // (1000 * b[w] + 20 * m)) for w in set(words(text)) if b[w])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:limit])]
    return sorted(out, key=repr)


def searched(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


ITEMS = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("score", T.LongType())])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbBcé .-\n1", max_size=30), max_size=6), st.integers(1, 40))
def test_bags_of_pieces_are_those_of_whole_texts(texts, held):
    number = {b"a": 0, b"b": 1, "é".encode(): 2, b"ab": 3, b"1": 4}
    with mock.patch.object(ranked_search, "HELD_TERMS", held), mock.patch.object(ranked_search, "segments", lambda t: runtime.segments(t, 4)):
        sizes, starts, pairs = ranked_search.bags_of([t.encode() for t in texts], number)
    for k, text in enumerate(texts):
        own = Counter(w.encode() for w in words(text))
        assert sizes[k] == sum(own.values())
        assert [tuple(p) for p in pairs[starts[k] : starts[k + 1]]] == sorted((number[w], n) for w, n in own.items() if w in number)


@pytest.mark.parametrize("limit, block", [(50, 4096), (2, 2), (1, 1)])
def test_search_of_odd_rows(spark, odd, limit, block):
    docs = odd.unionByName(odd.selectExpr("doc_id + 100 AS doc_id", "text", "n", "fingerprint")).repartition(3)
    items = [("a", "The quick, quick FOX; one word", 1), ("b", None, 2), ("c", "", 3), ("d", "words stand for a while", 4), ("d", "words stand for a while", 5), (None, "straße näive x 한국어", 6), ("e", "nowhere", 7)]
    with mock.patch.object(ranked_search, "INDEX_ITEMS", block):
        got = searched(ranked_search.search(docs, spark.createDataFrame(items, ITEMS), limit))
    assert got == ranking([(r["doc_id"], r["text"]) for r in docs.collect()], [i[:2] for i in items], limit)


def test_large_class_and_ties(spark):
    rows = [(k, "same words here") for k in range(0, 600, 2)] + [(k, "same words there") for k in range(1, 200, 2)] + [(k, f"other text {k}") for k in range(1000, 1200)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(7)
    items = spark.createDataFrame([("a", "same words", 0), ("b", "here text", 0)], ITEMS)
    assert searched(ranked_search.search(docs, items, 50)) == ranking(rows, [("a", "same words"), ("b", "here text")], 50)


def test_search_without_rows(spark, none, odd):
    items = spark.createDataFrame([("a", "one", 0)], ITEMS)
    assert searched(ranked_search.search(none, items)) == []
    empty = ranked_search.search(odd, spark.createDataFrame([], ITEMS))
    assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.collect() == []


def test_best_keeps_the_first_of_equal_scores():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    scores = rng.integers(0, 6, (400, 3))
    with mock.patch.object(ranked_search, "HELD_CANDIDATES", 40):
        best = ranked_search.Best(3, 5)
        for i in range(0, 400, 16):
            best.add(scores[i : i + 16], np.arange(i, i + 16), pa.array(range(i, i + 16)))
        owner, _, _, classes, _ = best.cut()
    for k in range(3):
        want = sorted((-s, i) for i, s in enumerate(scores[:, k].tolist()) if s > 0)[:5]
        assert classes[owner == k].tolist() == [i for _, i in want]


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("key", T.LongType())])
LONG = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 60


def odd_pages():
    rows = [(k, f"http://h{k % 7}.Example.com/{k}?q=1", f"<p>page {k}</p>" + "x" * (k % 3) * 100) for k in range(120)]
    rows += [(k, "https://one.example.org/same", LONG) for k in range(500, 460, -1)]
    rows += [(200, None, None), (201, None, LONG), (None, "http://a.b/ \r\nX: y", LONG), (None, "no scheme", "y" * 100), (None, "no scheme", "y" * 100), (202, "http://a.b/", ""), (203, "http://a.b/", "z" * 99), (204, "http://a.b/", "z" * 99)]
    rows += [(205, "http://ü.de/ü", "w" * 100), (205, "http://ü.de/ü", "w" * 100), (206, "http://", "w" * 100), (207, "", "v" * 3_000_000)]
    return rows


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)


def archived(rows):
    firsts = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(page, firsts.get(html, page))
    out = []
    for page, url, html in rows:
        body = (html or "").encode()
        first = firsts.get(html) if len(body) >= 100 else None
        refers = first if first is not None and first != page else None
        out.append((page, url, body if refers is None else None, len(body), hashlib.sha256(body).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def read_back(df):
    return sorted(((r["page_id"], r["url"], None if r["payload"] is None else bytes(r["payload"]), *tuple(r)[3:]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("archive, block, root", [(64 << 20, 1000, 100_000), (3000, 3, 2)])
def test_archives_give_back_the_pages(spark, tmp_path, archive, block, root):
    # workers get the sizes with the functions that use them
    from pyspark import cloudpickle

    rows = odd_pages()
    cloudpickle.register_pickle_by_value(warc)
    try:
        with mock.patch.multiple(warc, ARCHIVE_BYTES=archive, BLOCK_CAPTURES=block, ROOT_ARCHIVES=root, READ_BYTES=4000 if block == 3 else warc.READ_BYTES):
            got = read_back(warc.archive_pages(pages_of(spark, rows).repartition(3), str(tmp_path)))
    finally:
        cloudpickle.unregister_pickle_by_value(warc)
    assert got == archived(rows)


def test_lookup_of_some_urls(spark, tmp_path):
    rows = odd_pages()
    archives = warc.write_archives(pages_of(spark, rows), str(tmp_path))
    asked = spark.createDataFrame([("https://one.EXAMPLE.org/same",), ("http://h3.example.com/3?q=1",), ("http://nowhere/",), (None,)], "url STRING")
    got = warc.lookup(asked, archives, "bigint")
    assert sorted((r["page"] for r in got.collect())) == sorted([*range(461, 501), 3, 200, 201, 206, 207])


def test_archive_is_plain_warc(spark, tmp_path):
    import gzip
    import pathlib

    warc.write_archives(pages_of(spark, odd_pages()[:20]), str(tmp_path))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in pathlib.Path(tmp_path).glob("*.warc.gz"))
    assert raw.count(b"WARC/1.1\r\nWARC-Type: response") == 20 and raw.endswith(b"\r\n\r\n")


def test_no_pages(spark, tmp_path):
    assert warc.archive_pages(pages_of(spark, []), str(tmp_path)).collect() == []


def test_keys(spark):
    urls = ["http://WWW.Example.com:80/A?b#c", "nothing", None, "https://x", ""]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url STRING").select(warc.url_key("url")).collect()]
    assert got == ["com:80,example,www)/A?b#c", ")nothing", ")", "x)", ")"]
