"""Fingerprints and their links against brute force."""

import numpy as np
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from careloom.llm import components, queries, simhash
from tests.conftest import SMALL
from tests.llm.conftest import pairs


def plain_fingerprint(text, n=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=4):
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return sorted(((doc, f"{f:016x}", least.get(find(k))) for k, (doc, f) in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark, docs):
    rows = [(d, plain_fingerprint(t)) for d, t in pairs(docs)]
    assert found(queries.op1_simhash_near_dedup(spark, SMALL)) == plain_components(rows)


def test_odd_rows(spark, odd, none):
    rows = [(d, plain_fingerprint(t)) for d, t in pairs(odd)]
    got = simhash.near_duplicates(odd)
    assert sorted(((r["doc_id"], r["fingerprint"].hex(), r["component_id"]) for r in got.collect()), key=repr) == plain_components(rows)
    assert simhash.near_duplicates(none).collect() == []


def one_of_each(rows):
    """For each component of the rows' texts: its smallest id, null last, and the texts of that id in it."""
    labelled = {}
    for doc, text in rows:
        labelled.setdefault((doc, plain_fingerprint(text)), set()).add(text)
    groups = []
    for doc, mark in sorted(labelled, key=lambda k: (k[0] is None, k[0] or 0)):
        near = [g for g in groups if any((mark ^ m).bit_count() <= 4 for _, m in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [(doc, mark)]]
    out = []
    for group in groups:
        first = min(group, key=lambda k: (k[0] is None, k[0] or 0))[0]
        out.append((first, set().union(*(labelled[k] for k in group if k[0] == first))))
    return out


def test_one_row_of_each_component_stays(spark, odd, none):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    more = [(3, a), (7, a), (7, b), (9, b), (None, c), (None, c), (None, "other words that nobody has"), (12, c + " end"), (12, c + " end"), (13, "one two"), (13, "three four")]
    extra = spark.createDataFrame([(d, t, "n", "x") for d, t in more], odd.schema)
    for docs in (odd, extra, odd.unionByName(extra).repartition(5)):
        kept = simhash.keep_one(docs)
        assert kept.schema == docs.schema
        got, want = pairs(kept), one_of_each(pairs(docs))
        assert len(got) == len(want)
        assert all(any(d == first and t in texts for d, t in got) for first, texts in want)
    assert simhash.keep_one(none).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_bit_planes_against_counting(radius):
    deal = np.random.default_rng(radius)
    sizes = deal.integers(1, 90, 25)
    bits = []
    for n in sizes:
        centre = deal.integers(0, 2, 64)
        bits.append(centre ^ (deal.random((n, 64)) < deal.choice([0.02, 0.05, 0.5])))
    each = np.concatenate(bits).astype(np.uint8)
    left = np.concatenate([np.arange(n)[::-1] for n in sizes])
    root = simhash.linked_rows(each, left, radius)
    begin = 0
    for n in sizes:
        part = each[begin : begin + n].astype(int)
        near = (part[:, None, :] != part[None]).sum(2) <= radius
        expected = np.arange(n)
        while True:
            after = np.array([expected[near[k]].min() for k in range(n)])
            if (after == expected).all():
                break
            expected = after
        assert (root[begin : begin + n] - begin == expected).all()
        begin += n


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4), st.sampled_from([10, 10**6, 10**9, 10**12]))
def test_keys_cover_the_radius(value, flips, rows):
    other = value
    for b in flips:
        other ^= 1 << b
    one, two = (simhash._bits_of([v.to_bytes(8, "big")], 64)[0] for v in (value, other))
    assert any((one[k] == two[k]).all() for k in simhash.covering_keys(64, 4, rows))


def test_large_buckets_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    monkeypatch.setattr(simhash, "COMPARED_ROWS", 8)
    chain = [(k, " ".join(f"w{j}" for j in range(k, k + 400))) for k in range(150)]
    docs = spark.createDataFrame(chain, "doc_id BIGINT, text STRING")
    rows = [(d, plain_fingerprint(t)) for d, t in chain]
    got = simhash.near_duplicates(docs)
    assert sorted(((r["doc_id"], r["fingerprint"].hex(), r["component_id"]) for r in got.collect()), key=repr) == plain_components(rows)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, links):
    edges = spark.createDataFrame(links or [(None, 1)], "a BIGINT, b BIGINT")
    least = {k: k for link in links for k in link if link[0] != link[1]}
    for _ in least:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert {r["node"]: r["root"] for r in components.components(edges).collect()} == least


def test_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {r["root"] for r in components.components(edges).collect()} == {0}
