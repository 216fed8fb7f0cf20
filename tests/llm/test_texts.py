"""Lines, test items, licenses, languages, URLs and quality against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from careloom.llm import decontaminate, language, licenses, line_dedup, quality_rules, queries, url_graph
from tests.conftest import SMALL
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.conftest import pairs

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_lines(rows):
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            key = lower(line.strip(SPACE))
            if len(key) >= 20:
                holders.setdefault(key, set()).add(-1 if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(lower(line.strip(SPACE)), ())
            if len(held) < 3 or max(held) == (-1 if d is None else d):
                kept.append(line)
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


class TestLines:
    def test_query(self, spark, docs):
        expected = [(d, n, gone, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, gone in plain_lines(pairs(docs))]
        got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in queries.op3_line_dedup(spark, SMALL).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)

    def test_odd_rows(self, spark, odd, none):
        shared = "A line that three documents have"
        rows = [(20, f" {shared.upper()}\t\nown"), (21, f"{shared}\n{shared}"), (None, f"x\n{shared} "), (22, "ÀÉ" * 10), (23, "ÀÉ" * 10), (24, "àÉ" * 10), (25, "éé" * 9), (26, "éé" * 9), (27, "éé" * 9)]
        more = odd.unionByName(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("n", F.lit("n")).withColumn("fingerprint", F.lit("n")))
        got = line_dedup.dedup_lines(more)
        assert got.columns == [*odd.columns, "n_lines", "n_dropped"]
        assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr) == plain_lines(pairs(more))
        clashing = none.withColumn("n_dropped", F.lit("x")).withColumn("h", F.lit(1))
        assert line_dedup.dedup_lines(clashing).collect() == []


def plain_score(words, item_words, all_items):
    """BM25 share of a passage that holds these words."""
    from collections import Counter
    from math import log1p

    mean = sum(map(len, all_items)) / len(all_items)
    total = own = 0.0
    for t, tf in Counter(item_words).items():
        df = sum(t in i for i in all_items)
        w = log1p((len(all_items) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(item_words) / mean))
        own += w
        total += w * (t in words)
    return total / own


class TestLeaks:
    def items(self, spark):
        return spark.read.parquet(f"{SMALL}/benchmark.parquet")

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.lists(st.sampled_from("abcdefghijklmnopqrst"), min_size=1, max_size=12), min_size=1, max_size=30), st.data())
    def test_search_finds_all_above(self, items, data):
        from collections import Counter

        texts = data.draw(st.lists(st.lists(st.sampled_from("abcdefghijklmnopqrstuvwxyz"), min_size=0, max_size=300), min_size=1, max_size=5))
        documents = [[w.encode() for w in t] for t in texts]
        frequency = Counter(t.encode() for i in items for t in set(i))
        index = decontaminate.Index(pa.array(range(len(items))), [" ".join(i).encode() for i in items], len(items), np.mean([len(i) for i in items]), frequency)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(decontaminate, "CELLS", data.draw(st.sampled_from([1, 60, 1 << 24])))
            got = index.search(documents, 0.6)
        as_bytes = [[t.encode() for t in i] for i in items]
        for d, words in enumerate(documents):
            strides = max(1, -(-len(words) // index.stride))
            for k, item in enumerate(as_bytes):
                scores = [plain_score(set(words[p * index.stride : (p + 2) * index.stride]), item, as_bytes) for p in range(max(1, strides - 1))]
                above = [p for p, s in enumerate(scores) if s >= 0.6]
                assert above == [p for p, _ in got.get((d, k), [])]
                assert [s for _, s in got.get((d, k), [])] == pytest.approx([scores[p] for p in above])

    def test_query(self, spark, docs):
        """All leaks, with their numbers, as by scoring every passage for every item."""
        items = [(r["item_id"], r["text"].encode()) for r in self.items(spark).collect()]
        words_of = [decontaminate.terms_of(t) for _, t in items]
        stride, expected = max(64, max(map(len, words_of))), {}
        weights = []
        for own in words_of:
            weights.append({t: plain_score({t}, own, words_of) for t in set(own)})
        for d, t in pairs(docs):
            words = decontaminate.terms_of((t or "").encode())
            for (i, text), weight in zip(items, weights):
                scored = []
                for p in range(max(1, -(-len(words) // stride) - 1)):
                    window = words[p * stride : (p + 2) * stride]
                    score = sum(w for u, w in weight.items() if u in set(window))
                    if score >= 0.5 - 1e-9:
                        runs = {n: set(zip(*(window[k:] for k in range(n)))) for n in (1, 2, 3)}
                        question, answer = (decontaminate.overlap(part, runs) for part in decontaminate.question_and_answer(text))
                        scored.append((min(question, answer), question, answer, score))
                if scored and max(scored)[0] >= 0.6:
                    expected[d, i] = (max(s[3] for s in scored), *max(scored)[1:3], len(scored))
        got = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in queries.op5_benchmark_leaks(spark, SMALL).collect()}
        assert expected and set(got) == set(expected)
        assert all(got[k] == pytest.approx(v) for k, v in expected.items())

    def test_parts_from_many_places_are_no_leak(self, spark):
        """A text that has an item's runs one by one, in places far from each other, is left alone."""
        item = self.items(spark).first()["text"]
        words, filler = item.split(), " ".join(f"f{k % 977}" for k in range(500))
        scattered = f" {filler} ".join(" ".join(words[k : k + 5]) for k in range(len(words) - 4))
        got = decontaminate.find_leaks(spark.createDataFrame([(1, scattered), (2, item)], "doc_id BIGINT, text STRING"), self.items(spark))
        assert {r["doc_id"] for r in got.collect()} == {2}

    @pytest.mark.parametrize("kind", ["SMALLINT", "INT", "STRING", "DECIMAL(9, 0)", "DATE"])
    def test_item_types_and_names(self, spark, kind):
        items = spark.createDataFrame([(1, LONG_ITEM)], "n INT, text STRING").selectExpr("date_from_unix_date(n) AS doc_id" if kind == "DATE" else f"CAST(n AS {kind}) AS doc_id", "text")
        docs = spark.createDataFrame([(5, LONG_ITEM, 1), (6, "else", 2)], "doc_id BIGINT, text STRING, leaked INT")
        got = decontaminate.find_leaks(docs, items, item_col="doc_id")
        assert got.columns[:2] == ["doc_id", "test_doc_id"] and got.schema["test_doc_id"].dataType == items.schema["doc_id"].dataType
        assert [r[:2] for r in got.collect()] == [(5, items.first()[0])]
        kept = decontaminate.without_leaks(docs, got)
        assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [6]

    def test_changed_and_long(self, spark):
        item = self.items(spark).first()["text"]
        words = item.split()
        words[4], words[-3] = "other", "words"
        filler = " ".join(f"f{k % 977}" for k in range(60000))
        rows = [(1, f"{filler} {' '.join(words)} {filler}"), (2, filler), (3, " ".join(item.split()[: len(words) // 2])), (4, f"{filler} {item}")]
        got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), self.items(spark))
        assert sorted({r["doc_id"] for r in got.collect()}) == [1, 4]

    def test_odd_rows(self, spark, odd, none, monkeypatch):
        items = spark.createDataFrame([(1, LONG_ITEM), (1, LONG_ITEM), (None, "words without an id that stand here"), (3, None), (4, ""), (5, "?!")], "item_id BIGINT, text STRING")
        expected = [(5, 1)] * 4 + [(6, 1)] * 2 + [(None, None)]
        for size, rounds in ((decontaminate.INDEX_BYTES, 4), (20, 4), (20, 1)):  # one index, and many, of several rounds
            monkeypatch.setattr(decontaminate, "INDEX_BYTES", size)
            monkeypatch.setattr(decontaminate, "INDEXES", rounds)
            got = decontaminate.find_leaks(odd, items)
            assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=repr) == sorted(expected, key=repr)
        kept = decontaminate.without_leaks(odd, got)
        assert kept.columns == odd.columns
        assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 10, 2, 3, 4, 7, 8, 9]
        assert decontaminate.find_leaks(none, items).collect() == []
        assert decontaminate.find_leaks(odd, items.limit(0)).collect() == []


LONG_ITEM = "Over the lazy dog. And runs away from here"


def plain_licenses(rows):
    out = []
    for d, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
        found = []
        for phrase, label in licenses.BASE.items():
            own = phrase.split()
            found += [(k, label) for k in range(len(words) - len(own) + 1) if words[k : k + len(own)] == own]
        places = [k for k, _ in found]
        out.append((d, len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))))
    return sorted(out, key=repr)


class TestLicenses:
    def base(self, df):
        return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in df.collect()), key=repr)

    def test_query(self, spark, docs):
        got = queries.op6_license_scan(spark, SMALL)
        assert self.base(got) == plain_licenses(pairs(docs))
        for r in got.collect():
            assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1

    def test_notices(self, spark, odd, none):
        notice = "Permission is hereby granted, free of charge, to any person obtaining one copy of this software and the associated documentation files"
        texts = [
            "CC BY cc-by; cc by-nc. MIT  License MIT-LICENSE", "gnu general public license gnu general public license", f"x {notice} y",
            "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.", "the gnu general", "mitlicense ccby été MIT License", "under the license of the copy",
        ]
        more = odd.select("doc_id", "text").union(spark.createDataFrame([(30 + k, t) for k, t in enumerate(texts)] + [(30, texts[0]), (30, "mit license"), (None, "MIT license")], "doc_id BIGINT, text STRING"))
        got = licenses.scan_licenses(more)
        assert self.base(got) == plain_licenses(pairs(more))
        labels = {r["doc_id"]: r["labels"] for r in got.collect() if r["doc_id"] != 30}
        assert labels[32] == "mit" and labels[33] == "apache,apache-2.0,cc-by,cc-by-nc" and labels[34] == labels[36] == labels[5] == ""
        assert licenses.scan_licenses(none).collect() == []
        with pytest.raises(ValueError):
            licenses.scan_licenses(none, {"one": "x"}, {})


class TestLanguage:
    def test_held_out_accuracy(self, spark):
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        got = queries.op8_language_id(spark, "/root/testdata/sf0.01").collect()
        lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
        held = [r for r in got if r["held_out"]]
        assert {r["doc_id"] for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
        assert len(got) == len(lang) and all(0 <= r["score"] <= 1 for r in got)
        assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97

    def test_scores_against_counting(self):
        texts = ["the cat and the dog", "le chat et le chien", "été là-bas"]
        deal = np.random.default_rng(1)
        model = language.Model(["a", "b"], deal.integers(0, 9, (language.BUCKETS, 2)).astype(float), np.array([3.0, 1.0]))
        for t, row in zip(texts, model.scores(texts)):
            codes = np.append([32], np.append(language.letters_of(t), [32, 32])).astype(np.uint32)
            two, three = language.buckets_of(codes)
            assert row == pytest.approx(model.prior + model.table[two].sum(0) + model.table[three].sum(0))

    def test_parts_of_long_texts(self, monkeypatch):
        deal = np.random.default_rng(1)
        model = language.Model(["a", "b"], deal.integers(0, 9, (language.BUCKETS, 2)).astype(float), np.array([3.0, 1.0]))
        texts = ["".join(deal.choice(list("abcdé  "), n)) for n in (500, 3, 0, 77, 64, 65)]
        whole = model.scores(texts)
        monkeypatch.setattr(language, "CHUNK_CHARS", 16)
        assert np.allclose(model.scores(texts), whole)

    def test_odd_rows(self, spark, odd, none):
        taught = spark.createDataFrame([(k, "the dog and the cat" if k % 2 else "der hund und die katze", "en" if k % 2 else "de") for k in range(50)] + [(60, None, "en"), (61, "chat", None)], "doc_id BIGINT, text STRING, lang STRING")
        model = language.fit(taught)
        assert model.languages == ["de", "en"]
        got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(odd, model).collect()]
        assert len(got) == odd.count()
        assert all((p == "und") == (s == 0) for _, p, s in got) and {d for d, p, _ in got if p == "und"} == {1, 2, 3, None}
        clashing = odd.withColumn("score", F.lit("s")).withColumn("lang_pred", F.lit("p"))
        kept = language.keep_identified(clashing, model)
        assert kept.columns == clashing.columns and {r["doc_id"] for r in kept.collect()} <= {None, 4, 5, 6, 7, 8, 9, 10}
        assert language.identify(none, model).collect() == []
        untaught = language.fit(none.withColumn("lang", F.lit("x")))
        assert {r["lang_pred"] for r in language.identify(odd, untaught).collect()} == {"und"}

    def test_learned_counts_against_counting(self, spark):
        rows = [(k, t, l) for k, (t, l) in enumerate([("the dog", "en"), ("a cat", "en"), ("der hund", "de"), (None, "de"), ("x", None)])]
        model = language.fit(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING"))
        counts = np.zeros((language.BUCKETS + 1, 2))
        for _, t, l in rows:
            if t and l:
                for grams in language.buckets_of(np.append([32], np.append(language.letters_of(t), [32, 32, 32, 32])).astype(np.uint32)):
                    np.add.at(counts[:, ["de", "en"].index(l)], grams, 1)
        smooth = counts[:-1] + language.SMOOTHING
        assert np.allclose(model.table[:-1], np.log(smooth / smooth.sum(0)))
        assert np.allclose(model.prior, np.log([1 / 3, 2 / 3]))

    def test_more_languages_than_are_held_at_once(self, spark, odd, monkeypatch):
        deal = np.random.default_rng(2)
        taught = spark.createDataFrame([(k, " ".join(deal.choice(list("abcdefgh"[k % 5 :]), 30)), f"l{k % 5}") for k in range(60)], "doc_id BIGINT, text STRING, lang STRING")
        asked = odd.unionByName(taught.select("doc_id", "text"), allowMissingColumns=True)

        def results(model):
            found = language.identify(asked, model, keep=("text",)).collect()
            kept = language.keep_identified(asked, model).select("doc_id", "text").collect()
            return sorted(((r[0], r[3], r[1], round(r[2], 9)) for r in found), key=repr), sorted(map(tuple, kept), key=repr)

        whole = results(language.fit(taught))
        monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 2)
        blocks = language.fit(taught)
        assert [m.languages for m in blocks] == [["l0", "l1"], ["l2", "l3"], ["l4"]]
        assert results(blocks) == whole

    def test_rows_without_ids_are_sampled(self, spark):
        taught = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
        model = language.fit(taught.withColumn("text", F.translate("text", "0123456789", "abcdefghij")), 300)
        grams = np.exp(model.table[:-1, 0])
        # about 300 of 3,000 different texts: far from all two- and three-letter endings occur
        assert 0 < (grams > grams.min() * 1.5).sum() < 1000


def plain_rule(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = lower(host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def plain_rank(edges, seeds, rounds=url_graph.ROUNDS):
    total, ranks = {}, dict(seeds)
    for (a, _), w in edges.items():
        total[a] = total.get(a, 0) + w
    for _ in range(rounds if edges else 0):
        moved = {h: s * (1 - url_graph.DAMPING) for h, s in seeds.items()}
        for (a, b), w in edges.items():
            if a in ranks:
                moved[b] = moved.get(b, 0) + ranks[a] * w / total[a] * url_graph.DAMPING
        ranks = moved
    return ranks if edges else {h: s * (1 - url_graph.DAMPING) for h, s in seeds.items()}


def plain_urls(rows, rules):
    parts = [(page, *plain_rule(url, rules), html) for page, url, html in rows]
    hosts = {p[1] for p in parts} - {""}
    edges, share = {}, {"allow": {}, "block": {}}
    for _, host, _, _, _, html in parts:
        for link in re.findall(r"""href\s*=\s*["']((?:https?:)?//[^"'\s>]+)""", html or "", re.I) if host else ():
            to = lower(re.match(r"(?:https?:)?//([^/?#]*)", link, re.I)[1])
            if to and to != host:
                edges[host, to] = edges.get((host, to), 0) + 1
        base = re.search(r"""<base\s[^>]*?href\s*=\s*["']((?:https?:)?//[^"'\s>]+)""", html or "", re.I)
        to = base and lower(re.match(r"(?:https?:)?//([^/?#]*)", base[1], re.I)[1])
        relative = len(re.findall(r"""href\s*=\s*["'](?![a-z]+:|//|#)[^"'\s>]""", html or "", re.I))
        if host and to and to != host and relative:
            edges[host, to] = edges.get((host, to), 0) + relative
    for h in hosts:
        outer = ".".join(h.split(".")[-2:])
        if outer != h and not re.search(r"\.\d+(:\d+)?$", h):
            edges[h, outer] = edges.get((h, outer), 0) + 1
            edges[outer, h] = edges.get((outer, h), 0) + 1
        own = [p[4] for p in parts if p[1] == h]
        for kind, held in share.items():
            if kind in own:
                held[h] = own.count(kind) / len(own)
    trust = plain_rank(edges, share["allow"])
    distrust = plain_rank({(b, a): w for (a, b), w in edges.items()}, share["block"])
    limit = url_graph.THRESHOLD * (1 - url_graph.DAMPING)
    out = []
    for page, host, path, rule, verdict, _ in parts:
        bad = distrust.get(host, 0) - trust.get(host, 0) > limit if host else False
        out.append((page, host, path, rule, verdict or ("block" if bad else "allow")))
    return sorted(out, key=repr)


class TestUrls:
    def found(self, df):
        return sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()), key=repr)

    def test_query(self, spark):
        rows = [(r["page_id"], r["url"], r["html"]) for r in queries.table(spark, SMALL, "pages").collect()]
        got = self.found(queries.op9_url_filter(spark, SMALL))
        assert got == plain_urls(rows, queries.URL_RULES)
        # some verdicts come from the walk
        assert {v for _, _, _, rule, v in got if rule is None} == {"allow", "block"}

    def test_more_rules_than_a_plan_holds(self, spark, monkeypatch):
        pages = queries.table(spark, SMALL, "pages")
        rules = queries.URL_RULES + [("block", f"host{k}.example", f"/{k}") for k in range(50)]
        few = self.found(url_graph.judge_urls(pages, rules))
        monkeypatch.setattr(url_graph, "MOST_RULES", 10)
        assert self.found(url_graph.judge_urls(pages, rules)) == few

    def test_siblings_meet_in_their_domain_and_bases_count(self, spark):
        rows = [(k, f"http://s{k}.bad.net/es/", None) for k in range(4)] + [(10, "http://new.bad.net/de/", None), (11, "http://1.2.3.4/", None), (12, "http://9.9.3.4/es/", None)]
        rows += [(20, "http://mirror.org/", '<base target="x" href="http://s1.bad.net/"><a href="a">'), (21, "http://plain.org/", '<base href="http://s1.bad.net/"><a href="#a"> <a href="http://plain.org/b">')]
        pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
        got = self.found(url_graph.judge_urls(pages, queries.URL_RULES))
        assert got == plain_urls(rows, queries.URL_RULES)
        assert {p: v for p, _, _, _, v in got}[20] == "block"

    def test_links_spread(self, spark):
        bad, good = "http://a.net/es/1", "http://B.com/x"
        rows = [
            (1, bad, None), (1, bad, None), (2, "https://links.org/1", '<a href="http://a.net/es/"> <a HREF = "//A.net/q">'), (3, "http://far.org/?x", "<a href='https://links.org'>"),
            (4, good, '<a href="http://trusted.org/">'), (5, "http://trusted.org#f", '<a href="http://a.net">'), (6, None, None), (7, "nothing here", '<a href="http://a.net">'),
            (8, "ftp://www.example.com/en/1?u=http://x.net/es/", ""), (9, "http://sub.example.com/en/", ""), (10, "http://com", ""), (None, "x://notcom/", None), (11, "://h\n.net/fr/", "x"),
        ]
        pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
        got = self.found(url_graph.judge_urls(pages, queries.URL_RULES))
        assert got == plain_urls(rows, queries.URL_RULES)
        verdicts = {p: v for p, _, _, _, v in got}
        assert verdicts[2] == "block" and verdicts[5] == verdicts[6] == verdicts[7] == "allow"

    def test_ranks_are_those_of_the_walk_at_rest(self, spark):
        """A chain of hosts to a blocked one, and a blocked host with five subdomains, against the solved equations."""
        chain = [(k, f"http://h{k}.org/", f'<a href="http://h{k + 1}.org/">') for k in range(12)] + [(12, "http://h12.org/", None)]
        star = [(20, "http://bad.io/", None)] + [(21 + k, f"http://s{k}.bad.io/", None) for k in range(5)]
        pages = spark.createDataFrame(chain + star, "page_id BIGINT, url STRING, html STRING")
        rules = [("block", "h12.org", "/"), ("block", "bad.io", "/"), *[("none", f"s{k}.bad.io", "/") for k in range(5)]]
        got = {r["page_id"]: r for r in url_graph.judge_urls(pages, rules).collect()}
        steps, seeds = np.zeros((19, 19)), np.zeros(19)  # the chain, then the star
        seeds[[12, 13]] = 1 - url_graph.DAMPING
        steps[range(12), range(1, 13)] = 1
        steps[14:, 13], steps[13, 14:] = 1 / 5, 1
        ranks = np.linalg.solve(np.eye(19) - url_graph.DAMPING * steps, seeds)
        assert [got[k]["distrust"] for k in [*range(13), *range(20, 26)]] == pytest.approx(ranks.tolist(), abs=1e-4)
        limit = url_graph.THRESHOLD * (1 - url_graph.DAMPING)
        assert [got[k]["verdict"] for k in range(12)] == ["block" if ranks[k] > limit else "allow" for k in range(12)]

    def test_odd_tables(self, spark):
        pages = spark.createDataFrame([(1, "http://a.org", None, "x", "y")], "page_id BIGINT, url STRING, html STRING, host STRING, verdict STRING")
        assert self.found(url_graph.judge_urls(pages, [])) == [(1, "a.org", "", None, "allow")]
        assert url_graph.judge_urls(pages.limit(0), queries.URL_RULES).collect() == []


def plain_statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


class TestQuality:
    def base(self, df):
        return sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in df.collect()), key=repr)

    def test_query(self, spark, docs):
        got = queries.op10_quality_rules(spark, SMALL)
        assert self.base(got) == sorted(((d, *plain_statistics(t)) for d, t in pairs(docs)), key=repr)
        assert got.where("base_failed AND kept").count() == 0

    def test_learned_rules_hold_on_other_rows(self, spark):
        sf = "/root/testdata/sf0.01"
        got = {r["doc_id"]: r["kept"] for r in queries.op10_quality_rules(spark, sf).collect()}
        labels = [(r["doc_id"], r["quality"]) for r in queries.table(spark, sf, "labels").collect()]
        assert np.mean([got[d] for d, q in labels if q == 1]) > 0.98
        assert np.mean([got[d] for d, q in labels if q == 0]) < 0.2

    def test_covering(self):
        deal = np.random.default_rng(3)
        rows = pd.DataFrame({"a": deal.random(3000), "b": deal.random(3000), "c": deal.random(3000)})
        bad = (((rows["a"] > 0.8) & (rows["b"] <= 0.5)) | (rows["c"] > 0.95)).to_numpy()
        rules = quality_rules.learn_rules(rows, bad, 0.95)
        cover = np.any([quality_rules._holds(rows, r) for r in rules], axis=0)
        assert (cover & bad).sum() > 0.8 * bad.sum() and (cover & ~bad).sum() < 0.05 * cover.sum()
        assert quality_rules.learn_rules(rows, np.zeros(3000, bool)) == [] == quality_rules.learn_rules(rows[:0], bad[:0])

    def test_odd_rows(self, spark, odd, none):
        labels = spark.createDataFrame([(5, 0), (5, 1), (None, 0), (8, None)], "doc_id BIGINT, quality BIGINT")
        got = quality_rules.judge_quality(odd, labels)
        assert self.base(got) == sorted(((d, *plain_statistics(t)) for d, t in pairs(odd)), key=repr)
        assert quality_rules.judge_quality(none, labels).collect() == []
        assert quality_rules.judge_quality(odd, labels.limit(0)).count() == odd.count()


class TestPipeline:
    def expected_after(self, name, before, spark):
        """The ids, or ids and texts, that a stage leaves of ``(id, text)``."""
        if name == "language_id":
            return {(d, t) for d, t in before if any(map(str.isalpha, t or ""))}
        if name == "line_dedup":
            return {(d, t) for d, t, _, _ in plain_lines(before)}
        if name == "near_dedup":
            marks = [(d, plain_fingerprint(t)) for d, t in before]
            first = {d: c for d, _, c in plain_components(marks)}
            return {(d, t) for d, t in before if first[d] == d}
        leaks = decontaminate.find_leaks(spark.createDataFrame(before, "doc_id BIGINT, text STRING"), queries.table(spark, SMALL, "benchmark"))
        leaked = {r["doc_id"] for r in leaks.collect()}
        assert leaked
        return {(d, t) for d, t in before if d not in leaked}

    def test_stages(self, spark, docs):
        import corpus_pipeline

        kept = docs
        for name, apply in corpus_pipeline.STAGES[:-1]:
            before, kept = kept, apply(spark, kept, SMALL)
            assert kept.schema.names == docs.schema.names, name
            kept = spark.createDataFrame(kept.toPandas(), docs.schema)
            assert set(pairs(kept)) == self.expected_after(name, pairs(before), spark), name
            assert kept.count() == len(set(pairs(kept)))
            assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
        final = entry_points.queries()["pipeline"](spark, SMALL)
        assert {r["doc_id"] for r in final.collect()} == {d for d, _ in pairs(kept)}

    def test_odd_and_empty_tables(self, spark, odd, none):
        import corpus_pipeline

        for docs in (odd, none):
            docs = docs.selectExpr("*", "CAST('en' AS STRING) AS lang", "99 AS n_lines", "'kept' AS n_dropped", "7 AS leaked", "'d' AS `dot.ted`")
            for name, apply in corpus_pipeline.STAGES[:-1]:
                before, docs = docs, apply(spark, docs, SMALL)
                assert docs.columns == before.columns, name
                docs = spark.createDataFrame(docs.collect(), before.schema)
                assert all((r["n_lines"], r["n_dropped"], r["leaked"], r["dot.ted"]) == (99, "kept", 7, "d") for r in docs.collect()), name
            packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
            assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
