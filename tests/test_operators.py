"""Operators on small fixtures, with the edges that matter."""

import collections
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from careloom.operators import codes, coverage, dedup, history, lookup, merge, orphans, patterns, profile, project, repairs, route, schema
from careloom.operators.collapse import collapse_first
from careloom.plans import mapping
from careloom.sources import reference
from tests.conftest import rows

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KEY = st.one_of(st.none(), st.sampled_from(["", "a", "b", "b ", "é"]))


class TestDedup:
    @QUICK
    @given(data=st.lists(st.tuples(KEY, KEY, st.sampled_from(["1", "2", None])), min_size=1, max_size=30))
    def test_kept_and_surplus_are_the_input(self, spark, data):
        df = spark.createDataFrame(data, "k STRING, l STRING, v STRING")
        d = dedup.dedup(df, ["k", "l"])
        kept, surplus = rows(d.kept), rows(d.surplus)
        assert collections.Counter(kept + surplus) == collections.Counter(data)
        assert len({(k, l) for k, l, _ in kept}) == len(kept) == len({(k, l) for k, l, _ in data})
        repeated = {k for k, n in collections.Counter((k, l) for k, l, _ in data).items() if n > 1}
        assert {(r["k"], r["l"]) for r in d.key_report.collect()} == repeated

    def test_order_decides(self, spark):
        df = spark.createDataFrame([("a", "2", "x"), ("a", "1", "y")], "k STRING, o STRING, v STRING")
        assert rows(dedup.keep_first(df, ["k"], ["o"])) == [("a", "1", "y")]
        assert rows(dedup.last_per_key(df, ["k"], ["o"])) == [("a", "2", "x")]

    def test_long_runs_of_copies_are_dealt_out(self, spark, monkeypatch):
        monkeypatch.setattr(dedup, "COPIES_PER_STEP", 3)
        df = spark.createDataFrame([("a", 8), ("b", 3), ("c", 1), ("d", 6)], "v STRING, n BIGINT")
        assert collections.Counter(r["v"] for r in dedup.repeat_rows(df, "n").collect()) == {"a": 8, "b": 3, "c": 1, "d": 6}


class TestOrphans:
    def child(self, spark):
        return spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c"), ("9", "d"), ("9", "e")], "K STRING, V STRING")

    def parents(self, spark):
        return spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "P STRING")

    def test_drop(self, spark):
        r = orphans.drop_orphans(self.child(spark), self.parents(spark), "K", "P")
        assert rows(r.good) == [("1", "a"), ("2", "b")]
        assert rows(r.rejects) == [("9", "d"), ("9", "e"), (None, "c")]
        assert rows(r.report) == [("9",), (None,)]

    def test_nullify_keeps_every_row_once(self, spark):
        r = orphans.nullify_orphans(self.child(spark), self.parents(spark), "K", "P")
        assert rows(r.good) == sorted([("1", "a"), ("2", "b"), (None, "c"), (None, "d"), (None, "e")], key=repr)
        assert rows(r.report) == [("9", 2)]
        assert rows(r.rejects) == [("9", "d"), ("9", "e")]

    def test_keys_of_another_type(self, spark):
        numbers = spark.createDataFrame([(1,), (2,)], "P BIGINT")
        assert orphans.drop_orphans(self.child(spark), numbers, "K", "P").good.count() == 2
        assert orphans.nullify_orphans(self.child(spark), numbers, "K", "P").good.where("K IS NOT NULL").count() == 2

    def test_no_parents_at_all(self, spark):
        none = spark.createDataFrame([], "P STRING")
        assert orphans.nullify_orphans(self.child(spark), none, "K", "P").good.where("K IS NOT NULL").count() == 0
        assert orphans.drop_orphans(self.child(spark), none, "K", "P").good.count() == 0

    def test_replicate(self, spark):
        child = spark.createDataFrame([("1", "x", "y"), ("9", "x", "y"), (None, "x", "y"), ("2", None, "q")], "E STRING, A STRING, B STRING")
        parent = spark.createDataFrame([("1", "x", "z"), ("1", "x", "z"), ("2", "w", "q")], "E STRING, A STRING, B STRING")
        r = orphans.replicate(child, parent, "E", ["A", "B"])
        assert rows(r.good) == sorted([("1", "x", "z"), ("9", None, None), (None, None, None), ("2", "w", "q")], key=repr)
        assert rows(r.rejects.select("E", "SOURCE_B")) == [("1", "z")]
        assert rows(orphans.replicate(child, parent, "E", ["A", "B"], how="inner").good) == [("1", "x", "z"), ("2", "w", "q")]


class TestRepairs:
    def test_patterns_are_plain_text(self, spark):
        df = spark.createDataFrame([("see client/phone # 5",), ("a[b",), ("fine",), (None,), ("x.y",), ("a Q\\e b",)], "t STRING")
        patterns = spark.createDataFrame([("CLIENT/PHONE #",), ("[",), ("x?y",), ("q\\E",)], "p STRING")
        r = repairs.remove_patterns(df, "t", patterns)
        assert rows(r.good) == [("fine",), ("x.y",), (None,)]
        assert rows(r.rejects) == [("a Q\\e b",), ("a[b",), ("see client/phone # 5",)]

    @pytest.mark.parametrize("tried", [1000, 2, 0])
    def test_long_lists_find_what_short_ones_find(self, spark, monkeypatch, tried):
        """Whatever the length at which a list is indexed, also where letters match beyond ASCII."""
        monkeypatch.setattr(patterns, "MOST_TRIED", tried)
        texts = ["Kelvin \u212aELVIN", "d\u0131ng", "D\u0130NGO", "mi\u017fs it", "stra\u00dfe STRASSE", "\u03a3\u03af\u03c3\u03c5\u03c6\u03bf\u03c2", "abc", "ab", "a.b*c?d", "x\\Ey\\Qz", "\U0001f600abc\U0001f600def", "", None, "abc", "line\nbreak here"]
        listed = ["kelvin k", "DING", "dingo", "MISS", "STRASSE", "\u03c3\u03af\u03c3\u03c5\u03c6\u03bf\u03c3", "b", ".b*C", "\\ey\\q", "\U0001f600ABC\U0001f600", "NE\nBR", "", None, "nothing has this"]
        df = spark.createDataFrame(list(enumerate(texts)), "n INT, t STRING")
        for few in (listed, listed[:3], listed[6:7], ["ab"], ["kkkk", "issb"]):
            r = repairs.remove_patterns(df, "t", spark.createDataFrame([(p,) for p in few], "p STRING"))
            hit = {n for n, t in enumerate(texts) if t and any(p and re.search(re.escape(p), t, re.I) for p in few)}
            # the engine's rule for sigma and dotless i is that of single characters, as here
            assert {x[0] for x in r.rejects.collect()} == hit
            assert sorted(x[0] for x in r.good.collect()) == [n for n in range(len(texts)) if n not in hit]

    def test_a_hundred_thousand_patterns(self, spark):
        numbers = spark.range(200_000).select(F.concat(F.lit("Item No. "), F.col("id").cast("string"), F.lit(" of the list")).alias("t"))
        listed = spark.range(0, 1_000_000, 10).select(F.concat(F.lit("NO. "), F.col("id").cast("string"), F.lit(" of")).alias("p"))
        r = repairs.remove_patterns(numbers, "t", listed)
        assert (r.good.count(), r.rejects.count()) == (180_000, 20_000)
        assert r.rejects.where("NOT t LIKE '%0 of %'").isEmpty()

    def test_no_patterns_remove_nothing(self, spark):
        df = spark.createDataFrame([("a",), (None,)], "t STRING")
        assert repairs.remove_patterns(df, "t", spark.createDataFrame([], "p STRING")).good.count() == 2

    def test_list(self, spark):
        df = spark.createDataFrame([("a",), ("b",), (None,)], "t STRING")
        listed = spark.createDataFrame([("a",), ("a",), (None,)], "code STRING")
        r = repairs.remove_listed(df, "t", listed)
        assert (rows(r.good), rows(r.rejects)) == ([("b",), (None,)], [("a",)])

    def test_invalid_to_null(self, spark):
        df = spark.createDataFrame([("F",), ("x",), (None,)], "s STRING")
        r = repairs.invalid_to_null(df, "s", spark.createDataFrame([(" F ",)], "VALUESET_ITEM STRING"))
        assert rows(r.good) == sorted([("F",), (None,), (None,)], key=repr) and rows(r.rejects) == [("x",)]

    def test_clamp(self, spark):
        df = spark.createDataFrame(
            [("2020-01-10", "2020-01-05"), ("2020-01-10", "2020-01-04"), ("bad", "2020-01-01"), ("2020-01-10", None)],
            "ADMIT_DATE STRING, D STRING",
        )
        got = [r["D"] for r in repairs.clamp_early_date(df, "D").good.collect()]
        assert got == ["2020-01-05", "2020-01-10", "2020-01-01", None]


class TestCodes:
    def code_map(self, spark, n=3):
        entries = {"a": "AA", "B": "", "c": None} | {f"k{i}": f"v{i}" for i in range(n)}
        return reference.code_map(spark, {("T", "F"): entries, ("T", "F_UNIT"): {"mg": "MG", "Mg": "MEGA"}})

    @pytest.mark.parametrize("n, most", [(3, 100_000), (500, 100_000), (500, 100)])
    def test_inline_and_joined_dictionaries_agree(self, spark, n, most, monkeypatch):
        monkeypatch.setattr(codes, "BROADCAST_ENTRIES", most)
        df = spark.createDataFrame([("A",), ("b",), ("C",), ("K1",), ("zz",), (None,)], "F STRING")
        mapped = codes.map_codes(df, self.code_map(spark, n), "T", ["F"])
        assert rows(mapped) == sorted([("AA",), ("",), ("C",), ("v1",), ("zz",), (None,)], key=repr)
        strict = codes.map_codes(df, self.code_map(spark, n), "T", ["F"], "strict")
        assert rows(strict) == sorted([("AA",), ("",), (None,), ("v1",), (None,), (None,)], key=repr)

    def test_sizes_and_small_entries_are_read_in_two_jobs(self, spark):
        fields = ["F", "F_UNIT", "G"]
        stored = self.code_map(spark, 100)
        assert codes.dictionary_sizes(stored, "T", fields) == {"F": (103, 585), "F_UNIT": (2, 10)}
        small = codes.small_dictionaries(stored, "T", ["F_UNIT"], {"F_UNIT"})
        assert small == {"F_UNIT": {"mg": "MG", "Mg": "MEGA"}}
        assert codes.small_dictionaries(stored, "T", [], set()) == {}

    def test_units_keep_their_case(self, spark):
        df = spark.createDataFrame([("mg",), ("Mg",), ("MG",)], "F_UNIT STRING")
        got = codes.map_codes(df, self.code_map(spark), "T", ["F_UNIT"], case_sensitive=["F_UNIT"])
        assert rows(got) == [("MEGA",), ("MG",), ("MG",)]

    def test_field_without_dictionary_is_unchanged(self, spark):
        df = spark.createDataFrame([("x",)], "G STRING")
        assert rows(codes.map_codes(df, self.code_map(spark), "T", ["G"])) == [("x",)]
        assert rows(codes.map_codes(df, self.code_map(spark), "T", ["G"], "strict")) == [(None,)]

    @pytest.mark.parametrize("n", [3, 500])
    def test_unchecked_dictionaries_never_multiply_rows(self, spark, n):
        entries = [("T", "F", s, v) for s, v in ((None, "N"), ("a", "1"), ("A", "3"), ("a", "2"), *[(f"k{i}", f"v{i}") for i in range(n)])]
        raw = spark.createDataFrame(entries, reference.CODE_MAP_SCHEMA)
        df = spark.createDataFrame([("a",), (None,), ("zz",)], "F STRING")
        assert rows(codes.map_codes(df, raw, "T", ["F"])) == sorted([("3",), (None,), ("zz",)], key=repr)

    def test_the_jobs_decide_about_case(self):
        for table, job in mapping.JOBS.items():
            for field in job.codes + job.exact_codes + job.strict_codes:
                assert codes.unit_name(table, field) == (field in job.exact_codes), (table, field)

    def test_missing_keys_are_refused(self, spark):
        with pytest.raises(ValueError):
            codes.checked(spark.createDataFrame([("T", "F", None, "1")], reference.CODE_MAP_SCHEMA))
        with pytest.raises(ValueError):
            codes.checked(spark.createDataFrame([("DISPENSING", "DISPENSE_DOSE_DISP_UNIT", x, "1") for x in ("mg", "MG")], reference.CODE_MAP_SCHEMA))

    def test_colliding_keys_are_refused(self, spark):
        with pytest.raises(ValueError):
            reference.code_map(spark, {("T", "F"): {"a": "1", "A": "2"}})
        raw = spark.createDataFrame([("T", "F", "a", "1"), ("T", "F", "A", "1")], reference.CODE_MAP_SCHEMA)
        with pytest.raises(ValueError):
            codes.checked(raw)

    def test_coverage_counts_every_row(self, spark):
        df = spark.createDataFrame([("A",), ("a",), ("zz",), (None,)], "F STRING")
        covered = coverage.coverage(df, self.code_map(spark), "T", ["F"])
        assert covered.agg(F.sum("count")).first()[0] == 4
        empty = spark.createDataFrame([], "FIELD_NAME STRING, VALUESET_ITEM STRING")
        assert rows(coverage.missing_mapping(covered, empty).select("value")) == [("zz",)]
        known = spark.createDataFrame([("F", " zz")], "FIELD_NAME STRING, VALUESET_ITEM STRING")
        assert coverage.missing_mapping(covered, known).count() == 0


class TestProfiles:
    def test_empty_table(self, spark):
        empty = spark.createDataFrame([], "A STRING, B_DATE STRING")
        assert profile.value_profile(empty).count() == 0
        assert profile.monthly_counts(empty).count() == 0
        assert {r["field"]: r["width"] for r in profile.width_profile(empty).collect()} == {"A": 1, "B_DATE": 1}

    def test_identifiers_are_left_out(self, spark):
        df = spark.createDataFrame([("1", "x"), ("2", "x")], "PATID STRING, SEX STRING")
        assert rows(profile.value_profile(df)) == [("SEX", "x", 2, 100.0)]

    def test_date_columns_by_spec(self, spark):
        spec = spark.createDataFrame(
            [("DEATH", "DEATH_DATE", "RDBMS Date"), ("DEATH", "DEATH_DATE_IMPUTE", "RDBMS Text(2)")],
            "TABLE_NAME STRING, FIELD_NAME STRING, RDBMS_DATA_TYPE STRING",
        )
        df = spark.createDataFrame([], "DEATH_DATE STRING, DEATH_DATE_IMPUTE STRING")
        assert profile.date_columns(df, spec, "DEATH") == ["DEATH_DATE"]
        assert profile.date_columns(df) == ["DEATH_DATE", "DEATH_DATE_IMPUTE"]


class TestHistory:
    schema = "PATID STRING, ADDRESS_ZIP5 STRING, ADDRESS_PERIOD_START STRING, ADDRESS_PERIOD_END STRING"
    start = st.sampled_from([None, "2001-01-01", "2002-01-01", "2003-01-01", "2004-01-01"])
    row = st.tuples(st.sampled_from(["p", "q", "r"]), st.sampled_from([None, "1", "2", "3"]), start, st.none())

    @QUICK
    @given(old=st.lists(row, max_size=8), new=st.lists(row, max_size=8))
    def test_against_pairs(self, spark, old, new):
        got = rows(
            history.merge_history(spark.createDataFrame(old, self.schema), spark.createDataFrame(new, self.schema))
        )
        assert got == sorted(self.by_pairs(old, new), key=repr)

    @staticmethod
    def by_pairs(old, new):
        """The rule, row by row; dates are ISO texts."""
        out = []
        for e in old:
            mine = [n for n in new if n[0] == e[0]]
            same = [n[2] for n in mine if n[1] == e[1]]
            starts = [s for s in same if s]
            if same:
                held = [*starts, *([e[2]] if e[2] else [])]
                out.append((e[0], e[1], min(held, default=None), max(held, default=None)))
            else:
                later = [n[2] for n in mine if n[2] and (not e[2] or n[2] > e[2])]
                out.append((e[0], e[1], e[2], min(later, default=e[3])))
        have = {(e[0], e[1]) for e in old}
        fresh = [n for n in new if (n[0], n[1]) not in have]
        assert len(out + fresh) == len(old) + len(fresh)
        return out + fresh

    def test_a_second_run_adds_nothing(self, spark):
        old = spark.createDataFrame([("p", "A", "2020-01-01", None), ("q", None, None, None)], self.schema)
        new = spark.createDataFrame([("p", None, "2021-01-01", None), ("p", "B", "2019-01-01", None), ("q", None, "2021-01-01", None), (None, "C", None, None)], self.schema)
        once = history.merge_history(old, new)
        assert rows(once) == sorted([
            ("p", "A", "2020-01-01", "2021-01-01"), ("q", None, "2021-01-01", "2021-01-01"), ("p", None, "2021-01-01", None), ("p", "B", "2019-01-01", None), (None, "C", None, None),
        ], key=repr)
        assert history.merge_history(once, new).count() == once.count()

    def test_released_data_can_be_matched(self, spark):
        old = spark.createDataFrame([("p", "A", "2020-01-01", None)], self.schema)
        new = spark.createDataFrame([("p", "A", "2019-01-01", None), ("p", "B", "2021-01-01", None)], self.schema)
        assert history.merge_history(old, new).count() == 2 and history.merge_history(old, new, parity=True).count() == 3


class TestRouting:
    def tables(self, spark):
        lab = [("l1", "both", "OD"), ("l2", "none", "OD"), ("l3", "unknown", "OD"), ("l4", "gen", "OD")]
        clin = [("c1", "lab", "OD", "LC"), ("c2", "lab", "OD", "SM"), ("c3", "gen", "OD", "LC")]
        return {
            route.LAB: spark.createDataFrame(lab, "LAB_RESULT_CM_ID STRING, LAB_LOINC STRING, LAB_RESULT_SOURCE STRING"),
            route.CLIN: spark.createDataFrame(clin, "OBSCLINID STRING, OBSCLIN_CODE STRING, OBSCLIN_SOURCE STRING, OBSCLIN_TYPE STRING"),
        }

    def flags(self, spark):
        rows_ = [("both", "1", "1", "0"), ("none", "0", "0", "0"), ("gen", "0", "0", "1"), ("lab", "1", "0", "0")]
        return spark.createDataFrame(rows_, "loinc_num STRING, found_in_lab STRING, found_in_obs_clin STRING, found_in_obs_gen STRING")

    def test_one_home_per_row(self, spark):
        routed = route.route(self.tables(spark), self.flags(spark))
        got = {r["ID"]: r[route.DESTINATION] for r in routed.collect()}
        assert got == {
            "l1": route.LAB, "l2": route.LAB, "l3": route.LAB, "l4": route.GEN, "c1": route.LAB, "c2": route.LAB, "c3": route.GEN,
        }

    def test_copies(self, spark):
        routed = route.route(self.tables(spark), self.flags(spark), copies=True)
        got = rows(routed.select("ID", route.DESTINATION, "RESULT_SOURCE"))
        assert ("l1", route.LAB, "OD") in got and ("l1", route.CLIN, "DR") in got and ("l3", route.LAB, "OD") in got
        assert not [r for r in got if r[0] == "l2"]

    def test_by_class(self, spark):
        classes = spark.createDataFrame([("both", "2"), ("gen", "3"), ("lab", "1")], "loinc_num STRING, classtype STRING")
        routed = route.move_by_class(self.tables(spark), classes)
        got = {r["ID"]: (r[route.DESTINATION], r["RESULT_SOURCE"], r["TYPE"]) for r in routed.collect()}
        assert got["l1"] == (route.CLIN, "HC", "LC") and got["l4"] == (route.GEN, "HC", "LC")
        assert got["c1"] == (route.LAB, "OD", "LC") and got["c2"] == (route.CLIN, "OD", "SM") and got["c3"][0] == route.GEN
        report = {r["step"]: r["records_moved"] for r in route.moved_report(routed).collect()}
        assert report["LAB_RESULT_CM -> OBS_CLIN"] == 1 and report["OBS_GEN -> LAB_RESULT_CM"] == 0 and len(report) == 5
        back = route.from_common(routed, route.LAB, ["LAB_RESULT_CM_ID", "LAB_LOINC", "RAW_PANEL"])
        assert ("c1", "lab", None) in rows(back)

    def test_the_code_type_travels(self, spark):
        tables = self.tables(spark)
        tables[route.LAB] = tables[route.LAB].withColumn("LAB_PX_TYPE", F.lit("CH"))
        routed = route.route(tables, self.flags(spark))
        assert ("l4", "CH") in rows(route.from_common(routed, route.GEN, ["OBSGENID", "OBSGEN_TYPE"]))
        assert ("c2", "SM") in rows(route.from_common(routed, route.LAB, ["LAB_RESULT_CM_ID", "LAB_PX_TYPE"]))

    def test_absent_destination_starts_empty(self, spark):
        routed = route.route({route.LAB: self.tables(spark)[route.LAB]}, self.flags(spark))
        assert rows(route.from_common(routed, route.GEN, ["OBSGENID", "OBSGEN_CODE", "OBSGEN_TYPE"])) == [("l4", "gen", None)]


def test_collapse_takes_the_first_filled_value(spark):
    data = [("e", "p", "2", "b", ""), ("e", "p", "1", "", "y"), ("e", "p", "3", "c", "z"), (None, None, "1", "q", None)]
    df = spark.createDataFrame(data, "E STRING, P STRING, O STRING, A STRING, B STRING")
    assert rows(collapse_first(df, ["E", "P"], ["O"])) == sorted([("e", "p", "1", "b", "y"), (None, None, "1", "q", None)], key=repr)


def test_upsert_keeps_what_did_not_come_again(spark):
    old = spark.createDataFrame([("1", "x", "old"), ("2", "x", "old"), (None, "x", "old")], "K STRING, L STRING, V STRING")
    new = spark.createDataFrame([("1", "x", "new", "n")], "K STRING, L STRING, V STRING, EXTRA STRING")
    assert rows(merge.upsert_keep_new(old, new, ["K", "L"])) == sorted(
        [("1", "x", "new", "n"), ("2", "x", "old", None), (None, "x", "old", None)], key=repr
    )


def test_lookup_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([("1",), (None,), ("3",)], "k STRING")
    dim = spark.createDataFrame([("1", "a", "1"), ("1", "b", "2"), (None, "z", "3")], "k STRING, v STRING, o STRING")
    assert rows(lookup.lookup(df, dim, {"k": "k"}, {"got": "v"}, last_by=["o"])) == sorted([("1", "b"), (None, None), ("3", None)], key=repr)


class TestSchema:
    fields = [("PATID", "RDBMS Text(x)"), ("SEX", "RDBMS Text(2)"), ("RAW_SEX", "RDBMS Text(x)"), ("DAY", "RDBMS Date"), ("N", "RDBMS Number(x)"), ("NOTE", "RDBMS Text(x)")]

    def df(self, spark):
        return spark.createDataFrame([("1", "Fem", "Female", "2020-02-30", "1e2", "abc", "more")], "PATID STRING, SEX STRING, RAW_SEX STRING, DAY STRING, N STRING, NOTE STRING, EXTRA STRING")

    def test_widths(self, spark):
        typed = schema.table_schema(self.fields, schema.observed_widths(self.df(spark)))
        assert schema.ddl(typed) == (
            "PATID VARCHAR(64),\nSEX VARCHAR(3),\nRAW_SEX VARCHAR(6),\nDAY DATE,\nN FLOAT,\nNOTE VARCHAR(3),\nEXTRA VARCHAR(4),\n"
            "UPDATED VARCHAR(19),\nSOURCE VARCHAR(20)"
        )
        assert schema.ddl(schema.parse_ddl(schema.ddl(typed))) == schema.ddl(typed)

    def test_without_data(self):
        typed = schema.table_schema(self.fields)
        assert [f.metadata.get("maxlength") for f in typed] == [64, 2, 20, None, None, 20, 100, 20]

    def test_apply(self, spark):
        out = schema.apply_schema(self.df(spark), schema.table_schema(self.fields))
        r = out.first()
        assert (r["DAY"], r["N"], r["UPDATED"]) == (None, 100.0, None)
        assert out.schema["SEX"].metadata == {"maxlength": 2}


def test_projection_passthrough_carries_the_rest(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a STRING, b STRING, EXTRA STRING")
    assert project.project(df, {"A": F.col("a"), "X": F.col("b")}, True, used=["b"]).columns == ["A", "X", "EXTRA"]


def test_missing_tables_ignore_case(spark):
    spec = spark.createDataFrame([("DEATH", "a"), ("DEATH", "b"), ("VITAL", "c")], "TABLE_NAME STRING, FIELD_NAME STRING")
    present = spark.createDataFrame([("death",)], "tableName STRING")
    assert rows(merge.missing_tables(spec, present)) == [("VITAL",)]
    assert reference.table_headers(spec, "DEATH") == ["a", "b"]


def test_top_of_every_field(spark):
    df = spark.createDataFrame([(f"v{n % 40}" if n % 3 else None, "same") for n in range(300)], "a STRING, b STRING")
    whole = sorted((r["field"], -r["count"], r["value"] or "", r["value"], r["percent"]) for r in profile.value_profile(df).collect())
    for rows_kept in (1, 2, 7, 1000):
        expected = [r for f in ("a", "b") for r in [w for w in whole if w[0] == f][:rows_kept]]
        got = profile.top_profile(df, rows=rows_kept).collect()
        assert sorted((r["field"], -r["count"], r["value"] or "", r["value"], r["percent"]) for r in got) == expected
    assert profile.top_profile(df.limit(0)).count() == 0
