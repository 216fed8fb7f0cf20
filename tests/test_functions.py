"""Scalar functions on hand-made rows."""

import base64
import datetime
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from careloom.functions import clinical, dates, ids, numbers, text


def apply(spark, fn, *columns):
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(f"{n} STRING" for n in names)
    df = spark.createDataFrame(list(zip(range(len(columns[0])), *columns)), "i INT, " + schema)
    out = df.select("i", fn(*[F.col(n) for n in names]).alias("r")).orderBy("i")
    return [r["r"] for r in out.collect()]


CASES = [
    (
        dates.format_date,
        {
            "2020-02-29": "2020-02-29", "2021-02-29": None, "02/03/2020": "2020-02-03", "2/3/2020": "2020-02-03",
            "2020-01-05 23:59:59": "2020-01-05", "20200105": "2020-01-05", "": None, "bad": None, None: None, " 2020-01-05 ": "2020-01-05",
            "2020": None, "13/13/2020": None, "1/5/2024 10:30": "2024-01-05", "1/5/2024 10:30:15": "2024-01-05", "1/5/2024 12:00:00 AM": "2024-01-05",
            "1/5/2024 3:05 pm": "2024-01-05", "1/5/2024 13:00 PM": None, "2024/01/05": "2024-01-05", "01-05-2024": "2024-01-05", "5 Jan 2024": "2024-01-05",
            "05JAN2024": "2024-01-05", "5-jan-2024": "2024-01-05", "Jan 5, 2024": "2024-01-05", "31 Feb 2024": None, "5 Abc 2024": None,
            "20240105 103000": "2024-01-05", "20240105103000": "2024-01-05", "1/5/24": "2024-01-05", "1/5/68": "2068-01-05", "1/5/69": "1969-01-05",
        },
    ),
    (
        dates.format_time,
        {"2020-01-05 23:59:59": "23:59", "2020-01-05": "00:00", "10:30": "10:30", "9:05:00": "09:05", "25:00": None, "1/5/2024 3:05 PM": "15:05", "1/5/2024 12:00:00 AM": "00:00", "20240105 103000": "10:30", "": None, None: None},
    ),
    (dates.time_of_datetime, {"2020-01-05 23:59:59": "23:59", "2020-01-05": None, "bad": None, None: None}),
    (dates.date_of_datetime, {"2020-01-05 23:59:59": "2020-01-05", "01/05/2020": None}),
    (dates.time_by_position, {"2020-01-05 23:59:59": "23:59", "": None, None: None}),
    (dates.us_date, {"02/03/2020": "2020-02-03", "2020-02-03": None, "02/30/2020": None}),
    (dates.date_or_default, {"2020-01-05": "2020-01-05", "bad": "1900-01-01", None: "1900-01-01"}),
    (dates.datetime_or_default, {"2020-01-05": "2020-01-05 00:00:00", "": "1900-01-01 00:00:00"}),
    (dates.month_bucket, {"2020-01-05 10:00:00": "2020-01", "02/03/2020": "2020-02", "bad": None}),
    (
        numbers.to_double,
        {
            "3": 3.0, "3.0": 3.0, " 3 ": 3.0, "1,234.5": None, "-5": -5.0, "+5": 5.0, ">5": None, "120/80": None, "nan": None,
            "inf": None, "1d": None, "1_0": None, "NULL": None, "": None, "30 tablets": None, None: None, "1e3": 1000.0,
        },
    ),
    (numbers.keep_if_numeric, {" 3 ": " 3 ", "nan": None, "+5": "+5"}),
    (numbers.to_double_without_commas, {"1,234.5": 1234.5, "12": 12.0, "x": None}),
    (numbers.leading_quantity, {"30 tablets": 30.0, "2.5": 2.5, "some": 0.0, None: 0.0, "": 0.0}),
    (numbers.whole_or_decimal, {"3": "3", "3.50": "3.5", "x": None, None: None}),
    (numbers.strip_signs, {"+5": "+5", "5-": "5", "5+-": "5", "high": None, None: None}),
    (numbers.ratio_text, {"120/80": "120/80", "5": None, None: None}),
    (numbers.non_ratio_number, {"120/80": None, "5": "5", "x": None}),
    (text.null_word, {"NULL": None, "x": "x"}),
    (text.after_pipe, {"123|VAL": "VAL", "123": None, None: None, "1|": ""}),
    (text.first_eight, {"abcdefghij": "abcdefgh", "abc": "abc"}),
    (text.strip_exponent_marks, {"e10E": "10", "ee 5 E": "5"}),
    (text.zip5, {"12345": "12345", "1234": None, "12345-6789": None, None: None}),
    (text.zip9, {"12345-6789": "123456789", "123456789": "123456789", "12345": None}),
    (text.us_state, {"fl": "FL", "ZZ": None, None: None}),
    (text.npi_flag, {"1234567890": "Y", "123456789": "N", "A234567890": "N", None: "N"}),
    (text.without_controls, {"a\x01b": "ab", "ok\n": "ok\n"}),
    (clinical.drg_version, {"2007-09-30": "01", "2007-10-01": "02", "": None, "bad": None, None: None}),
    (clinical.drg_label, {"2007-09-30": "CMS-DRG (old system)", "2007-10-01": "MS-DRG (current system)"}),
    (clinical.condition_status, {"": "AC", None: "AC", "2020-01-01": "RS"}),
    (clinical.lab_location, {None: "L", "POC glucose": "P", " POC": "L", "x": "L"}),
    (lambda c: clinical.lab_location(c, prefix=" POC", missing="UN"), {None: "UN", " POC glucose": "P", "POC": "L"}),
    (clinical.prn_flag, {"daily *as needed*": "Y", "daily": "N", None: None}),
    (clinical.principal_diagnosis, {"Primary": "P", "Secondary": "S", "x": "NI", None: "NI"}),
    (clinical.present_on_admission, {"": "N", None: "N", "NONE": "N", "E11": "Y"}),
    (clinical.principal_procedure, {"0": "UN", "1": "P", "2": "S", "3": "OT", "10": "OT", "x": "UN", None: "UN"}),
    (clinical.discharge_disposition, {"30000000|638666": "E", "30000000|638667": "E", "1": "A", None: "A"}),
    (clinical.result_qualifier, {"POSITIVE": "POSITIVE", "positive": "OT", "NONE": "NI", "": "NI", None: "NI"}),
    (clinical.other_or_no_information, {"x": "OT", "": "NI", None: "NI"}),
]


@pytest.mark.parametrize("fn, cases", CASES, ids=[getattr(f, "__name__", "fn") for f, _ in CASES])
def test_cases(spark, fn, cases):
    assert apply(spark, fn, list(cases)) == list(cases.values())


def test_custom_date_format(spark):
    assert apply(spark, lambda c: dates.format_date(c, ["dd-MMM-yyyy", "yyyy-MM-dd"]), ["05-Jan-2020", "2020-01-06", "x"]) == [
        "2020-01-05", "2020-01-06", None,
    ]


def test_first_date(spark):
    got = apply(spark, dates.first_date, ["a", "", None, ""], ["b", "b", None, ""], ["c", "c", "c", None])
    assert got == ["a", "b", "c", "1900-01-01"]


def test_later_and_earlier(spark):
    a = ["2020-01-01", "2020-01-03", "2020-01-01", None, "2020-01-01"]
    b = ["2020-01-02", "2020-01-02", None, "2020-01-01", "bad"]
    assert apply(spark, dates.later_of, a, b) == ["2020-01-02", "2020-01-03", "2020-01-01", None, "2020-01-01"]
    assert apply(spark, dates.earlier_of, a, b) == ["2020-01-01", "2020-01-02", "2020-01-01", None, "2020-01-01"]


def test_dash_join_needs_both_sides(spark):
    assert apply(spark, text.dash_join, ["a", None, "a"], ["1", "1", None]) == ["a - 1", None, None]


def test_dictionary_entry(spark):
    got = apply(spark, lambda k, v: text.dictionary_entry(k, v, F.lit(False)), ["ab", "x", "a" * 25], ["T", "", "T"])
    assert got == [
        '       "AB"' + " " * 16 + '  :  "T",', '       # "X"' + " " * 15 + '  :  "",', f'       "{"A" * 25}"  :  "T",',
    ]


def test_load_stamp_is_text_to_the_second(spark):
    (stamp,) = spark.range(1).select(dates.load_stamp()).first()
    assert len(stamp) == 19


class TestPseudonyms:
    values = ["abc", "é1", "", "x" * 90, "y" * 300, None]

    def test_xor_is_the_older_scheme(self, spark):
        pad = hashlib.sha1(b"seed").digest()

        def expected(v):
            plain = ("ABC" + v).encode()
            return base64.b64encode(bytes(b ^ pad[i % 20] for i, b in enumerate(plain))).decode()

        got = apply(spark, lambda c: ids.pseudonym(c, "ABC", "seed", "xor"), self.values)
        assert got == [None if v is None else expected(v) for v in self.values]

    def test_keyed_is_a_digest_and_salt_separates(self, spark):
        got = apply(spark, lambda c: ids.pseudonym(c, "ABC", "key"), ["1", None])
        sized = b"".join(len(p).to_bytes(8, "big") + p for p in (b"key", b"ABC", b""))
        assert got == [hashlib.sha256((hashlib.sha256(sized).hexdigest() + "1").encode()).hexdigest(), None]
        assert apply(spark, lambda c: ids.pseudonym(c, "A", "key"), ["X1"]) != apply(spark, lambda c: ids.pseudonym(c, "AX", "key"), ["1"])
        hidden = spark.range(1).select(ids.pseudonym(F.col("id"), "ABC", "secret key"))
        assert "secret key" not in hidden._jdf.queryExecution().toString()
        assert apply(spark, lambda c: ids.pseudonym(c, "ABC", "key", salt="OBS"), ["1"]) != got[:1]

    def test_site_is_required(self):
        with pytest.raises(ValueError):
            ids.pseudonym(F.lit("1"), "", "key")


def test_encounter_type_rules(spark):
    from careloom.operators.claims import add_encounter_type

    lines = [
        ("U", "0111", "0450", None, None, None, "EI"), ("u", "111", None, "99283", None, None, "EI"),
        ("U", "12", None, None, None, None, "IP"), ("U", "21", "0450", None, None, None, "IS"),
        ("U", "99", "0981", None, None, None, "ED"), ("U", "13", "0760", None, None, None, "OS"),
        ("U", "13", None, "g0378", None, None, "OS"), ("U", "07", None, None, None, None, "AV"),
        ("U", "99", None, None, "02", None, "TH"), ("U", "99", None, None, None, "GT", "TH"),
        ("U", "99", None, None, None, None, "OT"), ("U", "", None, None, None, None, "NI"),
        ("H", None, None, "99281", "21", None, "ED"), ("H", None, None, None, "21", None, "IC"),
        ("H", None, None, "99252", "11", None, "IC"), ("H", None, None, "99217", "11", None, "OS"),
        ("H", None, None, None, "10", None, "TH"), ("H", None, None, None, "11", None, "AV"),
        ("H", None, None, "T1015", "99", None, "AV"), ("H", None, None, None, "99", None, "OT"),
        ("H", None, None, None, None, None, "OT"), ("H", None, None, None, "77", None, "AV"), ("X", "11", None, None, None, None, "NI"),
    ]
    df = spark.createDataFrame(lines, "f STRING, b STRING, r STRING, h STRING, p STRING, m STRING, want STRING")
    got = add_encounter_type(df, "f", "b", "r", "h", "p", ["m"], name="got").where("NOT got <=> want").collect()
    assert got == []


# layouts read by their parts, besides those with a shape of their own
LAYOUTS = (
    "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S+00:00", "%Y-%m-%dT%H:%M:%S.%f",
    "%Y-%m-%dT%H:%M:%S.%f+02:00", "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %I:%M %p", "%Y-%m-%d %I:%M:%S %p",
    "%Y-%m-%d %H:%M:%S UTC", "%Y-%m-%d %H:%M:%S-05:00", "%Y-%m-%d %H:%M:%S -0500", "%Y%m%dT%H%M%S", "%Y%m%dT%H%M", "%Y%m%dT%H%M%SZ",
    "%Y%m%d%H%M", "%Y%m%d %H:%M", "%Y%m%d %H:%M:%S", "%Y/%m/%d %H:%M", "%Y/%m/%d %H:%M:%S", "%Y/%m/%d %I:%M %p", "%Y.%m.%d",
    "%Y.%m.%d %H:%M", "%m.%d.%Y", "%m.%d.%Y %H:%M", "%m/%d/%Y %I:%M%p", "%m/%d/%Y %I%p", "%m/%d/%Y %I %p", "%m/%d/%Y %H:%M:%S.%f",
    "%m/%d/%Y, %I:%M:%S %p", "%m-%d-%Y %H:%M", "%m-%d-%Y %I:%M:%S %p", "%m/%d/%y %H:%M", "%m/%d/%y %I:%M %p", "%m-%d-%y", "%m.%d.%y",
    "%m %d %Y", "%B %d, %Y", "%B %d %Y", "%b %d %Y", "%b. %d, %Y", "%B %d, %Y %H:%M", "%B %d, %Y %I:%M %p", "%B %d, %Y at %I:%M %p",
    "%b %d %Y %I:%M%p", "%d %B %Y", "%d %B %Y %H:%M", "%d %b %Y %H:%M:%S", "%d-%b-%Y %H:%M:%S", "%d-%b-%y", "%d%b%y",
    "%d%B%Y", "%d %b, %Y", "%d-%B-%Y", "%d/%b/%Y", "%d/%b/%Y %H:%M:%S", "%d.%b.%Y", "%Y-%b-%d", "%Y %B %d", "%Y-%b-%d %H:%M", "%b-%d-%Y",
    "%b/%d/%Y", "%A, %B %d, %Y", "%a, %d %b %Y", "%a, %d %b %Y %H:%M:%S GMT", "%a %b %d %H:%M:%S %Y", "%a %d %b %Y",
    "%A %d %B %Y %I:%M %p", "%a %m/%d/%Y", "%d of %B %Y", "%dth of %B, %Y", "%B %dth, %Y", "%H:%M %m/%d/%Y", "%H:%M:%S %Y-%m-%d",
    "%I:%M %p %B %d, %Y", "%m/%d/%Y %I:%M a.m.", "%m/%d/%Y %I:%M P.M.", "%m/%d/%Y %H:%M EST",
)


def test_layouts_by_parts(spark):
    """Sixty moments in each layout, against what a general parser of dates makes of them."""
    parser = pytest.importorskip("dateutil.parser")
    draw, texts = random.Random(3), []
    for layout in LAYOUTS:
        for _ in range(60):
            seconds, micros = draw.randrange(60 * 365 * 86400), draw.randrange(10**6)
            texts.append((datetime.datetime(1980, 1, 1) + datetime.timedelta(seconds=seconds, microseconds=micros)).strftime(layout))
    expected = [parser.parse(t, tzinfos=lambda *_: datetime.timezone.utc) for t in texts]
    assert apply(spark, dates.format_date, texts) == [e.strftime("%Y-%m-%d") for e in expected]
    assert apply(spark, dates.format_time, texts) == [e.strftime("%H:%M") for e in expected]


def test_parts_that_make_no_date(spark):
    lost = [
        "bad", "", None, "2020", "jan", "5 jan", "march 2020", "maybe 5 2020", "13/13/2020", "31 Feb 2024", "1/5/2024 13:00 PM", "1/2/3/4",
        "2020-25-12", "10:30:99 2020-01-02", "2020-01-01 24:00", "0/5/2024", "5 January", "12", "1 2 3 4 5 " * 1000, "9" * 5000,
    ]
    assert apply(spark, dates.format_date, lost) == [None] * len(lost)
    alone = ["3:05 pm", "12am", "12:10 AM", "10:30", "7 P.M.", "13:00 pm", "noon"]
    assert apply(spark, dates.format_date, alone) == [None] * len(alone)
    assert apply(spark, dates.format_time, alone) == ["15:05", "00:00", "00:10", "10:30", "19:00", None, None]


@pytest.mark.parametrize("total", [200, 2000, 20_000, 60_175])
def test_halves_of_percents_round_as_in_sql(spark, total):
    part = F.col("id")
    got = spark.range(total + 1).select("id", numbers.round_percent(part, F.lit(total).cast("bigint"))).orderBy("id").collect()
    sql = f"SELECT range, round(100.0 * range / {total}::HUGEINT, 2) FROM range({total + 1}) ORDER BY 1"
    assert [tuple(r) for r in got] == duckdb.sql(sql).fetchall()
