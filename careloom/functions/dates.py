"""Dates and times held as text.

A date that cannot be read becomes NULL; nothing here raises on bad text.

The layouts that occur everywhere are recognised by their shape, rewritten as ISO
text and cast.  That costs a match and a cast per value; trying parser patterns one
after the other costs an exception for every one that fails.  A text of none of these
shapes is read by its parts: names, clock and numbers are told apart and put in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts accepted when a source declares none.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "yyyyMMdd")
DATETIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy H:mm", "M/d/yyyy")
TIME_FORMATS = ("H:mm:ss", "H:mm")
# Two-digit years up to 68 are of this century, the others of the last.
ANY_FORMATS = (
    "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "yyyyMMdd", "yyyyMMdd HHmmss", "yyyy/M/d",
    "M-d-yyyy", "M/d/yy", "M/d/yy (1900)", "M/d/yyyy h:mm a", "M/d/yyyy h:mm:ss a", "d MMM yyyy", "d-MMM-yyyy", "dMMMyyyy", "MMM d, yyyy",
    "by its parts",
)

# Stand-in date for an unusable one, and the day the DRG system changed.
UNKNOWN_DATE = "1900-01-01"
DRG_CUTOFF = "2007-10-01"

# Shape of each known layout, and its rewriting as ISO text where it is not ISO already.
_US = "([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})"
_SHAPES: dict[str, tuple[str, str | None]] = {
    "yyyy-MM-dd": ("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", None),
    "yyyy-MM-dd HH:mm:ss": ("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}", None),
    "M/d/yyyy": (_US, "$3-$1-$2"),
    "M/d/yyyy H:mm": (_US + " ([0-9]{1,2}:[0-9]{2})", "$3-$1-$2 $4:00"),
    "M/d/yyyy H:mm:ss": (_US + " ([0-9]{1,2}:[0-9]{2}:[0-9]{2})", "$3-$1-$2 $4"),
    "yyyyMMdd": ("([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3"),
    "yyyyMMdd HHmmss": ("([0-9]{4})([0-9]{2})([0-9]{2}) ?([0-9]{2})([0-9]{2})([0-9]{2})", "$1-$2-$3 $4:$5:$6"),
    "yyyy/M/d": ("([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})", "$1-$2-$3"),
    "M-d-yyyy": ("([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})", "$3-$1-$2"),
    "M/d/yy": ("([0-9]{1,2})/([0-9]{1,2})/([0-5][0-9]|6[0-8])", "20$3-$1-$2"),
    "M/d/yy (1900)": ("([0-9]{1,2})/([0-9]{1,2})/(69|[7-9][0-9])", "19$3-$1-$2"),
    "H:mm:ss": ("([0-9]{1,2}:[0-9]{2}:[0-9]{2})", "1970-01-01 $1"),
    "H:mm": ("([0-9]{1,2}:[0-9]{2})", "1970-01-01 $1:00"),
}


# Layouts left to the parser, which is called only where the shape fits.
_CLOCK = "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} (0?[1-9]|1[0-2]):[0-5][0-9]"
_PARSED: dict[str, str] = {
    "M/d/yyyy h:mm a": _CLOCK + " (?i:AM|PM)",
    "M/d/yyyy h:mm:ss a": _CLOCK + ":[0-5][0-9] (?i:AM|PM)",
    "d MMM yyyy": "[0-9]{1,2} [A-Za-z]{3} [0-9]{4}",
    "d-MMM-yyyy": "[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}",
    "dMMMyyyy": "[0-9]{1,2}[A-Za-z]{3}[0-9]{4}",
    "MMM d, yyyy": "[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}",
}

BY_PARTS = "by its parts"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = f"(?:{'|'.join(_MONTHS)})"
_N, _YEAR, _END, _SEP = "[0-9]{1,2}", "([0-9]{4})", "(?![0-9:])[, ]*", "[-/., ]+"
_TIME = f"{_N}:[0-9]{{2}}:[0-9]{{2}}(?: [ap]m)?+"
_NO_MONTH = "1[3-9]|2[0-9]|3[01]"
# Rewritings, one after the other, of a text in lower case into "year-month-day h:m:s am"; the month may be a name.
_PARTS = (
    # words that carry nothing: days of the week, "of", endings of ordinals
    ("(?<![a-z])(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?(?![a-z])[., ]*", ""),
    ("(?<=[ ,])(?:of|at|on) ", ""),
    ("(?<=[0-9])(?:st|nd|rd|th)(?![a-z])", ""),
    # month names by their first three letters
    (f"(?<![a-z])({_MONTH})(?:(?<=jan)uary|(?<=feb)ruary|(?<=mar)ch|(?<=apr)il|(?<=jun)e|(?<=jul)y|(?<=aug)ust|(?<=sep)t(?:ember)?|"
     "(?<=oct)ober|(?<=nov|dec)ember)?(?![a-z])", " $1 "),
    # the clock: halves of the day, whole hours, "T", digits without colons, fractions, zones, seconds
    ("([0-9]) ?([ap])[.]?m(?![a-z])[.]?", "$1 $2m"),
    (f"(?<![:0-9./-])({_N}) ([ap]m)", "$1:00 $2"),
    ("(?<=[0-9])t(?=[0-9])", " "),
    ("^([0-9]{8}) ?([0-9]{2})([0-9]{2})([0-9]{2})(?![0-9])", "$1 $2:$3:$4"),
    ("^([0-9]{8}) ?([0-9]{2})([0-9]{2})(?![0-9])", "$1 $2:$3"),
    ("(:[0-9]{2})[.,][0-9]+", "$1"),
    ("(:[0-9]{2}|[ap]m) ?(?:z|utc|gmt|[ecmp][sd]t|[+-][0-9]{2}:?(?:[0-9]{2})?)(?= |$)", "$1"),
    (f"(?<![:0-9])({_N}:[0-9]{{2}})(?![:0-9])", "$1:00"),
    # the clock goes last
    (f"^ *({_TIME})[, ]+(.+)$", "$2 $1"),
    (f"^(.+?) ({_TIME}) ([0-9]{{4}}) *$", "$1 $3 $2"),
    # the day: digits without separators, years of two digits, then by what can only be a year, a month or a day
    ("^ *([0-9]{4})([0-9]{2})([0-9]{2})(?![0-9])", "$1-$2-$3"),
    (f"^ *((?:{_N}|{_MONTH}){_SEP}(?:{_N}|{_MONTH}){_SEP})'?([0-5][0-9]|6[0-8])(?![0-9:])", "$120$2"),
    (f"^ *((?:{_N}|{_MONTH}){_SEP}(?:{_N}|{_MONTH}){_SEP})'?(69|[7-9][0-9])(?![0-9:])", "$119$2"),
    (f"^ *{_YEAR}{_SEP}({_N}|{_MONTH}){_SEP}({_N}){_END}", "$1-$2-$3 "),
    (f"^ *({_NO_MONTH}){_SEP}(0?[1-9]|1[0-2]){_SEP}{_YEAR}{_END}", "$3-$2-$1 "),
    (f"^ *({_N}){_SEP}({_MONTH}){_SEP}{_YEAR}{_END}", "$3-$2-$1 "),
    (f"^ *({_N}|{_MONTH}){_SEP}({_N}){_SEP}{_YEAR}{_END}", "$3-$1-$2 "),
)
_ORDERED = f"^([0-9]{{4}})-({_N}|{_MONTH})-({_N})(?: +({_N}):([0-9]{{2}}):([0-9]{{2}})(?: ([ap])m)?)? *$"


def read_parts(text: Column, clock_alone: bool = False) -> Column:
    """Wall-clock time of a text whose parts tell which is which, in any usual order; NULL where one is missing.

    Month before day where both could be either; zones and fractions of a second are dropped.  ``clock_alone`` takes
    a time without a day too.  The rewritings are bound by lambdas: only texts that get here pay for them, and the
    code generated for a table with many dates stays small.
    """
    tidy = lambda t: reduce(lambda x, step: F.regexp_replace(x, *step), _PARTS, F.lower(t))
    day = lambda t: F.when(t.rlike(f"^ *{_TIME} *$"), F.concat(F.lit("1970-1-1 "), t)).otherwise(t) if clock_alone else t

    def ordered(t: Column) -> Column:
        part = lambda k: F.regexp_extract(t, _ORDERED, k)
        number = lambda k: F.coalesce(part(k).try_cast("int"), F.lit(0))
        month = F.when(part(2).rlike("[a-z]"), ((F.instr(F.lit("".join(_MONTHS)), part(2)) + 2) / 3).cast("int")).otherwise(number(2))
        half = part(7)
        hour = F.when(half == "", number(4)).when(number(4).between(1, 12), number(4) % 12 + F.when(half == "p", 12).otherwise(0))
        return F.when(part(1) != "", F.try_make_timestamp_ntz(number(1), month, number(3), hour, number(5), number(6)))

    steps = F.array(text)
    for step in (tidy, day, ordered):
        steps = F.transform(steps, step)
    return F.when(text.rlike("[0-9]"), steps[0])


def parse_datetime(c: Column, formats: Sequence[str] = DATETIME_FORMATS) -> Column:
    """Wall-clock time of a text in one of the formats; other formats are Spark patterns.

    Where both ISO layouts are welcome, any ISO text is left to the cast.
    """
    text = F.trim(c)
    known = [_SHAPES[f] for f in formats if f in _SHAPES]
    plain = [shape for shape, rewrite in known if rewrite is None]
    if len(plain) == 2:
        iso = F.when((F.length(text) >= 8) & (F.substring(text, 5, 1) == "-"), text)
    else:
        iso = F.when(text.rlike(f"^{plain[0]}$") if plain else F.lit(False), text)
    for shape, rewrite in known:
        if rewrite is not None:
            iso = iso.when(text.rlike(f"^{shape}$"), F.regexp_replace(text, f"^{shape}$", rewrite))
    others = []
    for f in formats:
        if f == BY_PARTS:
            others.append(read_parts(text, clock_alone="H:mm" in formats))
        elif f not in _SHAPES:
            parsed = F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz")
            others.append(F.when(text.rlike(f"^{_PARSED[f]}$"), parsed) if f in _PARSED else parsed)
    return F.coalesce(iso.try_cast("timestamp_ntz"), *others)


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    return parse_datetime(c, formats).cast("date")


def _day(c: Column) -> Column:
    return F.substring(c.cast("string"), 1, 10)


def _clock(c: Column) -> Column:
    return F.substring(c.cast("string"), 12, 5)


def format_date(c: Column, formats: Sequence[str] = ANY_FORMATS) -> Column:
    return _day(parse_datetime(c, formats))


def unreadable(c: Column, formats: Sequence[str] = ANY_FORMATS) -> Column:
    """Whether a text that is not blank cannot be read as a date."""
    return F.coalesce(F.trim(c) != "", F.lit(False)) & parse_datetime(c, formats).isNull()


def format_time(c: Column, formats: Sequence[str] = ANY_FORMATS + TIME_FORMATS) -> Column:
    return _clock(parse_datetime(c, formats))


def date_of_datetime(c: Column) -> Column:
    """Date part of a strict ``yyyy-MM-dd HH:mm:ss`` text."""
    return _day(parse_datetime(c, ["yyyy-MM-dd HH:mm:ss"]))


def time_of_datetime(c: Column) -> Column:
    """Time part of a strict ``yyyy-MM-dd HH:mm:ss`` text."""
    return _clock(parse_datetime(c, ["yyyy-MM-dd HH:mm:ss"]))


def time_by_position(c: Column) -> Column:
    """Characters 12 to 16 of a datetime text."""
    return F.when(c != "", F.substring(c, 12, 5))


def us_date(c: Column) -> Column:
    return _day(parse_datetime(c, ["M/d/yyyy"]))


def iso_date(c: Column) -> Column:
    return parse_date(c, ["yyyy-MM-dd"])


def date_or_default(c: Column, default: str = UNKNOWN_DATE) -> Column:
    return F.coalesce(iso_date(c).cast("string"), F.lit(default))


def datetime_or_default(c: Column, default: str = UNKNOWN_DATE) -> Column:
    return F.concat(date_or_default(c, default), F.lit(" 00:00:00"))


def first_date(*dates: Column, default: str = UNKNOWN_DATE) -> Column:
    """First date text that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(d, F.lit("")) for d in dates], F.lit(default))


def month_bucket(c: Column, typed: bool = False) -> Column:
    """``yyyy-MM`` of a date; ``typed`` columns skip the text parse."""
    return F.substring((c if typed else parse_datetime(c)).cast("date").cast("string"), 1, 7)


def days_before(anchor: Column, c: Column) -> Column:
    """Days by which ``c`` lies before ``anchor``; NULL when either is unreadable."""
    return F.datediff(parse_date(anchor), parse_date(c))


def later_of(current: Column, other: Column) -> Column:
    """The later text date; ``current`` wins when the two cannot be compared."""
    return F.when(parse_date(current) < parse_date(other), other).otherwise(current)


def earlier_of(current: Column, other: Column) -> Column:
    """The earlier text date; ``current`` wins when the two cannot be compared."""
    return F.when(parse_date(other) <= parse_date(current), other).otherwise(current)


def load_stamp(zone: str = "America/New_York") -> Column:
    """Load time of the running query in the network's zone, to the second."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(F.from_utc_timestamp(utc, zone), "yyyy-MM-dd HH:mm:ss")
