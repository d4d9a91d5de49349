"""Property tests: Spark column functions vs a plain-Python model of the rules.

The model follows the original server's documented string functions:
``CHARINDEX`` is 1-based and 0 when absent, ``LEFT(s, n)`` takes n
characters, ``SUBSTRING(s, start, len)`` is 1-based, ``LEN`` ignores
trailing blanks.
"""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.functions import date_span_label, recode, split_first_word

NAMES = st.lists(st.text(alphabet="ab C", min_size=0, max_size=8) | st.none(), min_size=1, max_size=25)
CODES = st.lists(st.sampled_from(["1", "2", "3", "8", "22", "x", "", None]), min_size=1, max_size=25)
DAYS = st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2040, 12, 31)) | st.none(),
                min_size=1, max_size=25)
FAST = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def charindex(needle: str, hay: str) -> int:
    return hay.find(needle) + 1


def sql_len(s: str) -> int:
    return len(s.rstrip(" "))


def sql_substring(s: str, start: int, length: int) -> str:
    begin = max(start, 1)
    end = start + length          # exclusive, 1-based
    return s[begin - 1:max(end - 1, begin - 1)]


def model_split(name):
    if name is None:
        return None, None
    pos = charindex(" ", name + " ")
    return name[:pos - 1], sql_substring(name, pos + 1, sql_len(name))


@FAST
@given(NAMES)
def test_split_first_word_matches_model(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    first, rest = split_first_word("n")
    got = [tuple(r) for r in df.select(first, rest).collect()]
    assert got == [model_split(n) for n in names]


VERTICALS = {"1": "To Be Determined", "3": "Automotive", "22": "Wholesale"}


@FAST
@given(CODES)
def test_recode_matches_case_semantics(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [tuple(r) for r in df.select(
        recode("c", VERTICALS),
        recode("c", VERTICALS, null_codes=("8",)),
        recode("c", VERTICALS, default="null")).collect()]

    def case(c, nulls=(), default="pass"):
        if c is None:
            return None                # NULL matches no WHEN
        if c in VERTICALS:
            return VERTICALS[c]
        if c in nulls:
            return None
        return c if default == "pass" else None

    assert got == [(case(c), case(c, ("8",)), case(c, default="null")) for c in codes]


@FAST
@given(DAYS)
def test_date_span_label_matches_model(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(date_span_label("d", 2)).collect()]

    def model(d):
        if d is None:
            return None
        end = d + dt.timedelta(days=2)
        return f"{d.strftime('%B')} {d.day:02d}-{end.day:02d} {d.year:04d}"

    assert got == [model(d) for d in days]
