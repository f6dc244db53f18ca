import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.text import (
    WHITESPACE, capitalize_first, fixed_text, flag, percent_text, py_strip, title_case,
)

SAMPLES = ["self-employed", "don't know", "1-14 days", "a1b c_d", "éCOLE ünï", "MAYBE",
           "go out every day", "line one\nline two", "", "x", "ÀÉÎ õü", "hello   world", "o'neil mc-DONALD"]


def _one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def _by_name(spark, values, expr):
    """Same, passing the column by name (title_case then goes through SQL text)."""
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr("v")).collect()]


def test_title_case_matches_python(spark):
    assert _one(spark, SAMPLES, title_case) == [s.title() for s in SAMPLES]
    assert _by_name(spark, SAMPLES, title_case) == [s.title() for s in SAMPLES]


def test_title_case_null(spark):
    assert _one(spark, [None], title_case) == [None]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=string.ascii_letters + string.digits + " -'_.,/éüÇ", max_size=12),
                min_size=1, max_size=10))
def test_title_case_property(spark, values):
    assert _one(spark, values, title_case) == [v.title() for v in values]


def test_title_case_idempotent(spark):
    once = _one(spark, SAMPLES, title_case)
    assert _one(spark, once, title_case) == once


def test_strip_matches_python(spark):
    values = ["  a b  ", "\t\n x \r\x0b\x0c", "　y ", " z ", "", "   "]
    assert _one(spark, values, py_strip) == [v.strip() for v in values]
    assert all(c.isspace() for c in WHITESPACE)


def test_capitalize_first(spark):
    assert _one(spark, ["abc DEF", "x", "", None], capitalize_first) == ["Abc DEF", "X", "", None]


def test_flag_null_and_case(spark):
    assert _one(spark, ["yes", "YES", "Yes ", " yes", None, "no"], flag) == [1, 1, 0, 0, 0, 0]
    trimmed = _one(spark, ["Yes ", " yes", None], lambda c: flag(c, trim=True))
    assert trimmed == [1, 1, 0]


def test_text_formats(spark):
    df = spark.createDataFrame([(0.25,), (1.0,), (0.0,), (1 / 3,)], "p double")
    got = [tuple(r) for r in df.select(percent_text("p"), fixed_text("p")).collect()]
    assert got == [("25.00%", "0.25"), ("100.00%", "1.00"), ("0.00%", "0.00"), ("33.33%", "0.33")]


# Letters, digraphs, ligatures, Greek with iota subscript, final sigma, modifier letters,
# Roman numerals, combining marks, CJK, digits and punctuation. (U+019B is left out: its
# upper case exists only in newer Unicode tables than Python's.)
_UNICODE = ("abcXYZ éÜßǄǅǆǱǳﬁﬂŉǰᾳᾼΣσςΑΒγδʰʲªºⅰⅠİıſ̅̀丕ぞ١²_-'’.,0123456789 ")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=_UNICODE, min_size=1, max_size=10), min_size=5, max_size=30))
def test_title_case_unicode_property(spark, values):
    want = [v.title() for v in values]
    assert _one(spark, values, title_case) == want
    assert _by_name(spark, values, title_case) == want
