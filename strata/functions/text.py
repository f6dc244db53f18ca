"""String expressions with Python's semantics, kept JVM-side (no Python UDF)."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() set: every code point whose str.isspace() is true (built by rule).
WHITESPACE: str = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())

# Runs of cased characters and runs of everything else. Python's str.title() gives the
# first character of each cased run its titlecase form and lower-cases the rest. "Cased"
# is Unicode's derived property (Uppercase, Lowercase or Titlecase), which also covers
# modifier letters and Roman numerals, in Java regex syntax.
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"
TITLE_RUNS = f"([{_CASED}]+|[^{_CASED}]+)"

_MAX_LEN = 2**31 - 1


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """``str.strip()``: trims every Unicode whitespace character, not just spaces."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


# Values made only of these characters are title-cased exactly by initcap (words split on
# spaces only, and a space is the only non-letter present).
_SIMPLE_ALPHABET = string.ascii_letters + " "


def title_case(c: str | Column) -> Column:
    """``str.title()`` with built-in expressions. Plain ASCII words take ``initcap``
    (whole-stage codegen); any other value is split into cased / uncased runs, and each
    run gets its first character in titlecase and the rest lower-cased.

    For a column name the expression is handed to Spark as SQL text - one call instead
    of hundreds of small API calls per column, which matters when many columns are
    cased. A Column object is built through the Column API with the same rules."""
    if isinstance(c, str):
        return F.expr(title_case_sql("`" + c.replace("`", "``") + "`"))
    simple = F.translate(c, _SIMPLE_ALPHABET, "") == F.lit("")
    return F.when(simple, F.initcap(c)).otherwise(title_case_runs(c))


def title_case_sql(x: str) -> str:
    """SQL text of :func:`title_case` for the SQL expression ``x``."""
    cased = _CASED  # used in raw (r'...') literals: backslashes pass through as they are
    up, ic = "upper(substring(r, 1, 1))", "initcap(substring(r, 1, 1))"
    head = f"regexp_extract({up}, r'^[^{cased}]*[{cased}]?', 0)"
    first = (
        f"CASE WHEN ascii(substring(r, 1, 1)) < 128 THEN {up} "
        f"WHEN length({up}) = 1 THEN CASE WHEN length({ic}) = 1 THEN {ic} ELSE {up} END "
        f"WHEN lower({ic}) != {ic} THEN {ic} "
        f"ELSE concat({head}, lower(substring({up}, length({head}) + 1))) END"
    )
    rest = "substring(lower(r), length(lower(substring(r, 1, 1))) + 1)"
    runs = f"regexp_extract_all({x}, r'([{cased}]+|[^{cased}]+)', 0)"
    return (
        f"CASE WHEN translate({x}, '{_SIMPLE_ALPHABET}', '') = '' THEN initcap({x}) "
        f"ELSE array_join(transform({runs}, r -> concat({first}, {rest})), '') END"
    )


def title_case_runs(c: str | Column) -> Column:
    """The general form of :func:`title_case` (any Unicode text)."""
    runs = F.regexp_extract_all(_col(c), F.lit(TITLE_RUNS), 0)
    fixed = F.transform(runs, _title_run)
    return F.array_join(fixed, "")


def _title_run(r: Column) -> Column:
    """First character in titlecase, the rest lower-cased in the context of the whole run
    (so a closing capital sigma becomes the final form)."""
    first = F.substring(r, 1, 1)
    low = F.lower(r)
    rest = F.substring(low, F.length(F.lower(first)) + F.lit(1), F.lit(_MAX_LEN))
    return F.concat(_title_char(first), rest)


def _title_char(ch: Column) -> Column:
    """Titlecase form of one character, as Python's str.title() gives it.

    * ASCII: the upper case.
    * One-character upper case: ``initcap`` maps it (the digraph dz becomes Dz, not DZ),
      unless that grows the text (dotted capital I), then the upper case is kept.
    * Several-character upper case (sharp s, ligatures, n with apostrophe): a
      single-character titlecase form wins when one exists (Greek with iota subscript);
      otherwise the upper case is kept up to its first cased character and the rest is
      lower-cased (sharp s -> Ss, n with apostrophe -> 'N)."""
    ic, up = F.initcap(ch), F.upper(ch)
    head = F.regexp_extract(up, f"^[^{_CASED}]*[{_CASED}]?", 0)
    multi = F.concat(head, F.lower(F.substring(up, F.length(head) + F.lit(1), F.lit(_MAX_LEN))))
    return (
        F.when(F.ascii(ch) < F.lit(128), up)
        .when(F.length(up) == F.lit(1), F.when(F.length(ic) == F.lit(1), ic).otherwise(up))
        .when(F.lower(ic) != ic, ic)
        .otherwise(multi)
    )


def capitalize_first(c: str | Column) -> Column:
    """Upper-case the first character and leave the rest as it is."""
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, _MAX_LEN))


def flag(c: str | Column, positive: str = "yes", trim: bool = False) -> Column:
    """1 when the lower-cased value equals ``positive``, else 0 (null counts as 0)."""
    v = _col(c)
    if trim:
        v = py_strip(v)
    return F.when(F.lower(v) == F.lit(positive.lower()), F.lit(1)).otherwise(F.lit(0))


def is_missing(c: str | Column, words: Iterable[str]) -> Column:
    """Null, or exactly one of the missing-value words."""
    c = _col(c)
    words = list(words)
    return c.isNull() | c.isin(words) if words else c.isNull()


def is_present(c: str | Column, words: Iterable[str]) -> Column:
    """Not null and none of the missing-value words (null-free boolean)."""
    c = _col(c)
    words = list(words)
    return c.isNotNull() & ~c.isin(words) if words else c.isNotNull()


_SPLIT = float(2**27 + 1)


def fixed_text(c: str | Column, decimals: int = 2) -> Column:
    """A number as fixed-point text, e.g. 0.25 -> '0.25', rounded from the exact binary value
    and half to even, as Python and C print it: 0.125 -> '0.12', 2.675 -> '2.67'.

    ``x * 10**decimals`` is taken as a double and its rounding error, which is exact when x is
    split into halves of 26 bits; the pair is compared with the half-way point. Built-in
    arithmetic on doubles only. From 2**52 / 10**decimals on, Spark's own text is used."""
    if not 0 <= decimals <= 8:
        raise ValueError("decimals must be between 0 and 8")
    v, k = _col(c).cast("double"), float(10**decimals)
    x = F.abs(v)
    high = x * F.lit(_SPLIT) - (x * F.lit(_SPLIT) - x)
    near = x * F.lit(k)
    off = (high * F.lit(k) - near) + (x - high) * F.lit(k)  # x * k == near + off, exactly
    low = F.floor(near).cast("double")
    past = (near - low - F.lit(0.5)) + off  # its sign is exact
    odd = F.pmod(low, F.lit(2.0)) == F.lit(1.0)
    units = (low + F.when((past > 0) | ((past == 0) & odd), F.lit(1.0)).otherwise(F.lit(0.0))).cast("bigint")
    digits = F.lpad(units.cast("string"), F.greatest(F.length(units.cast("string")), F.lit(decimals + 1)), F.lit("0"))
    text = F.concat(
        F.when((v < 0) | (v.cast("string") == "-0.0"), F.lit("-")).otherwise(F.lit("")),
        F.substring(digits, F.lit(1), F.length(digits) - decimals),
        *([F.lit("."), F.right(digits, F.lit(decimals))] if decimals else []),
    )
    return F.when(x < F.lit(2.0**52 / k), text).when(v.isNotNull(), F.format_string(f"%.{decimals}f", v))


def percent_text(c: str | Column, decimals: int = 2) -> Column:
    """A share as percent text, e.g. 0.25 -> '25.00%'."""
    return F.concat(fixed_text(_col(c) * F.lit(100.0), decimals), F.lit("%"))
