"""Column expressions used by the operators. All are built-in Spark expressions."""

from strata.functions.text import (  # noqa: F401
    WHITESPACE,
    capitalize_first,
    flag,
    fixed_text,
    is_missing,
    is_present,
    percent_text,
    py_strip,
    title_case,
)
