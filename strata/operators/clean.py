"""Silver -> Gold cleaning rules, each a named, selectable policy.

Every rule is a projection or a filter over the whole row, so the cleaning plan is one
narrow stage (scan -> filter -> project) with no shuffle; only ``dedup`` shuffles, and it
aggregates map-side first so a heavily duplicated row collapses before the exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import capitalize_first, is_missing, is_present, title_case
from strata.schemas import (
    MERGED,
    META_COLUMNS,
    NULL_WORDS,
    PAIR,
    PANDAS_NULL_WORDS,
    SURVEY_COLUMNS,
)
from strata.session import scratch_path

NULL_RULES: dict[str, list[str]] = {"reference": NULL_WORDS, "pandas": PANDAS_NULL_WORDS, "none": []}
CASE_RULES = ("title", "first", "none")
MERGE_POLICIES = ("null_on_mismatch", "keep_pair", "whole_table", "whole_table_in_plan", "none")


def _words(nulls: str | Iterable[str]) -> list[str]:
    return NULL_RULES[nulls] if isinstance(nulls, str) else list(nulls)


def _survey_cols(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    return [c for c in df.columns if c not in META_COLUMNS]


def _all(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def row_is_complete(df: DataFrame, columns: Sequence[str] | None = None, nulls="reference") -> Column:
    """One predicate: every column present (not null, not a missing word)."""
    words = _words(nulls)
    return _all([is_present(c, words) for c in _survey_cols(df, columns)])


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None, nulls="reference") -> DataFrame:
    """Drop rows with any missing value, as ONE combined predicate (a chain of per-column
    filters over an unmaterialised parse can blow up the planner)."""
    return df.filter(row_is_complete(df, columns, nulls))


def normalize_missing(df: DataFrame, columns: Sequence[str] | None = None, nulls="reference") -> DataFrame:
    """Rewrite missing words to null instead of dropping the row."""
    words = _words(nulls)
    cols = set(_survey_cols(df, columns))
    return df.select(
        *[
            (F.when(is_missing(c, words), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
             if c in cols else F.col(c))
            for c in df.columns
        ]
    )


def string_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns of string type (by the type object, not its printed name)."""
    wanted = set(_survey_cols(df, columns))
    return [f.name for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, T.StringType)]


def apply_case(df: DataFrame, rule: str = "title", columns: Sequence[str] | None = None) -> DataFrame:
    """Standardise capitalisation of every string column: ``title`` (Python ``str.title``),
    ``first`` (upper-case the first character only) or ``none``."""
    if rule not in CASE_RULES:
        raise ValueError(f"case rule must be one of {CASE_RULES}")
    if rule == "none":
        return df
    fn = title_case if rule == "title" else capitalize_first
    targets = set(string_columns(df, columns))
    return df.select(*[fn(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def merge_pair(
    df: DataFrame,
    first: str = PAIR[0],
    second: str = PAIR[1],
    merged: str = MERGED,
    policy: str = "null_on_mismatch",
) -> DataFrame:
    """Merge two columns that say the same thing.

    * ``null_on_mismatch``: ``merged`` = the value when equal, else null; pair dropped;
      ``merged`` goes last.
    * ``keep_pair``: row by row - equal rows get ``merged`` and a nulled pair, unequal rows
      keep the pair and a null ``merged``; the schema is fixed.
    * ``whole_table``: if the pair agrees on every row (null-safe), drop ``second`` and
      rename ``first`` in place; otherwise change nothing. The columns depend on the rows, so
      ``df`` is written once to the shared scratch folder and read back (``settled``).
    * ``whole_table_in_plan``: the same decision as a scalar subquery inside the plan, so
      nothing runs while it is built, and so with a fixed schema: if the pair agrees on every
      row all rows get ``merged`` and a nulled pair, else all keep the pair and a null
      ``merged``.
    * ``none``: leave the pair alone.
    """
    if policy not in MERGE_POLICIES:
        raise ValueError(f"merge policy must be one of {MERGE_POLICIES}")
    if policy == "none" or first not in df.columns or second not in df.columns:
        return df
    p, s = F.col(first), F.col(second)
    if policy == "null_on_mismatch":
        return df.withColumn(merged, F.when(p == s, p)).drop(first, second)
    if policy == "whole_table":
        return settled(df, scratch_path(df.sparkSession, "pair"), first, second, merged)
    if policy == "keep_pair":
        eq = F.coalesce(p == s, F.lit(False))
    else:
        eq = df.agg(F.coalesce(F.bool_and(p.eqNullSafe(s)), F.lit(True))).scalar()
    return df.select(
        *[
            F.when(eq, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
            if c in (first, second) else F.col(c)
            for c in df.columns
        ],
        F.when(eq, p).alias(merged),
    )


def settled(
    df: DataFrame, path: str, first: str = PAIR[0], second: str = PAIR[1], merged: str = MERGED
) -> DataFrame:
    """``df`` (with its pair) written to ``path`` as Parquet and read back in the layout that
    its rows call for: if the pair agrees on every row, ``second`` is gone and ``first`` is
    renamed in place, otherwise nothing changes. Whether it agrees is observed by the write
    itself, so ``df`` is computed once and never for the decision alone."""
    seen = Observation()
    agree = F.bool_and(F.col(first).eqNullSafe(F.col(second))).alias("agree")
    df.observe(seen, agree).write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if seen.get["agree"] is False:  # null: no rows, nothing disagrees
        return out
    return out.drop(second).withColumnRenamed(first, merged)


def drop_metadata(df: DataFrame, meta: Sequence[str] = META_COLUMNS) -> DataFrame:
    """Drop the metadata columns that exist (missing names are ignored)."""
    return df.drop(*[m for m in meta if m in df.columns])


def dedup(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Remove duplicate rows by the survey columns (metadata never part of the key)."""
    return df.dropDuplicates(_survey_cols(df, columns))


def clean(
    silver: DataFrame,
    nulls: str | Iterable[str] = "reference",
    case: str = "title",
    merge: str = "null_on_mismatch",
    dedup_rows: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Silver -> Gold: drop metadata, drop incomplete rows, standardise case, merge the
    pair, optionally remove duplicates. Defaults give the 16-column Gold schema."""
    cols = list(columns) if columns is not None else [c for c in SURVEY_COLUMNS if c in silver.columns]
    df = drop_metadata(silver)
    df = drop_missing(df, cols, nulls)
    df = apply_case(df, case, cols)
    df = merge_pair(df, policy=merge)
    if dedup_rows:
        df = dedup(df)
    return df


# The three rule sets the reference's cleaning faces apply, by face name.
FACE_RULES: dict[str, dict] = {
    "rdd": {"nulls": "reference", "case": "title", "merge": "keep_pair"},
    "spark_df": {"nulls": "reference", "case": "none", "merge": "null_on_mismatch"},
    "pandas": {"nulls": "pandas", "case": "title", "merge": "whole_table"},
}


def clean_counts(silver: DataFrame, nulls: str | Iterable[str] = "reference") -> DataFrame:
    """Rows in, dropped and kept by the missing-value rule, in one pass."""
    keep = row_is_complete(silver, [c for c in SURVEY_COLUMNS if c in silver.columns], nulls)
    return silver.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count(F.when(~keep, 1)).alias("rows_dropped"),
        F.count(F.when(keep, 1)).alias("rows_kept"),
    )
