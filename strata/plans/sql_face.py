"""The SQL face of the serving questions: SQL text over a named view.

Column names come from fixed lists and are back-quoted, never pasted raw. Ratios are cast
to double (``decimal=True`` gives the ``COUNT(*) * 1.0 / ...`` decimal form instead).
"""

from __future__ import annotations

from collections.abc import Sequence

from strata.schemas import FACTORS, TARGET


def q(name: str) -> str:
    """Back-quote an identifier."""
    return "`" + name.replace("`", "``") + "`"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _flag(col: str, positive: str = "yes") -> str:
    return f"CASE WHEN lower({q(col)}) = {_lit(positive.lower())} THEN 1 ELSE 0 END"


def _ratio(num: str, den: str, decimal: bool) -> str:
    return f"{num} * 1.0 / {den}" if decimal else f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"


def rate_by_factor_sql(view: str, factors: Sequence[str] = FACTORS, target: str = TARGET,
                       positive: str = "yes") -> str:
    cols = ", ".join(q(f) for f in factors)
    casts = ", ".join(f"CAST({q(f)} AS STRING) AS {q(f)}" for f in factors)
    return f"""
    SELECT factor, category, COUNT(*) AS n,
           CAST(SUM(hi) AS BIGINT) AS yes_count,
           {_ratio('SUM(hi)', 'COUNT(*)', False)} AS prop
    FROM (SELECT {_flag(target, positive)} AS hi, {casts} FROM {q(view)})
    UNPIVOT EXCLUDE NULLS (category FOR factor IN ({cols}))
    GROUP BY factor, category"""


def top_category_sql(view: str, factors: Sequence[str] = FACTORS, target: str = TARGET,
                     positive: str = "yes") -> str:
    return f"""
    SELECT factor, category, prop FROM (
      SELECT factor, category, prop,
             row_number() OVER (PARTITION BY factor ORDER BY prop DESC, category ASC) AS rk
      FROM ({rate_by_factor_sql(view, factors, target, positive)}))
    WHERE rk = 1"""


def top_category_one_factor_sql(view: str, factor: str, target: str = TARGET,
                                positive: str = "yes") -> str:
    return f"""
    SELECT {_lit(factor)} AS factor, CAST({q(factor)} AS STRING) AS category,
           AVG({_flag(target, positive)}) AS prop
    FROM {q(view)} WHERE {q(factor)} IS NOT NULL
    GROUP BY {q(factor)} ORDER BY prop DESC, category ASC LIMIT 1"""


def share_within_sql(view: str, group: str, value: str, decimal: bool = False) -> str:
    return f"""
    SELECT {q(group)}, {q(value)}, COUNT(*) AS count,
           {_ratio('COUNT(*)', f'SUM(COUNT(*)) OVER (PARTITION BY {q(group)})', decimal)} AS prop
    FROM {q(view)} GROUP BY {q(group)}, {q(value)} ORDER BY {q(group)}, {q(value)}"""


def share_global_sql(view: str, value: str, decimal: bool = False) -> str:
    # An aggregate inside a window over the grouped rows: the view is scanned once, and the
    # window's one task sees a row per distinct value.
    return f"""
    SELECT {q(value)}, COUNT(*) AS count,
           {_ratio('COUNT(*)', 'SUM(COUNT(*)) OVER ()', decimal)} AS prop
    FROM {q(view)} GROUP BY {q(value)}"""


def rate_by_group_sql(view: str, key: str, flag_col: str, positive: str = "yes",
                      drop_null_key: bool = False, decimal: bool = False) -> str:
    where = f"{q(flag_col)} IS NOT NULL" + (f" AND {q(key)} IS NOT NULL" if drop_null_key else "")
    s = f"SUM({_flag(flag_col, positive)})"
    return f"""
    SELECT {q(key)}, CAST({s} AS BIGINT) AS yes_count, COUNT(*) AS total_count,
           {_ratio(s, 'COUNT(*)', decimal)} AS prop
    FROM {q(view)} WHERE {where} GROUP BY {q(key)}"""
