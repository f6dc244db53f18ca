"""Answer the same questions through the DataFrame, SQL and RDD faces; check that they
agree and time them under equal conditions (each forced with the ``noop`` sink)."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import serve
from strata.plans import rdd_face, sql_face
from strata.schemas import TARGET

# --- fixed values: the reference's five questions as (group/key, value/flag) -----------
QUESTIONS: dict[str, tuple[str, str]] = {
    "A": ("*factors*", TARGET),
    "B": ("Country", "IncreasingStress"),
    "C": ("", "IncreasingStress"),
    "D": ("Country", "MentalHealthHistory"),
    "E": ("Occupation", "SelfEmployed"),
}

FACES = ("dataframe", "sql", "rdd")


def faces(spark: SparkSession, gold: DataFrame, view: str = "survey_gold") -> dict[str, dict[str, Callable[[], DataFrame]]]:
    """question -> face -> a builder of that face's answer (same columns in every face)."""
    gold.createOrReplaceTempView(view)
    return {
        "A": {
            "dataframe": lambda: serve.top_category(gold),
            "sql": lambda: spark.sql(sql_face.top_category_sql(view)),
            "rdd": lambda: rdd_face.top_category_rdd(spark, gold),
        },
        "B": {
            "dataframe": lambda: serve.share_within(gold, "Country", "IncreasingStress", sort=False),
            "sql": lambda: spark.sql(sql_face.share_within_sql(view, "Country", "IncreasingStress")),
            "rdd": lambda: rdd_face.share_within_rdd(spark, gold, "Country", "IncreasingStress"),
        },
        "C": {
            "dataframe": lambda: serve.share_global(gold, "IncreasingStress"),
            "sql": lambda: spark.sql(sql_face.share_global_sql(view, "IncreasingStress")),
            "rdd": lambda: rdd_face.share_global_rdd(spark, gold, "IncreasingStress"),
        },
        "D": {
            "dataframe": lambda: serve.rate_by_group(gold, "Country", "MentalHealthHistory"),
            "sql": lambda: spark.sql(sql_face.rate_by_group_sql(view, "Country", "MentalHealthHistory")),
            "rdd": lambda: rdd_face.rate_by_group_rdd(spark, gold, "Country", "MentalHealthHistory"),
        },
        "E": {
            "dataframe": lambda: serve.rate_by_group(gold, "Occupation", "SelfEmployed", drop_null_key=True),
            "sql": lambda: spark.sql(
                sql_face.rate_by_group_sql(view, "Occupation", "SelfEmployed", drop_null_key=True)),
            "rdd": lambda: rdd_face.rate_by_group_rdd(spark, gold, "Occupation", "SelfEmployed",
                                                      drop_null_key=True),
        },
    }


def _aligned(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields])


def signed_rows(base: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """Distinct rows of all answers, each with how many copies more (positive) or fewer
    (negative) ``base`` has than each other answer, in a column ``_w_<name>`` per answer.

    A signed multiset union: every answer is planned once and enters one union, ``base`` with
    +1 in every weight and another answer with -1 in its own; one aggregate over all columns,
    partial in each task, adds the weights."""
    weights = [f"_w_{n}" for n in others]
    tagged = [base.select("*", *[F.lit(1).alias(w) for w in weights])]
    for name, df in others.items():
        tagged.append(_aligned(df, base).select("*", *[F.lit(-1 if w == f"_w_{name}" else 0).alias(w) for w in weights]))
    return reduce(DataFrame.unionAll, tagged).groupBy(*base.columns).agg(*[F.sum(w).alias(w) for w in weights])


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that two answers hold in unequal numbers, with ``surplus``: copies in ``a`` less
    copies in ``b``."""
    rows = signed_rows(a, {"b": b}).filter(F.col("_w_b") != 0)
    return rows.select(*a.columns, F.col("_w_b").alias("surplus"))


def mismatches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one answer and not the other, both ways, multiset-exact (one-row count)."""
    return differing_rows(a, b).agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("mismatches"))


def compare_faces(question: str, answers: dict[str, DataFrame], base: str = "dataframe") -> DataFrame:
    """(question, face, mismatches) of every face but ``base`` against it."""
    others = {n: df for n, df in answers.items() if n != base}
    wrong = signed_rows(answers[base], others).agg(
        F.array(*[F.struct(F.lit(n).alias("face"), F.coalesce(F.sum(F.abs(f"_w_{n}")), F.lit(0)).alias("mismatches")) for n in others]).alias("f"))
    return wrong.select(F.lit(question).alias("question"), F.inline("f"))


def faces_agree(spark: SparkSession, gold: DataFrame, view: str = "survey_gold") -> DataFrame:
    """One row per (question, face): mismatching rows against the DataFrame face (0 = agree)."""
    built = faces(spark, gold, view)
    return reduce(DataFrame.unionAll, [compare_faces(q, {f: build() for f, build in by_face.items()}) for q, by_face in built.items()])


def time_faces(spark: SparkSession, gold: DataFrame, view: str = "survey_gold") -> list[dict]:
    """Wall time of each (question, face), every face forced to completion with ``noop``."""
    out = []
    for question, by_face in faces(spark, gold, view).items():
        for face, build in by_face.items():
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            out.append({"question": question, "face": face, "seconds": time.perf_counter() - t0})
    return out
