"""Declared schemas and the fixed names of the questionnaire data model.

Every schema is declared; nothing is inferred from data, so plans are stable and the
reader never samples files.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw JSON groups and their fields, in source order -------------------
RAW_GROUPS: dict[str, list[str]] = {
    "person": ["gender", "country", "occupation"],
    "status": [
        "self_employed", "family_history", "treatment", "mental_health_history",
        "increasing_stress", "mood_swings", "social_weakness_primary",
        "social_weakness_secondary", "coping_struggles", "mental_health_interview",
        "care_options",
    ],
    "lifestyle": ["days_indoors", "habits_change", "work_interest"],
}

# --- fixed values: Silver column names, one per raw field above, same order ------------
SURVEY_COLUMNS: list[str] = [
    "Gender", "Country", "Occupation",
    "SelfEmployed", "FamilyHistory", "Treatment", "MentalHealthHistory", "IncreasingStress",
    "MoodSwings", "SocialWeaknessPrimary", "SocialWeaknessSecondary", "CopingStruggles",
    "MentalHealthInterview", "CareOptions",
    "DaysIndoors", "HabitsChange", "WorkInterest",
]

# --- fixed values: metadata columns ------------------------------------------------------
SILVER_META: list[str] = ["_ingestion_timestamp", "_source", "_status"]
META_COLUMNS: list[str] = ["_ingestion_timestamp", "_source", "_status", "_raw_data"]

# --- fixed values: the pair of columns that say the same thing, and the merged name -----
PAIR: tuple[str, str] = ("SocialWeaknessPrimary", "SocialWeaknessSecondary")
MERGED: str = "SocialWeakness"

# --- fixed values: serving target and the 15 factors, in the reference's order ----------
TARGET: str = "IncreasingStress"
FACTORS: list[str] = [
    "Gender", "Country", "Occupation", "SelfEmployed", "FamilyHistory",
    "Treatment", "DaysIndoors", "HabitsChange", "MentalHealthHistory",
    "MoodSwings", "SocialWeakness", "CopingStruggles", "WorkInterest",
    "MentalHealthInterview", "CareOptions",
]

# --- fixed values: words that mean "missing" ---------------------------------------------
# The row-level rule of the reference: null, the empty string, or exactly NULL.
NULL_WORDS: list[str] = ["", "NULL"]
# pandas.read_csv's default NA words (pandas 2.x), for the pandas-face rule.
PANDAS_NULL_WORDS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: status tags of a Bronze record -----------------------------------------
VALID, PARSE_ERROR, SCHEMA_ERROR = "valid", "parse_error", "schema_error"
TOO_DEEP = "too_deep"  # ours: of the declared shape, but a field is nested too deep to be kept as text
SOURCE_JSONL = "jsonl"

# Column name <- raw path, built from the two tables above.
RAW_PATHS: list[tuple[str, str]] = list(
    zip(
        SURVEY_COLUMNS,
        [f"{g}.{f}" for g, fields in RAW_GROUPS.items() for f in fields],
    )
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField(g, T.StructType([T.StructField(f, T.StringType()) for f in fields]))
        for g, fields in RAW_GROUPS.items()
    ]
)

SILVER_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in SURVEY_COLUMNS]
    + [
        T.StructField("_ingestion_timestamp", T.DoubleType()),
        T.StructField("_source", T.StringType()),
        T.StructField("_status", T.StringType()),
    ]
)

GOLD_COLUMNS: list[str] = [c for c in SURVEY_COLUMNS if c not in PAIR] + [MERGED]
GOLD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in GOLD_COLUMNS])

BRONZE_SCHEMA = T.StructType(
    list(RAW_SCHEMA.fields)
    + [
        T.StructField("_raw_data", T.StringType()),
        T.StructField("_ingestion_timestamp", T.DoubleType()),
        T.StructField("_source", T.StringType()),
        T.StructField("_status", T.StringType()),
    ]
)
