"""

Every query reads the driver's tables: a questionnaire is derived from
orders x customer x nation (``strata.fixtures``), serialised to raw JSON lines with dirt,
and pushed through Bronze -> Silver -> Gold by the library. The oracle SQL computes the
same answers directly from the tables in DuckDB, reusing only the answer expressions
(``ANSWER_EXPRS``) and the rule that says which lines are malformed.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata import fixtures  # noqa: E402
from strata.functions.text import py_strip  # noqa: E402
from strata.operators import clean as C  # noqa: E402
from strata.operators import ingest as I  # noqa: E402
from strata.operators import serve as S  # noqa: E402
from strata.plans import compare, rdd_face, sql_face  # noqa: E402
from strata.plans.pipeline import read_gold_by_approach, run_gold_by_approach  # noqa: E402
from strata.schemas import (  # noqa: E402
    FACTORS,
    GOLD_COLUMNS,
    MERGED,
    NULL_WORDS,
    PAIR,
    PANDAS_NULL_WORDS,
    RAW_GROUPS,
    RAW_PATHS,
    SURVEY_COLUMNS,
)
from strata.session import scratch_path  # noqa: E402
from strata.sinks.writers import output_sizes, row_bytes, write_gold  # noqa: E402
from strata.sources.files import CSV_OPTIONS, read_gold, read_silver_csv  # noqa: E402
from strata.sources.jsonl import bronze, quarantine, read_lines  # noqa: E402

# The language-model operators and the pipeline are optional: without their folders every
# other query still works.
corpus_pipeline = llm_queries = None
if importlib.util.find_spec("strata.llm") and importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline  # noqa: E402
    from strata.llm import queries as llm_queries  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
VIEW = "survey_gold"
SILVER_OUT = SURVEY_COLUMNS + ["_source", "_status"]


# ----------------------------------------------------------------------------- helpers
def _raw(spark, sf):
    return fixtures.materialize(spark, sf)[0]


def _layers(spark, sf):
    return fixtures.materialize(spark, sf)[1]


def _bronze(spark, sf) -> DataFrame:
    return bronze(read_lines(spark, _raw(spark, sf)))


def _silver(spark, sf) -> DataFrame:
    """Silver as written (CSV), read back by the declared schema."""
    return read_silver_csv(spark, _layers(spark, sf).silver)


def _gold(spark, sf) -> DataFrame:
    """Default Gold as written (Parquet); every question is served from it."""
    return read_gold(spark, _layers(spark, sf).gold["parquet"], "parquet")


def _bronze_written(spark, sf) -> DataFrame:
    """Bronze as written (Parquet): the raw lines are parsed once, by the pipeline."""
    return spark.read.parquet(_layers(spark, sf).bronze)


def _answers(spark, sf) -> DataFrame:
    """The flat records of Bronze with missing-value words as nulls: keys and flags have gaps."""
    return C.normalize_missing(C.drop_metadata(I.flatten(_bronze_written(spark, sf))))


def _reversed_csv(spark, df, name) -> str:
    """``df`` written as CSV with its columns in reverse order."""
    out = scratch_path(spark, name)
    text = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    df.select(df.columns[::-1]).write.options(**text, quoteAll="true", ignoreLeadingWhiteSpace="false",
                                              ignoreTrailingWhiteSpace="false").csv(out)
    return out


def _silver_by_name(spark, sf) -> DataFrame:
    return read_silver_csv(spark, _reversed_csv(spark, _silver(spark, sf), "silver-reversed")).select(*SILVER_OUT)


def _gold_csv_by_name(spark, sf) -> DataFrame:
    return read_gold(spark, _reversed_csv(spark, _gold(spark, sf), "gold-reversed"), "csv")


# ----------------------------------------------------------------------------- entry
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: question A - for each factor, the category with the highest rate of
    IncreasingStress = yes, over Gold built from the sf0.001 tables."""
    return S.top_category(_gold(spark, SMOKE_DIR))


# ----------------------------------------------------------------------------- queries
def _raw_lines(spark, sf):
    lines = read_lines(spark, _raw(spark, sf))
    return lines.groupBy(
        (py_strip("value") == "").alias("blank"), F.col("value").contains("\r").alias("has_cr")
    ).agg(F.count(F.lit(1)).alias("n_lines"))


def _ingest_parse(spark, sf):
    b = _bronze(spark, sf)
    return b.select(
        *[F.col(path).alias(name) for name, path in RAW_PATHS],
        "_source", "_status", F.col("_raw_data").isNotNull().alias("raw_kept"),
    )


def _ingest_quarantine(spark, sf):
    return quarantine(_bronze_written(spark, sf)).groupBy("_status").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count("_raw_data").alias("n_with_text")
    )


def _top_one(spark, sf):
    return S.top_category_one_factor(_gold(spark, sf), "Country")


def _merge_whole_table(spark, sf):
    # The second answer is set to the first, so the whole table agrees and the pair collapses
    # into one column, renamed in place.
    df = C.drop_missing(C.drop_metadata(_silver(spark, sf)))
    return C.merge_pair(df.withColumn(PAIR[1], F.col(PAIR[0])), policy="whole_table")


def _merge_whole_table_mismatch(spark, sf):
    df = C.drop_missing(C.drop_metadata(_silver(spark, sf)))
    return C.merge_pair(df, policy="whole_table")


def _merge_in_plan(spark, sf, agree):
    df = C.drop_missing(C.drop_metadata(_silver(spark, sf)))
    if agree:
        df = df.withColumn(PAIR[1], F.col(PAIR[0]))
    return C.merge_pair(df, policy="whole_table_in_plan")


def _by_approach(spark, sf) -> DataFrame:
    """Gold of the three approaches, written to their folders and read back as one table."""
    root = scratch_path(spark, "gold-approaches")
    run_gold_by_approach(spark, _layers(spark, sf).silver, root, formats=("parquet",))
    return read_gold_by_approach(spark, root)


def _by_approach_pruned(spark, sf):
    one = _by_approach(spark, sf).filter("approach = 'spark_df'")
    return S.rate_by_group(one, "Country", "MentalHealthHistory").withColumn("approach", F.lit("spark_df"))


SMALL_TASK = 1 << 20  # text a task may write in the queries of the sinks


def _text_sink(spark, sf):
    """Gold as text in tasks of at most about SMALL_TASK bytes: rows read back, and whether no
    file is larger (a quarter is left for quoting, which the plan doesn't count)."""
    paths = write_gold(spark, _gold(spark, sf), scratch_path(spark, "gold-text"), ("csv", "json"), task_bytes=SMALL_TASK)
    parts = []
    for fmt, path in paths.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("length")
        rows = read_gold(spark, path, fmt).agg(F.count(F.lit(1)).alias("n_rows"))
        most = files.agg(F.max("length")).scalar()
        parts.append(rows.select(F.lit(fmt).alias("format"), "n_rows", (most <= SMALL_TASK * 5 // 4).alias("bounded")))
    return parts[0].unionAll(parts[1])


def _row_bytes(spark, sf):
    paths = _layers(spark, sf).gold
    return row_bytes(spark, {f: paths[f] for f in ("csv", "json")})


def _face_rules_difference(spark, sf):
    """A rate by the DataFrame rule against the RDD rule for a missing flag."""
    answers = _answers(spark, sf)
    rates = [S.rate_by_group(answers, "Occupation", "CareOptions", missing_flag=m, drop_null_key=True) for m in ("drop", "as_no")]
    return compare.differing_rows(*rates)


def _ingest_times(spark, sf):
    """The ingestion time of a batch: one value, set when it ran."""
    return _bronze_written(spark, sf).agg(
        F.countDistinct("_ingestion_timestamp").alias("n_times"),
        F.min(F.col("_ingestion_timestamp").between(1.6e9, F.unix_micros(F.current_timestamp()) / 1e6)).alias("in_past"),
        F.countDistinct("_source").alias("n_sources"))


def _share_map(spark, sf):
    m = S.share_map(_gold(spark, sf), "Country", "IncreasingStress")
    return m.select("Country", "total", F.explode("shares").alias("IncreasingStress", "prop"))


def _gold_faces_row_counts(spark, sf):
    """Rows and columns of Gold under each of the reference's three cleaning rule sets."""
    silver = _silver(spark, sf)
    parts = []
    for face, rules in C.FACE_RULES.items():
        g = C.clean(silver, **rules)
        parts.append(g.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(face).alias("face"), "n_rows", F.lit(len(g.columns)).cast("bigint").alias("n_columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _output_sizes(spark, sf):
    return output_sizes(spark, _layers(spark, sf).gold)


def _bronze_stream(spark, sf):
    from strata.streaming import start_bronze_stream

    out = scratch_path(spark, "bronze-stream")
    q = start_bronze_stream(spark, _raw(spark, sf), out)
    q.awaitTermination()
    return I.status_counts(spark.read.parquet(out))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = _queries()
    if llm_queries is not None:
        own |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return own


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # Bronze
        "raw_lines": _raw_lines,
        "ingest_parse": _ingest_parse,
        "ingest_status_counts": lambda s, d: I.status_counts(_bronze_written(s, d)),
        "ingest_quarantine": _ingest_quarantine,
        "ingest_quarantine_text": lambda s, d: quarantine(_bronze_written(s, d)).select("_status", "_raw_data"),
        "ingest_times": _ingest_times,
        "ingest_shape": lambda s, d: I.shape(I.flatten(_bronze_written(s, d))),
        "bronze_stream_status_counts": _bronze_stream,
        # Silver
        "silver_flatten": lambda s, d: I.flatten(_bronze(s, d)).select(*SILVER_OUT),
        "bronze_roundtrip": lambda s, d: I.flatten(s.read.parquet(_layers(s, d).bronze)).select(*SILVER_OUT),
        "silver_csv_scan": lambda s, d: _silver(s, d).select(*SILVER_OUT),
        "silver_csv_by_name": _silver_by_name,
        # cleaning rules
        "clean_drop_null": lambda s, d: C.drop_missing(C.drop_metadata(_silver(s, d))),
        "clean_drop_null_pandas": lambda s, d: C.drop_missing(C.drop_metadata(_silver(s, d)), nulls="pandas"),
        "normalize_missing": lambda s, d: C.normalize_missing(C.drop_metadata(I.flatten(_bronze_written(s, d)))),
        "clean_title_case": lambda s, d: C.apply_case(C.drop_missing(C.drop_metadata(_silver(s, d))), "title"),
        "clean_capitalize_first": lambda s, d: C.apply_case(
            C.drop_missing(C.drop_metadata(_silver(s, d))), "first"),
        "merge_keep_pair": lambda s, d: C.clean(_silver(s, d), merge="keep_pair"),
        "merge_null_on_mismatch": lambda s, d: C.merge_pair(
            C.drop_missing(C.drop_metadata(_silver(s, d))), policy="null_on_mismatch"),
        "merge_whole_table": _merge_whole_table,
        "merge_whole_table_mismatch": _merge_whole_table_mismatch,
        "merge_whole_table_in_plan": lambda s, d: _merge_in_plan(s, d, True),
        "merge_whole_table_in_plan_mismatch": lambda s, d: _merge_in_plan(s, d, False),
        "drop_metadata": lambda s, d: C.drop_metadata(_silver(s, d)),
        "clean_dedup": lambda s, d: C.clean(_silver(s, d), dedup_rows=True),
        "clean_row_counts": lambda s, d: C.clean_counts(_silver(s, d)),
        "silver_to_gold": lambda s, d: C.clean(_silver(s, d)),
        "silver_to_gold_pandas_rules": lambda s, d: C.clean(_silver(s, d), nulls="pandas", merge="whole_table"),
        "gold_faces_row_counts": _gold_faces_row_counts,
        # sinks
        "gold_roundtrip_parquet": lambda s, d: read_gold(s, _layers(s, d).gold["parquet"], "parquet"),
        "gold_roundtrip_csv": lambda s, d: read_gold(s, _layers(s, d).gold["csv"], "csv"),
        "gold_roundtrip_json": lambda s, d: read_gold(s, _layers(s, d).gold["json"], "json"),
        "gold_csv_by_name": _gold_csv_by_name,
        "gold_by_approach": _by_approach,
        "gold_by_approach_pruned": _by_approach_pruned,
        "text_sink_bounds": _text_sink,
        "output_sizes": _output_sizes,
        "output_row_bytes": _row_bytes,
        "sample_rows": lambda s, d: S.hash_sample(_gold(s, d), 0.1, seed=42),
        # serving
        "top_category_per_factor": lambda s, d: S.top_category(_gold(s, d)),
        "top_category_per_factor_sql": lambda s, d: _sql(s, d, sql_face.top_category_sql(VIEW)),
        "top_category_one_factor": _top_one,
        "rate_by_factor_category": lambda s, d: S.rate_by_factor(_gold(s, d)),
        "share_within_group": lambda s, d: S.share_within(_gold(s, d), "Country", "IncreasingStress"),
        "share_within_group_sql": lambda s, d: _sql(
            s, d, sql_face.share_within_sql(VIEW, "Country", "IncreasingStress")),
        "share_map_by_group": _share_map,
        "share_global": lambda s, d: S.share_global(_gold(s, d), "IncreasingStress"),
        "share_global_sql": lambda s, d: _sql(s, d, sql_face.share_global_sql(VIEW, "IncreasingStress")),
        "rate_by_group": lambda s, d: S.rate_by_group(_gold(s, d), "Country", "MentalHealthHistory"),
        "rate_by_group_sql": lambda s, d: _sql(
            s, d, sql_face.rate_by_group_sql(VIEW, "Country", "MentalHealthHistory")),
        "rate_by_group_two_filters": lambda s, d: S.rate_by_group(
            _gold(s, d), "Occupation", "SelfEmployed", drop_null_key=True),
        "rate_by_group_missing_as_no": lambda s, d: S.rate_by_group(
            I.flatten(_bronze_written(s, d)), "Occupation", "SelfEmployed", missing_flag="as_no", drop_null_key=True),
        "rate_by_group_missing_as_no_country": lambda s, d: S.rate_by_group(
            _answers(s, d), "Country", "MentalHealthHistory", trim=True, missing_flag="as_no", drop_null_key=True),
        "rate_by_group_null_key": lambda s, d: S.rate_by_group(
            _answers(s, d), "Occupation", "CareOptions", trim=True),
        "share_within_group_null_key": lambda s, d: S.share_within(
            _answers(s, d), "Occupation", "CareOptions"),
        "share_within_group_drop_null_key": lambda s, d: S.share_within(
            _answers(s, d), "Occupation", "CareOptions", drop_null_key=True),
        "share_global_drop_null": lambda s, d: S.share_global(
            _answers(s, d), "CareOptions", drop_null=True),
        "share_within_group_decimal_sql": lambda s, d: _sql(
            s, d, sql_face.share_within_sql(VIEW, "Country", "IncreasingStress", decimal=True)).withColumn(
                "prop", F.col("prop").cast("string")),
        "cached_answers": lambda s, d: S.cached_answers(_gold(s, d), scratch_path(s, "cached")),
        "one_scan_top_category": lambda s, d: S.answer_all(_gold(s, d))["A"],
        "one_scan_rate_by_factor": lambda s, d: S.answer_all(_gold(s, d))["A_rates"],
        "one_scan_share_within": lambda s, d: S.answer_all(_gold(s, d))["B"],
        "one_scan_share_global": lambda s, d: S.answer_all(_gold(s, d))["C"],
        "one_scan_rate_by_group": lambda s, d: S.answer_all(_gold(s, d))["D"],
        "one_scan_rate_by_group_two_filters": lambda s, d: S.answer_all(_gold(s, d))["E"],
        "rate_by_factor_category_sql": lambda s, d: _sql(s, d, sql_face.rate_by_factor_sql(VIEW)),
        "top_category_one_factor_sql": lambda s, d: _sql(
            s, d, sql_face.top_category_one_factor_sql(VIEW, "Country")),
        "rate_by_group_two_filters_sql": lambda s, d: _sql(
            s, d, sql_face.rate_by_group_sql(VIEW, "Occupation", "SelfEmployed", drop_null_key=True)),
        "top_category_per_factor_rdd": lambda s, d: rdd_face.top_category_rdd(s, _gold(s, d)),
        "share_within_group_rdd": lambda s, d: rdd_face.share_within_rdd(
            s, _gold(s, d), "Country", "IncreasingStress"),
        "share_global_rdd": lambda s, d: rdd_face.share_global_rdd(s, _gold(s, d), "IncreasingStress"),
        "rate_by_group_rdd": lambda s, d: rdd_face.rate_by_group_rdd(
            s, _gold(s, d), "Country", "MentalHealthHistory"),
        "rate_by_group_two_filters_rdd": lambda s, d: rdd_face.rate_by_group_rdd(
            s, _gold(s, d), "Occupation", "SelfEmployed", drop_null_key=True),
        "share_percent_text": lambda s, d: S.with_percent_text(
            S.share_within(_gold(s, d), "Country", "IncreasingStress")).drop("prop"),
        "distinct_values": lambda s, d: S.distinct_values(_gold(s, d), "Occupation"),
        "report_top_category": lambda s, d: S.report_top(S.top_category(_gold(s, d))),
        "report_share_global": lambda s, d: S.report_counts(
            S.share_global(_gold(s, d), "IncreasingStress"), "IncreasingStress"),
        "report_rate_by_group": lambda s, d: S.report_rates(
            S.rate_by_group(_gold(s, d), "Country", "MentalHealthHistory"), "Country"),
        "report_rate_by_group_two_filters": lambda s, d: S.report_rates(
            S.rate_by_group(_gold(s, d), "Occupation", "SelfEmployed", drop_null_key=True), "Occupation"),
        "faces_agree": lambda s, d: compare.faces_agree(s, _gold(s, d), VIEW),
        "face_rules_difference": _face_rules_difference,
    }


def _sql(spark, sf, text):
    _gold(spark, sf).createOrReplaceTempView(VIEW)
    return spark.sql(text)


# ----------------------------------------------------------------------------- oracle
# DuckDB's regex engine has general categories but not the Cased property; on the fixture's
# text (Latin letters, digits, punctuation) the two classes pick the same runs.
TITLE_RUNS_RE2 = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def _t(x: str) -> str:
    """DuckDB form of Python's str.title() (cased / uncased runs)."""
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '{TITLE_RUNS_RE2}', 0), "
        "lambda r: upper(substring(r, 1, 1)) || lower(substring(r, 2))), '')"
    )


def _words(ws) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ws)


def _complete(ws) -> str:
    return " AND ".join(f"({c} IS NOT NULL AND {c} NOT IN ({_words(ws)}))" for c in SURVEY_COLUMNS)


_BASE = (
    "q AS (" + fixtures.questionnaire_sql() + "),\n"
    "silver AS (SELECT "
    + ", ".join(f"CASE WHEN expected_status = 'valid' THEN {c} END AS {c}" for c in SURVEY_COLUMNS)
    + ", 'jsonl' AS _source, expected_status AS _status FROM q WHERE line_kind <> 'blank'),\n"
    # Silver as read back from CSV: the empty string comes back as null.
    "silver_csv AS (SELECT "
    + ", ".join(f"CASE WHEN {c} = '' THEN NULL ELSE {c} END AS {c}" for c in SURVEY_COLUMNS)
    + ", _source, _status FROM silver),\n"
    "complete AS (SELECT " + ", ".join(SURVEY_COLUMNS) + f" FROM silver_csv WHERE {_complete(NULL_WORDS)}),\n"
    "titled AS (SELECT " + ", ".join(f"{_t(c)} AS {c}" for c in SURVEY_COLUMNS) + " FROM complete),\n"
    "gold AS (SELECT " + ", ".join(c for c in GOLD_COLUMNS if c != MERGED)
    + f", CASE WHEN {PAIR[0]} = {PAIR[1]} THEN {PAIR[0]} END AS {MERGED} FROM titled)\n"
)


def _with(body: str) -> str:
    return "WITH " + _BASE + body


def _ratio(n, d):
    return f"CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE)"


def _flag(c):
    return f"CASE WHEN lower({c}) = 'yes' THEN 1 ELSE 0 END"


def _rate_by_factor_sql() -> str:
    parts = [
        f"SELECT '{f}' AS factor, {f} AS category, {_flag('IncreasingStress')} AS hi FROM gold "
        f"WHERE {f} IS NOT NULL"
        for f in FACTORS
    ]
    return (
        "SELECT factor, category, COUNT(*) AS n, CAST(SUM(hi) AS BIGINT) AS yes_count, "
        f"{_ratio('SUM(hi)', 'COUNT(*)')} AS prop FROM (" + " UNION ALL ".join(parts) + ") u "
        "GROUP BY factor, category"
    )


_TOP = (
    "SELECT factor, category, prop FROM (SELECT factor, category, prop, row_number() OVER "
    "(PARTITION BY factor ORDER BY prop DESC, category ASC) AS rk FROM (" + _rate_by_factor_sql()
    + ") r) t WHERE rk = 1"
)
_SHARE_WITHIN = (
    "SELECT Country, IncreasingStress, COUNT(*) AS count, "
    + _ratio("COUNT(*)", "SUM(COUNT(*)) OVER (PARTITION BY Country)")
    + " AS prop FROM gold GROUP BY Country, IncreasingStress"
)
_SHARE_GLOBAL = (
    "SELECT IncreasingStress, COUNT(*) AS count, "
    + _ratio("COUNT(*)", "(SELECT COUNT(*) FROM gold)") + " AS prop FROM gold GROUP BY IncreasingStress"
)


def _rate_by_group(key, flag, src="gold", extra=""):
    return (
        f"SELECT {key}, CAST(SUM({_flag(flag)}) AS BIGINT) AS yes_count, COUNT(*) AS total_count, "
        f"{_ratio(f'SUM({_flag(flag)})', 'COUNT(*)')} AS prop FROM {src} "
        f"WHERE {flag} IS NOT NULL {extra} GROUP BY {key}"
    )


# The raw text of a line that is not valid, put together from the answers: groups of the fields
# that are not null, as JSON.
def _json_groups() -> str:
    names, groups = iter(SURVEY_COLUMNS), []
    for g, fields in RAW_GROUPS.items():
        parts = ", ".join(f"'\"{f}\":' || CAST(to_json({next(names)}) AS VARCHAR)" for f in fields)
        groups.append(f"'\"{g}\":{{' || concat_ws(',', {parts}) || '}}'")
    return "'{' || " + " || ',' || ".join(groups) + " || '}'"


_RAW_TEXT = (
    "CASE line_kind WHEN 'trailing_brace' THEN j || '}' WHEN 'single_quotes' THEN replace(j, '\"', chr(39)) "
    "WHEN 'array' THEN '[' || j || ']' WHEN 'group_not_object' THEN '{\"person\":[' || CAST(to_json(Country) AS VARCHAR) || ']}' "
    "ELSE j END"
)


def _csv_cell(c: str) -> str:
    quoted = f"regexp_matches({c}, '[,\"\n\r]')"
    return f"CASE WHEN {c} IS NULL THEN 0 WHEN {quoted} THEN strlen(replace({c}, '\"', '\"\"')) + 2 ELSE strlen({c}) END"


def _json_cell(c: str) -> str:
    return f"{len(c) + 4} + CASE WHEN {c} IS NULL THEN 4 ELSE strlen(CAST(to_json({c}) AS VARCHAR)) END"


def _share(src: str, where: str = "") -> str:
    return (
        "SELECT Occupation, CareOptions, COUNT(*) AS count, "
        + _ratio("COUNT(*)", "SUM(COUNT(*)) OVER (PARTITION BY Occupation)") + f" AS prop FROM {src} {where} GROUP BY Occupation, CareOptions"
    )


_ANSWERS = "(SELECT " + ", ".join(
    f"CASE WHEN {c} IN ({_words(NULL_WORDS)}) THEN NULL ELSE {c} END AS {c}" for c in SURVEY_COLUMNS) + " FROM silver) n"
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _trimmed_rate(key: str, flag: str, where: str) -> str:
    yes = f"CASE WHEN lower(trim({flag}, {_STRIP})) = 'yes' THEN 1 ELSE 0 END"
    return (
        f"SELECT {key}, CAST(SUM({yes}) AS BIGINT) AS yes_count, COUNT(*) AS total_count, "
        f"{_ratio(f'SUM({yes})', 'COUNT(*)')} AS prop FROM {_ANSWERS} WHERE {where} GROUP BY {key}"
    )


_SILVER_OUT = ", ".join(SILVER_OUT)
_SURVEY = ", ".join(SURVEY_COLUMNS)
_GOLD = ", ".join(GOLD_COLUMNS)
_NO_PAIR = ", ".join(c for c in SURVEY_COLUMNS if c not in PAIR)


def oracle_sql() -> dict[str, str]:
    own = _oracle_sql()
    if llm_queries is not None:
        own |= llm_queries.ORACLE
        if corpus_pipeline.ORACLE_SQL:
            own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own


def _oracle_sql() -> dict[str, str]:
    faces = ", ".join(f"('{q}', '{f}', CAST(0 AS BIGINT))" for q in compare.QUESTIONS for f in ("sql", "rdd"))
    keep_pair_cols = ", ".join(
        f"CASE WHEN {PAIR[0]} = {PAIR[1]} THEN NULL ELSE {c} END AS {c}" if c in PAIR else c
        for c in SURVEY_COLUMNS
    )
    return {
        "raw_lines": (
            "SELECT line_kind = 'blank' AS blank, line_kind = 'cr_inside' AS has_cr, COUNT(*) AS n_lines "
            f"FROM ({fixtures.questionnaire_sql()}) q GROUP BY 1, 2"
        ),
        "ingest_parse": _with(f"SELECT {_SILVER_OUT}, _status <> 'valid' AS raw_kept FROM silver"),
        "ingest_status_counts": _with("SELECT _status, COUNT(*) AS n_records FROM silver GROUP BY _status"),
        "ingest_quarantine": _with(
            "SELECT _status, COUNT(*) AS n_lines, COUNT(*) AS n_with_text FROM silver "
            "WHERE _status <> 'valid' GROUP BY _status"
        ),
        "ingest_shape": _with("SELECT COUNT(*) AS n_rows, CAST(20 AS BIGINT) AS n_columns FROM silver"),
        "bronze_stream_status_counts": _with(
            "SELECT _status, COUNT(*) AS n_records FROM silver GROUP BY _status"),
        "silver_flatten": _with(f"SELECT {_SILVER_OUT} FROM silver"),
        "bronze_roundtrip": _with(f"SELECT {_SILVER_OUT} FROM silver"),
        "silver_csv_scan": _with(f"SELECT {_SILVER_OUT} FROM silver_csv"),
        "silver_csv_by_name": _with(f"SELECT {_SILVER_OUT} FROM silver_csv"),
        "clean_drop_null": _with(f"SELECT {_SURVEY} FROM complete"),
        "clean_drop_null_pandas": _with(
            f"SELECT {_SURVEY} FROM silver_csv WHERE {_complete(PANDAS_NULL_WORDS)}"),
        "normalize_missing": _with(
            "SELECT " + ", ".join(
                f"CASE WHEN {c} IN ({_words(NULL_WORDS)}) THEN NULL ELSE {c} END AS {c}" for c in SURVEY_COLUMNS
            ) + " FROM silver"
        ),
        "clean_title_case": _with(f"SELECT {_SURVEY} FROM titled"),
        "clean_capitalize_first": _with(
            "SELECT " + ", ".join(f"upper(substring({c}, 1, 1)) || substring({c}, 2) AS {c}"
                                  for c in SURVEY_COLUMNS) + " FROM complete"
        ),
        "merge_keep_pair": _with(
            f"SELECT {keep_pair_cols}, CASE WHEN {PAIR[0]} = {PAIR[1]} THEN {PAIR[0]} END AS {MERGED} FROM titled"
        ),
        "merge_null_on_mismatch": _with(
            f"SELECT {_NO_PAIR}, CASE WHEN {PAIR[0]} = {PAIR[1]} THEN {PAIR[0]} END AS {MERGED} FROM complete"
        ),
        "merge_whole_table": _with(
            "SELECT " + ", ".join(f"{PAIR[0]} AS {MERGED}" if c == PAIR[0] else c
                                  for c in SURVEY_COLUMNS if c != PAIR[1])
            + " FROM complete"
        ),
        "merge_whole_table_mismatch": _with(f"SELECT {_SURVEY} FROM complete"),
        "drop_metadata": _with(f"SELECT {_SURVEY} FROM silver_csv"),
        "clean_dedup": _with(f"SELECT DISTINCT {_GOLD} FROM gold"),
        "clean_row_counts": _with(
            "SELECT COUNT(*) AS rows_in, "
            f"COUNT(*) - (SELECT COUNT(*) FROM complete) AS rows_dropped, "
            "(SELECT COUNT(*) FROM complete) AS rows_kept FROM silver_csv"
        ),
        "silver_to_gold": _with(f"SELECT {_GOLD} FROM gold"),
        "silver_to_gold_pandas_rules": _with(
            "SELECT " + ", ".join(f"{_t(c)} AS {c}" for c in SURVEY_COLUMNS)
            + f" FROM silver_csv WHERE {_complete(PANDAS_NULL_WORDS)}"
        ),
        "gold_faces_row_counts": _with(
            "SELECT 'rdd' AS face, (SELECT COUNT(*) FROM complete) AS n_rows, CAST(18 AS BIGINT) AS n_columns "
            "UNION ALL SELECT 'spark_df', (SELECT COUNT(*) FROM complete), CAST(16 AS BIGINT) "
            "UNION ALL SELECT 'pandas', (SELECT COUNT(*) FROM silver_csv WHERE "
            + _complete(PANDAS_NULL_WORDS) + "), CAST(17 AS BIGINT)"
        ),
        "gold_roundtrip_parquet": _with(f"SELECT {_GOLD} FROM gold"),
        "gold_roundtrip_csv": _with(f"SELECT {_GOLD} FROM gold"),
        "gold_roundtrip_json": _with(f"SELECT {_GOLD} FROM gold"),
        "top_category_per_factor": _with(_TOP),
        "top_category_per_factor_sql": _with(_TOP),
        "top_category_one_factor": _with(
            "SELECT 'Country' AS factor, Country AS category, AVG(" + _flag("IncreasingStress")
            + ") AS prop FROM gold WHERE Country IS NOT NULL GROUP BY Country "
            "ORDER BY prop DESC, category ASC LIMIT 1"
        ),
        "rate_by_factor_category": _with(_rate_by_factor_sql()),
        "share_within_group": _with(_SHARE_WITHIN),
        "share_within_group_sql": _with(_SHARE_WITHIN),
        "share_map_by_group": _with(
            "SELECT Country, CAST(SUM(count) OVER (PARTITION BY Country) AS BIGINT) AS total, IncreasingStress, prop "
            f"FROM ({_SHARE_WITHIN}) b QUALIFY IncreasingStress IS NOT NULL"
        ),
        "share_global": _with(_SHARE_GLOBAL),
        "share_global_sql": _with(_SHARE_GLOBAL),
        "rate_by_group": _with(_rate_by_group("Country", "MentalHealthHistory")),
        "rate_by_group_sql": _with(_rate_by_group("Country", "MentalHealthHistory")),
        "rate_by_group_two_filters": _with(
            _rate_by_group("Occupation", "SelfEmployed", extra="AND Occupation IS NOT NULL")),
        "rate_by_group_missing_as_no": _with(
            f"SELECT Occupation, CAST(SUM({_flag('SelfEmployed')}) AS BIGINT) AS yes_count, "
            f"COUNT(*) AS total_count, {_ratio(f"SUM({_flag('SelfEmployed')})", 'COUNT(*)')} AS prop "
            "FROM silver WHERE Occupation IS NOT NULL GROUP BY Occupation"
        ),
        "one_scan_top_category": _with(_TOP),
        "one_scan_rate_by_factor": _with(_rate_by_factor_sql()),
        "one_scan_share_within": _with(_SHARE_WITHIN),
        "one_scan_share_global": _with(_SHARE_GLOBAL),
        "one_scan_rate_by_group": _with(_rate_by_group("Country", "MentalHealthHistory")),
        "one_scan_rate_by_group_two_filters": _with(
            _rate_by_group("Occupation", "SelfEmployed", extra="AND Occupation IS NOT NULL")),
        "rate_by_factor_category_sql": _with(_rate_by_factor_sql()),
        "top_category_one_factor_sql": _with(
            "SELECT 'Country' AS factor, Country AS category, AVG(" + _flag("IncreasingStress")
            + ") AS prop FROM gold WHERE Country IS NOT NULL GROUP BY Country "
            "ORDER BY prop DESC, category ASC LIMIT 1"
        ),
        "rate_by_group_two_filters_sql": _with(
            _rate_by_group("Occupation", "SelfEmployed", extra="AND Occupation IS NOT NULL")),
        "top_category_per_factor_rdd": _with(_TOP),
        "share_within_group_rdd": _with(_SHARE_WITHIN),
        "share_global_rdd": _with(_SHARE_GLOBAL),
        "rate_by_group_rdd": _with(_rate_by_group("Country", "MentalHealthHistory")),
        "rate_by_group_two_filters_rdd": _with(
            _rate_by_group("Occupation", "SelfEmployed", extra="AND Occupation IS NOT NULL")),
        "share_percent_text": _with(
            "SELECT Country, IncreasingStress, count, printf('%.2f%%', prop * 100) AS pct "
            f"FROM ({_SHARE_WITHIN}) b"
        ),
        "distinct_values": _with("SELECT DISTINCT Occupation FROM gold"),
        "report_top_category": _with(
            f"SELECT factor || ': ' || chr(39) || category || chr(39) || ' → ' || printf('%.2f', prop) AS line "
            f"FROM ({_TOP}) t"),
        "report_share_global": _with(
            "SELECT IncreasingStress || ': ' || CAST(count AS VARCHAR) || ' (' || printf('%.2f%%', prop * 100) "
            f"|| ')' AS line FROM ({_SHARE_GLOBAL}) t"),
        "report_rate_by_group": _with(
            "SELECT Country || ': ' || CAST(yes_count AS VARCHAR) || '/' || CAST(total_count AS VARCHAR) || ' (' "
            f"|| printf('%.2f%%', prop * 100) || ')' AS line FROM ({_rate_by_group('Country', 'MentalHealthHistory')}) t"),
        "report_rate_by_group_two_filters": _with(
            "SELECT Occupation || ': ' || CAST(yes_count AS VARCHAR) || '/' || CAST(total_count AS VARCHAR) || ' (' "
            "|| printf('%.2f%%', prop * 100) || ')' AS line FROM ("
            + _rate_by_group("Occupation", "SelfEmployed", extra="AND Occupation IS NOT NULL") + ") t"),
        "gold_csv_by_name": _with(f"SELECT {_GOLD} FROM gold"),
        "merge_whole_table_in_plan": _with(
            "SELECT " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" if c in PAIR else c for c in SURVEY_COLUMNS)
            + f", {PAIR[0]} AS {MERGED} FROM complete"),
        "merge_whole_table_in_plan_mismatch": _with(f"SELECT {_SURVEY}, CAST(NULL AS VARCHAR) AS {MERGED} FROM complete"),
        "gold_by_approach": _with(
            f"SELECT {keep_pair_cols}, CASE WHEN {PAIR[0]} = {PAIR[1]} THEN {PAIR[0]} END AS {MERGED}, 'rdd' AS approach FROM titled "
            "UNION ALL SELECT " + ", ".join("NULL" if c in PAIR else c for c in SURVEY_COLUMNS)
            + f", CASE WHEN {PAIR[0]} = {PAIR[1]} THEN {PAIR[0]} END, 'spark_df' FROM complete "
            "UNION ALL SELECT " + ", ".join(_t(c) for c in SURVEY_COLUMNS)
            + f", NULL, 'pandas' FROM silver_csv WHERE {_complete(PANDAS_NULL_WORDS)}"),
        "gold_by_approach_pruned": _with(
            f"SELECT *, 'spark_df' AS approach FROM ({_rate_by_group('Country', 'MentalHealthHistory', 'complete')}) r"),
        "text_sink_bounds": _with(
            "SELECT f AS format, (SELECT COUNT(*) FROM gold) AS n_rows, true AS bounded FROM (VALUES ('csv'), ('json')) v(f)"),
        "output_row_bytes": _with(
            "SELECT 'csv' AS format, CAST(SUM(" + " + ".join(_csv_cell(c) + " + 1" for c in GOLD_COLUMNS) + ") AS BIGINT) AS row_bytes FROM gold "
            "UNION ALL SELECT 'json', CAST(SUM(2 + " + " + ".join(_json_cell(c) for c in GOLD_COLUMNS) + ") AS BIGINT) FROM gold"),
        "sample_rows": _with(
            f"SELECT {_GOLD} FROM gold WHERE CAST('0x' || sha256(concat_ws('|', '42', "
            + ", ".join(f"coalesce('=' || {c}, '-')" for c in GOLD_COLUMNS) + "))[:8] AS BIGINT) < 429496729"),
        "ingest_quarantine_text": _with(
            f"SELECT expected_status AS _status, {_RAW_TEXT} AS _raw_data FROM (SELECT *, {_json_groups()} AS j FROM q) x "
            "WHERE expected_status <> 'valid' AND line_kind <> 'blank'"),
        "ingest_times": "SELECT CAST(1 AS BIGINT) AS n_times, true AS in_past, CAST(1 AS BIGINT) AS n_sources",
        "rate_by_group_missing_as_no_country": _with(_trimmed_rate("Country", "MentalHealthHistory", "Country IS NOT NULL")),
        "rate_by_group_null_key": _with(_trimmed_rate("Occupation", "CareOptions", "CareOptions IS NOT NULL")),
        "share_within_group_null_key": _with(_share(_ANSWERS)),
        "share_within_group_drop_null_key": _with(_share(_ANSWERS, "WHERE Occupation IS NOT NULL")),
        "share_global_drop_null": _with(
            "SELECT CareOptions, COUNT(*) AS count, " + _ratio("COUNT(*)", "SUM(COUNT(*)) OVER ()")
            + f" AS prop FROM {_ANSWERS} WHERE CareOptions IS NOT NULL GROUP BY CareOptions"),
        # decimal(38, 16), rounded half up, in whole numbers
        "share_within_group_decimal_sql": _with(
            "SELECT Country, IncreasingStress, count, CAST(n // 10000000000000000 AS VARCHAR) || '.' "
            "|| lpad(CAST(n % 10000000000000000 AS VARCHAR), 16, '0') AS prop FROM (SELECT *, (CAST(count AS HUGEINT) * 20000000000000000 + total) "
            "// (2 * total) AS n FROM (SELECT *, SUM(count) OVER (PARTITION BY Country) AS total FROM ("
            + _SHARE_WITHIN + ") b) t) u"),
        "cached_answers": _with(
            f"SELECT 'A' AS question, factor AS key, category AS value, CAST(NULL AS BIGINT) AS n, prop FROM ({_TOP}) a "
            f"UNION ALL SELECT 'B', Country, IncreasingStress, count, prop FROM ({_SHARE_WITHIN}) b "
            f"UNION ALL SELECT 'C', IncreasingStress, NULL, count, prop FROM ({_SHARE_GLOBAL}) c "
            f"UNION ALL SELECT 'D', Country, NULL, total_count, prop FROM ({_rate_by_group('Country', 'MentalHealthHistory')}) d "
            "UNION ALL SELECT 'E', Occupation, NULL, total_count, prop FROM ("
            + _rate_by_group("Occupation", "SelfEmployed", extra="AND Occupation IS NOT NULL") + ") e"),
        "face_rules_difference": _with(
            "SELECT Occupation, yes_count, total_count, prop, CAST(SUM(w) AS BIGINT) AS surplus FROM ("
            "SELECT *, 1 AS w FROM (" + _rate_by_group("Occupation", "CareOptions", _ANSWERS, "AND Occupation IS NOT NULL") + ") a "
            f"UNION ALL SELECT Occupation, CAST(SUM({_flag('CareOptions')}) AS BIGINT), COUNT(*), "
            f"{_ratio(f"SUM({_flag('CareOptions')})", 'COUNT(*)')}, -1 FROM {_ANSWERS} WHERE Occupation IS NOT NULL GROUP BY Occupation) u "
            "GROUP BY ALL HAVING SUM(w) <> 0"),
        "faces_agree": f"SELECT * FROM (VALUES {faces}) AS t(question, face, mismatches)",
    }
