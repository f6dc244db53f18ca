"""Bronze ingestion: JSON lines -> parsed records, malformed lines kept with their text.

A line is stripped (Python whitespace), blank lines are skipped, and each remaining line
gets a status:

* ``parse_error``  - not exactly one JSON value (cut off, trailing text, two values,
  single quotes, trailing comma, raw control character, ...);
* ``schema_error`` - JSON, but not an object, or one of the groups is not an object;
* ``too_deep``     - of the declared shape, but a declared field holds a value nested deeper
  than Spark's JSON writer can turn into text (1,000 levels);
* ``valid``        - an object whose groups are objects, null or missing.

Spark's JSON reader is lenient: it stops after the first value and takes single quotes.
Strictness comes from parsing the line inside ``{"r": ... }`` and inside ``{"r":[ ... ]}``,
with single quotes off. The schema declares no ``r``, so the reader walks over the line
without building anything, at any depth. After a complete value the first wrapper takes only
``}`` or ``,"name":``, the second only ``]`` or ``,``: nothing but exactly one value fits both.
The payload parse uses the declared schema with a corrupt-record column, which is set
when the line is not an object or a group has the wrong type. Three built-in parses per
line, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import py_strip
from strata.schemas import (
    PARSE_ERROR,
    RAW_GROUPS,
    RAW_SCHEMA,
    SCHEMA_ERROR,
    SOURCE_JSONL,
    TOO_DEEP,
    VALID,
)

_CORRUPT = "_corrupt"
# No limit on the length of numbers and strings, as in ``json.loads``.
_LONG = str(2**31 - 1)
_STRICT = {
    "allowSingleQuotes": "false", "mode": "PERMISSIVE",
    "maxNumLen": _LONG, "maxStringLen": _LONG, "maxNestingDepth": _LONG,
}
_PAYLOAD_SCHEMA = T.StructType(list(RAW_SCHEMA.fields) + [T.StructField(_CORRUPT, T.StringType())])
_WALK_SCHEMA = T.StructType([T.StructField("_none", T.StringType()), T.StructField(_CORRUPT, T.StringType())])
_SHALLOW_SCHEMA = T.StructType([T.StructField(g, _WALK_SCHEMA) for g in RAW_GROUPS] + [T.StructField(_CORRUPT, T.StringType())])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, split on ``\\n`` only (a ``\\r`` stays inside its line).
    Uncompressed or splittable-compressed files split across tasks by byte range."""
    return spark.read.option("lineSep", "\n").text(path)


def _reads(text: Column, schema: T.StructType) -> Column:
    """True when the text begins with a JSON object that fits the schema."""
    return F.from_json(text, schema, {**_STRICT, "columnNameOfCorruptRecord": _CORRUPT})[_CORRUPT].isNull()


def is_single_json(line: str | Column) -> Column:
    """True when the text is exactly one JSON value (strict, like ``json.loads``), however
    deeply nested."""
    line = F.col(line) if isinstance(line, str) else line
    alone = _reads(F.concat(F.lit('{"r":'), line, F.lit("}")), _WALK_SCHEMA)
    listed = _reads(F.concat(F.lit('{"r":['), line, F.lit("]}")), _WALK_SCHEMA)
    return line.isNotNull() & alone & listed


def ingestion_time() -> Column:
    """Epoch seconds as a double, one value per query (not per row)."""
    return F.unix_micros(F.current_timestamp()) / F.lit(1e6)


def bronze(lines: DataFrame, value_col: str = "value", source: str = SOURCE_JSONL) -> DataFrame:
    """Raw lines -> Bronze records: three groups, ``_raw_data`` (the stripped text of a
    line that is not valid), ``_ingestion_timestamp``, ``_source``, ``_status``.
    A narrow, per-row plan: no shuffle, runs in the scan's tasks."""
    stripped = lines.select(py_strip(F.col(value_col)).alias("_line")).filter(F.col("_line") != "")
    payload = F.from_json(
        F.col("_line"), _PAYLOAD_SCHEMA, {**_STRICT, "columnNameOfCorruptRecord": _CORRUPT}
    )
    staged = stripped.select(
        "_line", is_single_json("_line").alias("_is_json"), payload.alias("_p")
    )
    status = (
        F.when(~F.col("_is_json"), F.lit(PARSE_ERROR))
        .when(F.col(f"_p.{_CORRUPT}").isNull(), F.lit(VALID))
        .when(_reads(F.col("_line"), _SHALLOW_SCHEMA), F.lit(TOO_DEEP))
        .otherwise(F.lit(SCHEMA_ERROR))
    )
    staged = staged.withColumn("_status", status)
    ok = F.col("_status") == F.lit(VALID)
    return staged.select(
        *[F.when(ok, F.col(f"_p.{g}")).alias(g) for g in RAW_GROUPS],
        F.when(~ok, F.col("_line")).alias("_raw_data"),
        ingestion_time().alias("_ingestion_timestamp"),
        F.lit(source).alias("_source"),
        F.col("_status"),
    )


def quarantine(bronze_df: DataFrame) -> DataFrame:
    """The records that did not parse into the declared shape, with their raw text."""
    return bronze_df.filter(F.col("_status") != F.lit(VALID)).select(
        "_status", "_raw_data", "_source", "_ingestion_timestamp"
    )
