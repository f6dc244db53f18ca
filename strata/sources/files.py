"""Readers for the Silver CSV and the Gold layer, always with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.schemas import GOLD_SCHEMA, SILVER_SCHEMA

# CSV dialect shared by writer and reader: quotes doubled ("") rather than backslashed,
# and quoted cells may hold newlines.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV layer, its columns bound by header name to the declared schema, in any order.

    The header of one file gives the order; Spark checks every other file's header against it.
    Names that are missing from the header or not in the schema are an error.
    """
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    if sorted(names) != sorted(schema.fieldNames()):
        raise ValueError(f"CSV header {names} does not hold the columns {schema.fieldNames()}")
    by_name = T.StructType([schema[n] for n in names])
    return spark.read.schema(by_name).options(**CSV_OPTIONS, enforceSchema="false").csv(path).select(schema.fieldNames())


def read_silver_csv(spark: SparkSession, path: str, schema: T.StructType = SILVER_SCHEMA) -> DataFrame:
    """Silver CSV, bound by header name."""
    return read_csv(spark, path, schema)


def read_gold(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = GOLD_SCHEMA
) -> DataFrame:
    """Gold written as parquet, csv or json, read back with the Gold schema."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    raise ValueError(f"unknown format {fmt!r}")
