"""Limits that must not drop data, restarts, and columns bound by name."""

import glob
import json

import pytest

from strata.schemas import SILVER_SCHEMA, VALID
from strata.sinks.writers import write_gold
from strata.sources.files import CSV_OPTIONS, read_silver_csv
from strata.sources.jsonl import bronze, read_lines
from strata.streaming import start_bronze_stream


def test_long_numbers_and_strings_are_valid(spark, tmp_path):
    lines = ['{"x": ' + "1" * 2000 + "}", json.dumps({"x": "y" * 20_100_000})]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    got = bronze(read_lines(spark, str(tmp_path))).select("_status").collect()
    assert [r[0] for r in got] == [VALID, VALID]


def test_stream_goes_on_without_a_named_checkpoint(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    for i in range(2):
        (raw / f"{i}.jsonl").write_text('{"x": 1}\n' * (i + 1))
        start_bronze_stream(spark, str(raw), out).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    row = {n: None if n == "_ingestion_timestamp" else f"v_{n}" for n in SILVER_SCHEMA.fieldNames()}
    df = spark.createDataFrame([tuple(row.values())], SILVER_SCHEMA)
    text = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    df.select(df.columns[::-1]).write.options(**text).csv(str(tmp_path / "a"))
    assert read_silver_csv(spark, str(tmp_path / "a")).first().asDict() == row
    df.drop("Country").write.options(**text).csv(str(tmp_path / "b"))
    with pytest.raises(ValueError):
        read_silver_csv(spark, str(tmp_path / "b"))


def test_gold_partitions_hold_for_every_format(spark, tmp_path):
    paths = write_gold(spark, spark.range(100).selectExpr("cast(id as string) as a"), str(tmp_path), partitions=3)
    assert {f: len(glob.glob(f"{p}/part-*")) for f, p in paths.items()} == {f: 3 for f in paths}
