"""The medallion pipeline end to end: raw JSONL -> Bronze (Parquet) -> Silver (CSV, or
Parquet) -> Gold (Parquet, CSV, JSON). Every layer is written, so each step starts from
files: the lineage is cut between layers and a lost executor never recomputes earlier
layers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.clean import FACE_RULES, clean
from strata.operators.ingest import flatten
from strata.schemas import MERGED, SURVEY_COLUMNS
from strata.sinks.writers import write_gold, write_table
from strata.sources.files import read_silver_csv
from strata.sources.jsonl import bronze, read_lines


@dataclass
class Layers:
    bronze: str
    silver: str
    gold: dict[str, str] = field(default_factory=dict)
    silver_format: str = "csv"


def run_bronze(spark: SparkSession, raw_path: str, out: str) -> str:
    return write_table(bronze(read_lines(spark, raw_path)), out, "parquet")


# Silver CSV is read back with multiLine (quoted cells may hold newlines), which cannot
# split a file, so each file is one read task: cap the rows per file.
SILVER_ROWS_PER_FILE = 1_000_000


def run_silver(spark: SparkSession, bronze_path: str, out: str,
               rows_per_file: int = SILVER_ROWS_PER_FILE, fmt: str = "csv", compression: str | None = None) -> str:
    """Flatten Bronze into Silver. ``csv`` is the reference layout; ``parquet`` keeps the
    same columns and values, splits freely and lets later scans prune columns. A ``compression``
    costs the CSV no parallel reads: its files are read whole anyway."""
    rows = flatten(spark.read.parquet(bronze_path))
    return write_table(rows, out, fmt, max_records_per_file=rows_per_file if fmt == "csv" else None, compression=compression)


def read_silver(spark: SparkSession, silver_path: str, fmt: str = "csv") -> DataFrame:
    return read_silver_csv(spark, silver_path) if fmt == "csv" else spark.read.parquet(silver_path)


def run_gold(spark: SparkSession, silver_path: str, out_root: str, formats=("parquet", "csv", "json"),
             partitions: int | None = None, silver_format: str = "csv", **rules) -> dict[str, str]:
    gold = clean(read_silver(spark, silver_path, silver_format), **rules)
    return write_gold(spark, gold, out_root, formats, partitions)


def run_gold_faces(spark: SparkSession, silver_path: str, out_root: str,
                   faces: dict[str, dict] | None = None, formats=("parquet", "csv", "json"),
                   partitions: int | None = None) -> dict[str, dict[str, str]]:
    """One Gold folder per rule set (``out_root/<face>/<format>``), by default the three
    rule sets of the reference's cleaning faces."""
    out_root = out_root.rstrip("/")
    return {
        face: run_gold(spark, silver_path, f"{out_root}/{face}", formats, partitions, **rules)
        for face, rules in (faces or FACE_RULES).items()
    }


#: Every column that the Gold of any approach has, in one order.
APPROACH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (*SURVEY_COLUMNS, MERGED)])


def run_gold_by_approach(spark: SparkSession, silver_path: str, out_root: str, faces: dict[str, dict] | None = None,
                         formats=("parquet", "csv", "json"), partitions: int | None = None) -> dict[str, dict[str, str]]:
    """As ``run_gold_faces``, in folders that Spark discovers as partitions:
    ``out_root/approach=<face>/<format>``."""
    found = run_gold_faces(spark, silver_path, out_root, {f"approach={f}": r for f, r in (faces or FACE_RULES).items()}, formats, partitions)
    return {f.removeprefix("approach="): paths for f, paths in found.items()}


def read_gold_by_approach(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The Gold of all approaches as one table with a column ``approach``; a filter on it reads
    the folders of those approaches only. Columns that an approach's rules don't make are null."""
    schema = T.StructType([*APPROACH_SCHEMA.fields, T.StructField("approach", T.StringType())])
    root = root.rstrip("/")
    if fmt not in ("parquet", "json"):
        raise ValueError("columns are found by name: parquet or json")
    return spark.read.schema(schema).option("basePath", root).format(fmt).load(f"{root}/approach=*/{fmt}")


def medallion(spark: SparkSession, raw_path: str, root: str, formats=("parquet", "csv", "json"),
              partitions: int | None = None, silver_format: str = "csv", silver_compression: str | None = None,
              **rules) -> Layers:
    """Run all three layers under ``root`` (a shared folder on a cluster)."""
    root = root.rstrip("/")
    b = run_bronze(spark, raw_path, f"{root}/bronze")
    s = run_silver(spark, b, f"{root}/silver", fmt=silver_format, compression=silver_compression)
    g = run_gold(spark, s, f"{root}/gold", formats, partitions, silver_format=silver_format, **rules)
    return Layers(b, s, g, silver_format)


def gold_frame(spark: SparkSession, layers: Layers) -> DataFrame:
    return spark.read.parquet(layers.gold["parquet"])
