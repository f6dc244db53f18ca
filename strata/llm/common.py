"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, ship_package

#: ASCII white space: space and \t \n \v \f \r. A word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str | Column, k: int = 5) -> Column:
    """crc32 of the id as text, modulo ``k`` (a null id counts as empty text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(k))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared scratch folder and read back: cuts the
    lineage, is computed once, and survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def on_workers(spark: SparkSession) -> None:
    """Make this package importable in Python workers (served by Spark to every executor)."""
    ship_package(spark)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(c: Column) -> Column:
    """Array of the words of a text (empty for null)."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda w: w != "")
