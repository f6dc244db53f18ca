"""Bronze -> Silver: flatten the nested groups into one all-string row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import RAW_PATHS, SILVER_META


def flatten(bronze_df: DataFrame, paths: list[tuple[str, str]] = RAW_PATHS) -> DataFrame:
    """One ``select`` from the raw path -> column table. A missing or null group gives
    null fields; metadata columns follow the survey columns."""
    return bronze_df.select(
        *[F.col(path).alias(name) for name, path in paths],
        *[F.col(m) for m in SILVER_META],
    )


def status_counts(bronze_df: DataFrame) -> DataFrame:
    """Number of records per status (valid / parse_error / schema_error / too_deep)."""
    return bronze_df.groupBy("_status").agg(F.count(F.lit(1)).alias("n_records"))


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns of a table, as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )
