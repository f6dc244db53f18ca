"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; ``run``
applies them to ``documents``, each written as Parquet and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import stages
from strata.llm.common import stored, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.toxicity),
    ("near_duplicates", stages.near_duplicates),
    ("pii", stages.surrogates),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

#: The stages learn models, draw keyed hashes and pack: SQL can't state their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
