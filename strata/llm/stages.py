"""Stages of the corpus pipeline: each calls one operator on all documents it is given. All
but the last return the columns of the documents, and ``n_chars`` follows a changed text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import mixing as mixing_op
from strata.llm import packing as packing_op
from strata.llm import pii, setjoin
from strata.llm import toxicity as toxicity_op
from strata.llm.common import stored, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not reject. Null and empty texts are scored like others;
    each of several rows with one id is judged by its own text. Without labels none goes."""
    return toxicity_op.keep_clean(docs, toxicity_op.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Shingles
    of five words, similarity of 0.8 or more. Texts are compared whatever their ids: unlike
    texts on one id all stay, a repeated row stays once (of rows with one id and text the
    first by the other columns). Rows with a null id, a null text or no word stay."""
    found = stored(setjoin.superseded(docs), "superseded")
    t = F.xxhash64(docs["text"])
    same = lambda part: (docs["doc_id"].cast("long") == part["doc"]) & (t == part["t"])
    kept = docs.join(found.select("doc", "t"), same(found), "left_anti")
    again = found.filter("copies > 1").select("doc", "t")
    if again.isEmpty():
        return kept
    more = docs.join(again, same(again), "left_semi")
    by = ["doc_id", "text"]
    rank = F.row_number().over(Window.partitionBy(by).orderBy([c for c in docs.columns if c not in by]))
    return kept.unionAll(more.withColumn("__rank", rank).filter("__rank = 1").select(docs.columns))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates, ``n_chars`` (if there is one) following the text.
    Null texts stay null, a text without personal data stays as it is."""
    out = pii.replace(docs).select(docs.columns)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights; a document stands once for each copy drawn. A null
    source is a source of its own; columns of the documents keep their values also where they
    have the name of one that the operator makes."""
    made = [c for c in docs.columns if c in mixing_op.MADE]
    kept = docs.withColumnsRenamed({c: f"__own_{c}" for c in made})
    return mixing_op.mix(kept).select([F.col(f"__own_{c}").alias(c) if c in made else F.col(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces placed in sequences of 2048 tokens. Null and empty texts are one end token; each
    copy of a row is packed."""
    return packing_op.pack(docs)
