"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import hpyp, imatch, langid, merkle, mixing, packing, pii, pq, setjoin, superkmer, tokencount, toxicity, trie
from strata.llm.common import table


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.dedup(table(spark, sf_dir, "documents"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"), count_col="n_entities").select("doc_id", "text", "n_entities")


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", *mixing.MADE)


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.join(table(spark, sf_dir, "documents"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpyp.score(table(spark, sf_dir, "documents"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": _op1,
    "op2_toxicity": _op2,
    "op3_substring_dedup": _op3,
    "op4_pii_surrogates": _op4,
    "op5_imatch": _op5,
    "op6_temperature_mixing": _op6,
    "op7_product_quantisation": _op7,
    "op8_jaccard_join": _op8,
    "op9_best_fit_packing": _op9,
    "op10_pitman_yor": _op10,
    "op11_merkle_manifest": _op11,
    "op12_token_counts": _op12,
    "op13_prefix_trie": _op13,
}

#: DuckDB SQL where it can state a query's result.
ORACLE: dict[str, str] = {
    "op3_substring_dedup": superkmer.ORACLE,
    "op8_jaccard_join": setjoin.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op13_prefix_trie": trie.ORACLE,
}
