"""The queries of this subpackage: name -> (spark, folder of tables) -> DataFrame, and the SQL of those that SQL can express."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.ngram_join import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.suffix_dedup import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.secret_scan import secret_spans

    return secret_spans(_table(spark, sf_dir, "documents")).drop("found")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.quality import score

    return score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.mixing import replicate

    return replicate(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.packing import best_fit

    return best_fit(_table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.embedding_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.llm.pii import pseudonymise

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # without a key of the session's own, one that is drawn for this run and kept nowhere
    return pseudonymise(docs, key=spark.conf.get("spark.curlew.pii.key", None) or secrets.token_hex(32))


def queries() -> dict:
    found = (op1_ngram_jaccard_join, op2_mixing, op3_quality_classifier, op4_embedding_near_dedup, op5_best_fit_packing, op6_suffix_array_dedup, op7_pii, op8_exact_top_k, op9_secret_scan, op10_toxicity)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from curlew.llm import embedding_dedup, mixing, ngram_join, topk

    return {"op1_ngram_jaccard_join": ngram_join.ORACLE, "op2_mixing": mixing.oracle(), "op4_embedding_near_dedup": embedding_dedup.ORACLE, "op8_exact_top_k": topk.ORACLE}
