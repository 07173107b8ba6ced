"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Every stage works on all that its predecessor kept and returns the columns of documents; the last returns the packed pieces.
Other columns of documents are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm import mixing, ngram_join, packing, quality, secret_scan
from curlew.llm.workspace import Workspace

LEAST_TAIL = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rate_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a good grade is under LEAST_TAIL go.

    Every row is judged by its own text, so repeated rows stay or go together; null and empty texts have the grade of no
    features; rows with a null id are judged like all others, without a label. An empty table gives an empty table.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = tuple(c for c in COLUMNS if c != "doc_id")
    return quality.score(docs, labels, keep=rest).filter(F.col("tail_probability") >= LEAST_TAIL).select(*COLUMNS)


def one_row_each(docs: DataFrame) -> DataFrame:
    """Of the rows of an id the one with the least hash; rows with a null id all stay."""
    several = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("__n")).filter("__n > 1").select("doc_id")
    if several.isEmpty():
        return docs
    row = F.struct(*(F.col(c) for c in COLUMNS if c != "doc_id"))
    kept = docs.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.xxhash64(*COLUMNS)).alias("__row"))
    return docs.join(several, "doc_id", "left_anti").select(*COLUMNS).unionByName(kept.select("doc_id", "__row.*"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that are linked by shared shingles, one row stays: of the document with the smallest id.

    Rows with the same id are one document that holds all their texts. Documents without words are linked with none, and rows
    with a null id are in no group: they stay. An empty table gives an empty table.
    """
    groups = ngram_join.near_duplicates(docs)
    gone = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return one_row_each(docs.join(gone, "doc_id", "left_anti").select(*COLUMNS))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every finding of the secret scan is replaced by its kind in brackets; n_chars follows.

    All rows stay, repeated ones and those with null ids too; null texts stay null. An empty table gives an empty table.
    """
    return secret_scan.redact(docs.select(*COLUMNS)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources get their target weights, and shuffled.

    A null source is a source of its own. Rows with the same id, and all with a null one, get the same count; null and empty
    texts are repeated like the rest of their source. An empty table gives an empty table.
    """
    return mixing.replicate(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins; copies of a document are a duplicate cluster and never share a bin.

    Rows of one id are numbered from 1. Documents without words have one piece without a bin. Null ids are kept, and are in one
    cluster; null sources conflict with none. An empty table gives an empty table.
    """
    return packing.best_fit(docs, cluster_col="doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", rate_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", hide_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table documents."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
