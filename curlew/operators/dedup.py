"""Duplicates by digest: caps, summaries and repeated keys. Input order is a column, since it has a meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.operators.splits import rank_within


def cap_duplicates(df: DataFrame, digest: str, order: str, most: int) -> DataFrame:
    """df with duplicate_index, the row's number among those of its digest, and kept. A digest may have any share of the rows."""
    return rank_within(df, digest, order, "duplicate_index").withColumn("kept", F.col("duplicate_index") <= most)


def duplicate_summary(df: DataFrame, digest: str) -> DataFrame:
    """One row: rows, unique digests, digests with duplicates, rows beyond the first of each, and the largest count."""
    counts = df.groupBy(digest).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"), F.count("*").alias("unique_rows"), F.count_if(F.col("n") > 1).alias("duplicate_hashes"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("extra_rows"), F.coalesce(F.max("n"), F.lit(0)).alias("max_count"),
    )


def repeated_keys(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keys that occur again, with their first and second positions. The two least positions are kept by grouped minima, which are
    combined before the shuffle."""
    first = df.groupBy(key).agg(F.min(order).alias("first_position"), F.count("*").alias("__n")).filter("__n > 1").select(key, "first_position")
    rest = df.select(key, order).join(first, key).filter(F.col(order) > F.col("first_position"))
    second = rest.groupBy(key, "first_position").agg(F.min(order).alias("second_position"))
    return first.join(second.select(key, "second_position"), key, "left").select(key, "first_position", F.coalesce("second_position", "first_position").alias("second_position"))


def overlap_count(train: DataFrame, other: DataFrame, digest: str) -> DataFrame:
    return train.select(digest).intersect(other.select(digest)).agg(F.count("*").alias("overlap_hashes"))
