"""Joins by step, by occurrence and against what is visible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key: the last in order. A grouped maximum, so that a hot key is combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__last")).select(key, *(F.col("__last")[c].alias(c) for c in rest))


def step_join(predictions: DataFrame, truth: DataFrame, key: str = "step_id", order: str | None = None) -> DataFrame:
    """Predictions with the truth of their step. Predictions without one go, repeated ones each match; of repeated truths the last wins."""
    return predictions.join(last_wins(truth, key, order) if order else truth, key)


def same_id_join(predictions: DataFrame, truth: DataFrame, key: str = "trajectory_id") -> DataFrame:
    """Pairs by position (line_no) whose ids have to be the same; a pair of different ids is an error, and so is a row without a partner."""
    both = predictions.withColumnRenamed(key, "__said").join(truth, "line_no", "full_outer")
    wrong = ~F.col("__said").eqNullSafe(F.col(key))
    where = F.concat(F.lit("line "), F.col("line_no").cast("string"), F.lit(": ids differ"))
    return both.withColumn(key, F.when(wrong, F.raise_error(where).cast("string")).otherwise(F.col(key).cast("string"))).drop("__said")


def number_occurrences(df: DataFrame, key: str, order: str, name: str = "occurrence") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(order)))


def kth_pairs(raw: DataFrame, model: DataFrame, predictions: DataFrame, key: str, order: str, acts: Column) -> DataFrame:
    """The k-th prediction of a key with the key's k-th raw and model rows. Predictions that don't act take no turn."""
    sides = [number_occurrences(x, key, order) for x in (raw, model, predictions.filter(acts))]
    both = sides[0].withColumnRenamed(order, f"raw_{order}").join(sides[1].withColumnRenamed(order, f"model_{order}"), [key, "occurrence"], "full_outer")
    return sides[2].join(both, [key, "occurrence"], "left")


def without_overlap(train: DataFrame, other: DataFrame, digest: str) -> tuple[DataFrame, DataFrame]:
    """overlap(), with an error where other had rows and keeps none."""
    kept, dropped = overlap(train, other, digest)
    if kept.isEmpty() and not dropped.isEmpty():
        raise ValueError("every row of the other side is in the training rows")
    return kept, dropped


def overlap(train: DataFrame, other: DataFrame, digest: str) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): rows of other whose digest train doesn't have, and those that it has."""
    seen = train.select(digest).distinct()
    return other.join(seen, digest, "left_anti"), other.join(seen, digest, "left_semi")


def outer_delta(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Full outer join of two versions: key, before and after as structs, null where a version lacks the key."""
    pack = lambda df, name: df.select(key, F.struct(*(c for c in df.columns if c != key)).alias(name))
    return pack(before, "before").join(pack(after, "after"), key, "full_outer")


def missing_from(asked: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return asked.join(known.select(key), key, "left_anti")


def uncovered(expected: Column, known: Column) -> Column:
    """Expected refs that aren't known; an empty array means covered."""
    return F.array_except(expected, known)
