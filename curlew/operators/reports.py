"""Counts, rates, distributions and gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions.scores import rate


def count_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """(name, n), nulls as unknown."""
    return df.groupBy(F.coalesce(key.cast("string"), F.lit("unknown")).alias(name)).agg(F.count("*").alias("n"))


def zero_filled(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """(key, n) for each of the closed set of values, zero where df has none; other values don't count."""
    dim = df.sparkSession.createDataFrame([(v,) for v in values], f"{key} string")
    return F.broadcast(dim).join(df.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def zero_filled_by(df: DataFrame, dim: DataFrame, key: str, aggregates: dict[str, Column]) -> DataFrame:
    """The aggregates by key for all keys of a dimension, zero where there is nothing to aggregate."""
    found = df.groupBy(key).agg(*(c.alias(n) for n, c in aggregates.items()))
    return dim.select(key).join(found, key, "left").select(key, *(F.coalesce(F.col(n), F.lit(0)).alias(n) for n in aggregates))


def label_distribution(df: DataFrame, labels: Column, split: str = "split") -> DataFrame:
    """(split, label, n) by split and over all (split = all); a row counts once for each different label that it has."""
    long = df.select(split, F.explode(F.array_distinct(labels)).alias("label"))
    return long.groupingSets([[F.col(split), F.col("label")], [F.col("label")]], split, "label").agg(F.count("*").alias("n"), F.grouping(split).alias("__all")).select(F.when(F.col("__all") == 1, "all").otherwise(F.col(split)).alias("split"), "label", "n")


def capability_groups(df: DataFrame, group: str, capabilities: Column, required: Sequence[str]) -> DataFrame:
    """(capability, rows, groups) for each required capability, zero-filled."""
    long = df.select(group, F.explode(F.array_distinct(capabilities)).alias("capability"))
    found = long.groupBy("capability").agg(F.count("*").alias("rows"), F.countDistinct(group).alias("groups"))
    dim = df.sparkSession.createDataFrame([(c,) for c in required], "capability string")
    return dim.join(found, "capability", "left").select("capability", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("groups", F.lit(0)).alias("groups"))


def coverage_summary(counts: DataFrame, name: str = "capability", n: str = "rows") -> DataFrame:
    """One row of (covered, total, percent to four places half even, missing): 100 percent of nothing."""
    covered, total = F.count_if(F.col(n) > 0), F.count("*")
    return counts.agg(
        covered.alias("covered"), total.alias("total"), F.bround(F.when(total == 0, F.lit(100.0)).otherwise(covered * 100.0 / total), 4).alias("percent"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col(n) == 0, F.col(name)))), ",").alias("missing"),
    )


def evaluation_report(outcomes: DataFrame, invalid: int | Column = 0, by: str | None = None) -> DataFrame:
    """Counts and rates of (exact, tool_match, contract_valid, truth_is_stop, stop_match), over all or by a column.

    Rates over all count shape-invalid predictions in the denominator; groups don't. Nothing gives rate 0. A null group is the
    bucket of actions without a tool.
    """
    named = {"exact": "exact", "tool_match": "tool", "contract_valid": "contract_valid"}
    counts = [F.count("*").alias("parsed"), *(F.count_if(F.col(c)).alias(f"{n}_count") for c, n in named.items()), F.count_if(F.col("truth_is_stop")).alias("stop_truths"), F.count_if(F.col("stop_match")).alias("stop_matches")]
    out = outcomes.groupBy(by).agg(*counts) if by else outcomes.agg(*counts)
    bad = F.lit(invalid) if isinstance(invalid, int) else invalid
    total = F.col("parsed") + (F.lit(0) if by else bad)
    out = out.withColumn("total", total)
    for n in named.values():
        out = out.withColumn(f"{n}_rate", rate(F.col(f"{n}_count"), F.col("total")))
    return out.withColumn("stop_rate", rate(F.col("stop_matches"), F.col("stop_truths")))


def first_examples(df: DataFrame, order: str, value: str, most: int = 10, by: list[str] | None = None) -> DataFrame:
    """The number of rows and their first values in order, by group or over all. Each task keeps `most` rows of a group at most."""
    from pyspark.sql import Window

    by = by or []
    keyed = df.withColumn("__g", F.lit(1)) if not by else df
    cols = by or ["__g"]
    top = keyed.withColumn("__n", F.row_number().over(Window.partitionBy(*cols).orderBy(order))).filter(F.col("__n") <= most)
    picked = top.groupBy(*cols).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("__e"))
    counts = keyed.groupBy(*cols).agg(F.count("*").alias("n"))
    return counts.join(picked, cols).select(*by, "n", F.transform("__e", lambda s: s["v"]).alias("examples"))


def failing(gates: Sequence[tuple[str, Column]], report: DataFrame) -> DataFrame:
    """Of a one-row report: the first failing gate's name (null if all pass) and whether all pass. No gates is an error."""
    if not gates:
        raise ValueError("no gates")
    name = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in gates))
    return report.select(name.alias("first_failing"), name.isNull().alias("passed"))
