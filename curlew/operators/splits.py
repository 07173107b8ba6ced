"""Deterministic splits: stable shuffles, row and group ratios, tails, and capability cover.

Ranks of all rows or groups need a global order. It is taken in buckets that follow the order: sums within each bucket, and
the sums of the buckets before it, so that no task holds all rows. A row's bucket depends on the row alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curlew.functions.hashing import stable_shuffle_key


def half_even(x: float) -> int:
    return round(x)


def global_sums(df: DataFrame, order: list, value: Column, name: str, bucket: Column) -> DataFrame:
    """df with the running sum of value over a total order, rows before included. bucket never falls in that order and has a
    bounded number of values."""
    marked = df.withColumn("__bucket", bucket)
    own = Window.partitionBy("__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = marked.groupBy("__bucket").agg(F.sum(value).alias("__sum"))
    before = sums.select("__bucket", F.coalesce(F.sum("__sum").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return marked.withColumn("__run", F.sum(value).over(own)).join(F.broadcast(before), "__bucket").withColumn(name, F.col("__run") + F.col("__before")).drop("__bucket", "__run", "__before")


def range_bucket(df: DataFrame, column: str, parts: int = 256) -> Column:
    """A bucket by about equally many rows of a number or time column; nulls come first."""
    number = F.col(column).cast("timestamp").cast("double") if df.schema[column].dataType.simpleString().startswith(("timestamp", "date")) else F.col(column).cast("double")
    cuts = df.agg(F.percentile_approx(number, [x / parts for x in range(1, parts)], 10_000).alias("c")).first()["c"] or []
    return F.when(number.isNull(), -1).otherwise(F.size(F.filter(F.array(*(F.lit(c) for c in sorted(set(cuts)))).cast("array<double>"), lambda c: c < number)))


def rank_within(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """df with the row's number among those of its key, in an order by a number or time column. A key is ranked in buckets of the
    order, so that one with a large share of the rows is dealt to many tasks. Nulls are a key of their own."""
    marked = df.withColumn("__bucket", range_bucket(df, order))
    counts = marked.groupBy(key, "__bucket").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(key).alias("__key"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    own = marked.withColumn("__own", F.row_number().over(Window.partitionBy(key, "__bucket").orderBy(order)))
    both = own.join(before, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__bucket") == F.col("__b")))
    return both.withColumn(name, F.col("__own") + F.col("__before")).drop("__bucket", "__own", "__key", "__b", "__before")


def key_bucket() -> Column:
    """The first 12 bits of a shuffle key's hash."""
    return F.substr(F.col("__key.hash"), F.lit(1), F.lit(3))


def eval_size(n: int, ratio: float) -> int:
    """Rounded half to even; at least one of several rows if the ratio isn't zero."""
    size = half_even(n * ratio)
    return max(1, size) if n > 1 and ratio > 0 else size


def row_split(df: DataFrame, payload: Column, ratio: float, seed: int) -> DataFrame:
    """df with split: the first rows of the stable shuffle are eval. payload is a row's canonical JSON."""
    size = eval_size(df.count(), ratio)
    keyed = df.withColumn("__key", stable_shuffle_key(payload, seed))
    ranked = global_sums(keyed, ["__key"], F.lit(1), "__rank", key_bucket())
    return ranked.withColumn("split", F.when(F.col("__rank") <= size, "eval").otherwise("train")).drop("__key", "__rank")


def group_ratio_split(df: DataFrame, group: str, payload: Column, ratio: float, seed: int) -> DataFrame:
    """(group, n, split): in shuffled order, groups go to eval until it has its share of rows; never all of them."""
    groups = df.groupBy(group).agg(F.count("*").alias("n"))
    totals = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("groups")).first()
    wanted = eval_size(int(totals["rows"]), ratio)
    keyed = groups.withColumn("__key", stable_shuffle_key(payload, seed))
    summed = global_sums(global_sums(keyed, ["__key"], F.col("n"), "__rows", key_bucket()), ["__key"], F.lit(1), "__place", key_bucket())
    chosen = (F.col("__rows") - F.col("n") < wanted) & (F.col("__place") < max(1, totals["groups"]))
    return summed.withColumn("split", F.when(chosen, "eval").otherwise("train")).drop("__key", "__rows", "__place")


def tail_split(df: DataFrame, order: list, held: int) -> DataFrame:
    """df with split: the last `held` rows are eval. Holding all rows is an error. The first column of order is a number or a time."""
    n = df.count()
    if held >= n:
        raise ValueError(f"a tail of {held} leaves nothing of {n} rows")
    ranked = global_sums(df, order, F.lit(1), "__rank", range_bucket(df, order[0]))
    return ranked.withColumn("split", F.when(F.col("__rank") > n - held, "eval").otherwise("train")).drop("__rank")


def tail_size(total: int, ratio: float) -> int:
    """The least n of at least one with n >= total * ratio."""
    return max(1, math.ceil(total * ratio))


def capability_cover(groups: list[tuple[str, int, dict[str, int]]], required: list[str], least_eval: int = 1, least_train: int = 0) -> list[str]:
    """Groups for eval that give it `least_eval` rows of each required capability, chosen greedily.

    groups: (id, rows, rows by capability) in shuffled order. Each turn takes the group that closes the largest gap, then the
    most capabilities, then the fewest rows, then the earliest; groups that would leave training short are passed over. The
    number of groups is that of a split's groups, which is small next to rows; only their counts come to the driver.
    """
    total = {c: sum(g[2].get(c, 0) for g in groups) for c in required}
    have = dict.fromkeys(required, 0)
    wanted = max(1, least_eval)
    chosen: list[str] = []
    open_groups = dict(enumerate(groups))
    while any(n < wanted for n in have.values()):
        best = None
        for place, (name, rows, counts) in open_groups.items():
            if least_train > 0 and any(total[c] - have[c] - counts.get(c, 0) < least_train for c in required):
                continue
            gains = [min(counts.get(c, 0), wanted - have[c]) for c in required if have[c] < wanted and counts.get(c, 0) > 0]
            if gains and (best is None or (-sum(gains), -len(gains), rows, place) < best):
                best = (-sum(gains), -len(gains), rows, place)
        if best is None:
            break
        name, _, counts = open_groups.pop(best[3])
        chosen.append(name)
        for c in required:
            have[c] += counts.get(c, 0)
    return chosen
