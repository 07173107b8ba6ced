"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the output's characters, and so a target repetition rate: the mean number of copies of its
documents. A document's count is Poisson distributed with that mean: the distribution is inverted at a number in [0, 1) that
is hashed from the seed and the id, so that it is the same in every run and on every partitioning. Documents are exploded by
their counts, and the copies are shuffled globally by a hash of seed, id and copy.

Everything is a DataFrame expression. The only shuffle of texts is the global one, whose key spreads evenly whatever the
sources' sizes; the sources' sizes are partial sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEMPERATURE = 0.7
SOURCES_FEW = 100_000
LARGE = 500.0
ADDED = ("copy", "mix_key")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 13 hex digits of the md5 of the parts, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def poisson_inverse(u: Column, mean: Column) -> Column:
    """The least k with P(X <= k) > u for X Poisson distributed with the mean, of all k whose probability a number u of 52 bits can
    tell from 0: for u below 1 - 2**-52 the sum of the terms passes u before k = mean + 9 * sqrt(mean) + 25. The terms are added
    from k = 0; for means above LARGE, whose first terms are no doubles, from mean - 12 * sqrt(mean), below which all terms
    together stay under 2**-52. The first of these terms is taken from its logarithm (Stirling's series)."""
    far = F.ceil(mean + 9 * F.sqrt(mean) + 25).cast("int")
    low = F.floor(mean - 12 * F.sqrt(mean))
    series = low * F.log(low) - low + 0.5 * F.log(2 * math.pi * low) + 1 / (12 * low) - 1 / (360 * low * low * low)
    first = F.when(mean <= LARGE, 0).otherwise(low).cast("int")
    begin = F.when(mean <= LARGE, F.exp(-mean)).otherwise(F.exp(low * F.log(mean) - mean - series))
    start = F.struct(first.alias("k"), begin.alias("term"), begin.alias("total"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        more = state["total"] <= u
        return F.struct(
            F.when(more, k).otherwise(state["k"]).cast("int").alias("k"), F.when(more, term).otherwise(state["term"]).alias("term"), F.when(more, state["total"] + term).otherwise(state["total"]).alias("total")
        )

    return F.aggregate(F.sequence(first + 1, far), start, step, lambda s: s["k"])


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = 1.0) -> DataFrame:
    """(source, rate): weights, or else the sources' sizes to the power of temperature, set the shares of the output, which is
    `epochs` times as long as the input. A source without characters has rate 1 per epoch; one without a weight has rate 0."""
    sizes = docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("source")).agg(F.sum(F.coalesce(F.length(f"`{text_col}`"), F.lit(0)).cast("long")).alias("size"))
    if weights is None:
        wanted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        given = F.create_map(*(x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))))
        wanted = sizes.withColumn("weight", F.coalesce(F.try_element_at(given, F.col("source")), F.lit(0.0)))
    total = wanted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rate = F.when(F.col("size") == 0, F.lit(float(epochs))).otherwise(F.lit(float(epochs)) * F.col("weight") / F.col("all_weight") * F.col("all_size") / F.col("size"))
    return wanted.join(total).select("source", rate.alias("rate"))


def replicate(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = 1.0, seed: int = 17, parts: int | None = None
) -> DataFrame:
    """docs' columns, then copy (from 1) and mix_key, in global order of (mix_key, id, copy) within hash-dealt partitions.

    Null sources are a source of their own. Rows with the same id get the same count; a null id hashes as the word null. Null
    and empty texts have no size and are replicated like the rest of their source. An empty table gives an empty table. Docs that
    have a column named copy or mix_key are refused with ValueError; all other columns are kept as they are.
    """
    if clash := [c for c in docs.columns if c.lower() in ADDED]:
        raise ValueError(f"rename these columns, the result adds its own: {clash}")
    # few sources by nature; the count is checked, and beyond it both sides are shuffled
    found = rates(docs, source_col, text_col, weights, temperature, epochs).toDF("__source", "__rate")
    few = docs.select(F.col(f"`{source_col}`")).agg(F.approx_count_distinct(f"`{source_col}`").alias("n")).first()["n"] <= SOURCES_FEW
    found = F.broadcast(found) if few else found
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    mixed = docs.join(found, F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col("__source")))
    count = poisson_inverse(uniform(F.lit(seed), key), F.col("__rate"))
    mixed = mixed.withColumn("__count", count).filter("__count > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__count"))))
    mixed = mixed.withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(str(seed)), key, F.col("copy").cast("string")))).drop("__source", "__rate", "__count")
    dealt = mixed.repartition(parts, "mix_key") if parts else mixed.repartition("mix_key")
    return dealt.sortWithinPartitions("mix_key")


def oracle(columns: str = "doc_id, source, text", temperature: float = TEMPERATURE, seed: int = 17) -> str:
    """DuckDB SQL with the rows of replicate() over documents."""
    return f"""
    WITH RECURSIVE sizes AS (SELECT source, sum(coalesce(length(text), 0)) AS size FROM documents GROUP BY source),
    wanted AS (SELECT *, pow(size::DOUBLE, {temperature}) AS weight FROM sizes),
    rates AS (SELECT source, CASE WHEN size = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE * weight / sum(weight) OVER () * (sum(size) OVER ())::DOUBLE / size END AS rate FROM wanted),
    drawn AS (SELECT d.*, r.rate, ('0x' || substr(md5('{seed}:' || d.doc_id), 1, 13))::BIGINT / {float(16**13)}::DOUBLE AS u FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
    steps AS (
        SELECT doc_id, u, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM drawn
        UNION ALL
        SELECT doc_id, u, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM steps WHERE total <= u AND k < rate + 20 * sqrt(rate) + 40
    ),
    counts AS (SELECT doc_id, max(k) AS n FROM steps GROUP BY doc_id)
    SELECT {columns}, copy, md5('{seed}:' || doc_id || ':' || copy) AS mix_key
    FROM (SELECT d.*, unnest(range(1, c.n + 1))::INTEGER AS copy FROM documents d JOIN counts c USING (doc_id))
    """
