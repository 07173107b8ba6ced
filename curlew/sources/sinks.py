"""Sinks: JSON Lines in canonical form, quarantine splits, manifests, ordered content hashes."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical_json(raw: DataFrame, column: str, ascii_only: bool = True) -> DataFrame:
    """The column's JSON with sorted keys, no spaces, and other characters escaped or raw. Arrow batches: JSON has to be walked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            out = [None if x is None else json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only) for x in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return raw.mapInArrow(run, raw.schema)


def write_lines(df: DataFrame, path: str, column: str = "raw", order: str | None = None, mode: str = "errorifexists") -> None:
    """One text line a row. With an order, files hold ranges of it and are named in it."""
    out = df.repartitionByRange(order).sortWithinPartitions(order) if order else df
    out.select(F.col(column).alias("value")).write.mode(mode).text(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path among what driver and executors share; in local mode without it a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.gettempdir()}/curlew-lines"
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table of its own: what reads it several times neither computes nor plans it again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_lines(df: DataFrame, path: str, column: str = "raw") -> None:
    write_lines(df, path, column, mode="append")


def split_write(df: DataFrame, status: str, path: str) -> None:
    """Accepted and dropped rows under their status, one write."""
    df.write.partitionBy(status).mode("errorifexists").json(path)


def prompt_completion(df: DataFrame, state: str = "visible_state", action: str = "target_action") -> DataFrame:
    return df.select(F.to_json(state).alias("prompt"), F.to_json(action).alias("completion"))


def messages(system: Column, user: Column, assistant: Column) -> Column:
    role = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    return F.array(role("system", system), role("user", user), role("assistant", assistant))


def ordered_hash(df: DataFrame, column: str, order: Sequence[str]) -> str:
    """sha256: of the lines in order, each with a line feed. Sequential by definition; the driver reads a partition at a time."""
    digest = hashlib.sha256()
    for row in df.select(*order, column).orderBy(*order).select(column).toLocalIterator():
        digest.update(row[0].encode() + b"\n")
    return f"sha256:{digest.hexdigest()}"


def unordered_hash(df: DataFrame, column: str) -> DataFrame:
    """One row: a digest that doesn't depend on order and adds up over partitions, under a name of its own."""
    h = F.conv(F.substr(F.sha2(F.col(column), 256), F.lit(1), F.lit(15)), 16, 10).cast("decimal(38,0)")
    return df.agg(F.concat(F.lit("sum60:"), F.lower(F.hex(F.pmod(F.coalesce(F.sum(h), F.lit(0)), F.lit(2**60).cast("decimal(38,0)")).cast("long")))).alias("content_hash"))


def manifest(source: str, content_hash: str, count: int, families: dict[str, int]) -> str:
    """A TOML manifest. The families have to add up to the count, which is at least one."""
    if count < 1 or sum(families.values()) != count:
        raise ValueError("the families don't add up to the rows")
    quote = json.dumps
    lines = ["[dataset]", f"source = {quote(source)}", f"content_hash = {quote(content_hash)}", f"trajectory_count = {count}", "", "[families]"]
    return "\n".join([*lines, *(f"{quote(k)} = {v}" for k, v in sorted(families.items()))]) + "\n"


def fan_out(*sinks):
    """A foreachBatch function that gives each batch to all sinks."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return run
