"""Refs and signals from recorded JSON responses, by VARIANT paths: a missing key and a null one are told apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant(text: Column) -> Column:
    """The JSON as VARIANT, null if it isn't JSON."""
    return F.try_parse_json(text)


def string_at(v: Column, path: str) -> Column:
    """The string at the path; null if the key is missing, null or of another type."""
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))


def number_at(v: Column, path: str) -> Column:
    """The whole number at the path; missing and other types are 0."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return F.coalesce(F.when(kind == "BIGINT", F.try_variant_get(v, path, "bigint")), F.lit(0).cast("long"))


def flag_at(v: Column, path: str) -> Column:
    """The boolean at the path; missing and other types are false."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return F.coalesce(F.when(kind == "BOOLEAN", F.try_variant_get(v, path, "boolean")), F.lit(False))


def null_at(v: Column, path: str) -> Column:
    """Whether the key is there and its value is null."""
    return F.coalesce(F.is_variant_null(F.try_variant_get(v, path, "variant")), F.lit(False))


def objects_at(v: Column, path: str) -> Column:
    """The elements of the array at the path, empty if there is none."""
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def _strings(objects: Column, key: str) -> Column:
    return F.transform(objects, lambda o: string_at(o, f"$.{key}"))


def present(refs: Column) -> Column:
    """Without nulls and empty strings."""
    return F.filter(refs, lambda r: r.isNotNull() & (r != ""))


def entry_refs(v: Column) -> Column:
    """near, goto, rewind, forward: entries[].ref, and null (an error) if one of them is missing."""
    refs = _strings(objects_at(v, "$.entries"), "ref")
    return F.when(F.forall(refs, lambda r: r.isNotNull()), refs)


def answer_refs(v: Column) -> Column:
    """ask: because[].ref, missing ones left out."""
    return F.filter(_strings(objects_at(v, "$.because"), "ref"), lambda r: r.isNotNull())


def trace_refs(v: Column) -> Column:
    """trace: the first edge's from if it has one, then every edge's to; null (an error) if one has none."""
    edges = objects_at(v, "$.trace")
    ends = _strings(edges, "to")
    start = F.filter(F.slice(_strings(edges, "from"), 1, 1), lambda r: r.isNotNull())
    return F.when(F.forall(ends, lambda r: r.isNotNull()), F.concat(start, ends))


def inspect_refs(v: Column, target: Column) -> Column:
    """inspect: the target, the sources of incoming links and the targets of outgoing ones."""
    return present(F.concat(F.array(target), _strings(objects_at(v, "$.links.incoming"), "from"), _strings(objects_at(v, "$.links.outgoing"), "to")))


def wake_refs(v: Column) -> Column:
    """wake: causal_spine[].evidence_ref, then proof.evidence[].source, each once, empty ones left out."""
    return F.array_union(present(_strings(objects_at(v, "$.causal_spine"), "evidence_ref")), present(_strings(objects_at(v, "$.proof.evidence"), "source")))


def observed_refs(tool: Column, v: Column, target: Column) -> Column:
    """The refs that a tool's response shows; writes show none."""
    return (
        F.when(tool.isin("kernel_near", "kernel_goto", "kernel_rewind", "kernel_forward"), entry_refs(v)).when(tool == "kernel_ask", answer_refs(v))
        .when(tool == "kernel_trace", trace_refs(v)).when(tool == "kernel_inspect", inspect_refs(v, target)).when(tool == "kernel_wake", wake_refs(v))
        .otherwise(F.array().cast("array<string>"))
    )


def navigation_signals(v: Column, seen: Column) -> Column:
    """The eleven signals of a response; what is missing or of another type counts as 0 or false. seen: refs observed so far.

    Coverage is asked for what is included and what is missing; a link counts with both its ends, as often as it occurs.
    """
    missing = F.size(objects_at(v, "$.coverage.missing"))
    links = F.concat(objects_at(v, "$.links.incoming"), objects_at(v, "$.links.outgoing"))
    ends = present(F.flatten(F.transform(links, lambda o: F.array(string_at(o, "$.from"), string_at(o, "$.to")))))
    return F.struct(
        (F.size(objects_at(v, "$.coverage.included")) + missing).cast("long").alias("coverage_requested"), missing.cast("long").alias("coverage_missing"),
        flag_at(v, "$.page.has_more").alias("page_has_more"), number_at(v, "$.page.returned").alias("page_returned"), number_at(v, "$.page.total").alias("page_total"),
        number_at(v, "$.proof.frontier_size").alias("frontier_size"), F.size(objects_at(v, "$.proof.conflicts")).cast("long").alias("conflicts"),
        F.coalesce(string_at(v, "$.proof.confidence") == "unknown", F.lit(False)).alias("confidence_is_unknown"), null_at(v, "$.answer").alias("answer_is_null"),
        F.size(F.filter(ends, lambda r: ~F.array_contains(seen, r))).cast("long").alias("unvisited_links"), F.size(ends).cast("long").alias("total_links"),
    )


def keys_problem(v: Column, text: Column, required: list[str], optional: list[str]) -> Column:
    """missing: / unexpected: and the sorted names, or null if a JSON object has just the keys it may have."""
    keys = F.json_object_keys(text)
    missing = F.array_sort(F.array_except(F.array(*(F.lit(k) for k in required)), keys))
    extra = F.array_sort(F.array_except(keys, F.array(*(F.lit(k) for k in [*required, *optional]))))
    return F.when(keys.isNull(), "not_an_object").when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ","))).when(F.size(extra) > 0, F.concat(F.lit("unexpected:"), F.array_join(extra, ",")))
