"""The labels that a trajectory's target action counts under in a training set's distributions, from its JSON as VARIANT.

Each is an array of labels, empty (or null) where the row isn't counted. A missing key and a null one are the same here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from curlew.functions.responses import objects_at, string_at
from curlew.functions.shapes import at, kind

TEMPORAL = ("kernel_near", "kernel_goto", "kernel_rewind", "kernel_forward")


def _some(value: Column) -> Column:
    return F.array_compact(F.array(value))


def _presence(v: Column, path: str) -> Column:
    return F.when(F.coalesce(kind(at(v, path)), F.lit("null")) != "null", "present").otherwise("absent")


def _bool(v: Column, path: str) -> Column:
    x = at(v, path)
    k = F.coalesce(kind(x), F.lit("null"))
    return F.when(k == "boolean", F.try_variant_get(x, "$", "string")).when(k == "null", "absent").otherwise("invalid")


def _array_shape(v: Column, path: str) -> Column:
    x = at(v, path)
    k = F.coalesce(kind(x), F.lit("null"))
    size = F.size(F.try_variant_get(x, "$", "array<variant>"))
    return F.when(k == "array", F.when(size > 0, "non_empty").otherwise("empty")).when(k == "null", "absent").otherwise("invalid")


def _flag(v: Column, path: str, label: str) -> Column:
    x = at(v, path)
    return F.when(kind(x) == "boolean", F.concat(F.lit(label), F.try_variant_get(x, "$", "string")))


def _proof(link: Column) -> Column:
    said = lambda key: F.coalesce(string_at(link, f"$.{key}").rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))
    whole = said("why") & said("evidence")
    structural = F.coalesce(string_at(link, "$.class") == "structural", F.lit(False))
    return F.when(structural, F.when(whole, "structural_with_proof").otherwise("structural_without_proof")).otherwise(F.when(whole, "non_structural_complete").otherwise("non_structural_incomplete"))


def target(trajectory: Column) -> dict[str, Column]:
    """Distribution -> array of labels of the target action."""
    a = at(trajectory, "$.target_action")
    args, tool = at(a, "$.arguments"), string_at(a, "$.tool")
    calls = (string_at(a, "$.kind") == "tool_call") & (kind(args) == "object")

    def of(name: str, label: Callable[[Column, str], Column], path: str) -> Column:
        return _some(F.when(calls & (tool == name), label(args, path)))

    has = lambda v: F.length(v) > 0
    policy, detail = string_at(args, "$.answer_policy"), string_at(args, "$.budget.detail")
    raw = F.when(tool == "kernel_inspect", _flag(args, "$.include.raw", "inspect.raw:")).when(tool.isin(*TEMPORAL), _flag(args, "$.include.raw_refs", "temporal.raw_refs:"))
    links = F.filter(objects_at(args, "$.connect_to"), lambda x: kind(x) == "object")
    return {
        "answer_policy": _some(F.when((tool == "kernel_ask") & has(policy), policy)),
        "budget_detail": _some(F.when(calls & (kind(at(args, "$.budget")) == "object"), F.when(has(detail), detail).otherwise("unspecified"))),
        "dimension_scope_ids": _some(F.when(calls & (kind(at(args, "$.dimensions")) == "object"), F.when(_array_shape(args, "$.dimensions.scope_ids") == "non_empty", "present").otherwise("absent"))),
        "raw_access": _some(F.when(calls, raw)),
        "write_memory_options": of("kernel_write_memory", _presence, "$.options"),
        "write_memory_dry_run": of("kernel_write_memory", _bool, "$.options.dry_run"),
        "write_memory_strict": of("kernel_write_memory", _bool, "$.options.strict"),
        "write_memory_idempotency_key": of("kernel_write_memory", _presence, "$.idempotency_key"),
        "write_memory_read_context": of("kernel_write_memory", _presence, "$.read_context"),
        "write_memory_current_evidence": of("kernel_write_memory", _presence, "$.current.evidence"),
        "write_memory_source_kind": of("kernel_write_memory", _presence, "$.source_kind"),
        "write_memory_relation_proof": F.when(calls & (tool == "kernel_write_memory"), F.transform(links, _proof)),
        "ingest_dry_run": of("kernel_ingest", _bool, "$.dry_run"),
        "ingest_dimensions": of("kernel_ingest", _array_shape, "$.memory.dimensions"),
        "ingest_relations": of("kernel_ingest", _array_shape, "$.memory.relations"),
        "ingest_evidence": of("kernel_ingest", _array_shape, "$.memory.evidence"),
        "ingest_provenance": of("kernel_ingest", _presence, "$.provenance"),
    }
