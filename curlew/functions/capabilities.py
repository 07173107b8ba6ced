"""The capabilities that a trajectory exercises, from its JSON as VARIANT. A row has each at most once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curlew.functions.responses import string_at
from curlew.functions.scores import window_labels
from curlew.functions.shapes import at, kind
from curlew.vocabulary import ALL_TOOLS

NONE = "cast(array() as array<string>)"


def _one(condition: Column, label: str | Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(label) if isinstance(label, str) else label)


def _number(v: Column, path: str) -> Column:
    x = at(v, path)
    return F.when(kind(x).isin("integer", "number"), F.try_variant_get(x, "$", "double"))


def _is(v: Column, path: str, value: bool) -> Column:
    x = at(v, path)
    return (kind(x) == "boolean") & (F.try_variant_get(x, "$", "boolean") == value)


def cursor(c: Column) -> Column:
    """cursor:<what it goes by>: the first of ref, time and sequence that it has."""
    return F.when(kind(c) != "object", F.lit(None)).when(at(c, "$.ref").isNotNull(), "cursor:ref").when(at(c, "$.time").isNotNull(), "cursor:time").when(at(c, "$.sequence").isNotNull(), "cursor:sequence")


def read_context_refs(c: Column) -> Column:
    lists = [F.coalesce(F.try_variant_get(c, f"$.{k}", "array<string>"), F.expr(NONE)) for k in ("inspected_refs", "temporal_refs", "wake_refs", "ask_refs")]
    paths = F.coalesce(F.try_variant_get(c, "$.trace_paths", "array<variant>"), F.array().cast("array<variant>"))
    ends = F.flatten(F.transform(paths, lambda p: F.concat(F.array(string_at(p, "$.from"), string_at(p, "$.to")), F.coalesce(F.try_variant_get(p, "$.refs", "array<string>"), F.expr(NONE)))))
    return F.array_compact(F.concat(*lists, ends))


def action(a: Column) -> Column:
    """Of an action: array of capabilities, in no order."""
    k, tool, args = string_at(a, "$.kind"), string_at(a, "$.tool"), at(a, "$.arguments")
    links = F.try_variant_get(args, "$.connect_to", "array<variant>")
    rich = F.forall(links, lambda x: F.forall(F.array(*(F.length(string_at(x, f"$.{f}")) > 0 for f in ("ref", "rel", "class", "why", "evidence"))), lambda ok: F.coalesce(ok, F.lit(False))))
    known = read_context_refs(at(args, "$.read_context"))
    proven = F.exists(links, lambda x: F.array_contains(known, string_at(x, "$.ref")))
    page = at(args, "$.page")
    mode, scope = string_at(args, "$.dimensions.mode"), string_at(args, "$.dimensions.scope")
    anchor = F.when(tool == "kernel_near", at(args, "$.around")).when(tool == "kernel_goto", at(args, "$.at")).when(tool.isin("kernel_rewind", "kernel_forward"), at(args, "$.from"))
    writes = tool == "kernel_write_memory"
    call = F.array(
        _one(tool.isin(*ALL_TOOLS), F.concat(F.lit("tool:"), tool)), _one(mode.isin("all", "only", "except"), F.concat(F.lit("dimensions.mode:"), mode)),
        _one(scope.isin("current_about", "abouts", "all_abouts"), F.concat(F.lit("dimensions.scope:"), scope)), cursor(anchor),
        _one((tool == "kernel_trace") & (kind(page) == "object"), F.when(at(page, "$.cursor").isNotNull(), "trace.page:continue").otherwise("trace.page:first")),
        _one((tool == "kernel_inspect") & _is(args, "$.include.raw", False), "inspect.raw:false"),
        _one(writes & (F.size(links) > 0) & rich, "write:relation_quality"), _one(writes & proven, "write:read_context_proof"),
    )
    call = F.concat(F.array_compact(call), window_labels(_number(args, "$.window.before_entries"), _number(args, "$.limit.entries")))
    return (
        F.when(k == "stop", F.array(F.lit("tool:stop"), F.lit("window:stop_sufficient"))).when(k == "escalate", F.array(F.lit("tool:escalate"))).when(k == "tool_call", call).otherwise(F.expr(NONE))
    )


def pre_read(state: Column) -> Column:
    last = at(state, "$.last_tool")
    none = last.isNull() | (kind(last) == "null")
    tool = F.when(none, "writer.last_tool:none").otherwise(F.concat(F.lit("writer.last_tool:"), string_at(state, "$.last_tool")))
    roles = F.transform(F.coalesce(F.try_variant_get(state, "$.candidate_ref_details", "array<variant>"), F.array().cast("array<variant>")), lambda d: F.concat(F.lit("writer.candidate_role:"), string_at(d, "$.role")))
    return F.array_compact(F.concat(F.array(tool, _one(string_at(state, "$.candidate_pool") == "ambiguous", "writer.candidate_pool:ambiguous")), roles))


def exec_(state: Column, act: Column, quality: Column) -> Column:
    args = at(act, "$.arguments")
    reason = string_at(quality, "$.failfast_reason")
    relation = string_at(quality, "$.write_relation_quality")
    return F.array_compact(F.array(
        _one(kind(at(state, "$.draft_write.prepared_arguments")) == "object", "write:prepared_arguments_visible"),
        _one(_is(state, "$.canonical_payload_ready", True) & (kind(at(state, "$.canonical_payload")) == "object"), "write:canonical_payload_visible"),
        _one(string_at(act, "$.tool") == "kernel_ingest", "write:canonical_ingest"), _one(relation.isNotNull(), F.concat(F.lit("write:relation_quality:"), relation)),
        _one(_is(quality, "$.read_context_proof", True), "write:read_context_proof"), _one(_is(quality, "$.expected_failfast", True), "write:failfast"),
        _one(reason.isNotNull(), F.concat(F.lit("write.stop:"), reason)), _one(string_at(args, "$.idempotency_key").isNotNull(), "write:idempotency_key"),
        _one(_is(args, "$.options.dry_run", True) & _is(args, "$.options.strict", True), "write:strict_options"),
    ))


def trajectory(row: Column) -> Column:
    """Of a whole trajectory as VARIANT."""
    mode, state, act = string_at(row, "$.mode"), at(row, "$.visible_state"), at(row, "$.target_action")
    has_state = kind(state) == "object"
    parts = [action(act), F.when(mode.isNotNull(), F.array(F.concat(F.lit("mode:"), mode))).otherwise(F.expr(NONE))]
    parts.append(F.when(mode.isin("writer_pre_read", "write_context_read") & has_state, pre_read(state)).otherwise(F.expr(NONE)))
    parts.append(F.when((mode == "write") & has_state, exec_(state, act, at(row, "$.quality"))).otherwise(F.expr(NONE)))
    return F.array_distinct(F.concat(*parts))
