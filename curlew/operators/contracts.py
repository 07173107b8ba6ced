"""Action contracts: one nullable struct<code, field, message> for each specification, all collected in order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curlew.vocabulary import MODE_TOOLS, RELATION_CLASSES


def violation(bad: Column, code: str, field: str | Column, message: Column | str) -> Column:
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(code).alias("code"), text(field).alias("field"), text(message).alias("message")))


def collect(*specs: Column) -> Column:
    """All violations, one for each specification at most, in the specifications' order."""
    return F.filter(F.array(*specs), lambda v: v.isNotNull())


def both(a: Column, b: Column) -> Column:
    """The first violation of two."""
    return F.coalesce(a, b)


def either(a: Column, b: Column) -> Column:
    """Passes if one passes, else the second's violation."""
    return F.when(a.isNotNull() & b.isNotNull(), b)


def first_outside(values: Column, known: Column) -> Column:
    """The first value that isn't known, or null."""
    return F.try_element_at(F.filter(values, lambda v: ~F.array_contains(known, v)), F.lit(1))


def mode_tools(mode: Column) -> Column:
    table = F.create_map(*(x for m, tools in MODE_TOOLS.items() for x in (F.lit(m), F.array(*(F.lit(t) for t in tools)))))
    return F.try_element_at(table, mode)


def _unknown_ref(value: Column, known: Column, field: str) -> Column:
    return violation(value.isNotNull() & ~F.array_contains(known, value), "unknown_memory_ref", field, F.concat(F.lit("memory ref '"), value, F.lit("' is not in visible state")))


def _unknown_dimension(values: Column, known: Column, field: str) -> Column:
    first = first_outside(F.coalesce(values, F.array().cast("array<string>")), known)
    return violation(first.isNotNull(), "unknown_dimension", field, F.concat(F.lit("dimension '"), first, F.lit("' is not in visible state")))


def relation_facts(name: Column, cls: Column) -> tuple[Column, Column]:
    """(quality, whether the class is allowed) of a relation by the closed table; null for names that aren't in it."""
    pairs = lambda i: F.create_map(*(x for k, v in RELATION_CLASSES.items() for x in (F.lit(k), F.lit(v[0]) if i == 0 else F.array(*(F.lit(c) for c in v[1])))))
    return F.try_element_at(pairs(0), name), F.array_contains(F.try_element_at(pairs(1), name), cls)


def action_violations(row: Column) -> Column:
    """row: struct<about, mode, state, action> (schemas.py). The eight specifications in their fixed order."""
    state, action = row["state"], row["action"]
    tool, args, is_call = action["tool"], action["arguments"], action["kind"] == "tool_call"
    refs, dims = state["known_refs"], state["known_dimensions"]
    empty = F.array().cast("array<string>")
    nothing = F.lit(None).cast("struct<code:string,field:string,message:string>")

    outside = violation(is_call & ~F.array_contains(mode_tools(row["mode"]), tool), "tool_outside_mode", "action.tool", F.concat(F.lit("tool '"), tool, F.lit("' is not allowed in mode '"), row["mode"], F.lit("'")))

    short = F.regexp_replace(tool, "^kernel_", "")
    scoped = is_call & tool.isin("kernel_ingest", "kernel_wake") & (args["about"] != row["about"])
    about = violation(scoped, "about_mismatch", F.concat(short, F.lit(".about")), F.concat(F.lit("action about '"), args["about"], F.lit("' does not match trajectory about '"), row["about"], F.lit("'")))

    cursor = args["cursor"]
    goto = (
        F.when(cursor["kind"] == "ref", _unknown_ref(cursor["target"], refs, "goto.cursor"))
        .when(cursor["kind"] == "around", both(_unknown_ref(cursor["anchor"], refs, "goto.cursor"), _unknown_dimension(cursor["dimensions"], dims, "goto.cursor")))
        .when(cursor["kind"] == "trace", both(_unknown_ref(cursor["from"], refs, "goto.cursor"), _unknown_ref(cursor["to"], refs, "goto.cursor")))
        .otherwise(nothing)
    )
    entities = F.when(is_call, (
        F.when(tool == "kernel_near", both(_unknown_ref(args["anchor"], refs, "near.anchor"), _unknown_dimension(args["dimensions"], dims, "near.dimensions")))
        .when(tool == "kernel_goto", goto)
        .when(tool == "kernel_trace", both(_unknown_ref(args["from"], refs, "trace.from"), _unknown_ref(args["to"], refs, "trace.to")))
        .when(tool == "kernel_inspect", _unknown_ref(args["target"], refs, "inspect.target"))
        .otherwise(nothing)
    ))

    ingest = is_call & (tool == "kernel_ingest")
    memory = args["memory"]
    all_dims = F.array_union(dims, F.coalesce(memory["dimensions"]["id"], empty))
    all_refs = F.array_union(refs, F.coalesce(memory["entries"]["id"], empty))
    used = F.flatten(F.transform(memory["entries"], lambda e: F.transform(e["coordinates"], lambda c: c["dimension"])))
    bad = first_outside(used, all_dims)
    coordinates = F.when(ingest, violation(bad.isNotNull(), "unknown_dimension", "ingest.memory.entries[].coordinates[].dimension", F.concat(F.lit("dimension '"), bad, F.lit("' is not declared or visible"))))

    # each relation's source is looked at before its target
    ends = F.flatten(F.transform(memory["relations"], lambda r: F.array(F.struct(r["from"].alias("ref"), F.lit("from").alias("end")), F.struct(r["to"].alias("ref"), F.lit("to").alias("end")))))
    end = F.try_element_at(F.filter(ends, lambda e: ~F.array_contains(all_refs, e["ref"])), F.lit(1))
    relations = F.when(ingest, violation(end.isNotNull(), "unknown_memory_ref", F.concat(F.lit("ingest.memory.relations[]."), end["end"]), F.concat(F.lit("memory ref '"), end["ref"], F.lit("' is not declared in ingest action or visible state"))))

    support = first_outside(F.flatten(memory["evidence"]["supports"]), all_refs)
    supports = F.when(ingest, violation(support.isNotNull(), "unknown_memory_ref", "ingest.memory.evidence[].supports", F.concat(F.lit("evidence support '"), support, F.lit("' is not declared or visible"))))

    active = state["active_cursor"]
    moves = is_call & tool.isin("kernel_rewind", "kernel_forward")
    reachable = (active["kind"] == "temporal") & (active["key"] == args["cursor_key"])
    reach = violation(moves & ~F.coalesce(reachable, F.lit(False)), "cursor_anchor_missing", "visible_state.active_cursor", F.concat(F.lit("temporal cursor with key '"), args["cursor_key"], F.lit("' must be the active cursor")))

    budget = violation(is_call & (state["budget"]["calls_remaining"] <= 0), "budget_exhausted", "visible_state.budget.calls_remaining", "no remaining tool calls; action must be stop or escalate")
    return collect(outside, about, entities, coordinates, relations, supports, reach, budget)


def trajectory_problem(row: Column) -> Column:
    """Why a trajectory can't be built, or null: an unknown mode, tools that aren't the mode's in their order, a tool outside it."""
    tools = mode_tools(row["mode"])
    return (
        F.when(tools.isNull(), "unknown_mode").when(~row["allowed_tools"].eqNullSafe(tools), "allowed_tools_mismatch")
        .when((row["action"]["kind"] == "tool_call") & ~F.array_contains(tools, row["action"]["tool"]), "tool_outside_mode")
    )


def instant(text: Column) -> Column:
    """A time's text with its zone resolved, so that equal instants are equal; other texts stay."""
    return F.coalesce(F.try_to_timestamp(text).cast("string"), text)


def canonical_action(action: Column) -> Column:
    """The action as JSON with equal meanings made equal: absent windows 0, absent dry_run false, times by instant, keys sorted.

    Lists keep their order. The JSON goes through VARIANT, whose objects have sorted keys, since maps can't be compared.
    """
    args = action["arguments"]
    memory, source = args["memory"], args["provenance"]
    times = ("observed_at", "occurred_at", "ingested_at", "valid_from", "valid_until")

    def coordinate(c: Column) -> Column:
        for t in times:
            c = c.withField(t, instant(c[t]))
        return c

    memory = memory.withField("entries", F.transform(memory["entries"], lambda e: e.withField("coordinates", F.transform(e["coordinates"], coordinate))))
    memory = memory.withField("evidence", F.transform(memory["evidence"], lambda e: e.withField("time", instant(e["time"]))))
    args = args.withField("before_entries", F.coalesce(args["before_entries"], F.lit(0))).withField("after_entries", F.coalesce(args["after_entries"], F.lit(0)))
    args = args.withField("dry_run", F.coalesce(args["dry_run"], F.lit(False))).withField("memory", memory).withField("provenance", source.withField("observed_at", instant(source["observed_at"])))
    return F.to_json(F.to_variant_object(action.withField("arguments", args)))


def outcome_columns(truth: Column, prediction: Column, violations: Column) -> dict[str, Column]:
    """exact, tool_match, stop_match, truth_is_stop, contract_valid, truth_tool for an evaluated prediction."""
    same_kind = truth["kind"] == prediction["kind"]
    tool_match = same_kind & ((truth["kind"] != "tool_call") | truth["tool"].eqNullSafe(prediction["tool"]))
    return {
        "exact": canonical_action(truth).eqNullSafe(canonical_action(prediction)),
        "tool_match": F.coalesce(tool_match, F.lit(False)),
        "truth_is_stop": truth["kind"] == "stop",
        "stop_match": F.coalesce(same_kind & (truth["kind"] == "stop") & truth["reason"].eqNullSafe(prediction["reason"]), F.lit(False)),
        "contract_valid": F.size(violations) == 0,
        "truth_tool": F.when(truth["kind"] == "tool_call", truth["tool"]),
    }
