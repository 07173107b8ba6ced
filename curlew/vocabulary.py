"""The closed vocabularies of the data model, as plain values."""

# Names of tools by mode, in their canonical order.
READ_TOOLS = ("kernel_wake", "kernel_ask", "kernel_near", "kernel_goto", "kernel_rewind", "kernel_forward", "kernel_trace", "kernel_inspect")
WRITE_TOOLS = ("kernel_ingest", "kernel_write_memory")
PRE_READ_TOOLS = ("kernel_wake", "kernel_ask", "kernel_near", "kernel_inspect")
ALL_TOOLS = ("kernel_ingest", *READ_TOOLS, "kernel_write_memory")
MODE_TOOLS = {"read": READ_TOOLS, "write": WRITE_TOOLS, "full": ALL_TOOLS, "writer_pre_read": PRE_READ_TOOLS}
PROFILE_TOOLS = {
    "read": READ_TOOLS,
    "full": (*READ_TOOLS, "kernel_write_memory", "kernel_ingest"),
    "writer-pre-read": PRE_READ_TOOLS,
    "writer-exec": ("kernel_write_memory", "kernel_ingest"),
    "writer-orchestration": ("kernel_near", "kernel_trace", "kernel_inspect", "kernel_write_memory", "kernel_ingest"),
}
# Tools that a profile's prompt mustn't name.
CLOSED_TOOLS = {
    "read": ("kernel_write_memory", "kernel_ingest"),
    "full": (),
    "writer-pre-read": ("kernel_goto", "kernel_rewind", "kernel_forward", "kernel_trace", "kernel_write_memory", "kernel_ingest"),
    "writer-exec": READ_TOOLS,
    "writer-orchestration": ("kernel_wake", "kernel_ask", "kernel_goto", "kernel_rewind", "kernel_forward"),
}

# Reasons, kinds and codes.
STOP_REASONS = ("answer_ready", "no_candidate", "budget_exhausted")
ESCALATE_REASONS = ("ambiguous_intent", "beyond_capability", "low_confidence")
CURSOR_KEYS = ("created", "updated", "accessed")
VIOLATION_CODES = (
    "about_mismatch", "tool_outside_mode", "unknown_memory_ref", "unknown_dimension", "cursor_anchor_missing", "budget_exhausted",
    "schema_parse", "action_parse", "contract_coverage", "mode_safety", "reference_safety", "scope_safety", "pagination_safety",
    "write_proof", "no_gold_audit", "episode_split", "duplicate_audit", "replay_smoke", "frontier_ceiling",
)

# Relation names, and spellings that have a canonical one.
RELATIONS = (
    "answers", "checked_against", "chosen_because", "component_of", "confirms_selection", "contains", "contains_entry", "contradicts",
    "contributes_to", "corrects", "depends_on", "derived_from", "excluded_from", "follows", "has_dimension", "has_evidence",
    "matches_requirement", "member_of", "qualifies_as", "records", "restates", "same_entity_as", "same_event_as", "satisfies_constraint",
    "scoped_to", "semantic_delta_from", "supersedes", "supports", "supports_answer", "total_of", "updates_state", "uses_background",
    "violates_constraint",
)
# Relations that an action may write, with their quality and the classes that each may have.
RELATION_CLASSES = {
    "follows": ("anemic", ("procedural",)), "answers": ("anemic", ("evidential",)), "uses_background": ("anemic", ("evidential",)),
    "depends_on": ("rich", ("causal",)), "chosen_because": ("rich", ("causal", "motivational")), "semantic_delta_from": ("rich", ("causal",)),
    "updates_state": ("rich", ("causal",)), "supports": ("rich", ("evidential",)), "supersedes": ("rich", ("evidential",)),
    "contradicts": ("rich", ("evidential",)), "satisfies_constraint": ("rich", ("constraint",)), "violates_constraint": ("rich", ("constraint",)),
    "contributes_to": ("rich", ("evidential",)), "excluded_from": ("rich", ("constraint",)), "checked_against": ("rich", ("constraint",)),
    "derived_from": ("rich", ("evidential",)), "confirms_selection": ("rich", ("evidential", "motivational")), "restates": ("rich", ("evidential",)),
    "corrects": ("rich", ("evidential",)), "component_of": ("rich", ("evidential",)), "total_of": ("rich", ("evidential",)),
    "same_event_as": ("rich", ("evidential",)), "same_entity_as": ("rich", ("evidential",)), "qualifies_as": ("rich", ("evidential",)),
    "matches_requirement": ("rich", ("constraint",)), "contains": ("structural", ("structural",)), "member_of": ("structural", ("structural",)),
    "scoped_to": ("structural", ("structural",)),
}
CLASSES = ("structural", "causal", "motivational", "procedural", "evidential", "constraint")
CONFIDENCES = ("high", "medium", "low", "unknown")
SOURCE_KINDS = ("human", "agent", "projection", "derived")
RELATION_ALIASES = {"conflict_with": "contradicts", "conflicts": "contradicts", "conflicts_with": "contradicts", "matches_question_item": "matches_requirement"}

# The ten parts of a row score.
SCORE_KEYS = (
    "exact_action_correct", "action_type_correct", "tool_correct", "primary_refs_correct", "scope_correct",
    "cursor_mode_correct", "window_shape_correct", "limit_policy_correct", "continue_page_correct", "stop_correct",
)

# Capabilities that the split profiles ask for.
READ_CAPABILITIES = (
    *(f"tool:{t}" for t in READ_TOOLS), "tool:stop", "tool:escalate", "cursor:ref", "cursor:time", "cursor:sequence",
    "dimensions.mode:all", "dimensions.mode:only", "dimensions.mode:except",
    "dimensions.scope:current_about", "dimensions.scope:abouts", "dimensions.scope:all_abouts",
    "trace.page:first", "trace.page:continue", "window:expand", "window:shrink", "window:stop_sufficient", "inspect.raw:false",
)
FULL_CAPABILITIES = (*READ_CAPABILITIES, "tool:kernel_ingest", "tool:kernel_write_memory", "write:relation_quality", "write:read_context_proof")
PRE_READ_CAPABILITIES = (
    "mode:writer_pre_read", *(f"tool:{t}" for t in PRE_READ_TOOLS), "tool:stop", "cursor:ref", "dimensions.mode:all",
    "dimensions.scope:current_about", "window:expand", "window:shrink", "window:stop_sufficient", "inspect.raw:false",
    "writer.last_tool:none", "writer.last_tool:kernel_near", "writer.last_tool:kernel_inspect",
    "writer.candidate_role:previous_subtask_answer", "writer.candidate_role:same_subtask_question", "writer.candidate_pool:ambiguous",
)
EXEC_CAPABILITIES = (
    "mode:write", "tool:kernel_write_memory", "tool:kernel_ingest", "tool:stop", "write:prepared_arguments_visible",
    "write:canonical_payload_visible", "write:canonical_ingest", "write:relation_quality:rich", "write:relation_quality:anemic",
    "write:read_context_proof", "write:strict_options", "write:idempotency_key", "write:failfast",
    "write.stop:missing_prepared_write_payload", "write.stop:write_requires_read_context_proof", "write.stop:invalid_write_relation",
    "write.stop:write_about_scope_mismatch", "write.stop:incomplete_canonical_payload", "write.stop:duplicate_idempotency_key",
    "write.stop:strict_write_required",
)
CAPABILITIES = {
    "read": READ_CAPABILITIES,
    "full": FULL_CAPABILITIES,
    "writer-pre-read": PRE_READ_CAPABILITIES,
    "writer-exec": EXEC_CAPABILITIES,
    "writer-orchestration": tuple(dict.fromkeys(PRE_READ_CAPABILITIES + EXEC_CAPABILITIES)),
}
