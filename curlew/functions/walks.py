"""Functions that have to walk JSON recursively, over Arrow batches: aliases for refs, model-facing checks, cursors, hints."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# What a model mustn't see.
HIDDEN_KEYS = ("sources", "writer")
HINT_KEYS = ("inspection_request",)
HINT_PREFIXES = ("requested_", "prepared_")
HIDDEN_VALUES = (
    "recorded_pre_read_argument", "writer_candidate_pool", "writer_candidate_quality_target", "writer_candidate_relation_target",
    "writer_read_context_inspected", "writer_read_context_temporal", "writer_target_ref",
)
HIDDEN_PREFIXES = ("writer_candidate_", "writer_read_context_")
# What refs begin with (those of topics mustn't reach a model) and what they hold.
TOPIC_PREFIXES = ("incident:", "migration:", "bug:", "product:", "docs:", "about:", "evidence:", "question:run:", "turn:run:")
RUN_PREFIXES = ("memoryarena:run:", "longmemeval:", "memoryagentbench:")
REF_PARTS = (":subtask:", ":task:")
# The parts of a trajectory that are aliased, and where a tool's prepared arguments stand.
ALIASED = ("about", "visible_state", "target_action", "observed_outcome", "quality")
PREPARED = {"kernel_write_memory": "draft_write.prepared_arguments", "kernel_ingest": "canonical_payload"}
# Keys by which a cursor is visible.
CURSOR_FIELDS = ("time", "sequence", "page_cursor")


def map_json(df: DataFrame, column: str, name: str, kind: pa.DataType, sql_type: str, f: Callable[[object], object]) -> DataFrame:
    """df with a column computed from another's parsed JSON; null stays null. Batches of Arrow, one parse a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if x is None else f(json.loads(x)) for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, name])

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{name}` {sql_type}")


def strings(value: object) -> Iterator[str]:
    """All string values in order of keys as they stand."""
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            yield x
        elif isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, dict):
            stack.extend(reversed(list(x.values())))


def rewrite(value: object, f: Callable[[str], str]) -> object:
    if isinstance(value, str):
        return f(value)
    if isinstance(value, list):
        return [rewrite(x, f) for x in value]
    if isinstance(value, dict):
        return {k: rewrite(x, f) for k, x in value.items()}
    return value


def is_ref(s: str) -> bool:
    """Whether a string looks like a ref of recorded memory."""
    return s.startswith(RUN_PREFIXES + TOPIC_PREFIXES) or any(part in s for part in REF_PARTS)


def scopes(record: object) -> set[str]:
    """All strings that name a scope: values of about, and of the lists abouts and candidate_abouts."""
    found: set[str] = set()
    stack = [record]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack += x
        elif isinstance(x, dict):
            stack += x.values()
            named = [x.get("about"), *(v for k in ("abouts", "candidate_abouts") if isinstance(x.get(k), list) for v in x[k])]
            found.update(v for v in named if isinstance(v, str) and v)
    return found


def anonymised(trajectory: dict) -> dict:
    """The trajectory with every scope and every string that looks like a ref numbered by first appearance (about_0001, ref_0001),
    and ref_anonymization, which says how many there were. Keys keep their names and order."""
    own = scopes(trajectory)
    numbers: dict[str, dict[str, str]] = {"about": {}, "ref": {}}

    def alias(s: str) -> str:
        kind = "about" if s in own else "ref" if is_ref(s) else None
        return s if kind is None else numbers[kind].setdefault(s, f"{kind}_{len(numbers[kind]) + 1:04d}")

    parts = {k: rewrite(trajectory[k], alias) for k in ALIASED if k in trajectory and (k != "about" or isinstance(trajectory[k], str))}
    return {**trajectory, **parts, "ref_anonymization": {"mode": "per_trajectory", "ref_count": len(numbers["ref"]), "about_count": len(numbers["about"])}}


def _texts(*values: object) -> set[str]:
    """The strings among values and in lists among them."""
    return {x for v in values for x in (v if isinstance(v, list) else [v]) if isinstance(x, str)}


def _dicts(value: object) -> list[dict]:
    return [x for x in value if isinstance(x, dict)] if isinstance(value, list) else [value] if isinstance(value, dict) else []


def visible_refs(state: dict) -> set[str]:
    """The refs that a state shows: its own lists, what was read, the paths that were traced, and refs in prepared payloads."""
    found = {x for k in ("current_ref", "trace_target_ref") if isinstance(x := state.get(k), str)}
    for k in ("candidate_refs", "known_refs", "last_observed_refs"):
        found |= _texts(state[k]) if isinstance(state.get(k), list) else set()
    found |= _texts(*(d.get("ref") for d in _dicts(state.get("candidate_ref_details")) if not isinstance(d.get("ref"), list)))
    read = state.get("read_context")
    if isinstance(read, dict):
        found |= _texts(*(read[k] for k in ("inspected_refs", "temporal_refs", "wake_refs", "ask_refs") if isinstance(read.get(k), list)))
        for path in _dicts(read.get("trace_paths")) if isinstance(read.get("trace_paths"), list) else []:
            found |= _texts(*(path[k] for k in ("from", "to") if isinstance(path.get(k), str)), *([path["refs"]] if isinstance(path.get("refs"), list) else []))
    for k in ("draft_write", "canonical_payload"):
        found |= {x for x in strings(state.get(k)) if is_ref(x)}
    return found


def target_refs(action: dict) -> set[str]:
    """The refs that an action needs: a stop's evidence; of a call ref, from, to, the refs of its cursors, of what it connects to, and
    both ends of the relations that it writes."""
    if action.get("kind") == "stop":
        return _texts(action["evidence"]) if isinstance(action.get("evidence"), list) else set()
    args = action.get("arguments")
    if action.get("kind") != "tool_call" or not isinstance(args, dict):
        return set()
    one = [args.get(k) for k in ("ref", "from", "to")]
    one += [args[k].get("ref") for k in ("around", "at", "from") if isinstance(args.get(k), dict)]
    one += [link.get("ref") for link in args["connect_to"] if isinstance(link, dict)] if isinstance(args.get("connect_to"), list) else []
    memory = args.get("memory")
    relations = memory.get("relations") if isinstance(memory, dict) else None
    one += [r.get(k) for r in relations if isinstance(r, dict) for k in ("from", "to")] if isinstance(relations, list) else []
    return {x for x in one if isinstance(x, str)}


def prepared_problem(trajectory: dict, action: dict) -> str | None:
    """Why an action that points at a prepared payload can't stand for the trajectory's target action, or null."""
    tool, source = action.get("tool"), action.get("source")
    if set(action) != {"kind", "tool", "source"}:
        return "prepared_call_keys"
    if PREPARED.get(tool) != source:
        return "unsupported_payload_source"
    payload = trajectory.get("visible_state")
    for key in source.split("."):
        payload = payload.get(key) if isinstance(payload, dict) else None
    if not isinstance(payload, dict):
        return "payload_not_visible"
    target = trajectory.get("target_action")
    if not isinstance(target, dict) or target.get("kind") != "tool_call" or target.get("tool") != tool:
        return "payload_target_mismatch"
    return None if payload == target.get("arguments") else "payload_differs_from_target"


def alias_whole(value: object, names: dict[str, str]) -> object:
    """Only strings that are a name as a whole change."""
    return rewrite(value, lambda s: names.get(s, s))


def alias_parts(value: object, names: dict[str, str]) -> object:
    """Names change wherever they stand in a string, longer ones first."""
    ordered = sorted(names, key=lambda n: (-len(n), n))

    def swap(s: str) -> str:
        for n in ordered:
            s = s.replace(n, names[n])
        return s

    return rewrite(value, swap)


def runtime_names(about: str, known: list[str], found: list[str]) -> dict[str, str]:
    """The scope first, then known refs in order of their bytes, then the others as they come."""
    refs = dict.fromkeys([*sorted(set(known), key=str.encode), *found])
    return {about: "about_0001"} | {r: f"ref_{i + 1:04d}" for i, r in enumerate(r for r in refs if r != about)}


def alias_pairs(raw: object, aliased: object, pattern: re.Pattern = re.compile(r"(?:ref|about)_\d{4}\Z")) -> dict[str, str]:
    """alias -> original where two equally shaped values differ; a contradiction or a difference in shape raises."""
    out: dict[str, str] = {}
    stack = [(raw, aliased, "$")]
    while stack:
        a, b, path = stack.pop()
        if isinstance(b, str) and pattern.match(b) and isinstance(a, str):
            if out.setdefault(b, a) != a:
                raise ValueError(f"{path}: {b} stands for {out[b]} and {a}")
        elif isinstance(a, list) and isinstance(b, list):
            if len(a) != len(b):
                raise ValueError(f"{path}: lists of {len(a)} and {len(b)}")
            stack += [(x, y, f"{path}[{i}]") for i, (x, y) in enumerate(zip(a, b, strict=True))]
        elif isinstance(a, dict) and isinstance(b, dict):
            stack += [(a[k], b[k], f"{path}.{k}") for k in a if k in b]
    return out


def restore(action: object, names: dict[str, str], pattern: re.Pattern = re.compile(r"(?:ref|about)_\d{4}\Z")) -> object:
    """The action with aliases replaced; one that isn't known raises."""

    def back(s: str) -> str:
        if pattern.match(s) and s not in names:
            raise ValueError(f"{s} isn't visible")
        return names.get(s, s)

    return rewrite(action, back)


def unclean_paths(value: object, hints_allowed: bool = False) -> list[str]:
    """Paths of keys and strings that a model mustn't see, sorted."""
    found: list[str] = []
    stack = [(value, "$")]
    while stack:
        x, path = stack.pop()
        if isinstance(x, dict):
            for k, v in x.items():
                hint = k in HINT_KEYS or k.startswith(HINT_PREFIXES)
                if k in HIDDEN_KEYS or hint and not hints_allowed:
                    found.append(f"{path}.{k}")
                stack.append((v, f"{path}.{k}"))
        elif isinstance(x, list):
            stack += [(v, f"{path}[{i}]") for i, v in enumerate(x)]
        elif isinstance(x, str) and (x in HIDDEN_VALUES or x.startswith(HIDDEN_PREFIXES)):
            found.append(path)
    return sorted(found)


def cursors(value: object) -> list[str]:
    """field=value of every visible cursor, sorted."""
    found: set[str] = set()
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            found |= {f"{k}={json.dumps(x[k])}" for k in CURSOR_FIELDS if x.get(k) is not None and not isinstance(x[k], dict | list)}
            stack += x.values()
        elif isinstance(x, list):
            stack += x
    return sorted(found)


def sanitised(state: dict) -> dict:
    """The state without the writer's notes and without the sources of candidates."""
    out = {k: v for k, v in state.items() if k != "writer"}
    if isinstance(out.get("candidate_ref_details"), list):
        out["candidate_ref_details"] = [{k: v for k, v in d.items() if k != "sources"} if isinstance(d, dict) else d for d in out["candidate_ref_details"]]
    return out


def compacted(state: dict, keys: tuple[str, ...], most: int) -> dict:
    """The state with long lists cut to `most` and <key>_truncated telling how many went."""
    out = dict(state)
    for k in keys:
        if isinstance(out.get(k), list) and len(out[k]) > most:
            out[f"{k}_truncated"] = len(out[k]) - most
            out[k] = out[k][:most]
    return out


def operator_state(state: dict) -> dict:
    """Counts and phases that follow from the visible state; keys whose source is missing are left out."""
    lists = {k: state.get(k) if isinstance(state.get(k), list) else [] for k in ("candidate_ref_details", "candidate_refs", "known_refs", "last_observed_refs")}
    tool = state.get("last_tool") if isinstance(state.get("last_tool"), str) else None
    seen = len(lists["last_observed_refs"])
    phase = "start" if tool is None else f"after_{tool}" if tool != "kernel_near" else f"after_near_{'with' if seen else 'without'}_observed_refs"
    out = {
        "navigation_phase": phase, "last_tool": tool or "none", "last_observed_ref_count": seen, "candidate_ref_count": len(lists["candidate_refs"]),
        "candidate_detail_count": len(lists["candidate_ref_details"]), "known_ref_count": len(lists["known_refs"]),
        "has_candidate_details": bool(lists["candidate_ref_details"]), "has_observed_refs": bool(seen),
    }
    whole = lambda x: isinstance(x, int) and not isinstance(x, bool)
    budget, page = (state.get(k) if isinstance(state.get(k), dict) else {} for k in ("remaining_budget", "last_result_page"))
    if whole(budget.get("tool_calls")):
        out["remaining_tool_calls"] = budget["tool_calls"]
    for key, value in (("last_result_has_more", page.get("has_more")), ("last_result_partial", state.get("last_result_partial"))):
        if isinstance(value, bool):
            out[key] = value
    if tool == "kernel_trace":
        out["trace_complete"] = out.get("last_result_has_more") is False and out.get("last_result_partial") is False
    details = [d for d in lists["candidate_ref_details"] if isinstance(d, dict)]
    if details:
        leads = ("target_question", "current", "anchor")
        best = min(details, key=lambda d: (d.get("role") not in leads, d["priority"] if isinstance(d.get("priority"), int) else 10_000))
        kept = {k: best[k] for k in ("ref", "role", "relation_hint", "priority") if best.get(k) is not None}
        if kept:
            out["primary_candidate"] = kept
    return out


def with_request_hints(trajectory: dict) -> dict:
    """The trajectory with its target action's wishes in the visible state, and the marker that lets them pass the clean check.

    An aid for smoke runs, never for evaluation: a model that sees them can copy the answer.
    """
    state, action = trajectory.get("visible_state", {}), trajectory.get("target_action")
    out = {**trajectory, "request_hints_injected": True}
    if not isinstance(state, dict) or not isinstance(action, dict):
        return out
    tool, args = action.get("tool"), action.get("arguments")
    hints: dict = {}
    if action.get("kind") == "stop":
        hints["requested_stop"] = {k: v for k, v in action.items() if k in ("answer", "evidence", "reason")}
    elif action.get("kind") == "tool_call" and isinstance(tool, str) and isinstance(args, dict):
        moves = {"kernel_near": "around", "kernel_goto": "at", "kernel_rewind": "from", "kernel_forward": "from"}
        if tool in ("kernel_wake", "kernel_ask"):
            hints["requested_" + tool.removeprefix("kernel_")] = {k: v for k, v in args.items() if k != "about"}
        elif tool in moves:
            if args.get(moves[tool]) is not None:
                hints["requested_move"] = {"kind": tool, "cursor_key": moves[tool], "cursor": args[moves[tool]]}
            if isinstance(args.get("dimensions"), dict):
                hints["requested_scope"] = args["dimensions"]
            if bounds := {k: args[k] for k in ("include", "limit", "window", "budget") if k in args}:
                hints["requested_bounds"] = bounds
        elif tool == "kernel_trace":
            hints["requested_trace"] = dict(args)
        elif tool == "kernel_inspect":
            hints["inspection_request"] = dict(args)
    return {**out, "visible_state": {**state, **hints}}
