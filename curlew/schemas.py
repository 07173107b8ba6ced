"""The typed schemas of the records, as Spark types. JSON keys that a schema closes are checked in sources.jsonl."""

from __future__ import annotations

REFS = "array<string>"
COORDINATE = "struct<dimension:string,scope_id:string,observed_at:string,occurred_at:string,ingested_at:string,valid_from:string,valid_until:string,sequence:long,rank:long,metadata:map<string,string>>"
ENTRY = f"struct<id:string,kind:string,text:string,coordinates:array<{COORDINATE}>,metadata:map<string,string>>"
RELATION = "struct<`from`:string,`to`:string,rel:string,`class`:string,why:string,evidence:string,confidence:string,sequence:long>"
EVIDENCE = f"struct<id:string,supports:{REFS},text:string,source:string,time:string,metadata:map<string,string>>"
DIMENSION = "struct<id:string,kind:string,title:string,metadata:map<string,string>>"
MEMORY = f"struct<dimensions:array<{DIMENSION}>,entries:array<{ENTRY}>,relations:array<{RELATION}>,evidence:array<{EVIDENCE}>>"
PROVENANCE = "struct<source_kind:string,source_agent:string,observed_at:string,correlation_id:string,causation_id:string>"
CURSOR = f"struct<kind:string,target:string,anchor:string,dimensions:{REFS},key:string,`from`:string,`to`:string>"

#: The union of all tools' arguments; a tool uses its own.
ARGUMENTS = (
    f"struct<about:string,max_entries:long,query:string,anchor:string,dimensions:{REFS},`limit`:long,before_entries:long,after_entries:long,cursor:{CURSOR},"
    f"cursor_key:string,cursor_anchor:string,window:long,`from`:string,`to`:string,page:long,target:string,summary:string,body:string,related:{REFS},"
    f"memory:{MEMORY},provenance:{PROVENANCE},idempotency_key:string,dry_run:boolean>"
)
ACTION = f"struct<kind:string,tool:string,arguments:{ARGUMENTS},reason:string,answer:string,evidence:{REFS},target_model:string>"
BUDGET = "struct<calls_remaining:long,tokens_remaining:long>"
DEVIATION = "struct<deviation_milli:int,saturated:boolean,conflict_blocking:boolean>"
STATE = f"struct<known_refs:{REFS},known_dimensions:{REFS},active_cursor:{CURSOR},budget:{BUDGET},coverage_deviation:{DEVIATION},candidate_abouts:{REFS}>"
TRAJECTORY = f"id string, step_id string, about string, mode string, task_family string, goal string, allowed_tools {REFS}, visible_state {STATE}, target_action {ACTION}"

# Each tool's argument keys, those that must be there first.
ARGUMENT_KEYS = {
    "kernel_wake": (("about",), ("max_entries",)),
    "kernel_ask": (("query",), ()),
    "kernel_near": (("anchor",), ("dimensions", "limit", "before_entries", "after_entries")),
    "kernel_goto": (("cursor",), ()),
    "kernel_rewind": (("cursor_key", "cursor_anchor", "window"), ()),
    "kernel_forward": (("cursor_key", "cursor_anchor", "window"), ()),
    "kernel_trace": (("from", "page"), ("to",)),
    "kernel_inspect": (("target",), ()),
    "kernel_write_memory": (("summary", "body"), ("related",)),
    "kernel_ingest": (("about", "memory", "idempotency_key"), ("provenance", "dry_run")),
}
# The greatest sizes that the bounded check lets pass.
BOUNDS = {"limit": 64, "before_entries": 256, "after_entries": 256, "window": 64, "page": 256, "max_entries": 1024}
MOST_RELATED = 32
MOST_INGESTED = {"dimensions": 64, "entries": 256, "relations": 512, "evidence": 512}
