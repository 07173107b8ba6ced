import hashlib
import json

import pytest
from pyspark.sql import functions as F

from curlew import vocabulary
from curlew.functions import capabilities, hashing, responses, scores, shapes, text, walks
from curlew.operators import contracts
from curlew.plans import sft_prep


def value(spark, column, **named):
    df = spark.createDataFrame([tuple(named.values()) or (0,)], list(named) or ["x"])
    return df.select(column.alias("r")).first()["r"]


def fnv(data: bytes, seed: int) -> str:
    h = 0xCBF29CE484222325 ^ seed
    for b in data:
        h = ((h ^ b) * 0x100000001B3) % 2**64
    return f"{h:016x}"


@pytest.mark.parametrize("s", ["", "a", "conv:12", 'quote " and \\', "ñandú – 日本", "x" * 300])
def test_fnv_is_that_of_a_plain_loop(spark, s):
    assert value(spark, hashing.fnv1a64(F.col("s"), 7), s=s) == fnv(s.encode(), 7)
    assert value(spark, hashing.sha256(F.col("s")), s=s) == hashlib.sha256(s.encode()).hexdigest()


def test_json_string_is_json(spark):
    import json

    for s in ("", "a", 'q"\\', "ñ", "line\nfeed"):
        assert json.loads(value(spark, hashing.json_string(F.col("s")), s=s)) == s


def test_strings(spark):
    assert value(spark, text.trim(F.col("s")), s="  a b ") == "a b"
    assert value(spark, text.non_empty(F.col("s")), s=" ") is False
    assert value(spark, text.after_marker(F.col("s"), ":task:"), s="a:task:b:task:c:d") == "c"
    assert value(spark, text.after_marker(F.col("s"), ":task:"), s="abc") is None
    assert value(spark, text.numbered("ref", F.col("n")), n=12345) == "ref_12345"
    pairs = F.array(F.struct(F.lit("ab").alias("from"), F.lit("1").alias("to")), F.struct(F.lit("abc").alias("from"), F.lit("2").alias("to")))
    assert value(spark, text.replace_longest_first(F.col("s"), pairs), s="abcab") == "21"


@pytest.mark.parametrize("name, ok", [("supports", True), (" supports ", True), ("Supports", False), ("conflicts", False), ("contradicts", True), ("depends-on", False), ("my own", True), ("", False)])
def test_relation_spellings(spark, name, ok):
    assert value(spark, text.relation_accepted(F.col("s")), s=name) is ok


@pytest.mark.parametrize("s, end", [('{"a":1}', 7), ('{"a":"}"} x', 9), ('{"a":{"b":"\\"}"}}', 17), ('{"a":1', None), ("no", None)])
def test_first_complete_object(spark, s, end):
    assert value(spark, text.brace_end(F.col("s")), s=s) == end


def test_rates_and_rounding(spark):
    z, n = F.lit(0), F.lit(4)
    assert [value(spark, scores.rate(z, z, e)) for e in (0.0, None, 1.0)] == [0.0, None, 1.0]
    assert value(spark, scores.rate(F.lit(1), n)) == 0.25
    assert value(spark, scores.per_mille(F.lit(0.0005))) == 1 and value(spark, scores.per_mille(F.lit(2.0))) == 1000
    assert value(spark, scores.saturating(F.lit(5000000000))) == 4294967295
    assert value(spark, scores.window_labels(F.lit(6), F.lit(12))) == [] and value(spark, scores.window_labels(F.lit(7), F.lit(3))) == ["window:expand", "window:shrink"]


@pytest.mark.parametrize("args, said", [((False, True, 0, 1, True), "missing_baseline"), ((True, False, 1, 0, False), "missing_candidate"), ((True, True, 1, 2, False), "improved"), ((True, True, 2, 1, True), "regressed"), ((True, True, 2, 2, True), "stable_correct"), ((True, True, 2, 2, False), "stable_gap")])
def test_verdicts(spark, args, said):
    assert value(spark, scores.verdict(*(F.lit(a) for a in args))) == said


RESPONSES = [
    ("kernel_near", '{"entries":[{"ref":"a"},{"ref":"b"}]}', ["a", "b"]),
    ("kernel_goto", '{"entries":[{"ref":"a"},{}]}', None),
    ("kernel_ask", '{"because":[{"ref":"a"},{}],"answer":null}', ["a"]),
    ("kernel_trace", '{"trace":[{"from":"a","to":"b"},{"from":"b","to":"c"}]}', ["a", "b", "c"]),
    ("kernel_trace", '{"trace":[{"from":"a"}]}', None),
    ("kernel_inspect", '{"links":{"incoming":[{"from":"a","to":"t"}],"outgoing":[{"from":"t","to":"b"}]}}', ["t", "a", "b"]),
    ("kernel_wake", '{"causal_spine":[{"evidence_ref":"a"},{"evidence_ref":""}],"proof":{"evidence":[{"source":"b"},{"source":"a"}]}}', ["a", "b"]),
    ("kernel_ingest", '{"entries":[{"ref":"a"}]}', []),
]


@pytest.mark.parametrize("tool, body, refs", RESPONSES)
def test_refs_of_responses(spark, tool, body, refs):
    assert value(spark, responses.observed_refs(F.lit(tool), responses.variant(F.col("s")), F.lit("t")), s=body) == refs


def test_signals_tell_null_from_missing_and_types(spark):
    seen = F.array(F.lit("a"))
    s = value(spark, responses.navigation_signals(responses.variant(F.col("s")), seen), s='{"answer":null,"coverage":{"included":["x"],"missing":["y","z"]},"page":{"has_more":"yes","total":7,"returned":true},"proof":{"frontier_size":2,"conflicts":[1],"confidence":"unknown"},"links":{"incoming":[{"from":"a","to":"b"}]}}')
    assert (s.coverage_requested, s.coverage_missing, s.page_has_more, s.page_returned, s.page_total, s.frontier_size, s.conflicts, s.confidence_is_unknown, s.answer_is_null, s.unvisited_links, s.total_links) == (3, 2, False, 0, 7, 2, 1, True, True, 1, 2)
    assert value(spark, responses.navigation_signals(responses.variant(F.col("s")), seen), s="{}").answer_is_null is False


ACTIONS = [
    ('{"kind":"tool_call","tool":"kernel_inspect","arguments":{"target":"n"}}', None),
    ('{"kind":"tool_call","tool":"kernel_inspect","arguments":{"ref":"n"}}', "argument_keys:missing=target;unexpected=ref"),
    ('{"kind":"tool_call","tool":"kernel_inspect","arguments":{"target":" "}}', "invalid_target"),
    ('{"kind":"tool_call","tool":"kernel_near","arguments":{"anchor":"n","limit":65}}', "limit_over_64"),
    ('{"kind":"tool_call","tool":"kernel_near","arguments":{"anchor":"n","limit":true}}', "invalid_limit"),
    ('{"kind":"tool_call","tool":"kernel_near","arguments":{"anchor":"n","dimensions":["a",1]}}', "invalid_dimensions[1]"),
    ('{"kind":"tool_call","tool":"kernel_goto","arguments":{"cursor":{"kind":"ref","target":"n"}}}', None),
    ('{"kind":"tool_call","tool":"kernel_goto","arguments":{"cursor":{"kind":"temporal","key":"x","anchor":"n"}}}', "invalid_cursor_key"),
    ('{"kind":"tool_call","tool":"kernel_rewind","arguments":{"cursor_key":"created","cursor_anchor":"a","window":5}}', None),
    ('{"kind":"tool_call","tool":"kernel_fly","arguments":{}}', "unknown_tool"),
    ('{"kind":"stop","reason":"no_candidate"}', None),
    ('{"kind":"stop","reason":"tired"}', "invalid_stop_reason"),
    ('{"kind":"escalate","reason":"low_confidence","target_model":"m"}', None),
    ('{"kind":"dance"}', "unknown_action_kind"),
    ("[]", "action_not_object"),
    ('{"kind":"tool_call","tool":"kernel_ingest","arguments":{"about":"a","idempotency_key":"k","dry_run":true,"memory":{"dimensions":[],"entries":[{"id":"e","kind":"k","text":"t","coordinates":[{"dimension":"d","scope_id":"s"}]}]}}}', None),
    ('{"kind":"tool_call","tool":"kernel_ingest","arguments":{"about":"a","idempotency_key":"k","dry_run":true,"memory":{"dimensions":[],"entries":[]}}}', "empty_memory_entries"),
    ('{"kind":"tool_call","tool":"kernel_ingest","arguments":{"about":"a","idempotency_key":"k","memory":{"dimensions":[],"entries":[{"id":"e","kind":"k","text":"t","coordinates":[{"dimension":"d","scope_id":"s"}]}]}}}', "missing_dry_run"),
]


def ingest(relations=(), **parts):
    memory = {"dimensions": [{"id": "d", "kind": "k"}], "entries": [{"id": "e", "kind": "k", "text": "t", "coordinates": [{"dimension": "d", "scope_id": "s"}]}], "relations": list(relations), "evidence": []}
    args = {"about": "a", "idempotency_key": "k", "dry_run": True, "memory": memory | parts.pop("memory", {})} | parts
    return json.dumps({"kind": "tool_call", "tool": "kernel_ingest", "arguments": args})


PROOF = {"why": "w", "confidence": "high"}
coordinate = lambda **c: {"memory": {"entries": [{"id": "e", "kind": "k", "text": "t", "coordinates": [{"dimension": "d", "scope_id": "s"} | c]}]}}
relation = lambda rel, cls="evidential", **more: {"from": "a", "to": "b", "rel": rel, "class": cls} | more
ACTIONS += [
    (ingest([relation(name, cls[0], **PROOF)]), None) for name, (_, cls) in vocabulary.RELATION_CLASSES.items()
] + [
    (ingest([relation(name, **PROOF)]), "invalid_relation_rel[0]") for name in ("contains_entry", "has_dimension", "has_evidence", "records", "supports_answer")
] + [
    (ingest([relation("answers", "vague", **PROOF)]), "invalid_relation_class[0]"),
    (ingest([relation("contains", "structural")]), None),
    (ingest([relation("answers", confidence="high")]), "unproven_relation[0]"),
    (ingest([relation("answers", evidence="x")]), "missing_relation_confidence[0]"),
    (ingest([relation("answers", evidence="x", confidence="sure")]), "invalid_relation_confidence[0]"),
    (ingest([relation("contains", "structural", confidence="sure")]), "invalid_relation_confidence[0]"),
    (ingest([relation("contains", "structural", why="")]), "invalid_relation_why[0]"),
    (ingest([relation("contains", "structural", sequence=0)]), "invalid_relation_sequence[0]"),
    (ingest([relation("contains", "structural", note="x")]), "relation_keys:missing=;unexpected=note[0]"),
    (ingest(**coordinate(sequence=1, rank=2, observed_at="2024-01-01", metadata={"k": "v"})), None),
    (ingest(**coordinate(sequence=True)), "invalid_coordinate_sequence[0][0]"),
    (ingest(**coordinate(rank=0)), "invalid_coordinate_rank[0][0]"),
    (ingest(**coordinate(valid_from=" ")), "invalid_coordinate_valid_from[0][0]"),
    (ingest(**coordinate(metadata={"k": 1})), "invalid_coordinate_metadata[0][0]"),
    (ingest(**coordinate(metadata=[])), "invalid_coordinate_metadata[0][0]"),
    (ingest(**coordinate(extra=1)), "coordinate_keys:missing=;unexpected=extra[0][0]"),
    (ingest(memory={"evidence": [{"id": "e", "text": "t", "supports": ["a"], "time": "x"}]}), None),
    (ingest(memory={"evidence": [{"id": "e"}]}), "evidence_keys:missing=text;unexpected=[0]"),
    (ingest(memory={"dimensions": [{"id": "d", "kind": "k", "title": ""}]}), "invalid_dimension_title[0]"),
    (ingest(provenance={"source_kind": "agent", "source_agent": "x", "observed_at": "t"}), None),
    (ingest(provenance={"source_kind": "robot", "source_agent": "x", "observed_at": "t"}), "invalid_provenance_source_kind"),
    (ingest(provenance={"source_kind": "agent", "observed_at": "t"}), "provenance_keys:missing=source_agent;unexpected="),
    (ingest(provenance=None), "invalid_provenance"),
]


def test_relation_table(spark):
    rows = [(n, c) for n in [*vocabulary.RELATION_CLASSES, "has_evidence"] for c in vocabulary.CLASSES]
    df = spark.createDataFrame(rows, "rel string, cls string")
    for r in df.select("rel", "cls", *(x.alias(n) for x, n in zip(contracts.relation_facts(F.col("rel"), F.col("cls")), ("quality", "allowed"), strict=True))).collect():
        known = vocabulary.RELATION_CLASSES.get(r["rel"])
        assert (r["quality"], r["allowed"]) == ((known[0], r["cls"] in known[1]) if known else (None, None))


def test_shape_codes(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(ACTIONS)], "i int, s string")
    got = {r["i"]: r["p"] for r in df.select("i", shapes.action_problem(responses.variant(F.col("s"))).alias("p")).collect()}
    assert [got[i] for i in range(len(ACTIONS))] == [p for _, p in ACTIONS]


def test_shape_check_is_a_small_plan_and_decimals_are_no_whole_numbers(spark):
    near = '{"kind":"tool_call","tool":"kernel_near","arguments":{"anchor":"DECIMAL","limit":%s}}'
    cases = [(near % "5", None), (near % "5.0", "invalid_limit"), (near % "5e0", "invalid_limit"), (near % 2**63, "invalid_limit"), (near % 2000, "limit_over_64"), ("5.0", "action_not_object"), ("null", "action_not_object"), ("{", "action_not_object")]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, s string").select("i", responses.variant(F.col("s")).alias("v"))
    found = df.select("i", shapes.action_problem(F.col("v")).alias("p"))
    assert [r["p"] for r in found.orderBy("i").collect()] == [p for _, p in cases]
    # as one expression the check took a millisecond a row
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 10_000


@pytest.mark.parametrize("s, code", [("", "empty_response"), ('{"action":{"a":1}}', None), ('{"action":{', "incomplete_json"), ('{"action":{}} more', "extra_content_after_json"), ("hello", "invalid_json"), ("[1]", "json_not_object"), ('{"x":1}', "missing_or_extra_top_level_fields"), ('{"action":3}', "action_not_object")])
def test_response_codes(spark, s, code):
    assert value(spark, shapes.response_problem(F.col("s")), s=s) == code


def test_capabilities(spark):
    def caps(s):
        return set(value(spark, capabilities.trajectory(responses.variant(F.col("s"))), s=s))

    assert caps('{"mode":"read","target_action":{"kind":"stop"}}') == {"mode:read", "tool:stop", "window:stop_sufficient"}
    assert caps('{"target_action":{"kind":"tool_call","tool":"kernel_near","arguments":{"around":{"time":1,"sequence":2},"dimensions":{"mode":"only","scope":"abouts"},"window":{"before_entries":7},"limit":{"entries":3}}}}') == {"tool:kernel_near", "cursor:time", "dimensions.mode:only", "dimensions.scope:abouts", "window:expand", "window:shrink"}
    assert "trace.page:continue" in caps('{"target_action":{"kind":"tool_call","tool":"kernel_trace","arguments":{"page":{"cursor":"c"}}}}')
    assert {"writer.last_tool:none", "writer.candidate_role:current"} <= caps('{"mode":"writer_pre_read","visible_state":{"candidate_ref_details":[{"role":"current"}]},"target_action":{"kind":"stop"}}')


VISIBLE = [
    ({"current_ref": "r"}, {"r"}), ({"trace_target_ref": "r"}, {"r"}), ({"candidate_refs": ["r", 1]}, {"r"}), ({"known_refs": ["r"]}, {"r"}), ({"last_observed_refs": ["r"]}, {"r"}), ({"known_refs": "r"}, set()),
    ({"candidate_ref_details": [{"ref": "r"}, {"ref": 1}, "x"]}, {"r"}), ({"read_context": {"inspected_refs": ["a"], "temporal_refs": ["b"], "wake_refs": ["c"], "ask_refs": ["d"], "other_refs": ["e"]}}, {"a", "b", "c", "d"}),
    ({"read_context": {"trace_paths": [{"from": "a", "to": "b", "refs": ["c", 2]}, "x"]}}, {"a", "b", "c"}), ({"read_context": []}, set()),
    ({"draft_write": {"prepared_arguments": {"deep": ["incident:1", "plain", {"x": "q:task:9"}]}}}, {"incident:1", "q:task:9"}), ({"canonical_payload": "docs:7"}, {"docs:7"}), ({"elsewhere": "docs:7"}, set()),
]
call = lambda **a: {"kind": "tool_call", "tool": "t", "arguments": a}
TARGETS = [
    ({"kind": "stop", "evidence": ["a", 1, "b"]}, {"a", "b"}), ({"kind": "stop", "evidence": "a"}, set()), ({"kind": "stop"}, set()), ({"kind": "escalate", "evidence": ["a"]}, set()),
    (call(ref="a", **{"from": "b", "to": "c"}), {"a", "b", "c"}), (call(around={"ref": "a"}, at={"ref": "b"}, **{"from": {"ref": "c"}}), {"a", "b", "c"}), (call(connect_to=[{"ref": "a"}, {"ref": 3}, "x"]), {"a"}),
    (call(memory={"relations": [{"from": "a", "to": "b"}, {"from": 1}, "x"], "entries": [{"id": "e", "ref": "f"}]}), {"a", "b"}), (call(target="a", anchor="b", nested={"ref": "c", "target": "d"}), set()), (call(memory=[]), set()),
]


@pytest.mark.parametrize("state, refs", VISIBLE)
def test_every_source_of_visible_refs(state, refs):
    assert walks.visible_refs(state) == refs


@pytest.mark.parametrize("action, refs", TARGETS)
def test_every_place_of_target_refs(action, refs):
    assert walks.target_refs(action) == refs


def test_refs_and_scopes_get_numbers():
    for prefix in walks.TOPIC_PREFIXES + walks.RUN_PREFIXES:
        assert walks.is_ref(prefix + "x") and not walks.is_ref("x " + prefix)
    assert walks.is_ref("q:subtask:1") and walks.is_ref("q:task:1") and not walks.is_ref("task:1") and not walks.is_ref("node:1")
    t = {
        "about": "incident:7", "goal": "see incident:7", "id": "docs:1",
        "visible_state": {"known_refs": ["docs:2", "node:1", "docs:3"], "candidate_abouts": ["team", "docs:2"], "abouts": "docs:9"},
        "target_action": {"arguments": {"ref": "docs:3", "about": "team"}}, "quality": ["docs:2", "team"],
    }
    got = walks.anonymised(t)
    # docs:2 is named as a scope as well, so it is one
    assert got["about"] == "about_0001" and got["visible_state"] == {"known_refs": ["about_0002", "node:1", "ref_0001"], "candidate_abouts": ["about_0003", "about_0002"], "abouts": "ref_0002"}
    assert got["target_action"]["arguments"] == {"ref": "ref_0001", "about": "about_0003"} and got["quality"] == ["about_0002", "about_0003"]
    assert got["goal"] == t["goal"] and got["id"] == "docs:1" and got["ref_anonymization"] == {"mode": "per_trajectory", "ref_count": 2, "about_count": 3} and t["about"] == "incident:7"


def test_topic_prefixes_never_reach_a_model():
    say = lambda role, content: {"role": role, "content": content}
    for prefix in walks.TOPIC_PREFIXES:
        for role in ("user", "assistant"):
            assert sft_prep.leaks([say(role, f'{{"k":"in the middle {prefix}x"}}')]) == [prefix]
        assert sft_prep.leaks([say("system", prefix), say("user", "ref_0001"), say("assistant", "about_0001")]) == []
        t = {"goal": f"look at {prefix}x", "visible_state": {}, "target_action": {"kind": "stop"}}
        assert sft_prep.build_row(t, "system") == (None, sft_prep.TOPIC_LEFT)
    assert sft_prep.build_row({"goal": "look", "visible_state": {"known_refs": ["docs:1"]}, "target_action": {"kind": "stop", "evidence": ["docs:1"]}}, "system")[1] is None
    assert sft_prep.build_row({"goal": "look", "visible_state": {"known_refs": ["docs:1"]}, "target_action": {"kind": "stop", "evidence": ["docs:2"]}}, "system") == (None, "target_ref_not_visible")


def test_prompts_fit_their_profiles():
    for profile, tools in vocabulary.PROFILE_TOOLS.items():
        assert sft_prep.prompt_problem(profile, "use " + ", ".join(tools)) is None
        assert "lacks" in sft_prep.prompt_problem(profile, "use " + ", ".join(tools[1:]))
        for closed in vocabulary.CLOSED_TOOLS[profile]:
            assert "closed" in sft_prep.prompt_problem(profile, "use " + ", ".join([*tools, closed]))


def test_prepared_payloads_equal_their_target():
    args = {"about": "a", "x": [1, {"y": None}]}
    t = {"visible_state": {"draft_write": {"prepared_arguments": args}}, "target_action": {"kind": "tool_call", "tool": "kernel_write_memory", "arguments": args}}
    prepared = {"kind": "prepared_tool_call", "tool": "kernel_write_memory", "source": "draft_write.prepared_arguments"}
    assert walks.prepared_problem(t, prepared) is None
    assert walks.prepared_problem({**t, "target_action": {**t["target_action"], "arguments": {**args, "x": []}}}, prepared) == "payload_differs_from_target"
    assert walks.prepared_problem({**t, "target_action": {"kind": "stop"}}, prepared) == "payload_target_mismatch"
    assert walks.prepared_problem({**t, "visible_state": {}}, prepared) == "payload_not_visible" and walks.prepared_problem(t, {**prepared, "source": "canonical_payload"}) == "unsupported_payload_source"
    assert walks.prepared_problem(t, {**prepared, "arguments": {}}) == "prepared_call_keys"


def test_walks():
    names = {"b": "ref_0001", "a": "ref_0002", "x": "about_0001"}
    raw = {"s": ["a", {"k": "b"}], "goal": "ab"}
    shown = walks.alias_whole(raw, names)
    assert shown == {"s": ["ref_0002", {"k": "ref_0001"}], "goal": "ab"}
    back = walks.alias_pairs(raw, shown)
    assert walks.restore(shown, back) == raw
    with pytest.raises(ValueError):
        walks.restore({"x": "ref_0009"}, back)
    with pytest.raises(ValueError):
        walks.alias_pairs({"a": ["x"]}, {"a": []})
    with pytest.raises(ValueError):
        walks.alias_pairs({"a": "x", "b": "y"}, {"a": "ref_0001", "b": "ref_0001"})
    assert walks.alias_parts("aab", {"a": "1", "aa": "2"}) == "2b"
    assert walks.runtime_names("q", ["z", "a"], ["m", "a"]) == {"q": "about_0001", "a": "ref_0001", "z": "ref_0002", "m": "ref_0003"}
    assert walks.unclean_paths({"writer": 1, "requested_x": 2, "ok": ["writer_target_ref"]}) == ["$.ok[0]", "$.requested_x", "$.writer"]
    assert walks.unclean_paths({"requested_x": 2}, hints_allowed=True) == []
    assert walks.compacted({"k": [1, 2, 3]}, ("k",), 2) == {"k": [1, 2], "k_truncated": 1}
    assert walks.operator_state({"last_tool": "kernel_near", "last_observed_refs": ["a"], "remaining_budget": {"tool_calls": True}})["navigation_phase"] == "after_near_with_observed_refs"
