import json

import pytest
from pyspark.sql import functions as F

from curlew.functions import responses, walks
from curlew.plans import audits
from curlew.sources import jsonl
from curlew.vocabulary import ALL_TOOLS


def pick(spark, column, **named):
    return spark.createDataFrame([tuple(json.dumps(v) for v in named.values())], list(named)).select(column.alias("r")).first()["r"]


def v(name):
    return responses.variant(F.col(name))


def test_group_keys(spark):
    row = {"about": "about:1:task:t9:x", "step_id": "s", "mode": "read", "visible_state": {"task": {"task_type": "count"}}}
    got = [pick(spark, audits.group_key(v("r"), k), r=row) for k in ("mode", "run_id", "task_type", "task", "task_or_step")]
    assert got == ["read", "missing", "count", "t9", "t9"]
    assert pick(spark, audits.group_key(v("r"), "task_or_step"), r={"about": "a", "step_id": "s"}) == "s" and pick(spark, audits.group_key(v("r"), "task"), r={"about": "a"}) == "a"


def test_prepared_payloads_go_out_and_come_back(spark):
    args = {"about": "a", "idempotency_key": "k", "dry_run": True, "memory": {"dimensions": [], "entries": [{"id": "e", "kind": "k", "text": "t", "coordinates": [{"dimension": "d", "scope_id": "s"}]}]}}
    shown = pick(spark, audits.model_action(F.col("a"), "writer-exec"), a={"kind": "tool_call", "tool": "kernel_ingest", "arguments": args})
    assert json.loads(shown) == {"kind": "prepared_tool_call", "tool": "kernel_ingest", "source": "canonical_payload"}

    def back(user):
        df = spark.createDataFrame([(shown, json.dumps(user))], "a string, u string").select(v("a").alias("a"), v("u").alias("u"))
        return tuple(audits.resolve_prepared(df, "a", "u").select(F.to_json("resolved"), "resolve_error").first())

    full, error = back({"about": "a", "visible_state": {"canonical_payload": args}})
    assert error is None and json.loads(full)["arguments"] == args
    assert back({"about": "b", "visible_state": {"canonical_payload": args}})[1] == "about_mismatch"
    assert back({"about": "a", "visible_state": {}})[1] == "missing_prepared_payload"
    assert back({"about": "a"})[1] == "missing_visible_state"


@pytest.mark.parametrize("tools, problem", [(["kernel_near", "kernel_wake"], None), ("x", "allowed_tools_not_a_list"), (["kernel_near", "kernel_near"], "duplicate_allowed_tools"), (["kernel_ingest"], "tools_outside_profile:kernel_ingest"), ([""], "allowed_tools_not_strings")])
def test_allowed_tools_keep_the_profiles_order(spark, tools, problem):
    got = pick(spark, audits.allowed_tools(v("t"), "read"), t=tools)
    assert got["problem"] == problem and (problem or got["tools"] == ["kernel_wake", "kernel_near"])


def test_training_input(spark, tmp_path):
    def row(step, said, tools=("kernel_inspect",)):
        user = {"mode": "read", "allowed_tools": list(tools)}
        return {"step_id": step, "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": json.dumps(user)}, {"role": "assistant", "content": json.dumps({"action": said})}]}

    good = {"kind": "tool_call", "tool": "kernel_inspect", "arguments": {"target": "n"}}
    other = {"kind": "tool_call", "tool": "kernel_inspect", "arguments": {"target": "m"}}
    rows = [row("a", good), row("a", other), row("b", good), row("c", {"kind": "stop", "reason": "tired"}), row("d", {"kind": "tool_call", "tool": "kernel_ask", "arguments": {"query": "q"}}), {"step_id": "e", "messages": []}, row("f", good, ["kernel_ingest", "kernel_inspect"])]
    path = tmp_path / "rows.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    got = {r["line_no"]: r["problem"] for r in audits.training_input(jsonl.read_sft(spark, str(path))).collect()}
    assert got == {2: "duplicate_id", 3: "duplicate_messages", 4: "invalid_stop_reason", 5: "tool_not_allowed", 6: "not_three_messages", 7: "allowed_tools_outside_mode"}


def scenario(n, target="kernel_inspect", goal="Look around.", category="happy", criteria=None, refs=None, mode="read"):
    about = f"about:{n}"
    state = {"known_refs": refs if refs is not None else [f"{about}:node:1"], "known_dimensions": ["time"]}
    return {"scenario_id": f"scenario:{n}", "target": target, "subject": {"about": about, "mode": mode, "goal": goal, "visible_state": state}, "acceptance_criteria": criteria or {}, "metadata": {"theme": f"t{n % 5}", "category": category}}


def test_scenario_checks(spark, tmp_path):
    rows = [scenario(i, t) for i, t in enumerate((*[t for t in ALL_TOOLS if t not in ("kernel_near", "kernel_goto")], "escalate"))]
    rows += [scenario(20, "stop", criteria={"expected_stop_reason": "no_candidate"}), scenario(21, "kernel_near", goal="At about:21:node:1 over time."), scenario(22, "kernel_goto", criteria={"expected_cursor_kind": "ref"})]
    rows += [scenario(30, "kernel_near"), scenario(31, goal="Please call kernel_ask."), scenario(32, goal="This may require stopping.", category="adversarial"), scenario(33, refs=["node:1"]), scenario(34, criteria={"expected_stop_reason": "no_candidate"})]
    path = tmp_path / "s.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    got = {r["check"]: (r["problems"], r["examples"]) for r in audits.verify_scenarios(jsonl.lines(spark, str(path))).collect()}
    n = len(rows)
    assert {k: x[0] for k, x in got.items()} == {"refs_share_about": 1, "adversarial_goals": 1, "situational_goals": 1, "near_goals": 1, "acceptance": 1, "total_count": 1500 - n, "unique_abouts": 0, "modes": 2, "targets": 0, "themes": 0}
    assert got["near_goals"][1] == [n - 4]
    assert jsonl.read_session_scenarios(spark, str(path), modes=["read"], tools=["stop"], limit=3).count() == 1


def test_episodes_and_interleaving(spark, tmp_path):
    path = tmp_path / "e.jsonl"
    path.write_text('{"about":"a","goal":"g","initial_window":3,"max_iterations":4,"expected_refs":["x"]}\n{"targets":[{"about":"a","expected_refs":["x"]},{"about":"b","expected_refs":["y","x"]}],"goal":"g","initial_window":3,"max_iterations":4,"token_budget":10}\n')
    got = [tuple(r) for r in audits.compile_episodes(jsonl.read_episodes(spark, str(path))).orderBy("line_no").select("about", "calls", "token_budget", "expected_refs").collect()]
    assert got == [("a", 4, 8192, ["x"]), ("a", 8, 10, ["x", "y"])]
    assert audits.interleave([("p", "p1"), ("p", "p2"), ("q", "q1"), ("p", "p3")], ["p", "q"], ["x"]) == ["p1", "q1", "x", "p2", "p3"]


def test_request_hints_pass_the_clean_check_only_with_the_marker():
    t = walks.with_request_hints({"visible_state": {"known_refs": []}, "target_action": {"kind": "tool_call", "tool": "kernel_near", "arguments": {"around": {"ref": "n"}, "limit": {"entries": 3}}}})
    assert t["visible_state"]["requested_move"]["cursor"] == {"ref": "n"} and t["request_hints_injected"]
    assert walks.unclean_paths(t["visible_state"], True) == [] and walks.unclean_paths(t["visible_state"])
