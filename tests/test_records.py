"""Sources, contracts, plans and sessions over small records."""

import json

import pytest
from pyspark.sql import functions as F

from curlew.operators import contracts, dedup, filters, joins, reports, splits
from curlew.plans import corpus_build, policy_eval, sft_prep
from curlew.sources import jsonl, sinks
from curlew.streaming import coverage, sessions
from curlew.vocabulary import MODE_TOOLS


def call(tool, **args):
    return {"kind": "tool_call", "tool": f"kernel_{tool}", "arguments": args}


def trajectory(n, action, mode="read", about="about:1", **state):
    visible = {"known_refs": ["node:1", "node:2"], "known_dimensions": ["d1"], "active_cursor": None, "budget": {"calls_remaining": None, "tokens_remaining": None}} | state
    return {"id": f"traj:{n}", "step_id": f"step:{n}", "about": about, "mode": mode, "task_family": "read.inspect", "goal": "Look.", "allowed_tools": list(MODE_TOOLS[mode]), "visible_state": visible, "target_action": action}


MEMORY = {"dimensions": [], "entries": [{"id": "e1", "kind": "k", "text": "t", "coordinates": [{"dimension": "d1", "scope_id": "s"}]}], "relations": [], "evidence": []}
CASES = [
    (call("inspect", target="node:1"), "read", {}, []),
    (call("inspect", target="node:9"), "read", {}, ["unknown_memory_ref"]),
    (call("ingest", about="about:1", memory=MEMORY, idempotency_key="k"), "read", {}, ["tool_outside_mode"]),
    (call("wake", about="about:2"), "read", {}, ["about_mismatch"]),
    (call("near", anchor="node:1", dimensions=["d2"]), "read", {}, ["unknown_dimension"]),
    (call("goto", cursor={"kind": "around", "anchor": "node:9", "dimensions": ["d2"]}), "read", {}, ["unknown_memory_ref"]),
    (call("goto", cursor={"kind": "temporal", "key": "created", "anchor": "x"}), "read", {}, []),
    (call("trace", **{"from": "node:1", "to": "node:9", "page": 1}), "read", {}, ["unknown_memory_ref"]),
    (call("rewind", cursor_key="created", cursor_anchor="x", window=3), "read", {}, ["cursor_anchor_missing"]),
    (call("rewind", cursor_key="created", cursor_anchor="x", window=3), "read", {"active_cursor": {"kind": "temporal", "key": "created", "anchor": "y"}}, []),
    (call("inspect", target="node:9"), "read", {"budget": {"calls_remaining": 0}}, ["unknown_memory_ref", "budget_exhausted"]),
    ({"kind": "stop", "reason": "no_candidate"}, "read", {"budget": {"calls_remaining": 0}}, []),
    (call("write_memory", summary="s", body="b", related=["node:9"]), "write", {}, []),
    (call("ingest", about="about:1", memory=MEMORY, idempotency_key="k"), "write", {}, []),
    (call("ingest", about="about:1", memory={**MEMORY, "entries": [{**MEMORY["entries"][0], "coordinates": [{"dimension": "d9", "scope_id": "s"}]}]}, idempotency_key="k"), "write", {}, ["unknown_dimension"]),
    (call("ingest", about="about:1", memory={**MEMORY, "relations": [{"from": "e1", "to": "e9", "rel": "supports", "class": "structural"}], "evidence": [{"id": "v", "supports": ["e8"], "text": "t"}]}, idempotency_key="k"), "write", {}, ["unknown_memory_ref", "unknown_memory_ref"]),
]


def write(path, rows):
    path.write_text("".join(r + "\n" if isinstance(r, str) else json.dumps(r) + "\n" for r in rows))
    return str(path)


@pytest.fixture(scope="module")
def truth(tmp_path_factory):
    rows = [trajectory(i, a, m, **s) for i, (a, m, s, _) in enumerate(CASES)]
    return write(tmp_path_factory.mktemp("truth") / "t.jsonl", [*rows[:3], "", *rows[3:]])


def test_every_specification_and_its_violations(spark, truth):
    rows = jsonl.read_trajectories(spark, truth)
    found = rows.select("step_id", contracts.action_violations(F.struct("about", "mode", F.col("visible_state").alias("state"), F.col("target_action").alias("action"))).alias("v"), contracts.trajectory_problem(F.struct("mode", "allowed_tools", F.col("target_action").alias("action"))).alias("p"))
    got = {r["step_id"]: ([v["code"] for v in r["v"]], r["p"]) for r in found.collect()}
    for i, (a, m, _, codes) in enumerate(CASES):
        assert got[f"step:{i}"] == (codes, "tool_outside_mode" if a.get("tool") and a["tool"] not in MODE_TOOLS[m] else None), i


def test_line_numbers_count_blank_lines_and_keep_the_files_order(spark, tmp_path):
    a, b = write(tmp_path / "b.jsonl", ["{}", "", "{}"]), write(tmp_path / "a.jsonl", ["{}"])
    assert [(r["file_idx"], r["line_no"]) for r in jsonl.lines(spark, [a, b]).orderBy("file_idx", "line_no").collect()] == [(0, 1), (0, 3), (1, 1)]


def test_bad_lines_name_themselves(spark, tmp_path):
    bad = write(tmp_path / "x.jsonl", [json.dumps(trajectory(1, CASES[0][0])), "{oops"])
    with pytest.raises(Exception, match="line 2"):
        jsonl.read_trajectories(spark, bad).collect()


def test_predictions_are_routed(spark, tmp_path):
    p = write(tmp_path / "p.jsonl", [{"step_id": "a", "action": {"kind": "stop", "reason": "answer_ready", "final_refs": ["n"]}}, {"step_id": "b", "action": {"kind": "dance"}}, "", {"step_id": "c", "action": CASES[0][0]}])
    good, bad = jsonl.read_predictions(spark, p)
    got = {r["step_id"]: r for r in good.collect()}
    assert set(got) == {"a", "c"} and got["a"]["action"]["evidence"] == ["n"] and [(r["line_no"], r["message"]) for r in bad.collect()] == [(2, "unknown_action_kind")]
    with pytest.raises(Exception, match="bad step_id"):
        jsonl.read_predictions(spark, write(tmp_path / "q.jsonl", [{"step_id": " ", "action": {}}]))[0].collect()


def test_truth_as_prediction_scores_one(spark, truth, tmp_path):
    p = write(tmp_path / "p.jsonl", [{"step_id": f"step:{i}", "action": a} for i, (a, *_) in enumerate(CASES)])
    out = policy_eval.evaluate(spark, p, truth, 1.0)
    r = out["report"].first()
    assert r["exact_rate"] == 1.0 and out["passed"] and r["total"] == len(CASES) and r["stop_rate"] == 1.0
    assert r["contract_valid_count"] == sum(not c[3] for c in CASES)
    assert {x["truth_tool"] for x in out["by_tool"].collect()} == {a.get("tool") for a, *_ in CASES}


def test_equal_meanings_are_exact_and_others_not(spark, truth, tmp_path):
    p = write(tmp_path / "p.jsonl", [
        {"step_id": "step:4", "action": call("near", anchor="node:1", dimensions=["d2"], before_entries=0)}, {"step_id": "step:13", "action": call("ingest", about="about:1", memory=MEMORY, idempotency_key="k", dry_run=False)},
        {"step_id": "step:0", "action": call("inspect", target="node:2")}, {"step_id": "step:11", "action": {"kind": "stop", "reason": "answer_ready"}}, {"step_id": "nowhere", "action": CASES[0][0]}, {"step_id": "step:1", "action": {"kind": "dance"}},
    ])
    r = policy_eval.evaluate(spark, p, truth)["report"].first()
    assert (r["parsed"], r["total"], r["exact_count"], r["tool_count"], r["stop_matches"], r["stop_truths"]) == (4, 5, 2, 4, 0, 1)


def test_contract_coverage_is_zero_filled(spark, truth):
    out = policy_eval.contract_coverage(jsonl.read_trajectories(spark, truth))
    tools = {r["tool"]: r["n"] for r in out["tools"].collect()}
    assert len(tools) == 10 and tools["kernel_ask"] == 0 and tools["kernel_inspect"] == 3
    assert out["validity"].first()["valid"] == sum(not c[3] for c in CASES)


def test_duplicates_and_overlap(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "a")], "o int, d string")
    assert [r["o"] for r in dedup.cap_duplicates(df, "d", "o", 1).filter("not kept").orderBy("o").collect()] == [3, 4]
    assert tuple(dedup.duplicate_summary(df, "d").first()) == (4, 2, 1, 2, 3)
    assert [tuple(r) for r in dedup.repeated_keys(df, "d", "o").collect()] == [("a", 1, 3)]
    assert tuple(dedup.duplicate_summary(df.limit(0), "d").first()) == (0, 0, 0, 0, 0)
    kept, gone = joins.overlap(df.filter("o < 3"), df.filter("o >= 3"), "d")
    assert kept.count() == 0 and gone.count() == 2


def test_splits(spark):
    assert [splits.eval_size(n, r) for n, r in ((0, 0.5), (1, 0.9), (5, 0.5), (7, 0.5), (10, 0.01), (10, 0.0))] == [0, 1, 2, 4, 1, 0]
    assert [splits.tail_size(n, 0.1) for n in (1, 10, 11)] == [1, 1, 2]
    df = spark.createDataFrame([(i, f"g{i % 4}") for i in range(20)], "i int, g string")
    with pytest.raises(ValueError):
        splits.tail_split(df, ["i"], 20)
    assert sorted(r["i"] for r in splits.tail_split(df, ["i"], 3).filter("split = 'eval'").collect()) == [17, 18, 19]
    groups = splits.group_ratio_split(df, "g", F.concat(F.lit('"'), F.col("g"), F.lit('"')), 1.0, 3)
    assert {r["split"] for r in groups.collect()} == {"train", "eval"}  # never all of them
    cover = splits.capability_cover([("a", 5, {"x": 2}), ("b", 3, {"x": 2, "y": 1}), ("c", 1, {"y": 1})], ["x", "y"])
    assert cover == ["b"] and splits.capability_cover([("a", 1, {"x": 1})], ["x"], least_train=1) == []


def test_group_split_is_that_of_a_plain_loop(spark):
    import random

    rng = random.Random(3)
    rows = [(i, f"g{rng.randint(0, 30)}") for i in range(400)]

    def key(g):
        h = 0xCBF29CE484222325 ^ 11
        for b in json.dumps(g).encode():
            h = ((h ^ b) * 0x100000001B3) % 2**64
        return h, json.dumps(g)

    sizes = {}
    for _, g in rows:
        sizes[g] = sizes.get(g, 0) + 1
    wanted, have, chosen = splits.eval_size(400, 0.3), 0, set()
    for g in sorted(sizes, key=key):
        if have < wanted:
            chosen.add(g)
            have += sizes[g]
    df = spark.createDataFrame(rows, "i int, g string")
    got = splits.group_ratio_split(df, "g", F.concat(F.lit('"'), F.col("g"), F.lit('"')), 0.3, 11)
    assert {r["g"] for r in got.filter("split = 'eval'").collect()} == chosen


def test_reports(spark):
    df = spark.createDataFrame([("a", True), ("a", False), (None, True)], "k string, ok boolean")
    assert {tuple(r) for r in reports.count_by(df, F.col("k")).collect()} == {("a", 2), ("unknown", 1)}
    assert {tuple(r) for r in reports.zero_filled(df, "k", ["a", "b"]).collect()} == {("a", 2), ("b", 0)}
    with pytest.raises(ValueError):
        reports.failing([], df)
    by, gate = corpus_build.calibration(spark.createDataFrame([("a", True), ("a", False), ("b", True)], "capability string, matched boolean"), ["a", "b", "c"], overall=0.5)
    assert {r["capability"]: r["accuracy"] for r in by.collect()} == {"a": 0.5, "b": 1.0, "c": None} and gate.first()["first_failing"] == "a"
    empty = corpus_build.corpus_report(spark.createDataFrame([], "drop_reason string"))
    assert empty.first()["drop_rate"] == 1.0 and corpus_build.max_drop_rate(empty, 1.0).first()["first_failing"] == "empty"
    with pytest.raises(Exception, match="nothing to replay"):
        corpus_build.replay_report(spark.createDataFrame([], "outcome string")).collect()
    with pytest.raises(ValueError):
        filters.filter_by_mode(spark.createDataFrame([("read",)], "mode string"), ["write"])


def test_corpus_decisions_and_packs(spark):
    s = spark.createDataFrame([("h1", None, "scenario:1"), ("h2", "own", "scenario:2"), ("h3", None, "scenario:3")], "subject_hash string, prepared_action string, scenario_id string")
    rec = spark.createDataFrame([("h1", "rec")], "subject_hash string, action string")
    assert {r["subject_hash"]: r["action"] for r in corpus_build.decide(s, rec).collect()} == {"h1": "rec", "h2": "own", "h3": None}
    asked = corpus_build.with_provider(corpus_build.decide(s, rec).withColumn("subject", F.col("subject_hash")), lambda subjects: [f"asked {x}" for x in subjects])
    assert {r["subject_hash"]: r["action"] for r in asked.collect()} == {"h1": "rec", "h2": "own", "h3": "asked h3"}
    order = spark.createDataFrame([(1, "scenario:2"), (2, "scenario:1")], "place long, id string")
    assert [r["scenario_id"] for r in corpus_build.pack(s, order).collect()] == ["scenario:2", "scenario:1"]
    with pytest.raises(ValueError):
        corpus_build.pack(s, spark.createDataFrame([(1, "scenario:9")], "place long, id string"))
    assert corpus_build.synthesize(spark, ["a", "b"], 3).count() == 6
    assert corpus_build.scenarios(spark, ["t1", "t2"], 5, 1).filter("template = 't1'").count() == 3


def test_corpus_quality(spark, truth):
    t = jsonl.read_trajectories(spark, truth)
    split = t.select("step_id", F.lit("train").alias("split"))
    assert corpus_build.corpus_quality(t, {}, split, 0, True) == ["contract_coverage", "mode_safety"]
    assert "episode_split" in corpus_build.corpus_quality(t, {"write_proof": 1}, split.union(split.limit(1)), 0, True)


def test_sft_rows(spark, truth):
    out = sft_prep.prepare(jsonl.read_trajectories(spark, truth), "system", ratio=0.3, group_key="step_id", aliases=True)
    rows = {r["step_id"]: r for r in out.collect()}
    assert len(rows) == len(CASES)
    kept = [r for r in rows.values() if r["drop_reason"] is None]
    assert {r["split"] for r in kept} == {"train", "eval"}
    train = {r["digest"] for r in kept if r["split"] == "train"}
    assert not train & {r["digest"] for r in kept if r["split"] == "eval"}
    assert sft_prep.distributions(out).filter("split = 'all'").count() > 0


def test_restored_predictions(spark):
    pair = lambda n, a, s: (n, s, json.dumps(a))
    raw = spark.createDataFrame([pair(1, {"v": ["node:7", "node:8"]}, "s"), pair(2, {"v": ["node:9"]}, "s")], "line_no long, step_id string, raw string")
    model = spark.createDataFrame([pair(1, {"v": ["ref_0001", "ref_0002"]}, "s"), pair(2, {"v": ["ref_0001"]}, "s")], "line_no long, step_id string, raw string")
    said = [pair(1, {"step_id": "s", "action": {"t": "ref_0002"}}, "s"), pair(2, {"step_id": "s"}, "s"), pair(3, {"step_id": "s", "action": {"t": "ref_0001"}}, "s"), pair(4, {"step_id": "s", "action": {}}, "s")]
    good, bad = policy_eval.restore_predictions(raw, model, spark.createDataFrame(said, "line_no long, step_id string, raw string"))
    assert {r["line_no"]: json.loads(r["raw"])["action"]["t"] for r in good.collect()} == {1: "node:8", 3: "node:9"}
    assert {r["line_no"]: r["failure"] for r in bad.collect()} == {2: "missing_action", 4: "missing_pair"}


STEP = dict(coverage_requested=0, coverage_missing=0, page_has_more=False, page_returned=4, page_total=4, frontier_size=0, conflicts=0, confidence_is_unknown=False, answer_is_null=False, unvisited_links=0, total_links=3)


def test_coverage_fold_and_stream_agree(spark, tmp_path):
    schema = f"session_id string, step_idx int, signals struct<{', '.join(f.replace(' ', ':') for f in coverage.SIGNALS.split(', '))}>, new_refs long"
    steps = [("s", 0, {**STEP, "conflicts": 1}, 2), ("s", 1, STEP, 0), ("s", 2, STEP, 0), ("t", 0, {**STEP, "answer_is_null": True, "confidence_is_unknown": True}, 1)]
    df = spark.createDataFrame([(a, b, tuple(c.values()), d) for a, b, c, d in steps], schema)
    batch = {r["session_id"]: r["state"] for r in coverage.fold_steps(df).collect()}
    assert batch["s"]["conflict_blocking"] and batch["s"]["saturated"] and batch["s"]["steps"] == 3 and batch["t"]["deviation"] == pytest.approx(0.5 * (0.25 + 0.10) + 0.5)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = coverage.observe_stream(stream).writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["session_id"]: r for r in spark.table("states").collect()}
    for s, state in batch.items():
        assert (got[s]["deviation"], got[s]["saturated"], got[s]["stall_streak"], got[s]["steps"]) == (pytest.approx(state["deviation"]), state["saturated"], state["stall_streak"], state["steps"])


def test_oracle_and_drops(spark):
    s = F.struct(F.lit(0).alias("coverage_missing"), F.lit(0).alias("frontier_size"), F.lit(False).alias("page_has_more"))
    one = spark.range(1)
    nothing = F.lit(None).cast("struct<coverage_missing:int,frontier_size:int,page_has_more:boolean>")
    assert one.select(sessions.oracle(s, F.lit(True)).alias("o")).first()["o"]["label"] == "complete"
    assert tuple(one.select(sessions.oracle(nothing, F.lit(False)).alias("o")).first()["o"]) == ("incomplete", 0)
    drop = lambda *a: one.select(sessions.episode_drop(*(F.lit(x).cast("boolean") for x in a[:3]), F.lit(a[3])).alias("d")).first()["d"]
    assert [drop(True, False, False, "x"), drop(False, False, True, "x"), drop(False, True, False, "x"), drop(False, None, True, "saturated"), drop(False, True, True, "incomplete"), drop(False, None, True, "complete")] == ["conflict", "missing_gold", "no_expansion", "saturated", None, None]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, '{"b":1,"a":"ñ"}'), (1, "{}")], "n int, raw string")
    assert [r["raw"] for r in sinks.canonical_json(df, "raw").orderBy("n").collect()] == ["{}", '{"a":"\\u00f1","b":1}']
    import hashlib

    assert sinks.ordered_hash(df, "raw", ["n"]) == "sha256:" + hashlib.sha256('{}\n{"b":1,"a":"ñ"}\n'.encode()).hexdigest()
    assert sinks.unordered_hash(df, "raw").first()[0] == sinks.unordered_hash(df.orderBy(F.desc("n")), "raw").first()[0]
    with pytest.raises(ValueError):
        sinks.manifest("s", "sha256:00", 2, {"a": 1})
    sinks.write_lines(df, str(tmp_path / "out"), order="n")
    assert jsonl.lines(spark, str(tmp_path / "out")).count() == 2
    assert jsonl.group_values("b, a,,#c", ["a", "# x", " d "]) == ["a", "b", "d"]


def test_target_distributions(spark):
    links = [{"class": "structural", "why": "w", "evidence": "e"}, {"class": "structural", "why": " \u00a0", "evidence": "e"}, {"class": "structural", "why": "w"}, {"class": "causal", "why": "w", "evidence": "e"}, {"why": 1, "evidence": "e"}, "text"]
    actions = [
        ("train", call("ask", answer_policy="strict", budget={"detail": "full"})), ("eval", call("ask", answer_policy="", budget={"detail": 3}, dimensions={"scope_ids": []})),
        ("train", call("near", include={"raw_refs": True}, dimensions={"scope_ids": ["a"]})), ("train", call("inspect", include={"raw": False, "raw_refs": True})), ("train", call("wake", include={"raw": True}, budget=None)),
        ("train", call("write_memory", options={"dry_run": True, "strict": "yes"}, idempotency_key=None, read_context={}, current={"evidence": []}, source_kind="agent", connect_to=links)),
        ("eval", call("write_memory", options=[], current="text")),
        ("eval", call("ingest", dry_run=False, memory={"dimensions": [], "relations": [1], "evidence": {}}, provenance={})), ("train", {"kind": "stop", "tool": "kernel_ingest", "arguments": {}}),
    ]
    rows = [(json.dumps({"target_action": a}), s, None) for s, a in actions] + [(json.dumps({"target_action": actions[0][1]}), "train", "gone"), ("{}", "train", None), (json.dumps({"target_action": None}), "eval", None)]
    got = sft_prep.target_distributions(spark.createDataFrame(rows, "trajectory string, split string, drop_reason string")).collect()
    by = {}
    for r in got:
        by.setdefault(r["distribution"], {}).setdefault(r["split"], {})[r["label"]] = r["n"]
    proof = {"structural_with_proof": 1, "structural_without_proof": 2, "non_structural_complete": 1, "non_structural_incomplete": 1}
    want = {
        "answer_policy": ({"strict": 1}, {}), "budget_detail": ({"full": 1}, {"unspecified": 1}), "dimension_scope_ids": ({"present": 1}, {"absent": 1}),
        "raw_access": ({"temporal.raw_refs:true": 1, "inspect.raw:false": 1}, {}), "write_memory_options": ({"present": 1}, {"present": 1}),
        "write_memory_dry_run": ({"true": 1}, {"absent": 1}), "write_memory_strict": ({"invalid": 1}, {"absent": 1}), "write_memory_idempotency_key": ({"absent": 1}, {"absent": 1}),
        "write_memory_read_context": ({"present": 1}, {"absent": 1}), "write_memory_current_evidence": ({"present": 1}, {"absent": 1}), "write_memory_source_kind": ({"present": 1}, {"absent": 1}),
        "write_memory_relation_proof": (proof, {}), "ingest_dry_run": ({}, {"false": 1}), "ingest_dimensions": ({}, {"empty": 1}), "ingest_relations": ({}, {"non_empty": 1}),
        "ingest_evidence": ({}, {"invalid": 1}), "ingest_provenance": ({}, {"present": 1}),
    }
    assert set(by) == set(want) and len(want) == 17
    for name, (train, held) in want.items():
        both = {k: train.get(k, 0) + held.get(k, 0) for k in {*train, *held}}
        assert (by[name].get("train", {}), by[name].get("eval", {}), by[name]["all"]) == (train, held, both), name


def test_fan_out_gives_each_batch_to_all_sinks(spark):
    seen = []
    sinks.fan_out(lambda b, i: seen.append(("a", i, b.count())), lambda b, i: seen.append(("b", i, b.agg(F.sum("id")).first()[0])))(spark.range(4), 7)
    assert seen == [("a", 7, 4), ("b", 7, 6)]


def test_played_sessions_end_where_they_should(spark):
    """Budget before contract, a wake moves the scope only if it succeeds, refs of failed calls stay unknown."""
    from curlew import schemas

    state = '{"known_refs":["n"],"known_dimensions":[]}'
    requests = [("a", 3), ("b", 1), ("c", 9), ("d", 9)]
    wake = json.dumps(call("wake", about="other"))
    look = lambda ref: json.dumps(call("inspect", target=ref))
    stop = json.dumps({"kind": "stop", "reason": "no_candidate"})
    steps = [
        ("a", 0, look("n"), True, ["m"]), ("a", 1, look("m"), False, ["k"]), ("a", 2, look("k"), True, []), ("a", 3, stop, True, []),  # k was never seen
        ("b", 0, look("n"), True, []), ("b", 1, look("nowhere"), True, []), ("b", 2, stop, True, []),  # out of budget before the contract is looked at
        ("c", 0, wake, False, []), ("c", 1, wake, True, []), ("c", 2, look("n"), True, []), ("c", 3, stop, True, []), ("c", 4, look("n"), True, []),
        ("d", 0, look("n"), True, []),
    ]
    r = spark.createDataFrame(requests, "session_id string, calls int").select("session_id", "calls", F.lit("own").alias("about"), F.lit("read").alias("mode"), F.from_json(F.lit(state), schemas.STATE).alias("state"))
    s = spark.createDataFrame(steps, "session_id string, step_idx int, raw string, succeeded boolean, refs array<string>").withColumn("action", F.from_json("raw", schemas.ACTION))
    played = sessions.multi_step(r, s)
    got = {(x["session_id"], x["step_idx"]): (x["outcome"], x["current_about"], x["calls_left"]) for x in played.collect()}
    assert got == {
        ("a", 0): (None, "own", 3), ("a", 1): (None, "own", 2), ("a", 2): ("contract_violation", "own", 1), ("b", 0): (None, "own", 1), ("b", 1): ("budget_exhausted", "own", 0),
        ("c", 0): (None, "own", 9), ("c", 1): (None, "own", 8), ("c", 2): (None, "other", 7), ("c", 3): ("completed", "other", 6), ("d", 0): (None, "own", 9),
    }
    ends = {x["session_id"]: (x["outcome"], x["steps"], x["calls_left"], x["about"]) for x in sessions.session_outcomes(played).collect()}
    assert ends == {"a": ("contract_violation", 2, 1, "own"), "b": ("budget_exhausted", 1, 0, "own"), "c": ("completed", 3, 6, "other"), "d": ("unfinished", 1, 8, "own")}
    assert sessions.session_events(played).filter("session_id = 'c'").count() == 8


def test_a_topic_that_is_left_fails_the_build(spark):
    t = json.dumps({"step_id": "s", "goal": "look at incident:7", "mode": "read", "visible_state": {}, "target_action": {"kind": "stop"}})
    rows = spark.createDataFrame([(1, t)], "line_no long, raw string")
    with pytest.raises(Exception, match="topic's prefix is left in step s"):
        sft_prep.prepare(rows, "system").collect()
    with pytest.raises(ValueError, match="lacks tools"):
        sft_prep.prepare(rows, "system", profile="read")


def test_a_training_set_that_holds_all_eval_rows_is_an_error(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "digest string")
    with pytest.raises(ValueError):
        joins.without_overlap(rows, rows.limit(1), "digest")
    kept, dropped = joins.without_overlap(rows, spark.createDataFrame([("b",), ("c",)], "digest string"), "digest")
    assert [r[0] for r in kept.collect()] == ["c"] and [r[0] for r in dropped.collect()] == ["b"]


def test_artifacts_of_a_training_set(spark, tmp_path):
    made = [{"step_id": f"s{i}", "about": f"u{i % 5}", "mode": "read", "task_family": "t", "goal": f"look {i}", "visible_state": {"known_refs": [f"docs:{i}"]}, "target_action": {"kind": "stop", "reason": "answer_ready", "evidence": [f"docs:{i + i % 2}"]}} for i in range(20)]
    tagged = sft_prep.prepare(spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(made)], "line_no long, raw string"), "system", ratio=0.3).cache()
    sft_prep.write_artifacts(tagged, str(tmp_path / "out"))
    found = {p.name.split("=")[1]: [json.loads(x) for f in p.glob("*.txt") for x in f.read_text().splitlines()] for p in (tmp_path / "out").glob("artifact=*")}
    assert {k: len(v) for k, v in found.items() if "train" not in k and "eval" not in k} == {"all": 10, "all_trajectories": 10, "all_model_trajectories": 10, "openai_all": 10, "debug_audit": 20, "dropped_non_visible_target_refs": 10}
    for form in ("{}", "{}_trajectories", "{}_model_trajectories", "openai_{}"):
        assert len(found[form.format("train")]) + len(found[form.format("eval")]) == 10
    assert all(set(x) == {"messages"} and [m["role"] for m in x["messages"]] == ["system", "user", "assistant"] for x in found["openai_all"])
    assert {x["visible_state"]["known_refs"][0] for x in found["all_model_trajectories"]} == {"ref_0001"} and {x["about"] for x in found["all_model_trajectories"]} == {"about_0001"}
    assert {x["status"] for x in found["debug_audit"]} == {"kept", "dropped"}


def test_training_rows_are_made_once(spark):
    raw = json.dumps({"step_id": "s1", "about": "a", "goal": "g", "visible_state": {}, "target_action": {"kind": "stop", "reason": "answer_ready"}})
    tagged = sft_prep.prepare(spark.createDataFrame([(1, raw)], "line_no long, raw string"), "system")
    assert "MapInArrow" not in tagged._jdf.queryExecution().optimizedPlan().toString()
    assert tagged.count() == 1
