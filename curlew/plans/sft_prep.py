"""Training rows from trajectories: visible targets, clean states, aliases, caps, splits, overlap, one tagged table."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.functions import capabilities, labels, responses, walks
from curlew.operators import dedup, joins, reports, splits
from curlew.sources import sinks
from curlew.vocabulary import CAPABILITIES, CLOSED_TOOLS, PROFILE_TOOLS

TOPIC_LEFT = "topic_prefix_left"
STATUS = "line_no long, step_id string, mode string, task_family string, grp string, drop_reason string, messages string, trajectory string, model_trajectory string"
#: The file that takes the rows of a drop reason.
QUARANTINE = {
    "target_ref_not_visible": "dropped_non_visible_target_refs", "target_cursor_not_visible": "dropped_non_visible_target_cursors",
    "duplicate_model_row_cap": "dropped_duplicate_model_rows", "eval_model_row_overlap_with_train": "dropped_eval_model_row_overlap",
}


def build_row(t: dict, system: str, check_refs: bool = True, aliases: bool = True, most_refs: int = 64) -> tuple[str | None, str | None]:
    """(messages, null) or (null, why the trajectory is dropped)."""
    return build(t, system, check_refs, aliases, most_refs)[:2]


def build(t: dict, system: str, check_refs: bool = True, aliases: bool = True, most_refs: int = 64) -> tuple[str | None, str | None, str | None]:
    """(messages, null, the trajectory as the model sees it) or (null, why the trajectory is dropped, null)."""
    state = t.get("visible_state") if isinstance(t.get("visible_state"), dict) else {}
    action = t.get("target_action")
    if not isinstance(action, dict):
        return None, "missing_target_action", None
    if check_refs:
        if walks.target_refs(action) - walks.visible_refs(state):
            return None, "target_ref_not_visible", None
        if action.get("kind") == "tool_call" and set(walks.cursors(action.get("arguments") or {})) - set(walks.cursors(state)):
            return None, "target_cursor_not_visible", None
    state = walks.sanitised(state)
    state = {**state, "operator_state": walks.operator_state(state)}
    if walks.unclean_paths(state, bool(t.get("request_hints_injected"))):
        return None, "model_facing_state_not_clean", None
    t = {**t, "visible_state": state}
    if aliases:
        t = walks.anonymised(t)
    state = walks.compacted(t["visible_state"], ("candidate_refs", "known_refs", "last_observed_refs", "candidate_ref_details"), most_refs)
    dump = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"))
    user = dump({"goal": t.get("goal"), "mode": t.get("mode"), "visible_state": state})
    messages = [{"role": "system", "content": system}, {"role": "user", "content": user}, {"role": "assistant", "content": dump({"action": t["target_action"]})}]
    if leaks(messages):
        return None, TOPIC_LEFT, None
    return json.dumps(messages, sort_keys=True, separators=(",", ":"), ensure_ascii=False), None, dump(t)


def leaks(messages: list[dict]) -> list[str]:
    """Prefixes of topics that are left in what a model reads or says; the system's message may name them."""
    shown = [m["content"] for m in messages if m.get("role") in ("user", "assistant") and isinstance(m.get("content"), str)]
    return [p for p in walks.TOPIC_PREFIXES if any(p in text for text in shown)]


def prompt_problem(profile: str, system: str) -> str | None:
    """Why a system prompt doesn't fit its profile, or null: it has to name each of the profile's tools and none that is closed to it."""
    closed = [t for t in CLOSED_TOOLS[profile] if t in system]
    if closed:
        return f"prompt of {profile} names closed tools: {', '.join(closed)}"
    lacking = [t for t in PROFILE_TOOLS[profile] if t not in system]
    return f"prompt of {profile} lacks tools: {', '.join(lacking)}" if lacking else None


def rows(trajectories: DataFrame, system: str, group_key: str = "about", **options) -> DataFrame:
    """(line_no, raw) trajectories -> STATUS columns: messages, or a drop reason. Batches of Arrow: JSON has to be walked."""

    def run(batches):
        for batch in batches:
            out = []
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                t = json.loads(raw)
                messages, reason, model = build(t, system, **options)
                group = t.get(group_key)
                out.append((n, t.get("step_id"), t.get("mode"), t.get("task_family"), group if isinstance(group, str) and group else "unknown", reason, messages, raw, model))
            kinds = [pa.int64(), *[pa.string()] * 8]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=[f.split()[0] for f in STATUS.split(", ")])

    return trajectories.select("line_no", "raw").mapInArrow(run, STATUS)


def prepare(trajectories: DataFrame, system: str, ratio: float = 0.15, seed: int = 7, most_copies: int | None = None, group_key: str = "about", profile: str | None = None, **options) -> DataFrame:
    """STATUS columns with digest and split: train, eval or null for dropped rows, whose drop_reason says why.

    Groups go to one split as a whole. With a profile, eval first gets groups that cover its capabilities. Rows beyond
    most_copies of one digest go, and eval rows whose messages train has. A topic's prefix that is left in what a model sees fails
    the job, wherever it is: such a corpus mustn't be trained on. So does a prompt that doesn't fit the profile. Rows and groups are
    stored where driver and executors share files, since each is read many times.
    """
    if profile and (problem := prompt_problem(profile, system)):
        raise ValueError(problem)
    made = rows(trajectories, system, group_key, **options)
    leak = F.concat(F.lit("a topic's prefix is left in step "), F.coalesce("step_id", F.lit("without an id")))
    made = made.withColumn("drop_reason", F.when(F.col("drop_reason") == TOPIC_LEFT, F.raise_error(leak)).otherwise(F.col("drop_reason"))).withColumn("digest", F.sha2("messages", 256))
    made = sinks.stored(made, "training-rows")
    kept = made.filter("drop_reason is null")
    if most_copies is not None:
        capped = dedup.cap_duplicates(kept, "digest", "line_no", most_copies)
        made = made.filter("drop_reason is not null").unionByName(capped.withColumn("drop_reason", F.when(~F.col("kept"), F.lit("duplicate_model_row_cap"))).drop("kept", "duplicate_index"))
        kept = made.filter("drop_reason is null")
    from curlew.functions.hashing import json_string

    groups = splits.group_ratio_split(kept, "grp", json_string(F.col("grp")), ratio, seed).select("grp", "split")
    if profile:
        required = list(CAPABILITIES[profile])
        caps = kept.select("grp", F.explode(capabilities.trajectory(responses.variant(F.col("trajectory")))).alias("cap")).filter(F.col("cap").isin(*required))
        counts = caps.groupBy("grp", "cap").agg(F.count("*").alias("n")).groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("cap", "n"))).alias("caps"))
        from curlew.functions.hashing import stable_shuffle_key

        table = kept.groupBy("grp").agg(F.count("*").alias("rows")).join(counts, "grp", "left").orderBy(stable_shuffle_key(json_string(F.col("grp")), seed)).collect()
        chosen = splits.capability_cover([(r["grp"], r["rows"], r["caps"] or {}) for r in table], required)
        groups = groups.withColumn("split", F.when(F.col("grp").isin(*chosen), "eval").otherwise(F.col("split"))) if chosen else groups
    tagged = made.join(sinks.stored(groups, "training-groups"), "grp", "left").withColumn("split", F.when(F.col("drop_reason").isNull(), F.col("split")))
    held = tagged.filter("split = 'eval'")
    stays, gone = joins.overlap(tagged.filter("split = 'train'"), held, "digest")
    columns = [*made.columns, "split"]
    gone = gone.withColumn("drop_reason", F.lit("eval_model_row_overlap_with_train")).withColumn("split", F.lit(None).cast("string"))
    rest = tagged.filter("split is null or split = 'train'")
    return rest.select(*columns).unionByName(stays.select(*columns)).unionByName(gone.select(*columns))


def distributions(tagged: DataFrame) -> DataFrame:
    """(split, label, n) of the capabilities of kept rows, by split and over all."""
    kept = tagged.filter("drop_reason is null")
    return reports.label_distribution(kept, capabilities.trajectory(responses.variant(F.col("trajectory"))))


def target_distributions(tagged: DataFrame) -> DataFrame:
    """(distribution, split, label, n) of the target actions' labels of kept rows, by split and over all; a label counts as
    often as a row has it."""
    none = F.expr("cast(array() as array<string>)")
    named = lambda name, own: F.transform(F.coalesce(own, none), lambda x: F.struct(F.lit(name).alias("distribution"), x.alias("label")))
    each = F.flatten(F.array(*(named(name, own) for name, own in labels.target(F.col("__v")).items())))
    kept = tagged.filter("drop_reason is null").select("split", responses.variant(F.col("trajectory")).alias("__v"))
    by_split = kept.select("split", F.explode(each).alias("x")).groupBy("x.distribution", "split", "x.label").agg(F.count("*").alias("n"))
    return by_split.unionByName(by_split.groupBy("distribution", "label").agg(F.sum("n").alias("n")).withColumn("split", F.lit("all")))


def artifacts(tagged: DataFrame) -> DataFrame:
    """(artifact, line_no, raw): the lines of all files that a training set is published as, from what prepare gives.

    Kept rows, their trajectories as they came and as the model sees them, and the bare messages, each by split and over all;
    the rows of each drop reason with a file of its own; an audit line for every row with its status, split and reason.
    """
    messages = F.from_json("messages", "array<struct<content:string,role:string>>")
    row = F.to_json(F.struct(F.col("step_id").alias("id"), "step_id", "task_family", "mode", messages.alias("messages")))
    audit = F.to_json(F.struct("step_id", "mode", "task_family", F.col("grp").alias("group"), F.when(F.col("drop_reason").isNull(), "kept").otherwise("dropped").alias("status"), "split", "drop_reason"))
    line = lambda name, raw: F.struct(name.alias("artifact") if not isinstance(name, str) else F.lit(name).alias("artifact"), raw.alias("raw"))
    kept = []
    for form, raw in (("{}", row), ("{}_trajectories", F.col("trajectory")), ("{}_model_trajectories", F.col("model_trajectory")), ("openai_{}", F.to_json(F.struct(messages.alias("messages"))))):
        before, after = form.split("{}")
        kept += [line(F.concat(F.lit(before), F.col("split"), F.lit(after)), raw), line(form.format("all"), raw)]
    files = F.create_map(*(F.lit(x) for pair in QUARANTINE.items() for x in pair))
    gone = F.try_element_at(files, F.col("drop_reason"))
    none = F.array().cast("array<struct<artifact:string,raw:string>>")
    lines = F.when(F.col("drop_reason").isNull(), F.array(*kept)).when(gone.isNotNull(), F.array(line(gone, F.col("trajectory")))).otherwise(none)
    return tagged.select("line_no", F.inline(F.concat(F.array(line("debug_audit", audit)), lines))).select("artifact", "line_no", "raw")


def write_artifacts(tagged: DataFrame, path: str) -> None:
    """One folder of text lines for each artifact that has any, in one write."""
    artifacts(tagged).select("artifact", F.col("raw").alias("value")).write.partitionBy("artifact").mode("errorifexists").text(path)


def audit_no_gold(messages: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(line_no, pattern): a finding for each row and pattern that its messages match."""
    from curlew.functions.text import matches_any

    return messages.select("line_no", F.explode(matches_any(F.col("messages"), patterns)).alias("pattern"))
