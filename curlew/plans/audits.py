"""Row and scenario audits as Column rules and assertion queries: each gives a null or the first problem's code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions import responses, shapes, text
from curlew.functions.responses import string_at
from curlew.operators import reports
from curlew.vocabulary import ALL_TOOLS, CAPABILITIES, MODE_TOOLS, PROFILE_TOOLS, STOP_REASONS

# What scenario goals mustn't say, what they say when a target follows, and sizes that are asked for.
INSTRUCTIONS = (r"\bcall kernel_\w+", r"\buse kernel_\w+", r"\bexecute kernel_\w+", r"\bstop with\b", r"\bescalate with\b", r"\bwith page \d+", r"\bwith limit \d+", r"\bwith window \d+")
ADVERSARIAL = {
    "stop": (r"\bmay require stopping\b", r"\bstopping is the honest\b", r"\bbounded answer is to stop\b"),
    "escalate": (r"\bmay require escalation\b", r"\bneeds a larger reasoner\b", r"\bescalation is the bounded path\b"),
    "ambiguous": (r"\bhonesty requires\b",),
}
LEAST_SCENARIOS, LEAST_PRE_READ, LEAST_FULL, THEMES = 1500, 100, 50, 5
SCENARIO_CURSORS = ("ref", "temporal", "trace")


def group_key(row: Column, key: str) -> Column:
    """The group of a trajectory (VARIANT) for splits: a plain key, the task's type, or its id with fallbacks."""
    about = F.coalesce(string_at(row, "$.about"), F.lit("missing"))
    as_text = lambda path: F.try_variant_get(row, path, "string")
    if key in ("run_id", "about", "task_family", "mode"):
        return F.coalesce(as_text(f"$.{key}"), F.lit("missing"))
    if key == "task_type":
        return F.coalesce(as_text("$.visible_state.task.task_type"), text.after_marker(about, ":task_type:"), about)
    task = F.coalesce(as_text("$.visible_state.task.task_id"), as_text("$.visible_state.task.question_id"), as_text("$.visible_state.writer.question_id"), text.after_marker(about, ":task:"))
    return F.coalesce(task, F.coalesce(string_at(row, "$.step_id"), about) if key == "task_or_step" else about)


def model_action(action: Column, profile: str) -> Column:
    """An action's JSON as the model has to say it: writes name the prepared payload in the profiles that execute them."""
    tool = string_at(responses.variant(action), "$.tool")
    source = F.when(tool == "kernel_write_memory", "draft_write.prepared_arguments").when(tool == "kernel_ingest", "canonical_payload")
    if profile not in ("writer-exec", "writer-orchestration"):
        return action
    prepared = F.to_json(F.struct(F.lit("prepared_tool_call").alias("kind"), source.alias("source"), tool.alias("tool")))
    return F.when((string_at(responses.variant(action), "$.kind") == "tool_call") & source.isNotNull(), prepared).otherwise(action)


def resolve_prepared(df: DataFrame, action: str, user: str) -> DataFrame:
    """df with resolved (VARIANT) and resolve_error for its VARIANT columns action and user payload: the full call that a prepared
    one stands for, or why there is none. Other actions stay. Steps are columns of their own, so that none is computed twice."""
    a, u = F.col(action), F.col(user)
    tool, source = string_at(a, "$.tool"), string_at(a, "$.source")
    drafts, ingests = (tool == "kernel_write_memory") & (source == "draft_write.prepared_arguments"), (tool == "kernel_ingest") & (source == "canonical_payload")
    is_object = lambda v: F.coalesce(shapes.kind(v) == "object", F.lit(False))
    step = df.withColumns({
        "__prepared": F.coalesce(string_at(a, "$.kind") == "prepared_tool_call", F.lit(False)), "__state": shapes.at(u, "$.visible_state"), "__about": string_at(u, "$.about"),
        "__drafts": F.coalesce(drafts, F.lit(False)), "__ingests": F.coalesce(ingests, F.lit(False)), "__tool": tool,
    })
    draft = shapes.at(F.col("__state"), "$.draft_write")
    step = step.withColumn("__args", F.when(F.col("__drafts"), shapes.at(draft, "$.prepared_arguments")).when(F.col("__ingests"), shapes.at(F.col("__state"), "$.canonical_payload")))
    step = step.withColumn("__full", F.try_parse_json(F.concat(F.lit('{"kind":"tool_call","tool":"'), "__tool", F.lit('","arguments":'), F.to_json("__args"), F.lit("}"))))
    error = F.coalesce(
        F.when(~is_object(F.col("__state")), "missing_visible_state"), F.when(F.coalesce(F.length("__about"), F.lit(0)) == 0, "missing_about"),
        F.when(F.col("__drafts") & ~is_object(draft), "missing_draft_write"), F.when(~(F.col("__drafts") | F.col("__ingests")), "unsupported_prepared_payload_source"),
        F.when(~is_object(F.col("__args")), "missing_prepared_payload"), F.when(~string_at(F.col("__args"), "$.about").eqNullSafe(F.col("__about")), "about_mismatch"),
        F.concat(F.lit("resolved_action_invalid:"), shapes.action_problem(F.col("__full"))),
    )
    step = step.withColumn("resolve_error", F.when(F.col("__prepared"), error))
    step = step.withColumn("resolved", F.when(~F.col("__prepared"), a).when(F.col("resolve_error").isNull(), F.col("__full")))
    return step.drop("__prepared", "__state", "__about", "__drafts", "__ingests", "__tool", "__args", "__full")


def allowed_tools(tools: Column, profile: str) -> Column:
    """struct<tools, problem>: tools (VARIANT) in the profile's order, or why they can't be."""
    listed = F.try_variant_get(tools, "$", "array<variant>")
    names = F.transform(listed, lambda t: string_at(t, "$"))
    order = F.array(*(F.lit(t) for t in PROFILE_TOOLS[profile]))
    outside = F.array_sort(F.array_distinct(F.array_except(names, order)))
    problem = F.coalesce(
        F.when(tools.isNull(), "missing_allowed_tools"), F.when(listed.isNull(), "allowed_tools_not_a_list"), F.when(F.exists(names, lambda n: n.isNull() | (n == "")), "allowed_tools_not_strings"),
        F.when(F.size(F.array_distinct(names)) < F.size(names), "duplicate_allowed_tools"), F.when(F.size(outside) > 0, F.concat(F.lit("tools_outside_profile:"), F.array_join(outside, ","))),
    )
    return F.struct(F.when(problem.isNull(), F.filter(order, lambda t: F.array_contains(names, t))).alias("tools"), problem.alias("problem"))


def messages_problem(messages: Column) -> Column:
    """Of array<struct<role, content>>: three messages of the three roles in order, with content."""
    return (
        F.when(messages.isNull() | (F.size(messages) != 3), "not_three_messages").when(F.exists(messages, lambda m: F.coalesce(F.length(m["content"]), F.lit(0)) == 0), "message_without_content")
        .when(F.array_join(F.transform(messages, lambda m: F.coalesce(m["role"], F.lit(""))), ",") != "system,user,assistant", "unexpected_roles")
    )


def openai_problem(step_id: Column, messages: Column) -> Column:
    return F.coalesce(F.when(F.coalesce(F.length(step_id), F.lit(0)) == 0, "bad_step_id"), messages_problem(messages))


def training_problems(rows: DataFrame) -> DataFrame:
    """rows (step_id, messages, ...) with problem: what keeps a row from being trained on, or null. Repeats need training_input."""
    content = lambda i: responses.variant(F.try_element_at("messages", F.lit(i))["content"])
    step = rows.withColumns({"__user": content(2), "__said": content(3)})
    step = step.withColumns({"__action": shapes.at(F.col("__said"), "$.action"), "__tools": F.try_variant_get("__user", "$.allowed_tools", "array<string>"), "__mode": string_at(F.col("__user"), "$.mode")})
    step = resolve_prepared(step, "__action", "__user")
    user, action, tools = F.col("__user"), F.col("__action"), F.col("__tools")
    kind = string_at(action, "$.kind")
    table = F.create_map(*(x for m, names in MODE_TOOLS.items() for x in (F.lit(m), F.array(*(F.lit(t) for t in names)))))
    outside = F.size(F.array_except(tools, F.try_element_at(table, F.col("__mode")))) > 0
    problem = F.coalesce(
        messages_problem(F.col("messages")), F.when(F.coalesce(shapes.kind(user), F.lit("")) != "object", "user_message_not_object"),
        F.when(tools.isNull() | F.exists(tools, lambda t: F.coalesce(F.length(t), F.lit(0)) == 0), "allowed_tools_not_strings"), F.when(F.size(F.array_distinct(tools)) < F.size(tools), "duplicate_allowed_tools"),
        F.when(F.col("__mode").isNotNull() & outside, "allowed_tools_outside_mode"), F.when(F.coalesce(shapes.kind(action), F.lit("")) != "object", "missing_action"),
        F.when(F.coalesce(kind.isin("tool_call", "prepared_tool_call"), F.lit(False)) & ~F.array_contains(tools, string_at(action, "$.tool")), "tool_not_allowed"),
        F.when(kind == "prepared_tool_call", F.col("resolve_error")).otherwise(shapes.action_problem(action)),
    )
    return step.withColumn("problem", problem).drop("__user", "__said", "__action", "__tools", "__mode", "resolved", "resolve_error")


def training_input(rows: DataFrame, order: str = "line_no") -> DataFrame:
    """(order, problem) of rows (order, step_id, messages) that have one, repeated ids and messages among them."""
    from pyspark.sql import Window

    marked = training_problems(rows).withColumn("__h", F.sha2(F.to_json(F.struct("messages")), 256))
    nth = lambda key: F.row_number().over(Window.partitionBy(key).orderBy(order))
    out = marked.withColumns({"__i": nth("step_id"), "__m": nth("__h")})
    again = F.coalesce(F.when(F.col("step_id").isNotNull() & (F.col("__i") > 1), F.lit("duplicate_id")), F.when(F.col("__m") > 1, F.lit("duplicate_messages")), F.col("problem"))
    return out.withColumn("problem", again).filter("problem is not null").select(order, "problem")


def capability_supply(rows: DataFrame, group: str, capabilities: Column, profile: str, least_groups: int = 1, least_rows: int = 0) -> DataFrame:
    """(capability, rows, groups, problem) of the profile's capabilities that are missing or in short supply."""
    found = reports.capability_groups(rows, group, capabilities, CAPABILITIES[profile])
    problem = F.when(F.col("groups") == 0, "missing").when(F.col("groups") < least_groups, "too_few_groups").when(F.col("rows") < least_rows, "too_few_rows")
    return found.withColumn("problem", problem).filter("problem is not null")


def replay_stats(rows: DataFrame) -> DataFrame:
    """One row of (sessions, attempted, completed) of rows (tool, outcome)."""
    return rows.agg(F.count("*").alias("sessions"), F.count_if(F.col("tool").isNotNull()).alias("attempted"), F.count_if(F.col("outcome") == "completed").alias("completed"))


def outcome_counts(rows: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """(outcome, n) for all of outcomes, in any order."""
    return reports.zero_filled(rows, "outcome", list(outcomes))


def interleave(templates: Sequence[tuple[str, str]], targets: Sequence[str], extras: Sequence[str] = ()) -> list[str]:
    """Templates (target, slug): the first of each target, the extras, then the second of each, and so on."""
    by = {t: [s for target, s in templates if target == t] for t in targets}
    out = [by[t][0] for t in targets if by[t]] + list(extras)
    for n in range(1, max((len(v) for v in by.values()), default=0)):
        out += [by[t][n] for t in targets if n < len(by[t])]
    return out


def compile_episodes(episodes: DataFrame) -> DataFrame:
    """Requests from episodes (sources.read_episodes): calls are the iterations of each target, up to an unsigned 32-bit count."""
    from curlew.functions.scores import saturating

    calls = saturating(F.col("max_iterations") * F.greatest(F.lit(1), F.size("targets")))
    return episodes.select("line_no", F.element_at("targets", 1)["about"].alias("about"), F.transform("targets", lambda t: t["about"]).alias("candidate_abouts"), "goal", F.col("initial_window").alias("window"), calls.alias("calls"), "token_budget", "expected_refs")


def _scenario_rules(v: Column) -> dict[str, Column]:
    """Row rules: the problem's text, or null."""
    about, target, mode = string_at(v, "$.subject.about"), string_at(v, "$.target"), string_at(v, "$.metadata.category")
    goal = F.coalesce(string_at(v, "$.subject.goal"), F.lit(""))
    low = F.lower(goal)
    known = F.coalesce(F.try_variant_get(v, "$.subject.visible_state.known_refs", "array<string>"), F.array().cast("array<string>"))
    dims = F.coalesce(F.try_variant_get(v, "$.subject.visible_state.known_dimensions", "array<string>"), F.array().cast("array<string>"))
    stop, cursor = string_at(v, "$.acceptance_criteria.expected_stop_reason"), string_at(v, "$.acceptance_criteria.expected_cursor_kind")
    says = lambda patterns: low.rlike("|".join(patterns))
    is_target = lambda t: F.coalesce(target == t, F.lit(False))
    return {
        "refs_share_about": F.when(F.exists(known, lambda r: ~r.startswith(F.concat(about, F.lit(":node:")))), "a known ref lies outside the scenario"),
        "adversarial_goals": F.when(mode == "adversarial", F.when(says(ADVERSARIAL["ambiguous"]), "ambiguous phrase").when(says(ADVERSARIAL["stop"]) & (target != "stop"), "suggests stop").when(says(ADVERSARIAL["escalate"]) & (target != "escalate"), "suggests escalate")),
        "situational_goals": F.when((mode == "happy") & ~target.isin("kernel_ingest", "kernel_write_memory") & says(INSTRUCTIONS), "the goal instructs"),
        "near_goals": F.when(is_target("kernel_near") & ~(F.exists(known, lambda r: goal.contains(r)) & F.exists(dims, lambda d: goal.contains(d))), "no visible anchor and dimension in the goal"),
        "acceptance": F.when(is_target("stop") & ~F.coalesce(stop.isin(*STOP_REASONS), F.lit(False)), "a stop without its reason").when(is_target("kernel_goto") & ~F.coalesce(cursor.isin(*SCENARIO_CURSORS), F.lit(False)), "a goto without its cursor kind")
        .when(~is_target("stop") & stop.isNotNull(), "a reason without a stop").when(~is_target("kernel_goto") & cursor.isNotNull(), "a cursor kind without a goto"),
    }


def verify_scenarios(rows: DataFrame) -> DataFrame:
    """(check, problems, examples) for all ten checks of scenarios (line_no, raw): row rules, then those on the whole set."""
    v = F.col("__v")
    marked = rows.withColumn("__v", responses.variant(F.col("raw"))).select("line_no", string_at(v, "$.subject.about").alias("about"), string_at(v, "$.subject.mode").alias("mode"), string_at(v, "$.target").alias("target"), string_at(v, "$.metadata.theme").alias("theme"), *(p.alias(n) for n, p in _scenario_rules(v).items()))
    names = list(_scenario_rules(v))
    long = marked.select("line_no", F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("problem")) for n in names))).alias("c")).select("line_no", "c.*").filter("problem is not null")
    found = reports.first_examples(long, "line_no", "line_no", 10, ["check"]).withColumnRenamed("n", "problems")
    dim = rows.sparkSession.createDataFrame([(n,) for n in names], "check string")
    by_row = dim.join(found, "check", "left").select("check", F.coalesce("problems", F.lit(0)).alias("problems"), F.coalesce("examples", F.array().cast("array<bigint>")).alias("examples"))
    whole = marked.agg(
        F.count("*").alias("n"), F.countDistinct("about").alias("abouts"), F.count_if(F.col("mode") == "writer_pre_read").alias("pre"), F.count_if(F.col("mode") == "full").alias("full"), F.countDistinct("theme").alias("themes"),
        F.size(F.array_except(F.array(*(F.lit(t) for t in (*ALL_TOOLS, "stop", "escalate"))), F.collect_set("target"))).alias("missing"),
    )
    sums = {
        "total_count": F.greatest(F.lit(0), LEAST_SCENARIOS - F.col("n")), "unique_abouts": F.col("n") - F.col("abouts"), "modes": (F.col("pre") < LEAST_PRE_READ).cast("long") + (F.col("full") < LEAST_FULL).cast("long"),
        "targets": F.col("missing"), "themes": (F.col("themes") != THEMES).cast("long"),
    }
    stacked = whole.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), c.cast("long").alias("problems")) for n, c in sums.items()))).alias("c")).select("c.check", "c.problems", F.array().cast("array<bigint>").alias("examples"))
    return by_row.unionByName(stacked)
