"""Corpus building, calibration and audits: recorded decisions, staged drop reasons, reports and gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.functions import responses, scores, shapes
from curlew.operators import reports
from curlew.vocabulary import ALL_TOOLS

# Why a row of a corpus is dropped, in the order in which it is looked at, and why a replayed call fails.
STAGES = ("teacher_error", "teacher_truncation", "parse_failure", "target_mismatch", "semantic_mismatch", "contract_violation", "trajectory_build")
REPLAY_FAILURES = ("transport", "protocol", "invalid_arguments", "malformed_response")


def drop_reason(**failed: Column) -> Column:
    """The first failing stage's name, or null; stages that aren't given pass."""
    return F.coalesce(*(F.when(F.coalesce(failed[s], F.lit(False)), F.lit(s)) for s in STAGES if s in failed), F.lit(None).cast("string"))


def target_matches(target: Column, action: Column) -> Column:
    """Whether an action is of the kind that a scenario is meant to lead to: a tool's name, stop or escalate."""
    return F.coalesce(F.when(action["kind"] == "tool_call", action["tool"] == target).otherwise(action["kind"] == target), F.lit(False))


def acceptance_matches(action: Column, stop_reason: Column, cursor_kind: Column) -> Column:
    """Whether an action meets what is expected of it beyond its target; what isn't expected is null."""
    same = lambda wanted, found: F.when(wanted.isNull(), True).otherwise(F.coalesce(found == wanted, F.lit(False)))
    return same(stop_reason, F.when(action["kind"] == "stop", action["reason"])) & same(cursor_kind, F.when(action["tool"] == "kernel_goto", action["arguments"]["cursor"]["kind"]))


def build_reason(teacher: Column, target: Column, action: Column, stop_reason: Column, cursor_kind: Column, violations: Column, problem: Column) -> Column:
    """The first stage that a decision fails, or null. teacher: null, or what went wrong in asking (shape, truncated, anything else);
    problem: why the trajectory can't be built."""
    return drop_reason(
        teacher_error=teacher.isNotNull() & ~teacher.isin("shape", "truncated"), teacher_truncation=teacher == "truncated", parse_failure=teacher == "shape",
        target_mismatch=~target_matches(target, action), semantic_mismatch=~acceptance_matches(action, stop_reason, cursor_kind), contract_violation=F.size(violations) > 0, trajectory_build=problem.isNotNull(),
    )


def decide(scenarios: DataFrame, recorded: DataFrame, prepared: str = "prepared_action") -> DataFrame:
    """scenarios with action: the prepared one, else the one recorded under the subject's hash. Only the others ask a provider."""
    return scenarios.join(recorded.select("subject_hash", F.col("action").alias("__recorded")), "subject_hash", "left").withColumn("action", F.coalesce(F.col(prepared), "__recorded")).drop("__recorded")


def with_provider(rows: DataFrame, provider, column: str = "action") -> DataFrame:
    """rows with column null filled by provider(list of subjects) -> list of actions, by Arrow batch on the executors."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            at, subject = batch.schema.get_field_index(column), batch.schema.get_field_index("subject")
            have = batch.column(at).to_pylist()
            asked = [i for i, a in enumerate(have) if a is None]
            for i, a in zip(asked, provider([batch.column(subject)[i].as_py() for i in asked]) if asked else [], strict=True):
                have[i] = a
            columns = list(batch.columns)
            columns[at] = pa.array(have, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def corpus_report(rows: DataFrame, reason: str = "drop_reason") -> DataFrame:
    """One row: total, accepted, dropped, drop_rate (1 for nothing)."""
    n, bad = F.count("*"), F.count_if(F.col(reason).isNotNull())
    return rows.agg(n.alias("total"), (n - bad).alias("accepted"), bad.alias("dropped"), scores.rate(bad, n, 1.0).alias("drop_rate"))


def by_target(rows: DataFrame, wanted: str = "target", actual: str = "actual_target", reason: str = "drop_reason") -> DataFrame:
    """(target, accepted, total): accepted rows count for what they are, dropped ones for what was asked."""
    target = F.when(F.col(reason).isNull(), F.col(actual)).otherwise(F.col(wanted))
    return rows.groupBy(target.alias("target")).agg(F.count_if(F.col(reason).isNull()).alias("accepted"), F.count("*").alias("total"))


def max_drop_rate(report: DataFrame, most: float) -> DataFrame:
    return reports.failing([("empty", F.col("total") > 0), ("drop_rate", F.col("drop_rate") <= most)], report)


def calibration(rows: DataFrame, capabilities: Sequence[str], overall: float = 0.80, floor: float = 0.60) -> tuple[DataFrame, DataFrame]:
    """rows (capability, matched) -> (by capability zero-filled with accuracy null for none, gate). The gate names the first
    capability in order that is under the floor, after the overall rate."""
    dim = rows.sparkSession.createDataFrame(list(enumerate(capabilities)), "place int, capability string")
    counts = rows.groupBy("capability").agg(F.count("*").alias("cases"), F.count_if("matched").alias("matched"))
    by = dim.join(counts, "capability", "left").select("place", "capability", F.coalesce("cases", F.lit(0)).alias("cases"), F.coalesce("matched", F.lit(0)).alias("matched"))
    by = by.withColumn("accuracy", scores.rate(F.col("matched"), F.col("cases"), None))
    low = F.min_by("capability", F.when(F.coalesce(F.col("accuracy"), F.lit(0.0)) < floor, F.col("place")))
    gate = by.agg(scores.rate(F.sum("matched"), F.sum("cases"), None).alias("overall"), low.alias("low"))
    first = F.when(F.coalesce("overall", F.lit(0.0)) < overall, "overall").otherwise(F.col("low"))
    return by.drop("place"), gate.select("overall", first.alias("first_failing"), first.isNull().alias("passed"))


def corpus_quality(trajectories: DataFrame, counters: dict[str, int], split: DataFrame | None = None, smoke_failures: int | None = None, ceiling_recorded: bool = False) -> list[str]:
    """The violated specifications of a corpus, in order: counters that aren't zero, missing tools, unsafe modes, splits, repeats."""
    from curlew.operators.contracts import mode_tools

    found = [name for name in ("schema_parse", "action_parse") if counters.get(name)]
    seen = {r[0] for r in trajectories.select("target_action.tool").distinct().collect()}  # at most ten tools
    if not set(ALL_TOOLS) <= seen:
        found.append("contract_coverage")
    tools = mode_tools(F.col("mode"))
    unsafe = ~F.col("allowed_tools").eqNullSafe(tools) | ((F.col("target_action.kind") == "tool_call") & ~F.array_contains(tools, F.col("target_action.tool")))
    if counters.get("mode_safety") or not trajectories.filter(unsafe).isEmpty():
        found.append("mode_safety")
    found += [name for name in ("reference_safety", "scope_safety", "pagination_safety", "write_proof", "no_gold_audit") if counters.get(name)]
    known = trajectories.select("step_id")
    if counters.get("episode_split") or split is None or not split_problem(split, known).isEmpty():
        found.append("episode_split")
    if counters.get("duplicate_audit") or not known.groupBy("step_id").count().filter("count > 1").isEmpty():
        found.append("duplicate_audit")
    if smoke_failures is None or smoke_failures > 0:
        found.append("replay_smoke")
    if not ceiling_recorded:
        found.append("frontier_ceiling")
    return found


def split_problem(split: DataFrame, known: DataFrame, key: str = "step_id") -> DataFrame:
    """Rows (key, problem) of a split (key, split): in several places, or not a known key."""
    again = split.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key, F.lit("repeated").alias("problem"))
    return again.unionByName(split.select(key).distinct().join(known, key, "left_anti").withColumn("problem", F.lit("unknown")))


def synthesize(spark: SparkSession, cases: Sequence[str], examples: int) -> DataFrame:
    """(case, index, id): `examples` rows for each case, with ids that don't depend on partitions."""
    dim = F.broadcast(spark.createDataFrame([(c,) for c in cases], "case string"))
    return spark.range(examples).withColumnRenamed("id", "index").join(dim).withColumn("id", F.format_string("synthetic:%s:%04d", "case", "index"))


def scenarios(spark: SparkSession, templates: Sequence[str], count: int, seed: int, most_variants: int | None = None) -> DataFrame:
    """(ordinal, template, variation, draw): rows go through the templates in turn; draw is a number in [0, 1) hashed from seed,
    template and variation."""
    n = len(templates)
    dim = F.broadcast(spark.createDataFrame(list(enumerate(templates)), "slot int, template string"))
    rows = spark.range(count).select(F.col("id").alias("ordinal"), (F.col("id") % n).cast("int").alias("slot"), F.floor(F.col("id") / n).alias("variation"))
    out = rows.join(dim, "slot").drop("slot")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), "template", F.col("variation").cast("string")))
    return out.withColumn("draw", F.conv(F.substr(key, F.lit(1), F.lit(13)), 16, 10).cast("double") / float(16**13))


def generation_report(rows: DataFrame, least: DataFrame) -> DataFrame:
    """One row: generated and satisfied over the cases of least (case, minimum)."""
    found = least.join(rows.groupBy("case").agg(F.count("*").alias("n")), "case", "left").select("minimum", F.coalesce("n", F.lit(0)).alias("n"))
    return found.agg(F.sum("n").alias("generated"), F.bool_and(F.col("n") >= F.col("minimum")).alias("all_satisfied"))


def pack(scenario_rows: DataFrame, places: DataFrame) -> DataFrame:
    """The scenarios of a pack in its order; unknown and repeated ids are errors."""
    found = places.join(scenario_rows, places["id"] == scenario_rows["scenario_id"], "left")
    bad = found.filter("scenario_id is null").limit(1).collect()
    if bad:
        raise ValueError(f"unknown scenario {bad[0]['id']}")
    if not places.groupBy("id").count().filter("count > 1").isEmpty():
        raise ValueError("a scenario is listed twice")
    return found.drop("id").orderBy("place")


def replay_report(rows: DataFrame) -> DataFrame:
    """rows (outcome success, failed or no_call) -> counts, and a success rate that is null if nothing was tried. No rows is an error."""
    out = rows.agg(F.count("*").alias("total"), *(F.count_if(F.col("outcome") == o).alias(o) for o in ("success", "failed", "no_call")))
    out = out.withColumn("success_rate", scores.rate(F.col("success"), F.col("success") + F.col("failed"), None))
    return out.withColumn("total", F.when(F.col("total") > 0, F.col("total")).otherwise(F.raise_error(F.lit("nothing to replay")).cast("long")))


def replay(actions: DataFrame, recorded: DataFrame) -> DataFrame:
    """actions (step_id, action) with outcome and reason by their recorded response (step_id, error, body), read as its tool's.

    A call without a record or with an unknown error fails in transport; a body that is no JSON object by the protocol; one
    that lacks refs which its tool's response must have is malformed.
    """
    both = actions.join(recorded, "step_id", "left").withColumn("__v", responses.variant(F.col("body")))
    tool = F.col("action.tool")
    refs = responses.observed_refs(tool, F.col("__v"), F.col("action.arguments.target"))
    reason = F.when(F.col("error").isin(*REPLAY_FAILURES), F.col("error")).when(F.col("error").isNotNull() | F.col("body").isNull(), "transport")
    reason = reason.when(F.coalesce(shapes.kind(F.col("__v")) != "object", F.lit(True)), "protocol").when(refs.isNull(), "malformed_response")
    call = F.col("action.kind") == "tool_call"
    both = both.withColumn("reason", F.when(call, reason)).drop("__v")
    return both.withColumn("outcome", F.when(~call, "no_call").when(F.col("reason").isNull(), "success").otherwise("failed"))


def generation_rows(rows: DataFrame, least: DataFrame) -> DataFrame:
    """(case, generated, minimum, satisfied) for every case of least."""
    found = least.join(rows.groupBy("case").agg(F.count("*").alias("generated")), "case", "left").select("case", F.coalesce("generated", F.lit(0)).alias("generated"), "minimum")
    return found.withColumn("satisfied", F.col("generated") >= F.col("minimum"))
