"""Policy evaluation: predictions against the truth of their steps, scored, reported and gated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.operators import contracts, joins, reports
from curlew.sources import jsonl
from curlew.vocabulary import ALL_TOOLS


def outcomes(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """(step_id, violations, exact, tool_match, stop_match, truth_is_stop, contract_valid, truth_tool) of predictions that have a
    truth. A prediction is held against the contract of the truth's scope, mode and state; of repeated truths the last counts."""
    both = joins.step_join(predictions.select("step_id", F.col("action").alias("said")), truth.select("step_id", "line_no", "about", "mode", "visible_state", "target_action"), order="line_no")
    row = F.struct("about", "mode", F.col("visible_state").alias("state"), F.col("said").alias("action"))
    checked = both.withColumn("violations", contracts.action_violations(row))
    return checked.select("step_id", "violations", *(c.alias(n) for n, c in contracts.outcome_columns(F.col("target_action"), F.col("said"), F.col("violations")).items()))


def evaluate(spark: SparkSession, predictions: str, truth: str, least_pass_rate: float | None = None) -> dict[str, DataFrame | bool]:
    """report (one row), by_tool, violations by code, and passed. No prediction with a truth is an error."""
    said, broken = jsonl.read_predictions(spark, predictions)
    # read and scored once, for the reports below
    scored = outcomes(said, jsonl.read_trajectories(spark, truth)).persist()
    if scored.isEmpty():
        raise ValueError("no prediction has a truth")
    report = reports.evaluation_report(scored, invalid=broken.count())
    codes = scored.select(F.explode("violations").alias("v")).groupBy(F.col("v.code").alias("code")).agg(F.count("*").alias("n"))
    passed = True if least_pass_rate is None else report.first()["exact_rate"] >= least_pass_rate
    return {"report": report, "by_tool": reports.evaluation_report(scored, by="truth_tool"), "codes": codes, "passed": passed}


def contract_coverage(trajectories: DataFrame) -> dict[str, DataFrame]:
    """kinds, tools (zero-filled), modes (read and write zero-filled), validity and the share of tools that occur."""
    a = trajectories.withColumn("violations", contracts.action_violations(F.struct("about", "mode", F.col("visible_state").alias("state"), F.col("target_action").alias("action"))))
    tools = reports.zero_filled(a.select(F.col("target_action.tool").alias("tool")), "tool", ALL_TOOLS)
    modes = reports.zero_filled(a, "mode", ("read", "write")).unionByName(a.filter("mode not in ('read', 'write')").groupBy("mode").agg(F.count("*").alias("n")))
    valid = a.agg(F.count_if(F.size("violations") == 0).alias("valid"), F.count_if(F.size("violations") > 0).alias("invalid"))
    share = tools.agg((F.count_if(F.col("n") > 0) / F.count("*")).alias("tool_share"))
    return {"kinds": a.groupBy(F.col("target_action.kind").alias("kind")).agg(F.count("*").alias("n")), "tools": tools, "modes": modes, "validity": valid.join(share)}


def compare_details(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two versions' details, as read by read_details, by step: scores, delta, verdict and capability."""
    from curlew.functions import scores
    from curlew.vocabulary import SCORE_KEYS

    both = joins.outer_delta(before.drop("line_no"), after.drop("line_no"), "step_id")
    b, a = F.col("before"), F.col("after")
    score = lambda s: F.when(s.isNull(), 0).otherwise(scores.row_score(s["prediction_status"] == "valid", [F.try_element_at(s["score"], F.lit(k)) for k in SCORE_KEYS]))
    rows = both.withColumn("before_score", score(b)).withColumn("after_score", score(a))
    said = scores.verdict(b.isNotNull(), a.isNotNull(), F.col("before_score"), F.col("after_score"), F.try_element_at(a["score"], F.lit("exact_action_correct")))
    return rows.select(
        "step_id", F.coalesce(a["target_capability_key"], b["target_capability_key"], F.lit("unknown")).alias("target_capability_key"), F.coalesce(a["target_action_label"], b["target_action_label"]).alias("target_action_label"),
        "before_score", "after_score", (F.col("after_score") - F.col("before_score")).alias("delta"), said.alias("verdict"), b["invalid_reason"].alias("before_invalid_reason"), a["invalid_reason"].alias("after_invalid_reason"),
    )


def restore_predictions(raw: DataFrame, model: DataFrame, predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(restored, failures): predictions with their aliases replaced by the refs of the k-th raw row of their step.

    raw, model, predictions: (line_no, step_id, raw) JSON lines. A prediction without an action takes no turn and fails.
    """
    import json

    import pyarrow as pa

    from curlew.functions import responses, walks

    numbered = predictions.withColumn("acts", F.try_variant_get(responses.variant(F.col("raw")), "$.action", "variant").isNotNull())
    side = lambda df, name: joins.number_occurrences(df.select("step_id", "line_no", F.col("raw").alias(name)), "step_id", "line_no").drop("line_no")
    rows = side(raw, "was").join(side(model, "shown"), ["step_id", "occurrence"], "full_outer")
    acting = joins.number_occurrences(numbered.filter("acts").select("step_id", "line_no", "raw"), "step_id", "line_no").join(rows, ["step_id", "occurrence"], "left")

    def one(was: str | None, shown: str | None, said: str) -> tuple[str | None, str | None]:
        if was is None or shown is None:
            return None, "missing_pair"
        try:
            names = walks.alias_pairs(json.loads(was), json.loads(shown))
            prediction = json.loads(said)
            return json.dumps({**prediction, "action": walks.restore(prediction["action"], names)}, sort_keys=True, separators=(",", ":")), None
        except ValueError as e:
            return None, str(e)

    def run(batches):
        for batch in batches:
            out = [one(*x) for x in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("was", "shown", "raw")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("step_id")), batch.column(batch.schema.get_field_index("line_no")), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string())], names=["step_id", "line_no", "raw", "failure"])

    done = acting.mapInArrow(run, "step_id string, line_no long, raw string, failure string")
    silent = numbered.filter("not acts").select("step_id", "line_no", F.lit(None).cast("string").alias("raw"), F.lit("missing_action").alias("failure"))
    return done.filter("failure is null").drop("failure"), done.filter("failure is not null").unionByName(silent).drop("raw")


def restore_summary(restored: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: selected, written, failures."""
    good = restored.agg(F.count("*").alias("written"))
    bad = failures.agg(F.count("*").alias("failures"))
    return good.join(F.broadcast(bad)).select((F.col("written") + F.col("failures")).alias("selected"), "written", "failures")


def failure_reasons(failures: DataFrame, column: str = "failure") -> DataFrame:
    """(reason, n): how often each reason occurs; null counts as unknown."""
    return reports.count_by(failures, F.col(column)).toDF("reason", "n")
