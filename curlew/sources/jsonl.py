"""JSON Lines sources: numbered lines, typed rows, and quarantined ones.

A line's number orders rows where order has a meaning (first kept, last wins, k-th pairing). Spark's text reader gives none;
it is built from the file's place in the list, the split's start and the row's place in the split, without one task seeing
all lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew import schemas
from curlew.functions import responses, shapes
from curlew.operators.splits import global_sums


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file_idx, line_no from 1, raw) of non-blank lines; blank ones count for the numbers. Files keep the order given."""
    parts = []
    for i, path in enumerate([paths] if isinstance(paths, str) else paths):
        text = spark.read.text(path).select(F.lit(i).alias("file_idx"), F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__m"), F.col("value").alias("raw"))
        parts.append(text)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    per_file = global_sums(out, ["file_idx", "__f", "__b", "__m"], F.lit(1), "__n", F.struct("file_idx", "__f", "__b"))
    starts = per_file.groupBy("file_idx").agg((F.min("__n") - 1).alias("__start"))
    numbered = per_file.join(F.broadcast(starts), "file_idx").withColumn("line_no", F.col("__n") - F.col("__start"))
    return numbered.filter(F.length(F.trim("raw")) > 0).select("file_idx", "line_no", "raw")


def typed(rows: DataFrame, schema: str, raw: str = "raw", name: str = "row") -> DataFrame:
    """rows with the parsed struct, null where the line isn't an object of the schema."""
    return rows.withColumn(name, F.from_json(raw, schema))


def must(df: DataFrame, bad: Column, message: str, column: str = "raw") -> DataFrame:
    """df, where reading a row with bad raises with its line. The error sits in a column that all others are made of, since
    filters may be reordered."""
    where = F.concat(F.lit(f"{message}: line "), F.col("line_no").cast("string"))
    return df.withColumn(column, F.when(F.coalesce(bad, F.lit(False)), F.raise_error(where).cast("string")).otherwise(F.col(column)))


def read_trajectories(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Typed trajectories; the first bad line is an error. Unknown keys are tolerated, a bad action isn't."""
    rows = lines(spark, paths)
    v = responses.variant(F.col("raw"))
    rows = must(rows, v.isNull() | (shapes.kind(v) != "object"), "not a JSON object")
    rows = must(rows, F.try_variant_get(v, "$.target_action", "variant").isNull(), "no target_action")
    parsed = rows.withColumn("row", F.from_json("raw", schemas.TRAJECTORY))
    return parsed.select("file_idx", "line_no", "raw", *(F.col("row")[f.split()[0]].alias(f.split()[0]) for f in ("id s", "step_id s", "about s", "mode s", "task_family s", "goal s", "allowed_tools s", "visible_state s", "target_action s")))


def mapping_problem(action: Column) -> Column:
    """Why an action can't be typed, or null: unknown kinds, tools, reasons and keys, missing or wrongly typed arguments. Sizes
    have no upper bounds here and relations no closed list; shapes.action_problem has both."""
    from curlew.vocabulary import ALL_TOOLS, ESCALATE_REASONS, STOP_REASONS

    k, tool, reason = (F.try_variant_get(action, f"$.{n}", "string") for n in ("kind", "tool", "reason"))
    args = shapes.at(action, "$.arguments")
    out = F.lit(None).cast("string")
    for name, (required, optional) in schemas.ARGUMENT_KEYS.items():
        checks = [shapes.exact_keys(args, required, optional, "argument_keys")]
        for key in (*required, *optional):
            v = shapes.at(args, f"$.{key}")
            if key in schemas.BOUNDS:
                checks.append(F.when(v.isNotNull() & ((shapes.kind(v) != "integer") | (F.try_variant_get(v, "$", "bigint") < 0)), f"invalid_{key}"))
            elif key == "cursor":
                checks.append(shapes.cursor_problem(v))
            elif key not in ("dimensions", "related", "memory", "dry_run", "provenance"):
                checks.append(shapes.text_problem(v, key, key in optional))
        out = F.when(tool == name, F.coalesce(*checks)).otherwise(out)
    call = F.coalesce(F.when(~F.coalesce(tool.isin(*ALL_TOOLS), F.lit(False)), "unknown_tool"), F.when(F.coalesce(shapes.kind(args), F.lit("")) != "object", "arguments_not_object"), out)
    stop = F.coalesce(F.when(~F.coalesce(reason.isin(*STOP_REASONS), F.lit(False)), "invalid_stop_reason"), shapes.text_problem(shapes.at(action, "$.answer"), "answer", True))
    escalate = F.coalesce(F.when(~F.coalesce(reason.isin(*ESCALATE_REASONS), F.lit(False)), "invalid_escalate_reason"), shapes.text_problem(shapes.at(action, "$.target_model"), "target_model"))
    return F.when(action.isNull() | (shapes.kind(action) != "object"), "action_not_object").when(k == "tool_call", call).when(k == "stop", stop).when(k == "escalate", escalate).otherwise("unknown_action_kind")


def typed_action(raw_action: Column) -> Column:
    """A JSON action as struct; final_refs is another name of evidence."""
    parsed = F.from_json(raw_action, schemas.ACTION)
    alias = F.from_json(raw_action, "struct<final_refs:array<string>>")["final_refs"]
    return F.when(parsed.isNotNull(), parsed.withField("evidence", F.coalesce(parsed["evidence"], alias)))


def read_predictions(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(predictions, violations): (line_no, step_id, action) and (line_no, step_id, message).

    Lines that aren't JSON objects and bad step ids are errors; an action that can't be typed makes its line a violation.
    """
    v = F.col("__v")
    rows = lines(spark, paths).withColumn("__v", responses.variant(F.col("raw")))
    rows = must(rows, v.isNull() | (shapes.kind(v) != "object"), "not a JSON object")
    rows = must(rows, F.coalesce(F.length(F.trim(responses.string_at(v, "$.step_id"))), F.lit(0)) == 0, "bad step_id")
    # from the checked line on, each step is a column, so that none is computed twice
    rows = rows.withColumn("__v", responses.variant(F.col("raw"))).withColumns({"step_id": responses.string_at(v, "$.step_id"), "__a": F.try_variant_get(v, "$.action", "variant")})
    rows = rows.withColumn("message", mapping_problem(F.col("__a"))).withColumn("action", F.when(F.col("message").isNull(), typed_action(F.to_json("__a"))))
    return rows.filter("message is null").select("line_no", "step_id", "action"), rows.filter("message is not null").select("line_no", "step_id", "message")


def read_scenarios(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Scenarios as (line_no, raw, scenario_id, target, subject, ...): all are checked, then the first `limit` stay. No line is an error."""
    rows = lines(spark, path)
    v = responses.variant(F.col("raw"))
    rows = must(rows, v.isNull() | (shapes.kind(v) != "object") | responses.string_at(v, "$.scenario_id").isNull(), "not a scenario")
    if rows.isEmpty():
        raise ValueError("no scenarios")
    rows.agg(F.count("raw")).collect()  # every line is checked before any is left out
    subject = F.try_variant_get(v, "$.subject", "variant")
    out = rows.select(
        "line_no", "raw", responses.string_at(v, "$.scenario_id").alias("scenario_id"), responses.string_at(v, "$.target").alias("target"), responses.string_at(subject, "$.mode").alias("mode"), responses.string_at(subject, "$.about").alias("about"),
        F.sha2(F.to_json(subject), 256).alias("subject_hash"), F.to_json(subject).alias("subject"), responses.string_at(v, "$.acceptance_criteria.expected_stop_reason").alias("expected_stop_reason"), responses.string_at(v, "$.acceptance_criteria.expected_cursor_kind").alias("expected_cursor_kind"),
    )
    return out if limit is None else out.orderBy("line_no").limit(limit)


def read_episodes(spark: SparkSession, path: str, default_budget: int = 8192) -> DataFrame:
    """Window episodes and cross-scope ones: (line_no, targets, goal, initial_window, max_iterations, token_budget, expected_refs)."""
    schema = "about string, targets array<struct<about:string,expected_refs:array<string>>>, goal string, initial_window long, max_iterations long, token_budget long, expected_refs array<string>"
    rows = lines(spark, path).withColumn("r", F.from_json("raw", schema))
    rows = must(rows, F.col("r").isNull() | (F.coalesce(F.col("r.max_iterations"), F.lit(0)) < 1) | (F.coalesce(F.col("r.initial_window"), F.lit(0)) < 1), "not an episode").withColumn("r", F.from_json("raw", schema))
    one = F.array(F.struct(F.col("r.about").alias("about"), F.coalesce("r.expected_refs", F.array().cast("array<string>")).alias("expected_refs")))
    targets = F.coalesce("r.targets", one)
    return rows.select("line_no", targets.alias("targets"), "r.goal", "r.initial_window", "r.max_iterations", F.coalesce("r.token_budget", F.lit(default_budget)).alias("token_budget"), F.array_distinct(F.flatten(F.transform(targets, lambda t: t["expected_refs"]))).alias("expected_refs"))


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """Policy details with unique step ids; a missing or repeated one is an error."""
    from curlew.operators.dedup import repeated_keys

    schema = "step_id string, prediction_status string, predicted_action_label string, target_action_label string, target_capability_key string, invalid_reason string, score map<string,boolean>"
    rows = lines(spark, path).withColumn("r", F.from_json("raw", schema)).select("line_no", "r.*")
    rows = must(rows, F.col("step_id").isNull(), "no step_id", "step_id")
    again = repeated_keys(rows, "step_id", "line_no").limit(1).collect()
    if again:
        raise ValueError(f"repeated step_id {again[0]['step_id']}")
    return rows


def read_pack(spark: SparkSession, path: str, prefix: str = "scenario:") -> DataFrame:
    """(place, id) of a pack file: trimmed lines that aren't blank or comments; each must have the prefix."""
    rows = lines(spark, path).withColumn("id", F.trim("raw")).filter(~F.col("id").startswith("#"))
    return must(rows, ~F.col("id").startswith(prefix), f"no {prefix}", "id").select(F.col("line_no").alias("place"), "id")


def group_values(listed: str, lines_of_file: Sequence[str] = ()) -> list[str]:
    """Sorted different values of a comma list and of a file's lines; blank ones and comments are left out."""
    return sorted({v for v in (x.strip() for x in [*listed.split(","), *lines_of_file]) if v and not v.startswith("#")})


def read_calibration(spark: SparkSession, path: str) -> DataFrame:
    """Calibration cases: (line_no, case_id, domain_theme, category, subject, accepted); one to three accepted actions each."""
    rows = lines(spark, path)
    v = responses.variant(F.col("raw"))
    accepted = F.try_variant_get(v, "$.accepted_actions", "array<variant>")
    rows = must(rows, responses.string_at(v, "$.case_id").isNull() | ~F.coalesce(F.size(accepted).between(1, 3), F.lit(False)), "not a calibration case")
    return rows.select("line_no", *(responses.string_at(v, f"$.{n}").alias(n) for n in ("case_id", "domain_theme", "category")), F.to_json(F.try_variant_get(v, "$.subject", "variant")).alias("subject"), F.transform(accepted, lambda a: F.to_json(a)).alias("accepted"))


def read_sft(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Training rows (line_no, step_id, messages); a line without messages is an error."""
    rows = lines(spark, paths)
    parsed = F.from_json("raw", "id string, step_id string, messages array<struct<role:string,content:string>>")
    rows = must(rows, parsed["messages"].isNull(), "no messages")
    return rows.select("line_no", F.coalesce(parsed["step_id"], parsed["id"]).alias("step_id"), parsed["messages"].alias("messages"))


def read_session_scenarios(spark: SparkSession, path: str, modes: Sequence[str] = (), tools: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Scenarios for sessions: the mode filter, the tool filter (a null tool goes), and only then the limit."""
    from curlew.operators.filters import included

    rows = read_scenarios(spark, path).filter(included(F.col("mode"), modes) & included(F.col("target"), tools))
    return rows if limit is None else rows.orderBy("line_no").limit(limit)
