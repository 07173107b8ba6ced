"""Sessions of recorded steps: budgets, scopes, transcripts, oracles and accept rules, as windows over ordered steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curlew.operators import contracts


def ordered(session: str, order: str):
    return Window.partitionBy(session).orderBy(order)


def budget_left(steps: DataFrame, calls: Column, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """calls_left before each step, and budget_failed: a tool call with none left. Stops and escalations are allowed at zero."""
    before = ordered(session, order).rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum((F.col("kind") == "tool_call").cast("int")).over(before), F.lit(0))
    left = F.greatest(F.lit(0), calls - used)
    return steps.withColumn("calls_left", left).withColumn("budget_failed", (F.col("kind") == "tool_call") & (F.col("calls_left") <= 0))


def current_scope(steps: DataFrame, start: Column, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """current_about: the scope of the last successful wake before the step, else the request's."""
    before = ordered(session, order).rowsBetween(Window.unboundedPreceding, -1)
    woken = F.when((F.col("tool") == "kernel_wake") & F.col("succeeded"), F.col("wake_about"))
    return steps.withColumn("current_about", F.coalesce(F.last(woken, ignorenulls=True).over(before), start))


def new_refs(steps: DataFrame, refs: Column, known: Column, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """(session, order, new_refs): how many of a step's refs the session didn't know, repeats within the step counted each."""
    long = steps.select(session, order, F.explode(refs).alias("ref"), known.alias("known")).filter(~F.array_contains("known", F.col("ref")))
    first = long.groupBy(session, "ref").agg(F.min(order).alias("first"))
    found = long.join(first, [session, "ref"]).filter(F.col(order) == F.col("first")).groupBy(session, order).agg(F.count("*").alias("new_refs"))
    return steps.select(session, order).join(found, [session, order], "left").select(session, order, F.coalesce("new_refs", F.lit(0)).alias("new_refs"))


def expand_transcript(steps: DataFrame, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """Rows of a transcript that become trajectories: tool responses, and the terminal row of a completed or escalated session.
    Their ids count from zero over what is kept."""
    kept = steps.filter((F.col("observation") == "tool_response") | ((F.col("observation") == "terminal") & F.col("outcome").isin("completed", "escalated")))
    n = F.row_number().over(ordered(session, order)) - 1
    made = F.format_string("%s:%04d", F.col(session), n)
    return kept.withColumn("id", made).withColumn("step_id", F.concat(F.lit("step:"), made))


def last_signals(steps: DataFrame, signals: str, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """(session, signals) of the last step that has them, null if none has."""
    return steps.groupBy(session).agg(F.max_by(signals, F.when(F.col(signals).isNotNull(), F.col(order))).alias(signals))


def oracle(signals: Column, saturated: Column) -> Column:
    """complete: no further page and nothing missing or unvisited; else saturated; else incomplete with what remains."""
    remaining = signals["coverage_missing"] + signals["frontier_size"]
    label = F.when(signals.isNull(), "incomplete").when(~signals["page_has_more"] & (remaining == 0), "complete").when(F.coalesce(saturated, F.lit(False)), "saturated").otherwise("incomplete")
    return F.struct(label.alias("label"), F.when(label == "incomplete", F.coalesce(remaining, F.lit(0))).alias("remaining"))


def episode_drop(conflict: Column, covered: Column, expanded: Column, label: Column) -> Column:
    """Why an episode is dropped, or null: a conflict, missing gold refs, no expansion, then (without gold refs) the oracle's label.

    covered is null for an episode without expected refs; with them, they overrule the oracle.
    """
    return (
        F.when(conflict, "conflict").when(~F.coalesce(covered, F.lit(True)), "missing_gold").when(~expanded, "no_expansion")
        .when(covered.isNull() & (label != "complete"), label)
    )


def single_step(kind: Column, violations: Column, calls: Column, responded: Column) -> Column:
    """The outcome of a session of one step: the contract comes first, then ends, then the budget, then the tool's response."""
    return (
        F.when(F.size(violations) > 0, "contract_violation").when(kind == "stop", "completed").when(kind == "escalate", "escalated")
        .when(calls <= 0, "budget_exhausted").when(F.coalesce(responded, F.lit(False)), "completed").otherwise("mcp_execution_failure")
    )


def multi_step(requests: DataFrame, steps: DataFrame, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """steps up to the one that ends its session, with current_about, calls_left, known_refs (before the step), violations and outcome.

    requests: (session, about, mode, calls, state: schemas.STATE); steps: (session, order, action: schemas.ACTION, succeeded, refs),
    recorded in order. A step is held against the state that the executed ones before it have left: their refs are known, each
    call is spent, a successful wake moves the scope. A call without budget ends a session before its contract is looked at;
    a violation, a stop and an escalation end it too. outcome is null for executed calls.
    """
    both = steps.join(requests, session)
    before = ordered(session, order).rowsBetween(Window.unboundedPreceding, -1)
    action = F.col("action")
    calls, wakes = action["kind"] == "tool_call", (action["kind"] == "tool_call") & (action["tool"] == "kernel_wake")
    woken = F.last(F.when(wakes & F.col("succeeded"), action["arguments"]["about"]), ignorenulls=True).over(before)
    shown = F.flatten(F.collect_list(F.when(F.col("succeeded"), F.col("refs"))).over(before))
    out = both.withColumns({
        "calls_left": F.greatest(F.lit(0), F.col("calls") - F.coalesce(F.sum(calls.cast("int")).over(before), F.lit(0))),
        "current_about": F.coalesce(woken, F.col("about")), "known_refs": F.array_union(F.col("state")["known_refs"], shown),
    })
    state = F.col("state").withField("known_refs", F.col("known_refs")).withField("budget.calls_remaining", F.col("calls_left").cast("long"))
    scope = F.when(wakes, action["arguments"]["about"]).otherwise(F.col("current_about"))
    out = out.withColumn("violations", contracts.action_violations(F.struct(scope.alias("about"), F.col("mode"), state.alias("state"), action.alias("action"))))
    end = F.when(calls & (F.col("calls_left") <= 0), "budget_exhausted").when(F.size("violations") > 0, "contract_violation").when(action["kind"] == "stop", "completed").when(action["kind"] == "escalate", "escalated")
    out = out.withColumn("outcome", end)
    last = F.min(F.when(F.col("outcome").isNotNull(), F.col(order))).over(Window.partitionBy(session))
    return out.withColumn("__last", last).filter(F.col("__last").isNull() | (F.col(order) <= F.col("__last"))).drop("__last", "about", "state", "calls")


def session_outcomes(played: DataFrame, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """(session, outcome, steps, calls_left, about) of what multi_step gives; a session that no step ends is unfinished."""
    spent = (F.col("action")["kind"] == "tool_call") & F.col("outcome").isNull()
    return played.groupBy(session).agg(
        F.coalesce(F.max("outcome"), F.lit("unfinished")).alias("outcome"), F.count_if(spent).alias("steps"), (F.max_by(F.col("calls_left") - F.when(spent, 1).otherwise(0), order)).alias("calls_left"), F.max_by("current_about", order).alias("about"),
    )


def session_events(played: DataFrame, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """(session, order, seq, event, kind, tool, class): the log of a session, two rows for a call that was executed, one for a step
    that ends it, and a last one."""
    action = F.col("action")
    event = lambda name, seq, kind=None, tool=None, cls=None: F.struct(F.lit(seq).alias("seq"), F.lit(name).alias("event"), *(F.lit(None).cast("string").alias(n) if c is None else c.alias(n) for n, c in (("kind", kind), ("tool", tool), ("class", cls))))
    predicted = event("action_predicted", 1, action["kind"], action["tool"])
    seen = event("observation", 2, cls=F.when(F.col("succeeded"), "tool_response").otherwise("tool_error"))
    done = event("session_complete", 3, cls=F.col("outcome"))
    rows = F.when(F.col("outcome").isNull(), F.array(predicted, seen)).otherwise(F.array(predicted, done))
    return played.select(session, order, F.inline(rows))


def cross_accept(targets: Column, known: Column, conflict: Column) -> Column:
    """struct<accepted, missing>: an episode over several scopes is kept if the refs that each target expects are known and no conflict
    blocks; missing lists the scopes that lack some."""
    missing = F.transform(F.filter(targets, lambda t: F.size(F.array_except(t["expected_refs"], known)) > 0), lambda t: t["about"])
    return F.struct(((F.size(missing) == 0) & ~conflict).alias("accepted"), missing.alias("missing"))
