"""The running estimate of how far a session's context is from what its task needs, as a fold over its steps.

The fold is order-dependent (a minimum over smoothed values), so a session's steps meet in one place: their number is bounded
by the session's budget, not by the input. fold_steps is the batch form; observe_stream is the same fold over a stream, with
each session's estimate kept as state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of the gaps, smoothing, the conflicts and links that saturate, and the stalled steps.
WEIGHTS = {"dim": 0.20, "page": 0.15, "proof": 0.25, "conflict": 0.15, "frontier": 0.15, "answer": 0.10}
SMOOTHING = 0.5
CONFLICTS_FULL = 3.0
FRONTIER_HALF = 2.0
STALLED_STEPS = 2

SIGNALS = (
    "coverage_requested long, coverage_missing long, page_has_more boolean, page_returned long, page_total long, frontier_size long, conflicts long, "
    "confidence_is_unknown boolean, answer_is_null boolean, unvisited_links long, total_links long"
)
STATE = "deviation double, dim_gap double, saturated boolean, conflict_blocking boolean, stall_streak int, last_yield long, steps int"


def _ratio(part: Column, whole: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")))


def gaps(s: Column) -> dict[str, Column]:
    """The six gaps of a step's signals, each from 0 to 1."""
    frontier = s["frontier_size"].cast("double")
    return {
        "dim": _ratio(s["coverage_missing"], s["coverage_requested"]),
        "page": F.when(s["page_has_more"], _ratio(F.greatest(F.lit(0), s["page_total"] - s["page_returned"]), s["page_total"])).otherwise(F.lit(0.0)),
        "proof": F.when(s["confidence_is_unknown"], F.lit(1.0)).otherwise(frontier / (frontier + FRONTIER_HALF)),
        "conflict": F.least(F.lit(1.0), s["conflicts"].cast("double") / CONFLICTS_FULL),
        "frontier": _ratio(s["unvisited_links"], s["total_links"]),
        "answer": F.when(s["answer_is_null"], F.lit(1.0)).otherwise(F.lit(0.0)),
    }


def step_deviation(s: Column) -> Column:
    found = gaps(s)
    out = F.lit(WEIGHTS["dim"]) * found["dim"]
    for name in ("page", "proof", "conflict", "frontier", "answer"):
        out = out + F.lit(WEIGHTS[name]) * found[name]
    return out


def ratchet(values: Column, start: float = 1.0, alpha: float = SMOOTHING) -> Column:
    """The smoothed value that only falls, after all values of an array in order."""
    return F.aggregate(values, F.lit(float(start)), lambda acc, v: F.least(acc, F.lit(alpha) * v + F.lit(1 - alpha) * acc))


def fold_steps(steps: DataFrame, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """steps (session, order, signals struct, new_refs) -> (session, state struct) after the last step."""
    step = F.struct(F.col(order).alias("at"), F.struct(*(F.col("signals")[n.split()[0]].alias(n.split()[0]) for n in SIGNALS.split(", "))).alias("signals"), F.col("new_refs").cast("long").alias("new_refs"))
    first = F.struct(
        F.lit(1.0).alias("deviation"), F.lit(0.0).alias("dim_gap"), F.lit(False).alias("saturated"), F.lit(False).alias("conflict_blocking"),
        F.lit(0).alias("stall_streak"), F.lit(0).cast("long").alias("last_yield"), F.lit(0).alias("steps"),
    )

    def observe(s: Column, x: Column) -> Column:
        dim = gaps(x["signals"])["dim"]
        smoothed = F.lit(SMOOTHING) * step_deviation(x["signals"]) + F.lit(1 - SMOOTHING) * s["deviation"]
        streak = F.when((x["new_refs"] == 0) & (dim >= s["dim_gap"]), s["stall_streak"] + 1).otherwise(F.lit(0))
        return F.struct(
            F.least(s["deviation"], smoothed).alias("deviation"), dim.alias("dim_gap"), (streak >= STALLED_STEPS).alias("saturated"),
            (s["conflict_blocking"] | (x["signals"]["conflicts"] > 0)).alias("conflict_blocking"), streak.alias("stall_streak"), x["new_refs"].alias("last_yield"), (s["steps"] + 1).alias("steps"),
        )

    return steps.groupBy(session).agg(F.aggregate(F.array_sort(F.collect_list(step)), first, observe).alias("state"))


def observe_once(state: tuple, signals: dict, new_refs: int) -> tuple:
    """One step of the fold on plain values: (deviation, dim_gap, saturated, conflict_blocking, stall_streak, last_yield, steps)."""
    part = lambda a, b: min(1.0, max(0.0, a / max(b, 1)))
    dim = part(signals["coverage_missing"], signals["coverage_requested"])
    page = part(max(0, signals["page_total"] - signals["page_returned"]), signals["page_total"]) if signals["page_has_more"] else 0.0
    frontier = float(signals["frontier_size"])
    proof = 1.0 if signals["confidence_is_unknown"] else frontier / (frontier + FRONTIER_HALF)
    found = {"dim": dim, "page": page, "proof": proof, "conflict": min(1.0, signals["conflicts"] / CONFLICTS_FULL), "frontier": part(signals["unvisited_links"], signals["total_links"]), "answer": float(bool(signals["answer_is_null"]))}
    now = sum(WEIGHTS[k] * found[k] for k in WEIGHTS)
    streak = state[4] + 1 if new_refs == 0 and dim >= state[1] else 0
    return (min(state[0], SMOOTHING * now + (1 - SMOOTHING) * state[0]), dim, streak >= STALLED_STEPS, state[3] or signals["conflicts"] > 0, streak, new_refs, state[6] + 1)


def observe_stream(steps: DataFrame, session: str = "session_id", order: str = "step_idx") -> DataFrame:
    """The fold over a streaming DataFrame: after each trigger, a row with the new state of each session that had steps.

    A step whose number isn't the session's next is left out, so late and repeated steps change nothing.
    """
    names = [n.split()[0] for n in SIGNALS.split(", ")]

    def advance(key: tuple, frames: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        state = held.get if held.exists else (1.0, 0.0, False, False, 0, 0, 0)
        rows = pd.concat(list(frames)).sort_values(order)
        for row in rows.itertuples(index=False):
            if getattr(row, order) == state[6]:
                state = observe_once(state, {n: row.signals[n] for n in names}, int(row.new_refs))
        held.update(state)
        yield pd.DataFrame([(key[0], *state)], columns=[session, *(f.split()[0] for f in STATE.split(", "))])

    kind = steps.schema[session].dataType.simpleString()
    return steps.groupBy(session).applyInPandasWithState(advance, f"{session} {kind}, {STATE}", STATE, "update", "NoTimeout")
