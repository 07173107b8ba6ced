"""Ratios, clamps, labels and verdicts as Column expressions. Each ratio says what a zero denominator gives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UINT32 = 4294967295


def rate(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """part / whole, and `empty` for a zero or null denominator."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(empty).cast("double")).otherwise(part.cast("double") / whole.cast("double"))


def clamp01(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def saturating(x: Column, top: int = UINT32) -> Column:
    """Unsigned saturating arithmetic on a wider integer."""
    return F.least(F.lit(top).cast("long"), F.greatest(F.lit(0).cast("long"), x))


def per_mille(x: Column) -> Column:
    """Rounded half away from zero and clamped to 0..1000."""
    return F.least(F.lit(1000), F.greatest(F.lit(0), F.round(x * 1000))).cast("int")


def row_score(valid: Column, parts: list[Column]) -> Column:
    """One for a valid prediction and one for each part that is true."""
    out = F.coalesce(valid, F.lit(False)).cast("int")
    for p in parts:
        out = out + F.coalesce(p, F.lit(False)).cast("int")
    return out


def verdict(has_before: Column, has_after: Column, before: Column, after: Column, exact_after: Column) -> Column:
    """Of a probe that two versions answered; scores of a missing version don't count."""
    return (
        F.when(~has_before, "missing_baseline").when(~has_after, "missing_candidate").when(after > before, "improved")
        .when(after < before, "regressed").when(F.coalesce(exact_after, F.lit(False)), "stable_correct").otherwise("stable_gap")
    )


def window_labels(before_entries: Column, entries: Column, before_usual: int = 6, entries_usual: int = 12) -> Column:
    """window:expand and window:shrink, either, both or none; usual sizes give none and null sizes nothing."""
    over = F.coalesce(before_entries > before_usual, F.lit(False)) | F.coalesce(entries > entries_usual, F.lit(False))
    under = F.coalesce(before_entries < before_usual, F.lit(False)) | F.coalesce(entries < entries_usual, F.lit(False))
    return F.filter(F.array(F.when(over, F.lit("window:expand")), F.when(under, F.lit("window:shrink"))), lambda x: x.isNotNull())


def navigation_phase(last_tool: Column, observed: Column) -> Column:
    """The phase that the last tool and the number of observed refs leave a session in."""
    near = F.when(observed > 0, "after_near_with_observed_refs").otherwise("after_near_without_observed_refs")
    return F.when(last_tool.isNull(), "start").when(last_tool == "kernel_near", near).otherwise(F.concat(F.lit("after_"), last_tool))


def primary_candidate(details: Column) -> Column:
    """Of array<struct<ref,role,priority,...>>: the first by leading role, priority (10000 if null) and position; null if empty."""
    leads = ("target_question", "current", "anchor")
    ranked = F.transform(details, lambda d, i: F.struct(F.when(d["role"].isin(*leads), 0).otherwise(1).alias("rank"), F.coalesce(d["priority"].cast("long"), F.lit(10000)).alias("priority"), i.alias("at"), d.alias("detail")))
    best = F.array_min(F.transform(ranked, lambda r: F.struct(r["rank"], r["priority"], r["at"])))
    return F.when(F.size(details) > 0, F.element_at(details, best["at"] + 1))
