"""Row filters; each says what a null does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def included(value: Column, allowed: Sequence[str]) -> Column:
    """One of the allowed values; null isn't. An empty list allows all."""
    return F.coalesce(value.isin(*allowed), F.lit(False)) if allowed else F.lit(True)


def not_excluded(value: Column, excluded: Sequence[str]) -> Column:
    """None of the excluded values; null passes."""
    return ~F.coalesce(value.isin(*excluded), F.lit(False)) if excluded else F.lit(True)


def passes_unless(value: Column, barred: Sequence[str]) -> Column:
    """Like not_excluded, for tools that an action needn't have."""
    return not_excluded(value, barred)


def filter_by_mode(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (), mode: str = "mode") -> DataFrame:
    """Include first, then exclude. No row left is an error."""
    out = df.filter(included(F.col(mode), include) & not_excluded(F.col(mode), exclude))
    if out.isEmpty():
        raise ValueError("the mode filter leaves no rows")
    return out


def read_profile(df: DataFrame) -> DataFrame:
    """Rows of a reading mode whose tool, if any, doesn't write."""
    return df.filter(included(F.col("mode"), ["read", "writer_pre_read"]) & not_excluded(F.col("tool"), ["kernel_ingest", "kernel_write_memory"]))


def window_of_rows(df: DataFrame, order: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows from an offset on in order, limit of them: taken before other filters."""
    out = df.orderBy(order).offset(offset)
    return out if limit is None else out.limit(limit)


def visible_targets(df: DataFrame, targets: Column, visible: Column) -> DataFrame:
    """Rows whose target refs are all visible."""
    return df.filter(F.size(F.array_except(targets, visible)) == 0)


def acceptance(kind: Column, reason: Column, cursor_kind: Column, wanted_reason: Column, wanted_cursor: Column, tool: Column) -> Column:
    """The action meets what a scenario expects of it; expectations that are null pass."""
    stop = wanted_reason.isNull() | ((kind == "stop") & reason.eqNullSafe(wanted_reason))
    cursor = wanted_cursor.isNull() | ((tool == "kernel_goto") & cursor_kind.eqNullSafe(wanted_cursor))
    return F.coalesce(stop, F.lit(False)) & F.coalesce(cursor, F.lit(False))
