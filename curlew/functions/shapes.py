"""Shape checks of JSON actions: null, or the first problem's code in a fixed order. The JSON is read as VARIANT, so that a
missing key, a null and a wrong type differ, and a boolean is no number."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import VariantVal

from curlew.functions import actions
from curlew.functions.responses import variant
from curlew.vocabulary import CURSOR_KEYS


def at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def kind(v: Column) -> Column:
    """object, array, string, integer, number, boolean, null, or SQL null if there is nothing."""
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None)).when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "STRING", "string").when(s == "BIGINT", "integer")
        .when(s == "BOOLEAN", "boolean").when(s == "VOID", "null").otherwise("number")
    )


def keys(v: Column) -> Column:
    return F.coalesce(F.json_object_keys(F.to_json(v)), F.array().cast("array<string>"))


def exact_keys(v: Column, required: tuple, optional: tuple, code: str) -> Column:
    """code:missing=..;unexpected=.. with sorted names, or null."""
    have = keys(v)
    missing = F.array_sort(F.array_except(F.array(*(F.lit(k) for k in required)).cast("array<string>"), have))
    extra = F.array_sort(F.array_except(have, F.array(*(F.lit(k) for k in (*required, *optional))).cast("array<string>")))
    said = F.concat(F.lit(f"{code}:missing="), F.array_join(missing, ","), F.lit(";unexpected="), F.array_join(extra, ","))
    return F.when((F.size(missing) > 0) | (F.size(extra) > 0), said)


def text_problem(v: Column, name: str, optional: bool = False) -> Column:
    bad = (kind(v) != "string") | (F.length(F.trim(F.try_variant_get(v, "$", "string"))) == 0)
    return F.when(v.isNull(), F.lit(None) if optional else F.lit(f"missing_{name}")).when(bad, f"invalid_{name}")


def texts_problem(v: Column, name: str, most: int | None = None) -> Column:
    """An optional array of non-empty strings; the first bad element's index is named."""
    items = F.try_variant_get(v, "$", "array<variant>")
    bad = F.array_min(F.filter(F.transform(items, lambda x, i: F.when((kind(x) != "string") | (F.length(F.trim(F.try_variant_get(x, "$", "string"))) == 0), i)), lambda i: i.isNotNull()))
    out = F.when(v.isNull(), F.lit(None)).when(kind(v) != "array", f"invalid_{name}").when(bad.isNotNull(), F.concat(F.lit(f"invalid_{name}["), bad, F.lit("]")))
    return out if most is None else F.coalesce(out, F.when(F.size(items) > most, f"{name}_over_{most}"))


def cursor_problem(c: Column) -> Column:
    k = F.try_variant_get(c, "$.kind", "string")
    dims = at(c, "$.dimensions")
    return (
        F.when(c.isNull(), "missing_cursor").when(kind(c) != "object", "invalid_cursor")
        .when(k == "ref", F.coalesce(exact_keys(c, ("kind", "target"), (), "cursor_keys"), text_problem(at(c, "$.target"), "cursor_target")))
        .when(k == "around", F.coalesce(exact_keys(c, ("anchor", "dimensions", "kind"), (), "cursor_keys"), text_problem(at(c, "$.anchor"), "cursor_anchor"), texts_problem(dims, "cursor_dimensions"), F.when(F.size(F.try_variant_get(dims, "$", "array<variant>")) == 0, "empty_cursor_dimensions")))
        .when(k == "temporal", F.coalesce(exact_keys(c, ("anchor", "key", "kind"), (), "cursor_keys"), F.when(~F.coalesce(F.try_variant_get(c, "$.key", "string").isin(*CURSOR_KEYS), F.lit(False)), "invalid_cursor_key"), text_problem(at(c, "$.anchor"), "cursor_anchor")))
        .when(k == "trace", F.coalesce(exact_keys(c, ("from", "kind", "to"), (), "cursor_keys"), text_problem(at(c, "$.from"), "cursor_from"), text_problem(at(c, "$.to"), "cursor_to")))
        .otherwise("invalid_cursor_kind")
    )


def action_problem(action: Column, allowed: Column | None = None) -> Column:
    """Of an action as VARIANT: its first problem, or null. allowed: array of tools that the row may use.

    Arrow batches: as one expression the check is too large to be compiled. An action comes as JSON text, beside which its VARIANT stands
    only where the text may hide a decimal: 5.0 is written as 5, and would pass for a whole number.
    """

    def run(texts: pa.Array, exact: pa.Array, tools: pa.Array) -> pa.Array:
        values = (None if t is None else json.loads(t) if x is None else VariantVal(x["value"], x["metadata"]).toPython() for t, x in zip(texts.to_pylist(), exact.to_pylist(), strict=True))
        return pa.array([actions.action_problem(v, ok) for v, ok in zip(values, tools.to_pylist(), strict=True)], pa.string())

    hides = F.schema_of_variant(action).rlike("DECIMAL|DOUBLE|FLOAT|VARIANT")
    tools = F.lit(None).cast("array<string>") if allowed is None else allowed
    return F.arrow_udf(run, "string")(F.to_json(action), F.when(hides, action), tools)


def response_problem(text: Column) -> Column:
    """Why a model's answer holds no action object, or null. The answer is one JSON object {"action": {...}}."""
    from curlew.functions.text import brace_end

    body = F.trim(text)
    end = brace_end(body)
    v = variant(F.substr(body, F.lit(1), end))
    whole = variant(body)
    return (
        F.when(F.coalesce(F.length(body), F.lit(0)) == 0, "empty_response").when(whole.isNotNull() & (kind(whole) != "object"), "json_not_object").when(~body.startswith("{"), "invalid_json").when(end.isNull(), "incomplete_json")
        .when(F.length(F.trim(F.substr(body, end + 1, F.length(body)))) > 0, "extra_content_after_json").when(v.isNull(), "invalid_json")
        .when(exact_keys(v, ("action",), (), "x").isNotNull(), "missing_or_extra_top_level_fields").when(kind(at(v, "$.action")) != "object", "action_not_object")
    )


def lenient_action(text: Column) -> Column:
    """The action as VARIANT of {"action": ...} or of the bare action."""
    v = variant(text)
    return F.coalesce(at(v, "$.action"), v)
