"""String functions and predicates as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curlew.vocabulary import RELATION_ALIASES, RELATIONS


def trim(text: Column) -> Column:
    """Without white space of any script at both ends (Spark's trim takes U+0020 only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def non_empty(text: Column) -> Column:
    return F.coalesce(F.length(trim(text)) > 0, F.lit(False))


def starts_with_any(text: Column, prefixes: list[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | text.startswith(p)
    return F.coalesce(out, F.lit(False))


def after_marker(text: Column, marker: str, stop: str = ":") -> Column:
    """What follows the last marker, up to the first stop; null without a marker."""
    return F.when(text.contains(marker), F.substring_index(F.substring_index(text, marker, -1), stop, 1))


def replace_longest_first(text: Column, pairs: Column) -> Column:
    """pairs: array of (from, to). Replaces every from, longer ones first, equally long ones in bytewise order."""
    ordered = F.array_sort(F.transform(pairs, lambda p: F.struct((-F.length(p["from"])).alias("n"), p["from"].alias("from"), p["to"].alias("to"))))
    return F.aggregate(ordered, text, lambda acc, p: F.replace(acc, p["from"], p["to"]))


def numbered(prefix: str, number: Column) -> Column:
    """prefix_0001; numbers over 9999 keep all their digits."""
    return F.format_string(f"{prefix}_%04d", number)


def safe_filename(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9._-]", "_")


def normalise_relation(text: Column) -> Column:
    return F.lower(F.translate(trim(text), "- ", "__"))


def canonical_relation(text: Column) -> Column:
    """The canonical name of a known relation, else the trimmed text."""
    known = F.create_map(*(F.lit(x) for r in RELATIONS for x in (r, r)), *(F.lit(x) for a, r in RELATION_ALIASES.items() for x in (a, r)))
    return F.coalesce(F.try_element_at(known, normalise_relation(text)), trim(text))


def relation_accepted(text: Column) -> Column:
    """Canonical spellings and unknown names pass; other spellings of known relations don't."""
    return non_empty(text) & (canonical_relation(text) == trim(text))


def content_hash_shape(text: Column) -> Column:
    return F.coalesce(text.rlike("^[a-z0-9_-]+:[0-9a-f]+$"), F.lit(False))


def matches_any(text: Column, patterns: dict[str, str], ignore_case: bool = True) -> Column:
    """The names of the patterns that the text has a match for, in their order."""
    flag = "(?i)" if ignore_case else ""
    found = F.array(*(F.when(text.rlike(flag + p), F.lit(name)) for name, p in patterns.items()))
    return F.filter(found, lambda x: x.isNotNull())


def brace_end(text: Column) -> Column:
    """The length of the text's first complete JSON object, counting braces outside strings; null if there is none."""
    chars = F.split(text, "")
    start = F.struct(*(F.lit(v).cast(t).alias(n) for n, v, t in (("at", 0, "int"), ("depth", 0, "int"), ("inside", False, "boolean"), ("escaped", False, "boolean"), ("end", None, "int"))))

    def step(s: Column, c: Column) -> Column:
        quote, outside = (c == '"') & ~s["escaped"], ~s["inside"]
        depth = s["depth"] + F.when(outside & (c == "{"), 1).when(outside & (c == "}"), -1).otherwise(0)
        closes = outside & (c == "}") & (depth == 0) & s["end"].isNull()
        return F.struct(
            (s["at"] + 1).alias("at"), depth.cast("int").alias("depth"), F.when(quote, outside).otherwise(s["inside"]).alias("inside"),
            (s["inside"] & (c == "\\") & ~s["escaped"]).alias("escaped"), F.when(closes, s["at"] + 1).otherwise(s["end"]).cast("int").alias("end"),
        )

    return F.aggregate(chars, start, step, lambda s: s["end"])
