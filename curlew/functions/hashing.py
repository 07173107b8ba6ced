"""Hashes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offset and prime (2**40 + 435) of 64-bit FNV-1a.
FNV_OFFSET = 0xCBF29CE484222325
LOW_PRIME = 435
MASK = 0xFFFFFFFF


def fnv1a64(text: Column, seed: int = 0) -> Column:
    """64-bit FNV-1a of the UTF-8 bytes with the offset XORed by seed, as 16 hex digits, whose order is that of the unsigned numbers.

    The state is kept as two 32-bit halves, so that no step overflows under ANSI arithmetic.
    """
    start = (FNV_OFFSET ^ seed) & (2**64 - 1)
    digits = F.hex(F.encode(text, "UTF-8"))
    # a byte's value is its two hex digits
    size = (F.length(digits) / 2).cast("int")
    codes = F.when(size > 0, F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: F.conv(F.substr(digits, i * 2 - 1, F.lit(2)), 16, 10).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    first = F.struct(F.lit(start >> 32).cast("long").alias("h"), F.lit(start & MASK).cast("long").alias("l"))

    def step(s: Column, b: Column) -> Column:
        low = s["l"].bitwiseXOR(b)
        product = low * LOW_PRIME
        high = s["h"] * LOW_PRIME + F.shiftright(product, 32) + F.shiftleft(low, 8)
        return F.struct(high.bitwiseAND(MASK).alias("h"), product.bitwiseAND(MASK).alias("l"))

    return F.aggregate(codes, first, step, lambda s: F.lower(F.concat(F.lpad(F.hex(s["h"]), 8, "0"), F.lpad(F.hex(s["l"]), 8, "0"))))


def json_string(text: Column) -> Column:
    """A string as JSON with its quotes, other characters raw."""
    return F.concat(F.lit('"'), F.substr(F.to_json(F.struct(text.alias("a"))), F.lit(7), F.length(F.to_json(F.struct(text.alias("a")))) - 8), F.lit('"'))


def stable_shuffle_key(payload: Column, seed: int) -> Column:
    """Sort by this for the stable shuffle: the seeded hash, then the payload. The payload is canonical JSON."""
    return F.struct(fnv1a64(payload, seed).alias("hash"), payload.alias("payload"))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)
