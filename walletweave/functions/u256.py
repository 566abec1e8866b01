"""Unsigned 256-bit integers as 64 lower-case hex digits; every operation is a built-in expression.

The fixed-width form compares and sorts as a string. Sums split it into eight 32-bit limbs, add
those as longs (exact up to 2**31 rows a group; beyond, ANSI mode raises) and carry once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = "0" * 64


def from_quantity(q: Column) -> Column:
    """``0x``-prefixed hex quantity to the fixed form; more than 64 digits raise."""
    digits = F.lower(F.regexp_replace(q, "^0[xX]0*", ""))
    return F.when(
        q.rlike("^0[xX][0-9a-fA-F]+$"),
        F.when(F.length(digits) <= 64, F.lpad(digits, 64, "0")).otherwise(F.raise_error(F.lit("quantity exceeds 256 bits")).cast("string")),
    ).when(q.isNotNull(), F.raise_error(F.concat(F.lit("not a hex quantity: "), q)).cast("string"))


def from_long(n: Column) -> Column:
    """A non-negative long to the fixed form."""
    return F.when(n >= 0, F.lpad(F.lower(F.hex(n.cast("long"))), 64, "0")).when(
        n < 0, F.raise_error(F.lit("a quantity cannot be negative")).cast("string"))


def limbs(h: Column) -> list[Column]:
    """Eight 32-bit parts, the highest first; most are zero, and a comparison is cheaper than a conversion."""
    part = lambda i: F.substring(h, 1 + 8 * i, 8)
    return [F.when(part(i) == "00000000", F.lit(0).cast("long")).otherwise(F.conv(part(i), 16, 10).cast("long")) for i in range(8)]


def from_limb_sums(sums: list[Column]) -> Column:
    """Fixed form of limb sums; null sums are zero, a carry out of 256 bits raises."""
    carry, out = F.lit(0).cast("long"), []
    for s in reversed(sums):
        total = F.coalesce(s, F.lit(0).cast("long")) + carry
        out.append(F.lpad(F.lower(F.hex(total % (1 << 32))), 8, "0"))
        carry = F.shiftright(total, 32)
    return F.when(carry != 0, F.raise_error(F.lit("sum exceeds 256 bits")).cast("string")).otherwise(F.concat(*reversed(out)))


def sum_(h: Column) -> Column:
    """Exact sum of a group, as an aggregate expression."""
    return from_limb_sums([F.sum(x) for x in limbs(h)])


def to_decimal(h: Column) -> Column:
    """Exact decimal string: base 10**9 long multiplication over the limbs."""
    digits = F.aggregate(
        F.array(*limbs(h)), F.array_repeat(F.lit(0).cast("long"), 9),
        lambda acc, limb: F.aggregate(
            acc, F.struct(limb.alias("carry"), F.array().cast("array<bigint>").alias("out")),
            lambda s, d: F.struct(
                _div(d * (1 << 32) + s["carry"]).alias("carry"),
                F.concat(s["out"], F.array((d * (1 << 32) + s["carry"]) % (10**9))).alias("out")),
            lambda s: s["out"]))
    text = F.array_join(F.transform(F.reverse(digits), lambda d: F.lpad(d.cast("string"), 9, "0")), "")
    return F.when(h.isNotNull(), F.when(h == ZERO, "0").otherwise(F.ltrim(text, F.lit("0"))))


def _div(x: Column) -> Column:
    return F.call_function("div", x, F.lit(10**9).cast("long"))
