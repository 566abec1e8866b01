"""Stable identifiers and address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
ZERO_ADDRESS = "0x" + "0" * 40
ADDRESS_PATTERN = "^0x[0-9a-fA-F]{40}$"


def _part(value: Column) -> Column:
    """Eight-byte big-endian length, then the UTF-8 bytes."""
    text = value.cast("string")
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(text)), 16, "0")), F.encode(text, "UTF-8"))


def stable_id(*parts) -> Column:
    """SHA-256 over length-prefixed parts; strings are literals, columns are values."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.sha2(F.concat(*map(_part, cols)), 256)


def stable_id_of(array: Column, *prefix) -> Column:
    """The same over prefix parts followed by every element of an array."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in prefix]
    return F.sha2(F.aggregate(array, F.concat(*map(_part, cols)), lambda acc, x: F.concat(acc, _part(x))), 256)


def valid_address(address: Column) -> Column:
    """Twenty hex bytes and not the zero address; null is not valid."""
    return F.coalesce(address.rlike(ADDRESS_PATTERN) & (F.lower(address) != ZERO_ADDRESS), F.lit(False))


def canonical_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """Lower-cased unordered pair; equal ends raise."""
    a, b = F.lower(a), F.lower(b)
    low = F.when(a == b, F.raise_error(F.lit("a pair needs two distinct wallets")).cast("string")).otherwise(F.least(a, b))
    return low, F.greatest(a, b)


def normalize_name(name: Column) -> Column:
    """White space collapsed, ends trimmed, case folded; the engine's form of an entity name.

    Lower case of upper case unfolds what one character alone does not (a sharp s is two). The
    translation between the two makes every sigma one, and keeps the optimiser from dropping the
    inner of two case changes. A capital sharp s and a dotless i, which fold by themselves, are
    taken care of before and after.
    """
    clean = F.translate(F.regexp_replace(name, r"(?U)\s+", " "), "\u1e9e\u0131", "\u00df\ue000")
    folded = F.lower(F.translate(F.upper(clean), "\u03a3", "\u03c3"))
    return F.trim(F.translate(folded, "\ue000", "\u0131"))


def seed_entity_id(chain: Column, name: Column) -> Column:
    return F.concat(F.lit("seed_"), stable_id(chain, normalize_name(name)))


def cluster_entity_id(chain: Column, cluster: Column) -> Column:
    return F.concat(F.lit("cluster_"), stable_id(chain, cluster))
