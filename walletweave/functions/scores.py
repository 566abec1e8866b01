"""Scores, metrics and changes; an undefined metric is null, never 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def delta_seconds(a: Column, b: Column) -> Column:
    """Whole seconds between two instants: the difference truncated, then its absolute value."""
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    return F.abs(F.call_function("div", micros(a) - micros(b), F.lit(1_000_000).cast("long")))


def time_bonus(delta: Column, window: int) -> Column:
    return F.lit(0.25) * F.greatest(F.lit(0.0), 1.0 - delta / F.lit(float(window)))


def fanout_bonus(fanout: Column, max_fanout: int) -> Column:
    if max_fanout <= 2:
        return F.lit(0.15)
    return F.lit(0.15) * F.greatest(F.lit(0.0), 1.0 - (fanout - 2) / F.lit(float(max_fanout - 2)))


def shared_funder_score(delta: Column, fanout: Column, window: int, max_fanout: int) -> Column:
    return F.least(F.lit(1.0), F.lit(0.60) + time_bonus(delta, window) + fanout_bonus(fanout, max_fanout))


def propagated_confidence(seed: Column, member: Column, factor: float) -> Column:
    """Product within [0, 1]; a factor outside raises."""
    product = F.greatest(F.lit(0.0), F.least(F.lit(1.0), seed * member * F.lit(float(factor))))
    fine = seed.between(0.0, 1.0) & member.between(0.0, 1.0) & F.lit(0.0 <= factor <= 1.0)
    return F.when(fine, product).otherwise(F.raise_error(F.lit("confidence components must be in [0,1]")).cast("double"))


def precision(tp: Column, fp: Column) -> Column:
    return F.try_divide(tp.cast("double"), (tp + fp).cast("double"))


def recall(tp: Column, fn: Column) -> Column:
    return F.try_divide(tp.cast("double"), (tp + fn).cast("double"))


def f1(p: Column, r: Column) -> Column:
    return F.try_divide(2 * p * r, p + r)


def relative_change(value: Column, prior: Column) -> Column:
    return F.try_divide(value - prior, F.abs(prior))


def stored_float(c: Column) -> Column:
    """A confidence as it is read back from single-precision storage."""
    return c.cast("float").cast("double")


#: Fixed order of enumerated values.
SECURITY_RANK = {"unsafe": 1, "safe": 2, "finalized": 3}
SEVERITY_RANK = {"info": 1, "warning": 2, "critical": 3}


def rank(value: Column, ranks: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for name, n in ranks.items():
        out = F.when(value == name, n).otherwise(out)
    return out


def security_of(height: Column, safe: Column, finalized: Column) -> Column:
    return F.when(height <= finalized, "finalized").when(height <= safe, "safe").otherwise("unsafe")
