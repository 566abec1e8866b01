"""Append-only versioned state, resolved when it is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_version(df: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """The row of the highest version per key.

    ``row_number() = 1`` over the key: the window group limit drops all but one row a key and
    task before the shuffle, and it needs no sort-based aggregate over a struct of strings. Null
    fields of the winning row survive. Ties, which a single writer cannot make, go by the row.
    """
    rest = [c for c in df.columns if c not in keys and c != version]
    order = [F.desc(version), *[F.col(c).desc() for c in rest]]
    return first_in_group(df, keys, order)


def latest_completed(runs: DataFrame, scope: list[str]) -> DataFrame:
    """Newest completed run per scope: versions are resolved before the status is looked at."""
    now = latest_by_version(runs, ["run_id"]).where("status = 'completed'")
    return first_in_group(now, scope, [F.desc("completed_at"), F.desc("run_id")])


def dedupe_latest(facts: DataFrame, identity: list[str], by: str = "ingested_at") -> DataFrame:
    """One row per physical identity, the newest; equal times are ordered by the other columns."""
    rest = [c for c in facts.columns if c not in identity and c != by]
    return first_in_group(facts, identity, [F.desc(by), *[F.col(c).desc() for c in rest]])


def first_in_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def next_versions(current: DataFrame, candidates: DataFrame, keys: list[str], payload: list[str],
                  version: str = "version") -> DataFrame:
    """Candidates whose payload differs from the current row, with the version after it.

    current holds one row a key. An unchanged candidate is dropped, so writing the same input
    twice adds nothing.
    """
    old = current.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(c).alias(f"__o_{c}") for c in payload],
                         F.col(version).alias("__v"))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    same = F.col("__v").isNotNull()
    for c in payload:
        same = same & F.col(c).eqNullSafe(F.col(f"__o_{c}"))
    joined = candidates.join(old, match, "left").where(~same)
    return joined.withColumn(version, (F.coalesce("__v", F.lit(0)) + 1).cast("long")).select(
        *[c for c in candidates.columns if c != version], version)


def next_sequences(history: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows numbered on from the highest sequence of their key."""
    last = history.groupBy(*keys).agg(F.max("sequence").alias("__last"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.join(last, keys, "left").withColumn(
        "sequence", (F.coalesce("__last", F.lit(0)) + F.row_number().over(w)).cast("long")).drop("__last")
