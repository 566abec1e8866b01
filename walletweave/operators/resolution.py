"""Shared-funder resolution and deterministic clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import stable_id, stable_id_of, valid_address
from ..functions.scores import delta_seconds, fanout_bonus, shared_funder_score, stored_float, time_bonus
from .components import connected_components

#: Fixed values.
HEURISTIC, HEURISTIC_VERSION, EVIDENCE_COUNT = "shared_funder", "shared_funder_v1", 3
WINDOW_SECONDS, MAX_FANOUT = 3600, 20


def eligible_funding(funding: DataFrame, max_fanout: int = MAX_FANOUT) -> DataFrame:
    """Funding edges of funders with 2 to ``max_fanout`` distinct funded wallets, with ``fanout``.

    The count is a partial aggregate; hot funders leave before any pair is formed, so the
    self-join's groups hold at most ``max_fanout`` rows.
    """
    rows = funding.where(valid_address(F.col("funded_address")) & valid_address(F.col("funder_address"))).select(
        "chain_id", F.lower("funder_address").alias("funder_address"), F.lower("funded_address").alias("funded_address"), "funding_timestamp")
    fanout = rows.select("chain_id", "funder_address", "funded_address").distinct().groupBy("chain_id", "funder_address").agg(
        F.count("*").alias("fanout")).where(F.col("fanout").between(2, max_fanout))
    return rows.join(fanout, ["chain_id", "funder_address"])


def shared_funder_pairs(funding: DataFrame, window: int = WINDOW_SECONDS, max_fanout: int = MAX_FANOUT) -> DataFrame:
    """Scored pairs of wallets that one funder funded first within ``window`` seconds."""
    if window <= 0 or max_fanout <= 0:
        raise ValueError("window and max_fanout must be positive")
    rows = eligible_funding(funding, max_fanout)
    left = rows.select("chain_id", "funder_address", "fanout", F.col("funded_address").alias("a"), F.col("funding_timestamp").alias("at"))
    right = rows.select("chain_id", "funder_address", F.col("funded_address").alias("b"), F.col("funding_timestamp").alias("bt"))
    pairs = left.join(right, ["chain_id", "funder_address"]).where("a < b").withColumn(
        "delta_seconds", delta_seconds(F.col("at"), F.col("bt"))).where(F.col("delta_seconds") <= window)
    return pairs.withColumnsRenamed({"a": "wallet_a", "b": "wallet_b"}).select(
        "chain_id", "wallet_a", "wallet_b", F.lit(HEURISTIC).alias("heuristic"),
        shared_funder_score(F.col("delta_seconds"), F.col("fanout"), window, max_fanout).alias("score"),
        F.lit(EVIDENCE_COUNT).alias("evidence_count"),
        stable_id(F.col("chain_id"), HEURISTIC, F.col("wallet_a"), F.col("wallet_b")).alias("edge_id"),
        "funder_address", "delta_seconds", "fanout")


def resolution_evidence(pairs: DataFrame, window: int = WINDOW_SECONDS, max_fanout: int = MAX_FANOUT) -> DataFrame:
    """Three rows a pair: the funder, the time apart and the funder's fanout."""
    item = lambda kind, value, weight, part: F.struct(
        F.lit(kind).alias("evidence_type"), value.cast("string").alias("evidence_value"),
        F.lit(weight).alias("weight"), part.cast("double").alias("score_contribution"))
    return pairs.select("chain_id", "wallet_a", "wallet_b", "heuristic", F.explode(F.array(
        item("same_first_funder", F.col("funder_address"), 0.60, F.lit(0.60)),
        item("funding_time_delta_seconds", F.col("delta_seconds"), 0.25, time_bonus(F.col("delta_seconds"), window)),
        item("funder_fanout", F.col("fanout"), 0.15, fanout_bonus(F.col("fanout"), max_fanout)),
    )).alias("e")).select("chain_id", "wallet_a", "wallet_b", "heuristic", "e.*")


def island_components(funding: DataFrame, window: int = WINDOW_SECONDS, max_fanout: int = MAX_FANOUT) -> DataFrame:
    """(chain_id, wallet, root) without iteration, for shared-funder edges only.

    A wallet has one first funder, so no edge leaves a funder; within one, edges join wallets at
    most a window apart, so components are the runs of time-ordered wallets without a larger gap.
    Runs of one wallet are dropped.
    """
    rows = eligible_funding(funding, max_fanout)
    order = Window.partitionBy("chain_id", "funder_address").orderBy("funding_timestamp", "funded_address")
    gap = delta_seconds(F.col("funding_timestamp"), F.lag("funding_timestamp").over(order))
    runs = rows.withColumn("cut", F.when(gap <= window, 0).otherwise(1)).withColumn("run", F.sum("cut").over(order))
    run = Window.partitionBy("chain_id", "funder_address", "run")
    return runs.select("chain_id", F.col("funded_address").alias("wallet"), F.min("funded_address").over(run).alias("root"),
                       F.count("*").over(run).alias("size")).where("size > 1").drop("size")


def edge_components(edges: DataFrame) -> DataFrame:
    """(chain_id, wallet, root) for any resolution edges, by iteration; keyed by chain and wallet."""
    node = lambda c: F.concat_ws("|", "chain_id", c)
    found = connected_components(edges.select(node("wallet_a").alias("a"), node("wallet_b").alias("b")))
    part = lambda c, i: F.split_part(F.col(c), F.lit("|"), F.lit(i))
    return found.select(part("node", 1).cast("long").alias("chain_id"), part("node", 2).alias("wallet"), part("root", 2).alias("root"))


def clusters(components: DataFrame, edges: DataFrame) -> DataFrame:
    """One row a member: id over the sorted members, size, confidence = least score inside."""
    groups = components.groupBy("chain_id", "root").agg(F.sort_array(F.collect_list("wallet")).alias("wallets"))
    scores = edges.join(components.select("chain_id", F.col("wallet").alias("wallet_a"), "root"), ["chain_id", "wallet_a"]).groupBy(
        "chain_id", "root").agg(F.min("score").alias("confidence"))
    return groups.join(scores, ["chain_id", "root"]).select(
        "chain_id", stable_id_of(F.col("wallets"), F.col("chain_id"), "cluster").alias("cluster_id"),
        F.explode("wallets").alias("wallet_address"), F.size("wallets").alias("cluster_size"), "confidence",
        F.lit(HEURISTIC_VERSION).alias("heuristic_version"))


def stored_clusters(members: DataFrame) -> DataFrame:
    """Clusters as later stages read them: the confidence went through single precision."""
    return members.withColumn("confidence", stored_float(F.col("confidence")))
