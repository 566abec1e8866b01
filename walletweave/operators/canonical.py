"""Canonicality: selection, forks, reorg plans and finality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import SECURITY_RANK, rank, security_of
from .state import latest_by_version, next_versions

MAX_REORG_DEPTH = 128
#: Reasons in the history.
OBSERVED, UPGRADE, ORPHANED, REPLACEMENT = "observed", "security_upgrade", "reorg_orphaned", "reorg_replacement"


def current_blocks(canonical: DataFrame) -> DataFrame:
    """The current canonical block of each height."""
    return latest_by_version(canonical, ["chain_id", "block_number"])


def canonical_facts(facts: DataFrame, current: DataFrame) -> DataFrame:
    """Facts of canonical blocks. The right side is unique per key, so a semi-join is the inner join."""
    return facts.join(current.select("chain_id", "block_number", "block_hash"), ["chain_id", "block_number", "block_hash"], "left_semi")


def observed_forks(raw_blocks: DataFrame) -> DataFrame:
    """Every block seen at a height, with its newest observation."""
    return raw_blocks.groupBy("chain_id", "block_number", "block_hash", "parent_hash").agg(F.max("ingested_at").alias("last_ingested_at"))


def reorg_conflicts(observed: DataFrame, current: DataFrame) -> DataFrame:
    """Observed blocks that contradict stored canonicality: another hash at the height, or a stored
    predecessor that is not the parent. A missing predecessor is no conflict; hashes ignore case."""
    cur = current.select("chain_id", F.col("block_number").alias("__n"), F.lower("block_hash").alias("__h"))
    here = cur.withColumnsRenamed({"__n": "block_number", "__h": "stored_hash"})
    below = cur.select("chain_id", (F.col("__n") + 1).alias("block_number"), F.col("__h").alias("stored_parent"))
    rows = observed.join(here, ["chain_id", "block_number"], "left").join(below, ["chain_id", "block_number"], "left")
    hash_differs = F.coalesce(F.col("stored_hash") != F.lower("block_hash"), F.lit(False))
    parent_differs = F.coalesce(F.col("stored_parent") != F.lower("parent_hash"), F.lit(False)) & (F.col("block_number") > 0)
    return rows.withColumn("hash_differs", hash_differs).withColumn("parent_differs", parent_differs).where("hash_differs OR parent_differs")


def common_ancestor(remote: DataFrame, current: DataFrame, max_depth: int = MAX_REORG_DEPTH) -> DataFrame:
    """Per chain the highest height at or below both heads, within ``max_depth``, where they agree.

    A chain that is stored but has no such height raises: its fork is deeper than the search.
    """
    heads = current.groupBy("chain_id").agg(F.max("block_number").alias("old_head")).join(
        remote.groupBy("chain_id").agg(F.max("block_number").alias("new_head")), "chain_id")
    top = F.least("old_head", "new_head")
    same = remote.select("chain_id", "block_number", F.lower("block_hash").alias("h")).join(
        current.select("chain_id", "block_number", F.lower("block_hash").alias("h")), ["chain_id", "block_number", "h"])
    near = same.join(heads, "chain_id").where((F.col("block_number") <= top) & (F.col("block_number") >= top - max_depth))
    found = near.groupBy("chain_id").agg(F.max("block_number").alias("ancestor"))
    checked = F.when(F.col("ancestor").isNull(), F.raise_error(F.lit("no common ancestor within the search depth")).cast("long")).otherwise(F.col("ancestor"))
    return heads.join(found, "chain_id", "left").withColumn("ancestor", checked)


def reorg_plan(remote: DataFrame, current: DataFrame, max_depth: int = MAX_REORG_DEPTH) -> DataFrame:
    """Orphaned canonical blocks and their replacements above the common ancestor: (…, role)."""
    plan = F.broadcast(common_ancestor(remote, current, max_depth))  # a row a chain
    cols = ["chain_id", "block_number", "block_hash", "parent_hash"]
    orphaned = current.join(plan, "chain_id").where("block_number > ancestor AND block_number <= old_head").select(*cols, F.lit(ORPHANED).alias("reason"))
    replaced = remote.join(plan, "chain_id").where("block_number > ancestor AND block_number <= new_head").select(*cols, F.lit(REPLACEMENT).alias("reason"))
    return orphaned.unionByName(replaced)


def reorg_event(plan: DataFrame) -> DataFrame:
    """One summary row a chain."""
    count = lambda r: F.sum(F.when(F.col("reason") == r, 1).otherwise(0))
    head = lambda r, c: F.max_by(F.when(F.col("reason") == r, F.col(c)), F.when(F.col("reason") == r, F.col("block_number")))
    return plan.groupBy("chain_id").agg(
        head(ORPHANED, "block_number").alias("old_head_block"), head(ORPHANED, "block_hash").alias("old_head_hash"),
        head(REPLACEMENT, "block_number").alias("new_head_block"), head(REPLACEMENT, "block_hash").alias("new_head_hash"),
        (F.min("block_number") - 1).alias("common_ancestor_block"),
        count(ORPHANED).alias("orphaned_block_count"), count(REPLACEMENT).alias("replacement_block_count"))


def finality_upgrades(current: DataFrame, heads: DataFrame) -> DataFrame:
    """New versions of blocks whose security rises; heads: chain_id, safe, finalized. Never a downgrade."""
    rows = current.join(F.broadcast(heads), "chain_id").withColumn(  # a row a chain
        "new_level", security_of(F.col("block_number"), F.col("safe"), F.col("finalized")))
    up = rank(F.col("new_level"), SECURITY_RANK) > rank(F.col("security_level"), SECURITY_RANK)
    return rows.where(up).select("chain_id", "block_number", "block_hash", "parent_hash", F.col("new_level").alias("security_level"),
                                 (F.col("version") + 1).alias("version"))


def set_canonical(current: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows to append so that ``blocks`` are canonical; unchanged blocks add nothing."""
    return next_versions(current, blocks, ["chain_id", "block_number"], ["block_hash", "parent_hash", "security_level"])


def continuous(blocks: DataFrame) -> DataFrame:
    """Blocks whose parent is not the block below them, among those given; hashes ignore case."""
    below = blocks.select("chain_id", (F.col("block_number") + 1).alias("block_number"), F.col("block_hash").alias("__below"))
    return blocks.join(below, ["chain_id", "block_number"]).where(F.lower("parent_hash") != F.lower("__below")).drop("__below")


def check_heads(latest: int, safe: int, finalized: int) -> None:
    if not finalized <= safe <= latest:
        raise ValueError("heads must be ordered finalized <= safe <= latest")
