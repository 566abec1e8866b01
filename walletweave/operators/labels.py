"""Curated labels: direct assignments, cluster candidates, conflicts and propagation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import cluster_entity_id, normalize_name, seed_entity_id
from ..functions.scores import propagated_confidence
from .state import first_in_group

#: Fixed values.
TAXONOMY_VERSION, PROPAGATION_FACTOR = "taxonomy_v1", 0.95
TAXONOMY = {
    "entity_category": ("dex", "exchange", "bridge", "protocol", "token_issuer", "unknown"),
    "contract_role": ("router", "factory", "pool_manager", "position_manager", "token_contract", "protocol_contract",
                      "hot_wallet", "deposit_wallet", "deployer", "unknown"),
}
DIRECT, MEMBERSHIP, PROPAGATED = "direct_seed", "cluster_membership", "cluster_propagation"
CONFLICT = "conflicting_direct_seed_identities"


def check_taxonomy(version: str, stored: set[tuple[str, str]]) -> None:
    """The stored active (dimension, value) pairs must be the code's."""
    if version != TAXONOMY_VERSION:
        raise ValueError(f"unsupported taxonomy version: {version}")
    if stored != {(d, v) for d, values in TAXONOMY.items() for v in values}:
        raise ValueError("the stored taxonomy differs from the code")


def named_seeds(seeds: DataFrame) -> DataFrame:
    """Seeds with the entity they stand for: its id and name come from its lowest address.

    An entity with two categories raises.
    """
    name = Window.partitionBy("chain_id", "name")
    out = seeds.withColumn("name", normalize_name(F.col("entity_name"))).withColumn(
        "exemplar", F.min_by(F.struct("entity_name", "address"), "address").over(name)).withColumn(
        "n", F.size(F.collect_set("entity_category").over(name)))
    one = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("conflicting categories for curated entity: "), "name")).cast("string")).otherwise(F.col("entity_category"))
    return out.withColumn("entity_category", one).withColumn(
        "entity_id", seed_entity_id(F.col("chain_id"), F.col("exemplar.entity_name"))).drop("n")


def cluster_seeds(seeds: DataFrame, members: DataFrame) -> DataFrame:
    """Members of clusters that are seeds, with what the labels need. Seeds are a curated list."""
    s = named_seeds(seeds).select("chain_id", F.col("address").alias("wallet_address"), "entity_name", "name", "entity_category",
                                  F.col("confidence").alias("seed_confidence"), "source_type", "source_reference")
    return members.select("chain_id", "cluster_id", "wallet_address", F.col("confidence").alias("member_confidence")).join(s, ["chain_id", "wallet_address"])


def conflicts(seeds: DataFrame, members: DataFrame) -> DataFrame:
    """Clusters whose direct seeds name more than one entity; details are compact sorted JSON."""
    found = cluster_seeds(seeds, members).groupBy("chain_id", "cluster_id").agg(
        F.countDistinct("name").alias("n"),
        F.to_json(F.struct(F.sort_array(F.collect_list("wallet_address")).alias("addresses"),
                           F.sort_array(F.collect_set("entity_name")).alias("entity_names"))).alias("details"))
    return found.where("n > 1").select("chain_id", "cluster_id", F.lit(CONFLICT).alias("conflict_type"), "details")


def selected_seeds(seeds: DataFrame, members: DataFrame) -> DataFrame:
    """The seed that speaks for each cluster without a conflict: highest confidence, then lowest address."""
    rows = cluster_seeds(seeds, members)
    clear = rows.groupBy("chain_id", "cluster_id").agg(F.countDistinct("name").alias("n")).where("n = 1").drop("n")
    return first_in_group(rows.join(clear, ["chain_id", "cluster_id"], "left_semi"), ["chain_id", "cluster_id"],
                          [F.desc("seed_confidence"), F.asc("wallet_address")])


def cluster_list(members: DataFrame) -> DataFrame:
    """(chain_id, cluster_id) of each cluster; where members tell their run, a cluster of two runs raises."""
    if "cluster_run_id" not in members.columns:
        return members.select("chain_id", "cluster_id").distinct()
    one = members.groupBy("chain_id", "cluster_id").agg(F.min("cluster_run_id").alias("lo"), F.max("cluster_run_id").alias("hi"))
    mixed = F.raise_error(F.concat(F.lit("members of more than one clustering run in cluster "), "cluster_id")).cast("string")
    return one.select("chain_id", F.when(F.col("lo") != F.col("hi"), mixed).otherwise(F.col("cluster_id")).alias("cluster_id"))


def entities(seeds: DataFrame, members: DataFrame) -> DataFrame:
    """Curated entities, and one candidate entity a cluster (``unknown`` without a selected seed)."""
    named = first_in_group(named_seeds(seeds), ["chain_id", "name"], [F.asc("address")])
    none = F.lit(None).cast("string")
    curated = named.select("chain_id", "entity_id", F.col("entity_name").alias("display_name"), "entity_category",
                           F.lit(DIRECT).alias("created_from"), none.alias("cluster_id"))
    chosen = selected_seeds(seeds, members).select("chain_id", "cluster_id", "entity_name", F.col("entity_category").alias("category"))
    found = cluster_list(members).join(chosen, ["chain_id", "cluster_id"], "left").select(
        "chain_id", cluster_entity_id(F.col("chain_id"), F.col("cluster_id")).alias("entity_id"), F.col("entity_name").alias("display_name"),
        F.coalesce("category", F.lit("unknown")).alias("entity_category"), F.lit(MEMBERSHIP).alias("created_from"), "cluster_id")
    return curated.unionByName(found)


def entity_members(seeds: DataFrame, members: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    direct = named_seeds(seeds).select("chain_id", "entity_id", F.col("address").alias("wallet_address"), F.lit(DIRECT).alias("membership_method"),
                                       F.col("confidence").alias("membership_confidence"), none.alias("cluster_id"))
    found = members.select("chain_id", cluster_entity_id(F.col("chain_id"), F.col("cluster_id")).alias("entity_id"), "wallet_address",
                           F.lit(MEMBERSHIP).alias("membership_method"), F.col("confidence").alias("membership_confidence"), "cluster_id")
    return direct.unionByName(found)


def _direct_rows(seeds: DataFrame) -> DataFrame:
    """A row per direct assignment: of the entity, of each address, and of the address's role."""
    named = named_seeds(seeds)
    item = lambda kind, subject, dimension, value: F.struct(
        F.lit(kind).alias("subject_type"), subject.alias("subject_id"), F.lit(dimension).alias("label_dimension"), value.alias("label_value"))
    found = F.filter(F.array(
        F.when(F.col("address") == F.col("exemplar.address"), item("entity", F.col("entity_id"), "entity_category", F.col("entity_category"))),
        item("address", F.col("address"), "entity_category", F.col("entity_category")),
        F.when(F.col("contract_role").isNotNull() & (F.col("contract_role") != ""), item("address", F.col("address"), "contract_role", F.col("contract_role"))),
    ), lambda x: x.isNotNull())
    return named.select("chain_id", "address", "entity_id", "confidence", "source_type", "source_reference", "notes", F.explode(found).alias("x")).select(
        "chain_id", "x.*", "entity_id", "confidence", "source_type", "source_reference", "notes", "address")


def _targets(seeds: DataFrame, members: DataFrame, factor: float) -> DataFrame:
    """What a selected seed's category spreads to: the cluster's entity and its members without a seed."""
    chosen = selected_seeds(seeds, members)
    spread = chosen.select("chain_id", "cluster_id", F.col("wallet_address").alias("seed_address"), "entity_category", "seed_confidence",
                           "source_type", "source_reference", F.col("member_confidence").alias("source_confidence"))
    known = seeds.select("chain_id", F.col("address").alias("wallet_address"))
    rest = members.select("chain_id", "cluster_id", "wallet_address", F.col("confidence").alias("member_confidence")).join(
        known, ["chain_id", "wallet_address"], "left_anti").join(spread, ["chain_id", "cluster_id"])
    entity = cluster_entity_id(F.col("chain_id"), F.col("cluster_id"))
    shared = ["chain_id", "cluster_id", "entity_category", "seed_address", "seed_confidence", "source_type", "source_reference"]
    out = rest.select(*shared, F.lit("address").alias("subject_type"), F.col("wallet_address").alias("subject_id"), "member_confidence").unionByName(
        spread.select(*shared, F.lit("entity").alias("subject_type"), entity.alias("subject_id"), F.col("source_confidence").alias("member_confidence")))
    return out.withColumn("entity_id", entity).withColumn(
        "confidence", propagated_confidence(F.col("seed_confidence"), F.col("member_confidence"), factor))


def assignments(seeds: DataFrame, members: DataFrame, factor: float = PROPAGATION_FACTOR) -> DataFrame:
    """Direct and propagated label assignments."""
    direct = _direct_rows(seeds).select("chain_id", "subject_type", "subject_id", "entity_id", "label_dimension", "label_value", "confidence",
                                        F.lit(DIRECT).alias("assignment_method"), "source_type", "source_reference", F.lit(TAXONOMY_VERSION).alias("taxonomy_version"))
    spread = _targets(seeds, members, factor).select(
        "chain_id", "subject_type", "subject_id", "entity_id", F.lit("entity_category").alias("label_dimension"), F.col("entity_category").alias("label_value"),
        "confidence", F.lit(PROPAGATED).alias("assignment_method"), "source_type", "source_reference", F.lit(TAXONOMY_VERSION).alias("taxonomy_version"))
    return direct.unionByName(spread)


def precise_text(value: Column) -> Column:
    """A double with 17 significant digits as C prints it; Arrow batches, a few rows a cluster."""
    @F.pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        return s.map(lambda x: format(x, ".17g"), na_action="ignore")

    return text(value)


def label_evidence(seeds: DataFrame, members: DataFrame, factor: float = PROPAGATION_FACTOR) -> DataFrame:
    """One evidence row a direct assignment, three a propagated one."""
    cols = ["chain_id", "subject_type", "subject_id", "label_dimension", "label_value", "evidence_type", "evidence_value", "weight",
            "confidence_contribution", "source_type", "source_reference"]
    notes = F.when(F.coalesce(F.col("notes"), F.lit("")) != "", F.col("notes")).otherwise(F.concat(F.lit("curated label for "), "address"))
    direct = _direct_rows(seeds).withColumns({"evidence_type": F.lit("curated_seed"), "evidence_value": notes, "weight": F.lit(1.0),
                                              "confidence_contribution": F.col("confidence")}).select(*cols)
    item = lambda kind, value, weight: F.struct(F.lit(kind).alias("evidence_type"), value.alias("evidence_value"), weight.alias("weight"))
    rows = _targets(seeds, members, factor).withColumn("text", precise_text(F.col("member_confidence")))
    spread = rows.withColumn("label_dimension", F.lit("entity_category")).withColumn("label_value", F.col("entity_category")).withColumn("e", F.explode(F.array(
        item("labeled_cluster_member", F.col("seed_address"), F.col("seed_confidence")),
        item("cluster_membership_confidence", F.col("text"), F.col("member_confidence")),
        item("propagation_factor", F.lit(format(factor, ".17g")), F.lit(float(factor)))))).select(
        "chain_id", "subject_type", "subject_id", "label_dimension", "label_value", "e.*", F.col("e.weight").alias("confidence_contribution"),
        "source_type", "source_reference").select(*cols)
    return direct.unionByName(spread)
