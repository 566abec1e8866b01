"""Served reads: bounded, read-only queries over current or chosen snapshots.

Each read returns a DataFrame; nested collections are functions of their own, so nothing is read
that is not asked for. Without a run id the newest completed run of the chain answers; a given id
must exist, be completed and be on the chain, or the read fails.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import u256
from ..functions.scores import SEVERITY_RANK, rank
from ..operators.state import latest_by_version
from .store import RUN_TABLES, Warehouse

DEFAULT_LIMIT, MAX_LIMIT, MAX_OFFSET, DEFAULT_CHAIN = 50, 500, 100_000, 8453


class ApiError(ValueError):
    """A request that names its own mistake."""


def normalize_address(address: str) -> str:
    if not re.fullmatch("0x[0-9a-fA-F]{40}", address):
        raise ApiError("an address is 0x and 40 hex digits")
    return address.lower()


def page(limit: int = DEFAULT_LIMIT, offset: int = 0) -> tuple[int, int]:
    if not 1 <= limit <= MAX_LIMIT:
        raise ApiError(f"limit has to lie in 1..{MAX_LIMIT}")
    if not 0 <= offset <= MAX_OFFSET:
        raise ApiError(f"offset has to lie in 0..{MAX_OFFSET}")
    return limit, offset


def paged(df: DataFrame, limit: int, offset: int, *order) -> DataFrame:
    limit, offset = page(limit, offset)
    return df.orderBy(*order).offset(offset).limit(limit)


def cluster_rows(members: DataFrame) -> DataFrame:
    """One row a cluster."""
    return members.groupBy("cluster_id").agg(F.max("cluster_size").alias("cluster_size"), F.min("confidence").alias("confidence"),
                                             F.any_value("heuristic_version").alias("heuristic_version"))


def ranked_clusters(members: DataFrame, min_size: int | None, limit: int, offset: int) -> DataFrame:
    rows = cluster_rows(members)
    if min_size is not None:
        if min_size < 1:
            raise ApiError("minSize must be at least 1")
        rows = rows.where(F.col("cluster_size") >= min_size)
    return paged(rows, limit, offset, F.desc("cluster_size"), "cluster_id")


def ranked_alerts(alerts: DataFrame, severity: str | None, limit: int) -> DataFrame:
    """Critical first: the order of the enumeration, not of its names."""
    if severity is not None:
        if severity not in SEVERITY_RANK:
            raise ApiError("severity must be one of: info, warning, critical")
        alerts = alerts.where(F.col("severity") == severity)
    return paged(alerts, limit, 0, rank(F.col("severity"), SEVERITY_RANK).desc(), "metric_name", "scope_key", "alert_id")


def inside_cluster(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Edges or evidence with both ends among the members: two semi-joins."""
    ends = members.select(F.col("wallet_address").alias("w"))
    return edges.join(ends, edges["wallet_a"] == ends["w"], "left_semi").join(ends, edges["wallet_b"] == ends["w"], "left_semi")


def with_evidence(labels: DataFrame, evidence: DataFrame) -> DataFrame:
    """Assignments with their evidence as a sorted array of structs."""
    keys = ["label_dimension", "label_value"]
    item = F.struct("evidence_type", "evidence_value", "weight", "confidence_contribution", "source_type", "source_reference")
    return labels.join(evidence.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("evidence")), keys, "left")


class Api:
    def __init__(self, store: Warehouse):
        self.store = store

    def snapshot(self, kind: str, chain: int, run_id: str | None) -> dict | None:
        """The run that answers, or None if the chain has none."""
        table, _, _ = RUN_TABLES[kind]
        if run_id is not None:
            row = self.store.run_state(table, run_id)
            if row is None:
                raise ApiError(f"there is no {kind} run {run_id}")
            if row["chain_id"] != chain:
                raise ApiError(f"{kind} run {run_id} was made for another chain")
            if row["status"] != "completed":
                raise ApiError(f"{kind} run {run_id} has not come to its end")
            return row
        rows = latest_by_version(self.store.read(table).where(F.col("chain_id") == chain), ["run_id"]).where("status = 'completed'")
        row = rows.orderBy(F.desc("completed_at"), F.desc("run_id")).limit(1).first()
        return row.asDict() if row else None

    def _of(self, kind: str, table: str, chain: int, run_id: str | None) -> DataFrame:
        run = self.snapshot(kind, chain, run_id)
        return self.store.read(table).where((F.col("chain_id") == chain) & (F.col("run_id") == (run["run_id"] if run else None)))

    # Wallets ---------------------------------------------------------------------------------

    def wallet(self, address: str, chain: int = DEFAULT_CHAIN, cluster_run: str | None = None, label_run: str | None = None) -> DataFrame:
        """One row: features, cluster, entity and labels of a wallet, null where there are none."""
        address = normalize_address(address)
        self.check_runs(chain, cluster_run, label_run)
        one = self.store.spark.createDataFrame([(chain, address)], "chain_id bigint, address string")
        whole = lambda df, name: df.limit(1).select(F.struct("*").alias(name))
        labels = self.labels("address", address, chain, label_run).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("labels"))
        out = one
        for df in (whole(self.features(address, chain, cluster_run), "features"), whole(self.wallet_cluster(address, chain, cluster_run), "cluster"),
                   whole(self.entity_of(address, chain, label_run), "entity"), labels):
            out = out.join(F.broadcast(df), F.lit(True), "left")  # at most one row
        return out

    def check_runs(self, chain: int, cluster_run: str | None, label_run: str | None) -> None:
        """Two chosen runs must belong together."""
        if cluster_run is not None and label_run is not None:
            self.snapshot("cluster", chain, cluster_run)
            linked = self.snapshot("label", chain, label_run)["cluster_run_id"]
            if linked is not None and linked != cluster_run:
                raise ApiError("the label run was made from another cluster run than the one chosen")

    def features(self, address: str, chain: int = DEFAULT_CHAIN, run: str | None = None) -> DataFrame:
        rows = self._of("cluster", "wallet_features", chain, run).where(F.col("wallet_address") == normalize_address(address))
        return rows.withColumns({c: u256.to_decimal(F.col(c)) for c in ("native_received_wei", "native_sent_wei")})

    def wallet_cluster(self, address: str, chain: int = DEFAULT_CHAIN, run: str | None = None) -> DataFrame:
        return self._of("cluster", "wallet_clusters", chain, run).where(F.col("wallet_address") == normalize_address(address)).limit(1)

    def entity_of(self, address: str, chain: int = DEFAULT_CHAIN, run: str | None = None) -> DataFrame:
        """The wallet's entity: a direct seed wins, then the lowest id."""
        members = self._of("label", "entity_members", chain, run).where(F.col("wallet_address") == normalize_address(address)).select(
            "entity_id", "membership_method", "membership_confidence")
        rows = members.join(self._of("label", "entities", chain, run), "entity_id")
        return rows.orderBy((F.col("membership_method") == "direct_seed").desc(), "entity_id").limit(1)

    def labels(self, subject_type: str, subject: str, chain: int = DEFAULT_CHAIN, run: str | None = None) -> DataFrame:
        mine = (F.col("subject_type") == subject_type) & (F.col("subject_id") == subject)
        rows = self._of("label", "label_assignments", chain, run).where(mine).select(
            "label_dimension", "label_value", "confidence", "assignment_method", "source_type", "source_reference", "taxonomy_version")
        return with_evidence(rows, self._of("label", "label_evidence", chain, run).where(mine))

    # Entities --------------------------------------------------------------------------------

    def entity(self, entity_id: str, chain: int = DEFAULT_CHAIN, run: str | None = None) -> DataFrame:
        return self._of("label", "entities", chain, run).where(F.col("entity_id") == entity_id).limit(1)

    def entities(self, chain: int = DEFAULT_CHAIN, category: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0, run: str | None = None) -> DataFrame:
        rows = self._of("label", "entities", chain, run)
        return paged(rows.where(F.col("entity_category") == category) if category else rows, limit, offset, "entity_id")

    def entity_members(self, entity_id: str, chain: int = DEFAULT_CHAIN, limit: int = DEFAULT_LIMIT, offset: int = 0, run: str | None = None) -> DataFrame:
        return paged(self._of("label", "entity_members", chain, run).where(F.col("entity_id") == entity_id), limit, offset, "wallet_address", "membership_method")

    # Clusters --------------------------------------------------------------------------------

    def cluster(self, cluster_id: str, chain: int = DEFAULT_CHAIN, run: str | None = None) -> DataFrame:
        return cluster_rows(self._of("cluster", "wallet_clusters", chain, run).where(F.col("cluster_id") == cluster_id))

    def clusters(self, chain: int = DEFAULT_CHAIN, min_size: int | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0, run: str | None = None) -> DataFrame:
        return ranked_clusters(self._of("cluster", "wallet_clusters", chain, run), min_size, limit, offset)

    def cluster_members(self, cluster_id: str, chain: int = DEFAULT_CHAIN, limit: int = DEFAULT_LIMIT, offset: int = 0, run: str | None = None) -> DataFrame:
        return paged(self._of("cluster", "wallet_clusters", chain, run).where(F.col("cluster_id") == cluster_id), limit, offset, "wallet_address")

    def _inside(self, table: str, cluster_id: str, chain: int, run: str | None) -> DataFrame:
        return inside_cluster(self._of("cluster", table, chain, run), self._of("cluster", "wallet_clusters", chain, run).where(F.col("cluster_id") == cluster_id))

    def cluster_edges(self, cluster_id: str, chain: int = DEFAULT_CHAIN, limit: int = DEFAULT_LIMIT, offset: int = 0, run: str | None = None) -> DataFrame:
        return paged(self._inside("entity_resolution_edges", cluster_id, chain, run), limit, offset, "wallet_a", "wallet_b", "heuristic")

    def cluster_evidence(self, cluster_id: str, chain: int = DEFAULT_CHAIN, limit: int = DEFAULT_LIMIT, offset: int = 0, run: str | None = None) -> DataFrame:
        return paged(self._inside("cluster_evidence", cluster_id, chain, run), limit, offset, "wallet_a", "wallet_b", "heuristic", "evidence_type")

    # Evaluation ------------------------------------------------------------------------------

    def evaluation(self, chain: int = DEFAULT_CHAIN, run: str | None = None) -> dict | None:
        """The run's row and its lazy parts; undefined metrics stay null."""
        row = self.snapshot("evaluation", chain, run)
        if row is None:
            return None
        drift = self._of("evaluation", "drift_metrics", chain, row["run_id"]).orderBy("metric_group", "metric_name", "scope_key")
        return {"run": row, "label_metrics": self._of("evaluation", "label_evaluations", chain, row["run_id"]).orderBy("label_dimension", "assignment_method", "label_value"),
                "clustering_metrics": self._of("evaluation", "clustering_evaluations", chain, row["run_id"]), "drift_metrics": drift,
                "coverage_metrics": drift.where("metric_group = 'coverage'"), "alerts": self.drift_alerts(chain, None, MAX_LIMIT, row["run_id"])}

    def drift_alerts(self, chain: int = DEFAULT_CHAIN, severity: str | None = None, limit: int = DEFAULT_LIMIT, run: str | None = None) -> DataFrame:
        page(limit)
        return ranked_alerts(self._of("evaluation", "drift_alerts", chain, run), severity, limit)

    # Health ----------------------------------------------------------------------------------

    def health(self) -> tuple[int, dict]:
        return 200, {"status": "ok"}

    def readiness(self) -> tuple[int, dict]:
        return (200, {"status": "ok"}) if self.store.healthy() else (503, {"detail": "the engine does not answer"})
