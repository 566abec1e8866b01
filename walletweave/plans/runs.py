"""Run lifecycles: ingest, cluster, label and evaluate.

Every run appends its states (pending, running, then completed or failed) as versions; readers
trust completed runs only. A run that derives a snapshot drops its own partial output when it
fails. Within a run, each derived table is one lazy plan; what several sinks share is staged.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import security_of, stored_float
from ..functions.staging import drop_stage, stage
from ..operators import canonical as C
from ..operators import evaluation as E
from ..operators import labels as L
from ..operators import resolution as R
from ..operators import transfers as X
from ..operators.state import dedupe_latest, latest_by_version, latest_completed, next_sequences
from ..sources import decode, seeds as seed_source
from . import schemas as S
from .store import Warehouse

JOB = "block_ingestion"
ERROR_LIMIT = 4000
#: Heights a step of a backfill.
STEP = 1000


def now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


@contextmanager
def run_states(store: Warehouse, table: str, row: dict, first: int, failed_version: int, cleanup: Callable[[], None]):
    """Append pending and running; on the way out completed with the row's counts, or failed."""
    def put(status, version, **more):
        store.append_rows(table, [row | {"status": status, "version": version} | more])

    put("pending", first)
    put("running", first + 1)
    try:
        yield row
    except Exception as e:
        cleanup()
        put("failed", failed_version, completed_at=now(), error=str(e)[:ERROR_LIMIT])
        raise
    put("completed", first + 2, completed_at=now())


# Ingestion ---------------------------------------------------------------------------------------


class Ingestion:
    """Backfill of a height range, in steps of at most ``step`` heights.

    capture(start, end) gives (chain_id, height, block, receipts, ingested_at) rows, from the RPC
    data source or from files; heads() gives the latest, safe and finalized heights; chain() the
    node's chain id. A step is captured and decoded on the executors, made canonical and
    checkpointed before the next begins, so a run that fails resumes behind its last whole step;
    only heights, counts and one block's hash reach the driver.
    """

    def __init__(self, store: Warehouse, chain_id: int, capture: Callable[[int, int], DataFrame], heads: Callable[[], dict],
                 chain: Callable[[], int] | None = None, max_depth: int = C.MAX_REORG_DEPTH, step: int = STEP):
        if step < 1:
            raise ValueError("a step has at least one height")
        self.store, self.chain_id, self.capture, self.heads, self.chain, self.max_depth, self.step = store, chain_id, capture, heads, chain, max_depth, step
        self.done = {"blocks_processed": 0, "transactions_inserted": 0, "transfers_decoded": 0, "reorgs_detected": 0}

    def _current(self) -> DataFrame:
        return C.current_blocks(self.store.read("canonical_blocks").where(F.col("chain_id") == self.chain_id))

    def _write_facts(self, rows: DataFrame) -> DataFrame:
        captured = stage(rows, "captured")
        rows = decode.parsed(captured)
        facts = {"raw_blocks": stage(decode.raw_blocks(rows), "blocks"), "raw_transactions": stage(decode.raw_transactions(rows), "transactions"),
                 "token_transfers": stage(decode.token_transfers(rows), "transfers")}
        for name, df in facts.items():
            self.store.append(name, df)
        self.done["transactions_inserted"] += facts["raw_transactions"].count()
        self.done["transfers_decoded"] += facts["token_transfers"].count()
        for df in (captured, facts["raw_transactions"], facts["token_transfers"]):
            drop_stage(df)
        return facts["raw_blocks"]

    def _set_canonical(self, blocks: DataFrame, reason: str, heads: dict, at: datetime) -> None:
        level = security_of(F.col("block_number"), F.lit(heads["safe"]), F.lit(heads["finalized"]))
        wanted = blocks.select("chain_id", "block_number", "block_hash", "parent_hash").withColumn("security_level", level).withColumn("observed_at", F.lit(at))
        changed = stage(C.set_canonical(self._current(), wanted), "changed")
        self.store.append("canonical_blocks", changed)
        self._history(changed, 1, reason, at)

    def _history(self, blocks: DataFrame, canonical: int, reason: str, at: datetime) -> None:
        rows = blocks.select("chain_id", "block_number", "block_hash", "parent_hash", "security_level").withColumns(
            {"canonical": F.lit(canonical), "reason": F.lit(reason), "detected_at": F.lit(at)})
        history = self.store.read("canonical_blocks_history").where(F.col("chain_id") == self.chain_id)
        self.store.append("canonical_blocks_history", stage(next_sequences(history, rows, ["chain_id", "block_number"], ["block_hash"]), "history"))

    def _checkpoint(self, height: int, block_hash: str) -> None:
        old = self.store.checkpoint(JOB, self.chain_id)
        if old and (old["last_processed_block"], old["last_processed_block_hash"]) == (height, block_hash):
            return
        self.store.append_rows("pipeline_checkpoints", [{
            "job_name": JOB, "chain_id": self.chain_id, "last_processed_block": height, "last_processed_block_hash": block_hash,
            "updated_at": now(), "version": (old["version"] if old else 0) + 1}])

    def _recover(self, new_head: int, heads: dict) -> None:
        """Replace the fork up to ``new_head``: facts, orphaned history, canonical blocks, one event."""
        current = stage(self._current(), "current")
        old_head = current.agg(F.max("block_number")).first()[0]
        if old_head is None:
            raise ValueError("no canonical block is stored to recover from")
        low = max(0, min(old_head, new_head) - self.max_depth)
        remote = decode.raw_blocks(decode.parsed(stage(self.capture(low, new_head), "remote")))
        plan = stage(C.reorg_plan(remote, current, self.max_depth), "plan")
        self.done["reorgs_detected"] += 1
        first = plan.where(F.col("reason") == C.REPLACEMENT).agg(F.min("block_number")).first()[0]
        at = now()
        if first is not None:
            self._write_facts(self.capture(first, new_head))
        gone = plan.where(F.col("reason") == C.ORPHANED).select("chain_id", "block_number")
        self._history(current.join(gone, ["chain_id", "block_number"], "left_semi"), 0, C.ORPHANED, at)
        self._set_canonical(plan.where(F.col("reason") == C.REPLACEMENT), C.REPLACEMENT, heads, at)
        self.store.append("reorg_events", C.reorg_event(plan).withColumns({"reorg_id": F.lit(str(uuid.uuid4())), "detected_at": F.lit(at)}))

    def refresh_finality(self, start: int, end: int, heads: dict) -> None:
        """Upgrade the security of canonical blocks in the range; never downgrade."""
        spark, at = self.store.spark, now()
        levels = spark.createDataFrame([(self.chain_id, heads["safe"], heads["finalized"])], "chain_id bigint, safe bigint, finalized bigint")
        rows = stage(C.finality_upgrades(self._current().where(F.col("block_number").between(start, end)), levels).withColumn("observed_at", F.lit(at)), "upgrades")
        self.store.append("canonical_blocks", rows)
        self._history(rows, 1, C.UPGRADE, at)

    def run(self, start: int, end: int) -> dict:
        if not 0 <= start <= end:
            raise ValueError("backfill requires 0 <= from-block <= to-block")
        store = self.store
        self.done = dict.fromkeys(self.done, 0)
        row = {"run_id": str(uuid.uuid4()), "job_name": JOB, "chain_id": self.chain_id, "mode": "backfill", "start_block": start, "end_block": end, "started_at": now()}
        with run_states(store, "pipeline_runs", row, 1, 3, lambda: None):
            if self.chain is not None and self.chain() != self.chain_id:
                raise ValueError("the node is on another chain")
            heads = self.heads()
            C.check_heads(heads["latest"], heads["safe"], heads["finalized"])
            at = store.checkpoint(JOB, self.chain_id)
            begin = start
            if at:
                height = at["last_processed_block"]
                seen = decode.raw_blocks(decode.parsed(self.capture(height, height))).first()
                if seen["block_hash"] != at["last_processed_block_hash"]:
                    self._recover(height, heads)
                    self._checkpoint(height, seen["block_hash"])
                begin = max(start, height + 1)
            for low in range(begin, end + 1, self.step):
                self._step(low, min(end, low + self.step - 1), heads)
            self.refresh_finality(start, end, heads)
        at = store.checkpoint(JOB, self.chain_id)
        last = f"{at['last_processed_block']}:{at['last_processed_block_hash']}" if at else "none"
        return {"run_id": row["run_id"], "chain_id": self.chain_id, "range": f"{start}-{end}"} | self.done | {"final_checkpoint": last}

    def _step(self, low: int, high: int, heads: dict) -> None:
        """Capture, write and make canonical the heights of one step, then its checkpoint."""
        blocks = self._write_facts(self.capture(low, high))
        if (broken := C.continuous(blocks).first()) is not None:
            raise ValueError(f"block {broken['block_number']} does not follow the block below it")
        last = blocks.where(F.col("block_number") == high).first()
        if last is None:
            raise ValueError(f"block {high} was not captured")
        if C.reorg_conflicts(blocks, self._current()).first() is not None:
            self._recover(high, heads)
        else:
            self._set_canonical(blocks, C.OBSERVED, heads, now())
        self._checkpoint(high, last["block_hash"])
        self.done["blocks_processed"] += high - low + 1
        drop_stage(blocks)


# Clustering --------------------------------------------------------------------------------------


def derive_snapshot(transactions: DataFrame, transfers: DataFrame, window: int, max_fanout: int) -> dict[str, DataFrame]:
    """The six snapshot tables; interaction edges never feed the components."""
    edges = stage(X.transfer_edges(transactions, transfers), "edges")
    funding = stage(X.first_funders(edges), "funding")
    pairs = stage(R.shared_funder_pairs(funding, window, max_fanout), "pairs")
    members = R.clusters(R.island_components(funding, window, max_fanout), pairs)
    return {"wallet_transfer_edges": edges, "wallet_funding_edges": funding, "wallet_features": stage(X.wallet_features(edges, funding), "features"),
            "entity_resolution_edges": pairs, "cluster_evidence": R.resolution_evidence(pairs, window, max_fanout),
            "wallet_clusters": stage(members, "members")}


def snapshot_sink(store: Warehouse, tables: dict[str, DataFrame], run_id: str, **more) -> None:
    at = now()
    for name, df in tables.items():
        store.append(name, df.withColumns({"run_id": F.lit(run_id), "derived_at": F.lit(at)} | {k: F.lit(v) for k, v in more.items()}))


def cluster(store: Warehouse, chain_id: int, start: int, end: int, window: int = R.WINDOW_SECONDS, max_fanout: int = R.MAX_FANOUT,
            resume: str | None = None) -> dict:
    """One clustering snapshot of a height range; aborts if canonicality changed meanwhile."""
    if chain_id < 0 or not 0 <= start <= end:
        raise ValueError("clustering requires a non-negative chain and a bounded range")
    if window <= 0 or max_fanout <= 0:
        raise ValueError("shared-funder configuration must be positive")
    scope = {"chain_id": chain_id, "start_block": start, "end_block": end, "heuristic_version": R.HEURISTIC_VERSION}
    row, first = scope | {"run_id": resume or str(uuid.uuid4()), "started_at": now()}, 1

    def clean():
        for t in S.CLUSTER_TABLES:
            store.delete_run(t, row["run_id"])

    if resume:
        old = store.run_state("cluster_runs", resume)
        if old is None:
            raise ValueError(f"cluster run {resume} does not exist")
        if old["status"] == "completed":
            raise ValueError(f"cluster run {resume} is already completed")
        if any(old[k] != v for k, v in scope.items()):
            raise ValueError("resume arguments do not match the original run")
        row["started_at"], first = old["started_at"], old["version"] + 1
        clean()

    def versions():
        rows = store.current_canonical_blocks().where((F.col("chain_id") == chain_id) & F.col("block_number").between(start, end))
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("block_number", "block_hash", "version").cast("decimal(38,0)"))).first())

    inside = (F.col("chain_id") == chain_id) & F.col("block_number").between(start, end)
    with run_states(store, "cluster_runs", row, first, first + 3, clean):
        before = versions()
        transactions = dedupe_latest(store.canonical_transactions().where(inside), ["chain_id", "block_hash", "tx_hash"])
        transfers = dedupe_latest(store.canonical_token_transfers().where(inside), ["chain_id", "block_hash", "tx_hash", "log_index"])
        tables = derive_snapshot(transactions, transfers, window, max_fanout)
        counts = {"wallet_count": tables["wallet_features"].count(), "resolution_edge_count": tables["entity_resolution_edges"].count(),
                  "cluster_count": tables["wallet_clusters"].select("cluster_id").distinct().count()}
        if versions() != before:
            raise RuntimeError("canonical block state changed during clustering; rerun the range")
        snapshot_sink(store, tables, row["run_id"])
        row |= counts
    return row


# Labels ------------------------------------------------------------------------------------------


def completed_run(store: Warehouse, table: str, run_id: str, chain_id: int) -> dict:
    row = store.run_state(table, run_id)
    if row is None:
        raise ValueError(f"run {run_id} does not exist")
    if row["chain_id"] != chain_id or row["status"] != "completed":
        raise ValueError(f"run {run_id} must be completed and on chain {chain_id}")
    return row


def label_tables(frame: DataFrame, members: DataFrame, factor: float = L.PROPAGATION_FACTOR) -> dict[str, DataFrame]:
    """The five label tables, staged."""
    tables = {"entities": L.entities(frame, members), "entity_members": L.entity_members(frame, members),
              "label_assignments": L.assignments(frame, members, factor), "label_evidence": L.label_evidence(frame, members, factor),
              "label_conflicts": L.conflicts(frame, members)}
    return {k: stage(v, k) for k, v in tables.items()}


def label_sink(store: Warehouse, tables: dict[str, DataFrame], run_id: str, cluster_run: str | None) -> None:
    """Append the label tables; rows that come from a cluster name its run."""
    for name, df in tables.items():
        if name == "label_conflicts":
            df = df.withColumn("cluster_run_id", F.lit(cluster_run))
        elif name in ("entities", "entity_members"):
            df = df.withColumn("cluster_run_id", F.when(F.col("cluster_id").isNotNull(), F.lit(cluster_run)))
        snapshot_sink(store, {name: df}, run_id)


def label(store: Warehouse, chain_id: int, seeds: list[dict], cluster_run: str | None = None, taxonomy: str = L.TAXONOMY_VERSION,
          factor: float = L.PROPAGATION_FACTOR, resume: str | None = None) -> dict:
    """One label snapshot from curated seeds and, if given, a completed clustering run."""
    if chain_id <= 0:
        raise ValueError("labelling requires a positive chain")
    known = store.read("label_taxonomy").where((F.col("taxonomy_version") == taxonomy) & (F.col("active") == 1))
    L.check_taxonomy(taxonomy, {(r[0], r[1]) for r in known.select("label_dimension", "label_value").distinct().collect()})  # a fixed list
    own = [s for s in seeds if s["chain_id"] == chain_id]
    scope = {"chain_id": chain_id, "cluster_run_id": cluster_run, "taxonomy_version": taxonomy, "seed_dataset_version": seed_source.digest(own)}
    row, first = scope | {"run_id": resume or str(uuid.uuid4()), "started_at": now()}, 1

    def clean():
        for t in S.LABEL_TABLES:
            store.delete_run(t, row["run_id"])

    if resume:
        old = store.run_state("label_runs", resume)
        if old is None or old["status"] == "completed" or any(old[k] != v for k, v in scope.items()):
            raise ValueError("the run to resume must exist, be unfinished and have the same scope")
        row["started_at"], first = old["started_at"], old["version"] + 1
        clean()
    with run_states(store, "label_runs", row, first, first + 3, clean):
        if cluster_run:
            completed_run(store, "cluster_runs", cluster_run, chain_id)
        members = store.read("wallet_clusters").where((F.col("chain_id") == chain_id) & (F.col("run_id") == cluster_run)).withColumn(
            "confidence", F.col("confidence").cast("double")).withColumnRenamed("run_id", "cluster_run_id")
        tables = label_tables(seed_source.to_frame(store.spark, own), members, factor)
        label_sink(store, tables, row["run_id"], cluster_run)
        by = {r[0]: r[1] for r in tables["label_assignments"].groupBy("assignment_method").count().collect()}  # two methods
        row |= {"entity_count": tables["entities"].count(), "direct_label_count": by.get(L.DIRECT, 0), "propagated_label_count": by.get(L.PROPAGATED, 0),
                "conflict_count": tables["label_conflicts"].count()}
    return row


# Evaluation --------------------------------------------------------------------------------------


def evaluate(store: Warehouse, chain_id: int, cluster_run: str, label_run: str, seeds: list[dict], thresholds: dict = E.THRESHOLDS) -> dict:
    """Metrics, drift against the last compatible evaluation, and alerts. A bad scope leaves no trace."""
    if chain_id <= 0:
        raise ValueError("evaluation requires a positive chain")
    own = [s for s in seeds if s["chain_id"] == chain_id]
    c, lab = completed_run(store, "cluster_runs", cluster_run, chain_id), completed_run(store, "label_runs", label_run, chain_id)
    if lab["cluster_run_id"] != cluster_run:
        raise ValueError("the label run must use the selected cluster snapshot")
    row = {"run_id": str(uuid.uuid4()), "chain_id": chain_id, "cluster_run_id": cluster_run, "label_run_id": label_run, "start_block": c["start_block"],
           "end_block": c["end_block"], "heuristic_version": c["heuristic_version"], "taxonomy_version": lab["taxonomy_version"],
           "ground_truth_version": seed_source.digest(own), "seed_dataset_version": lab["seed_dataset_version"], "evaluation_version": E.EVALUATION_VERSION, "started_at": now()}
    with run_states(store, "evaluation_runs", row, 1, 3, lambda: None):
        of = lambda t, run: store.read(t).where((F.col("chain_id") == chain_id) & (F.col("run_id") == run))
        frame = seed_source.to_frame(store.spark, own)
        members = of("wallet_clusters", cluster_run).withColumn("confidence", stored_float(F.col("confidence")))
        seen = of("wallet_features", cluster_run).select(F.col("wallet_address").alias("address"))
        found = of("label_assignments", label_run).withColumn("confidence", stored_float(F.col("confidence")))
        predictions = found.where("subject_type = 'address'").select(F.lower("subject_id").alias("subject"), F.col("label_dimension").alias("dimension"),
                                                                     F.col("assignment_method").alias("method"), F.col("label_value").alias("value"))
        drift = E.drift_metrics(c, members, lab["entity_count"], found, of("label_conflicts", label_run).count(), frame, seen)
        compared = stage(E.compare_drift(drift, previous_metrics(store, row)), "drift")
        snapshot_sink(store, {
            "label_evaluations": E.evaluate_labels(E.truth_labels(frame), predictions).withColumn("chain_id", F.lit(chain_id)),
            "clustering_evaluations": E.evaluate_clustering(frame.select("address", F.col("entity_name").alias("entity")), seen,
                                                            members.select(F.col("wallet_address").alias("address"), "cluster_id")).withColumn("chain_id", F.lit(chain_id)),
            "drift_metrics": compared.withColumn("chain_id", F.lit(chain_id)),
            "drift_alerts": E.drift_alerts(compared, thresholds).withColumns({"chain_id": F.lit(chain_id), "alert_id": F.uuid()}),
        }, row["run_id"])
    return row


def previous_metrics(store: Warehouse, row: dict) -> DataFrame:
    """Metrics of the newest completed evaluation of the same scope; empty without one."""
    same = latest_by_version(store.read("evaluation_runs"), ["run_id"]).where(F.col("run_id") != row["run_id"])
    for k in S.EVALUATION_SCOPE:
        same = same.where(F.col(k) == row[k])
    last = latest_completed(same, ["chain_id"]).select("run_id")
    return store.read("drift_metrics").join(F.broadcast(last), "run_id", "left_semi")  # at most one row


def summary(row: dict) -> str:
    """``key=value`` lines; a missing value is NULL."""
    return "\n".join(f"{k}={'NULL' if v is None else v}" for k, v in row.items())
