"""A warehouse filled from the star-schema tables, and the queries that read it through its views and ``Api``.

Orders of status P have an orphaned first version, whose facts no view may show. The chain has a
finished clustering run, one that failed later and one that never ended; a label run and two
evaluations, the first with a quarter of each metric, belong to the finished one.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import shared_dir, stage
from ..operators import evaluation as E
from ..operators import labels as L
from ..operators import resolution as R
from . import runs
from .api import MAX_LIMIT, Api
from .queries import DAYS30, DRIFT, EVIDENCE, FANOUT, FEATURES, SQL, Star, f32, hex64, query, with_
from .store import Warehouse

CHAIN, T0 = 1, datetime(2024, 1, 1)
CLUSTER, LABEL, EVALUATION = "cluster-run", "label-run", "evaluation-run"
_FILLED: dict[tuple[str, str], Warehouse] = {}


def _finished(store: Warehouse, table: str, run_id: str, at: datetime, status: str = "completed", **row) -> None:
    """The states of a run up to ``status``."""
    states = ["pending", "running"] + ([status] if status != "running" else [])
    store.append_rows(table, [row | {"run_id": run_id, "chain_id": CHAIN, "status": x, "version": i + 1, "started_at": at,
                                     "completed_at": at + timedelta(hours=1) if x in ("completed", "failed") else None} for i, x in enumerate(states)])


def fill(star: Star) -> Warehouse:
    store = Warehouse(star.spark, f"{shared_dir(star.spark)}/star-{uuid.uuid4().hex}")
    store.create()
    star.shared_rows  # noqa: B018 - every fact table reads them
    facts, at = star.facts, F.lit(T0).cast("timestamp")
    stale = F.concat(F.lit("0x"), F.sha2(F.concat(F.lit("stale"), F.col("block_number").cast("string")), 256))
    forked = F.col("o_orderstatus") == "P"
    blocks = star.table("orders").select(
        F.lit(CHAIN).alias("chain_id"), F.col("o_orderkey").alias("block_number"), "o_orderstatus",
        F.concat(F.lit("0x"), F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("block_hash"), F.concat(F.lit("p"), "o_orderkey").alias("parent_hash"),
        F.when(F.col("o_orderstatus") == "F", "safe").otherwise("unsafe").alias("security_level"), at.alias("observed_at"), F.when(forked, 2).otherwise(1).alias("version"))
    orphans = blocks.where(forked).withColumn("block_hash", stale).withColumn("version", F.lit(1))
    store.append("canonical_blocks", blocks.unionByName(orphans))
    more = {"gas": F.lit(21000), "gas_price": F.lit(None), "input": F.lit("0x"), "ingested_at": at}
    sent, moved = star.transactions().withColumns(more), star.transfers().withColumn("ingested_at", at)
    keys = facts.where(forked).select("block_number").distinct()
    for name, rows in (("raw_transactions", sent), ("token_transfers", moved)):
        old = rows.join(keys, "block_number", "left_semi").withColumn("block_hash", stale)
        store.append(name, rows.unionByName(old))
    store.append_rows("pipeline_checkpoints", [{"job_name": runs.JOB, "chain_id": CHAIN, "last_processed_block": 100 * v, "last_processed_block_hash": f"h{v}", "updated_at": T0, "version": v} for v in (1, 2, 3)])

    scope = {"start_block": 0, "end_block": 2**40, "heuristic_version": R.HEURISTIC_VERSION}
    tables = runs.derive_snapshot(store.canonical_transactions(), store.canonical_token_transfers(), DAYS30, FANOUT)
    runs.snapshot_sink(store, tables, CLUSTER)
    counts = {"wallet_count": tables["wallet_features"].count(), "resolution_edge_count": tables["entity_resolution_edges"].count(),
              "cluster_count": tables["wallet_clusters"].select("cluster_id").distinct().count()}
    _finished(store, "cluster_runs", CLUSTER, T0, **scope, **counts)
    _finished(store, "cluster_runs", "failed-run", T0 + timedelta(days=1), "failed", **scope)
    _finished(store, "cluster_runs", "running-run", T0 + timedelta(days=2), "running", **scope)

    members = store.read("wallet_clusters").where(F.col("run_id") == CLUSTER).withColumn("confidence", F.col("confidence").cast("double")).withColumnRenamed("run_id", "cluster_run_id")
    labels = runs.label_tables(star.seeds, members)
    runs.label_sink(store, labels, LABEL, CLUSTER)
    labelled = {"cluster_run_id": CLUSTER, "taxonomy_version": L.TAXONOMY_VERSION, "seed_dataset_version": "sha256:seeds"}
    by = {r[0]: r[1] for r in labels["label_assignments"].groupBy("assignment_method").count().collect()}  # two methods
    _finished(store, "label_runs", LABEL, T0, **labelled, entity_count=labels["entities"].count(), conflict_count=labels["label_conflicts"].count(),
              direct_label_count=by.get(L.DIRECT, 0), propagated_label_count=by.get(L.PROPAGATED, 0))

    own = labelled | scope | {"label_run_id": LABEL, "ground_truth_version": "sha256:truth", "evaluation_version": E.EVALUATION_VERSION}
    seen = store.read("wallet_features").where(F.col("run_id") == CLUSTER).select(F.col("wallet_address").alias("address"))
    found = labels["label_assignments"].where("subject_type = 'address'").select(
        F.col("subject_id").alias("subject"), F.col("label_dimension").alias("dimension"), F.col("assignment_method").alias("method"), F.col("label_value").alias("value"))
    drift = stage(star.drift(), "drift")
    first = drift.withColumn("value", F.col("value") / 4)
    for run_id, days, metrics, before in ((f"{EVALUATION}-0", 1, first, first.limit(0)), (EVALUATION, 2, drift, first)):
        compared = stage(E.compare_drift(metrics, before), "compared")
        runs.snapshot_sink(store, {
            "label_evaluations": E.evaluate_labels(E.truth_labels(star.seeds), found), "drift_metrics": compared,
            "clustering_evaluations": E.evaluate_clustering(star.seeds.select("address", F.col("entity_name").alias("entity")), seen,
                                                            members.select(F.col("wallet_address").alias("address"), "cluster_id")),
            "drift_alerts": E.drift_alerts(compared).withColumn("alert_id", F.concat_ws(":", "metric_name", "scope_key"))}, run_id, chain_id=CHAIN)
        _finished(store, "evaluation_runs", run_id, T0 + timedelta(days=days), **own)
    return store


def filled(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of these tables, filled once a session."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _FILLED:
        _FILLED[key] = fill(Star(spark, sf_dir))
    return _FILLED[key]


def shown(df: DataFrame) -> DataFrame:
    """A table's columns in the types of the SQL: doubles, times without a zone, no derivation time."""
    out = []
    for f in df.schema.fields:
        kind = {"float": "double", "timestamp": "timestamp_ntz"}.get(f.dataType.simpleString())
        if f.name not in ("derived_at", "run_id", "ingested_at", "observed_at", "alert_id"):
            out.append(F.col(f.name).cast(kind).alias(f.name) if kind else F.col(f.name))
    return df.select(*out)


# Views -----------------------------------------------------------------------------------------------

PAIR = "chain_id, wallet_a, wallet_b, 'shared_funder' AS heuristic"
EDGE_ROWS = f"SELECT * EXCLUDE (amount, tx_index), {hex64('amount')} AS amount_raw FROM edge"
COUNTED = "(SELECT count(*) FROM {})"
_RUN = "CAST(1 AS BIGINT) AS chain_id, '{run}' AS run_id, 'completed' AS status, CAST(3 AS BIGINT) AS version"
_ALERTS = """SELECT CAST(1 AS BIGINT) AS chain_id, metric_name, scope_key, severity, round(value, 6) AS current_value, round(previous_value, 6) AS previous_value, kind AS threshold_type, t AS threshold_value,
  message FROM (SELECT *, CASE WHEN value >= 3 * previous_value AND metric_name = 'largest_cluster_size' THEN 'critical' ELSE 'warning' END AS severity FROM cmp) JOIN (VALUES
    ('largest_cluster_size', 'relative_increase', 1.0::DOUBLE, 'Largest cluster size increased beyond the configured guardrail.'),
    ('propagated_label_count', 'relative_increase', 1.0::DOUBLE, 'Propagated label count increased beyond the configured guardrail.'),
    ('conflict_count', 'absolute_count', 1.0::DOUBLE, 'Label conflicts increased to a non-trivial count.')) r(name, kind, t, message) ON name = metric_name
  WHERE value > 0"""
_COMPARED = """, cmp AS (SELECT metric_group, metric_name, scope_key, value, value / 4 AS previous_value FROM dm)"""
_METRICS = """SELECT CAST(1 AS BIGINT) AS chain_id, metric_group, metric_name, scope_key, round(value, 6) AS value, round(value / 4, 6) AS previous_value, round(value - value / 4, 6) AS absolute_change,
  CASE WHEN value <> 0 THEN 3.0::DOUBLE END AS relative_change FROM dm"""
_LABELS = SQL["label_evaluation"]
_PAIRWISE = SQL["clustering_evaluation"]
_ENTITIES = SQL["entities"]
_CURRENT = "CASE WHEN cluster_id IS NOT NULL THEN 'cluster-run' END AS cluster_run_id"

VIEWS = {
    "current_canonical_blocks": """SELECT CAST(1 AS BIGINT) AS chain_id, o_orderkey AS block_number, '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS block_hash, 'p' || o_orderkey AS parent_hash,
        CASE o_orderstatus WHEN 'F' THEN 'safe' ELSE 'unsafe' END AS security_level, CAST(CASE o_orderstatus WHEN 'P' THEN 2 ELSE 1 END AS BIGINT) AS version FROM orders""",
    "canonical_transactions": with_(f"""SELECT chain_id, block_number, block_hash, block_timestamp, tx_hash, tx_index, supplier AS from_address, customer AS to_address, {hex64('quantity')} AS value_wei,
        CAST(21000 AS BIGINT) AS gas, CAST(NULL AS VARCHAR) AS gas_price, '0x' AS input, CAST(status AS BIGINT) AS status FROM fact""", "fact"),
    "canonical_token_transfers": with_(f"""SELECT chain_id, block_number, block_hash, block_timestamp, tx_hash, tx_index + 100 AS log_index, part AS token_address, customer AS from_address,
        supplier AS to_address, {hex64('price')} AS amount_raw FROM fact WHERE l_linestatus = 'F'""", "fact"),
    "latest_cluster_runs": with_(f"SELECT {_RUN.format(run=CLUSTER)}, {COUNTED.format('feat')} AS wallet_count, {COUNTED.format('pair')} AS resolution_edge_count, {COUNTED.format('grp')} AS cluster_count",
                                 "feat", "grp", "pair"),
    "latest_label_runs": with_(f"""SELECT {_RUN.format(run=LABEL)}, 'cluster-run' AS cluster_run_id, (SELECT count(*) FROM named WHERE rn = 1) + {COUNTED.format('cid')} AS entity_count,
        (SELECT count(*) FROM asg WHERE assignment_method = 'direct_seed') AS direct_label_count, (SELECT count(*) FROM asg WHERE assignment_method = 'cluster_propagation') AS propagated_label_count,
        {COUNTED.format('conf')} AS conflict_count""", "named", "cid", "asg", "conf"),
    "latest_evaluation_runs": f"SELECT {_RUN.format(run=EVALUATION)}, 'cluster-run' AS cluster_run_id, 'label-run' AS label_run_id",
    "current_wallet_transfer_edges": with_(EDGE_ROWS, "edge"),
    "current_wallet_funding_edges": SQL["first_funder"].replace("0.7::DOUBLE AS confidence", f"{f32('0.7')} AS confidence"),
    "current_wallet_features": SQL["wallet_features"],
    "current_entity_resolution_edges": with_(f"SELECT {PAIR}, {f32('score')} AS score, CAST(3 AS INTEGER) AS evidence_count, edge_id FROM pair", "pair"),
    "current_cluster_evidence": "SELECT * REPLACE (" + f32("weight") + " AS weight, " + f32("score_contribution") + " AS score_contribution) FROM (" + SQL["resolution_evidence"] + ")",
    "current_wallet_clusters": with_(f"SELECT chain_id, cluster_id, wallet_address, cluster_size, {f32('confidence')} AS confidence, 'shared_funder_v1' AS heuristic_version FROM clus", "clus"),
    "current_entities": f"SELECT *, {_CURRENT} FROM ({_ENTITIES})",
    "current_entity_members": f"SELECT * REPLACE ({f32('membership_confidence')} AS membership_confidence), {_CURRENT} FROM ({SQL['entity_members']})",
    "current_label_assignments": with_(f"SELECT * REPLACE ({f32('confidence')} AS confidence) FROM asg", "asg"),
    "current_label_evidence": f"SELECT * REPLACE ({f32('weight')} AS weight, {f32('confidence_contribution')} AS confidence_contribution) FROM ({SQL['label_evidence']})",
    "current_label_conflicts": with_("SELECT *, 'cluster-run' AS cluster_run_id FROM conf", "conf"),
    "current_label_evaluations": f"SELECT CAST(1 AS BIGINT) AS chain_id, * FROM ({_LABELS})",
    "current_clustering_evaluations": f"SELECT CAST(1 AS BIGINT) AS chain_id, * FROM ({_PAIRWISE})",
    "current_drift_metrics": with_(DRIFT + _METRICS, "csize", "asg", "seed", "fund"),
    "current_drift_alerts": with_(DRIFT + _COMPARED + _ALERTS, "csize", "asg", "seed", "fund"),
}
RUN_COLUMNS = {"latest_cluster_runs": ("wallet_count", "resolution_edge_count", "cluster_count"),
               "latest_label_runs": ("cluster_run_id", "entity_count", "direct_label_count", "propagated_label_count", "conflict_count"), "latest_evaluation_runs": ("cluster_run_id", "label_run_id")}
ROUNDED = ("value", "previous_value", "absolute_change", "relative_change", "current_value")


def rounded(df: DataFrame) -> DataFrame:
    """Averages may differ in the last digits with the order of their sums."""
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED if c in df.columns})


def _view(name: str):
    def read(spark, sf_dir):
        df = filled(spark, sf_dir).views()[name]
        return df.select("chain_id", "run_id", "status", "version", *RUN_COLUMNS[name]) if name in RUN_COLUMNS else rounded(shown(df))

    read.__name__ = f"view_{name}"
    return read


for _name, _sql in VIEWS.items():
    query(_sql)(_view(_name))


# Api -------------------------------------------------------------------------------------------------


def top_cluster(api: Api) -> str:
    return api.clusters(CHAIN, limit=1).first()["cluster_id"]


TOP = "top AS (SELECT cluster_id FROM clus GROUP BY 1 ORDER BY max(cluster_size) DESC, cluster_id LIMIT 1), w AS (SELECT * FROM clus WHERE cluster_id IN (SELECT cluster_id FROM top))"


@query(with_(f", {TOP} SELECT wallet_address, {f32('confidence')} AS confidence, cluster_size FROM w ORDER BY wallet_address LIMIT 50 OFFSET 1", "clus"))
def api_cluster_members(spark, sf_dir):
    api = Api(filled(spark, sf_dir))
    return shown(api.cluster_members(top_cluster(api), CHAIN, 50, 1)).select("wallet_address", "confidence", "cluster_size")


@query(with_(f""", {TOP}, e AS (SELECT * REPLACE ({f32('weight')} AS weight, {f32('score_contribution')} AS score_contribution) FROM ({EVIDENCE}))
  SELECT * FROM e WHERE wallet_a IN (SELECT wallet_address FROM w) AND wallet_b IN (SELECT wallet_address FROM w) ORDER BY wallet_a, wallet_b, heuristic, evidence_type LIMIT 500""", "clus", "pair"))
def api_cluster_evidence(spark, sf_dir):
    api = Api(filled(spark, sf_dir))
    return shown(api.cluster_evidence(top_cluster(api), CHAIN, MAX_LIMIT))


FIRST = "one AS (SELECT min(wallet_address) AS a FROM w)"


def first_member(api: Api) -> str:
    return api.cluster_members(top_cluster(api), CHAIN, 1).first()["wallet_address"]


@query(with_(f", {TOP}, {FIRST} SELECT x.* FROM ({FEATURES.replace(', e AS', 'WITH e AS', 1)}) x JOIN one ON wallet_address = a", "clus", "edge", "fund"))
def api_features(spark, sf_dir):
    """A wallet's features; amounts are served as decimals and shown as stored."""
    from ..functions import u256

    api = Api(filled(spark, sf_dir))
    wide = lambda c: u256.from_long(F.col(c).cast("long"))
    return shown(api.features(first_member(api), CHAIN)).withColumns({c: wide(c) for c in ("native_received_wei", "native_sent_wei")})


@query(with_(f""", {TOP}, {FIRST} SELECT a AS address, CAST(1 AS BIGINT) AS chain_id, (SELECT cluster_id FROM top) AS cluster_id, coalesce(n.entity_id, cid.entity_id) AS entity_id,
    CASE WHEN n.entity_id IS NULL THEN 'cluster_membership' ELSE 'direct_seed' END AS membership_method, CAST((SELECT count(*) FROM asg WHERE subject_type = 'address' AND subject_id = a) AS INTEGER) AS n_labels
  FROM one JOIN top ON true JOIN cid ON cid.cluster_id = top.cluster_id LEFT JOIN named n ON n.address = a""", "clus", "named", "cid", "asg"))
def api_wallet(spark, sf_dir):
    api = Api(filled(spark, sf_dir))
    return api.wallet(first_member(api), CHAIN, CLUSTER, LABEL).select(
        "address", "chain_id", "cluster.cluster_id", "entity.entity_id", "entity.membership_method", F.size("labels").alias("n_labels"))


@query(with_("""SELECT entity_id, entity_name AS display_name, entity_category, 'direct_seed' AS created_from FROM named WHERE rn = 1 ORDER BY entity_id DESC LIMIT 1""", "named"))
def api_entity(spark, sf_dir):
    api = Api(filled(spark, sf_dir))
    last = api._of("label", "entities", CHAIN, None).agg(F.max("entity_id")).first()[0]
    return api.entity(last, CHAIN).select("entity_id", "display_name", "entity_category", "created_from")


@query(with_(f"""SELECT address AS wallet_address, 'direct_seed' AS membership_method, {f32('confidence')} AS membership_confidence FROM named
  WHERE entity_id = (SELECT max(entity_id) FROM named) ORDER BY 1, 2 LIMIT 500""", "named"))
def api_entity_members(spark, sf_dir):
    api = Api(filled(spark, sf_dir))
    last = api._of("label", "entities", CHAIN, None).agg(F.max("entity_id")).first()[0]
    return shown(api.entity_members(last, CHAIN, MAX_LIMIT)).select("wallet_address", "membership_method", "membership_confidence")


@query(with_(f"""SELECT label_dimension, label_value, {f32('confidence')} AS confidence, 'curated_seed' AS evidence_type, 'curated label for ' || address AS evidence_value, source_reference FROM dir
  WHERE subject_type = 'address' AND subject_id = (SELECT max(address) FROM seed)""", "dir", "seed"))
def api_labels(spark, sf_dir):
    """The labels of an address with their evidence, a row each."""
    api = Api(filled(spark, sf_dir))
    who = api._of("label", "label_assignments", CHAIN, None).where("subject_type = 'address' AND assignment_method = 'direct_seed'").agg(F.max("subject_id")).first()[0]
    return api.labels("address", who, CHAIN).select("label_dimension", "label_value", F.col("confidence").cast("double").alias("confidence"), F.explode("evidence").alias("e"), "source_reference").select(
        "label_dimension", "label_value", "confidence", "e.evidence_type", "e.evidence_value", "source_reference")


@query(f"SELECT * FROM ({VIEWS['current_drift_alerts']}) ORDER BY CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END DESC, metric_name, scope_key LIMIT 50")
def api_alerts(spark, sf_dir):
    return rounded(shown(Api(filled(spark, sf_dir)).drift_alerts(CHAIN)))


@query(f"SELECT * FROM ({VIEWS['current_label_evaluations']})")
def api_evaluation_labels(spark, sf_dir):
    return shown(Api(filled(spark, sf_dir)).evaluation(CHAIN)["label_metrics"])


@query(f"SELECT * FROM ({VIEWS['current_drift_metrics']}) WHERE metric_group = 'coverage'")
def api_evaluation_coverage(spark, sf_dir):
    return rounded(shown(Api(filled(spark, sf_dir)).evaluation(CHAIN, EVALUATION)["coverage_metrics"]))


@query(with_(DRIFT + """SELECT CAST(1 AS BIGINT) AS chain_id, metric_group, metric_name, scope_key, round(value / 4, 6) AS value, CAST(NULL AS DOUBLE) AS previous_value, CAST(NULL AS DOUBLE) AS absolute_change,
  CAST(NULL AS DOUBLE) AS relative_change FROM dm""", "csize", "asg", "seed", "fund"))
def api_past_evaluation(spark, sf_dir):
    """An earlier run, named: the current one does not shadow it."""
    return rounded(shown(Api(filled(spark, sf_dir)).evaluation(CHAIN, f"{EVALUATION}-0")["drift_metrics"]))


@query("""SELECT 'block_ingestion' AS job_name, CAST(1 AS BIGINT) AS chain_id, CAST(300 AS BIGINT) AS last_processed_block, 'h3' AS last_processed_block_hash, CAST(3 AS BIGINT) AS version,
  'failed' AS failed_run_status, 'running' AS running_run_status""")
def store_states(spark, sf_dir):
    """The checkpoint and the states of runs as the store answers them."""
    store = filled(spark, sf_dir)
    at = store.checkpoint(runs.JOB, CHAIN)
    names = ("job_name", "chain_id", "last_processed_block", "last_processed_block_hash", "version")
    states = [store.run_state("cluster_runs", r)["status"] for r in ("failed-run", "running-run")]
    return spark.createDataFrame([(*(at[n] for n in names), *states)],
                                 "job_name string, chain_id bigint, last_processed_block bigint, last_processed_block_hash string, version bigint, failed_run_status string, running_run_status string")
