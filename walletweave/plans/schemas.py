"""Declared schemas of the stored tables; nothing is inferred."""

from __future__ import annotations

from typing import NamedTuple


class Table(NamedTuple):
    columns: str
    partition: tuple[str, ...] = ("chain_id",)


_RUN_STATE = "status string, started_at timestamp, completed_at timestamp, error string, version bigint"
_BLOCK = "chain_id bigint, block_number bigint, block_hash string"

#: Column order is part of the declaration. 256-bit amounts are 64 hex digits.
TABLES = {
    "raw_blocks": Table(f"{_BLOCK}, parent_hash string, block_timestamp timestamp, transaction_count int, ingested_at timestamp"),
    "raw_transactions": Table(f"{_BLOCK}, block_timestamp timestamp, tx_hash string, tx_index bigint, from_address string, to_address string, "
                              "value_wei string, gas bigint, gas_price string, input string, status bigint, ingested_at timestamp"),
    "token_transfers": Table(f"{_BLOCK}, block_timestamp timestamp, tx_hash string, log_index bigint, token_address string, from_address string, "
                             "to_address string, amount_raw string, ingested_at timestamp"),
    "canonical_blocks": Table(f"{_BLOCK}, parent_hash string, security_level string, observed_at timestamp, version bigint"),
    "canonical_blocks_history": Table(f"{_BLOCK}, parent_hash string, security_level string, canonical int, reason string, detected_at timestamp, sequence bigint"),
    "reorg_events": Table("chain_id bigint, reorg_id string, detected_at timestamp, old_head_block bigint, old_head_hash string, new_head_block bigint, "
                          "new_head_hash string, common_ancestor_block bigint, orphaned_block_count bigint, replacement_block_count bigint"),
    "pipeline_runs": Table(f"run_id string, job_name string, chain_id bigint, mode string, start_block bigint, end_block bigint, {_RUN_STATE}"),
    "pipeline_checkpoints": Table("job_name string, chain_id bigint, last_processed_block bigint, last_processed_block_hash string, updated_at timestamp, version bigint"),
    "wallet_transfer_edges": Table(f"{_BLOCK}, block_timestamp timestamp, tx_hash string, asset_type string, token_address string, from_address string, "
                                   "to_address string, amount_raw string, edge_id string, derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "wallet_funding_edges": Table("chain_id bigint, funded_address string, funder_address string, funding_tx_hash string, funding_block_number bigint, "
                                  "funding_block_hash string, funding_timestamp timestamp, amount_wei string, heuristic string, confidence float, "
                                  "derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "wallet_features": Table("chain_id bigint, wallet_address string, first_seen_block bigint, last_seen_block bigint, incoming_native_tx_count bigint, "
                             "outgoing_native_tx_count bigint, incoming_erc20_transfer_count bigint, outgoing_erc20_transfer_count bigint, "
                             "unique_counterparties bigint, native_received_wei string, native_sent_wei string, first_funder_address string, "
                             "first_funding_block bigint, derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "entity_resolution_edges": Table("chain_id bigint, wallet_a string, wallet_b string, heuristic string, score float, evidence_count int, edge_id string, "
                                     "derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "cluster_evidence": Table("chain_id bigint, wallet_a string, wallet_b string, heuristic string, evidence_type string, evidence_value string, weight float, "
                              "score_contribution float, derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "wallet_clusters": Table("chain_id bigint, cluster_id string, wallet_address string, cluster_size int, confidence float, heuristic_version string, "
                             "derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "cluster_runs": Table("run_id string, chain_id bigint, start_block bigint, end_block bigint, heuristic_version string, wallet_count bigint, "
                          f"resolution_edge_count bigint, cluster_count bigint, {_RUN_STATE}"),
    "label_taxonomy": Table("taxonomy_version string, label_dimension string, label_value string, description string, active int, created_at timestamp", ()),
    "label_runs": Table("run_id string, chain_id bigint, cluster_run_id string, taxonomy_version string, seed_dataset_version string, entity_count bigint, "
                        f"direct_label_count bigint, propagated_label_count bigint, conflict_count bigint, {_RUN_STATE}"),
    "entities": Table("chain_id bigint, entity_id string, display_name string, entity_category string, created_from string, cluster_id string, "
                      "cluster_run_id string, derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "entity_members": Table("chain_id bigint, entity_id string, wallet_address string, membership_method string, membership_confidence float, "
                            "cluster_id string, cluster_run_id string, derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "label_assignments": Table("chain_id bigint, subject_type string, subject_id string, entity_id string, label_dimension string, label_value string, "
                               "confidence float, assignment_method string, source_type string, source_reference string, taxonomy_version string, "
                               "derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "label_evidence": Table("chain_id bigint, subject_type string, subject_id string, label_dimension string, label_value string, evidence_type string, "
                            "evidence_value string, weight float, confidence_contribution float, source_type string, source_reference string, "
                            "derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "label_conflicts": Table("chain_id bigint, cluster_id string, cluster_run_id string, conflict_type string, details string, derived_at timestamp, "
                             "run_id string", ("chain_id", "run_id")),
    "evaluation_runs": Table("run_id string, chain_id bigint, cluster_run_id string, label_run_id string, start_block bigint, end_block bigint, "
                             "heuristic_version string, taxonomy_version string, ground_truth_version string, seed_dataset_version string, "
                             f"evaluation_version string, {_RUN_STATE}"),
    "label_evaluations": Table("chain_id bigint, label_dimension string, label_value string, assignment_method string, tp bigint, fp bigint, fn bigint, "
                               "precision double, recall double, f1 double, support bigint, predicted_count bigint, coverage double, derived_at timestamp, "
                               "run_id string", ("chain_id", "run_id")),
    "clustering_evaluations": Table("chain_id bigint, metric_scope string, tp_pairs bigint, fp_pairs bigint, fn_pairs bigint, pairwise_precision double, "
                                    "pairwise_recall double, pairwise_f1 double, ground_truth_entity_count bigint, ground_truth_address_count bigint, "
                                    "evaluated_address_count bigint, predicted_cluster_count bigint, derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "drift_metrics": Table("chain_id bigint, metric_group string, metric_name string, scope_key string, value double, previous_value double, "
                           "absolute_change double, relative_change double, derived_at timestamp, run_id string", ("chain_id", "run_id")),
    "drift_alerts": Table("chain_id bigint, alert_id string, metric_name string, scope_key string, severity string, current_value double, previous_value double, "
                          "threshold_type string, threshold_value double, message string, derived_at timestamp, run_id string", ("chain_id", "run_id")),
}

#: Scope of a "latest" run per kind, and the tables that hold its snapshot.
CLUSTER_SCOPE = ["chain_id", "start_block", "end_block", "heuristic_version"]
LABEL_SCOPE = ["chain_id", "cluster_run_id", "taxonomy_version", "seed_dataset_version"]
EVALUATION_SCOPE = ["chain_id", "start_block", "end_block", "heuristic_version", "taxonomy_version", "ground_truth_version", "evaluation_version"]
CLUSTER_TABLES = ("wallet_clusters", "entity_resolution_edges", "cluster_evidence", "wallet_features", "wallet_funding_edges", "wallet_transfer_edges")
LABEL_TABLES = ("entities", "entity_members", "label_assignments", "label_evidence", "label_conflicts")
EVALUATION_TABLES = ("label_evaluations", "clustering_evaluations", "drift_metrics", "drift_alerts")
