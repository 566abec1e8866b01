import itertools
import random
from math import comb

import pytest
from pyspark.sql import functions as F

from walletweave.operators import canonical as C
from walletweave.operators import evaluation as E
from walletweave.operators import labels as L
from walletweave.operators import resolution as R
from walletweave.operators import state as ST
from walletweave.operators import transfers as X
from walletweave.operators.components import connected_components
from walletweave.sources import seeds as S

from .helpers import FUNDING, MEMBER, TRANSFER, TX, address, digest, funded, hex64, seed, transfer, tx


def test_latest_state_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "b", 1)], "k int, s string, version long")
    assert sorted((r.k, r.s, r.version) for r in ST.latest_by_version(df, ["k"]).collect()) == [(1, None, 2), (2, "b", 1)]


def test_latest_completed_ignores_failed_and_older(spark):
    rows = [("r1", 1, "completed", "2024-01-01", 3), ("r2", 1, "running", "2024-01-02", 2), ("r2", 1, "failed", "2024-01-02", 3), ("r3", 1, "completed", "2024-01-01", 3)]
    df = spark.createDataFrame(rows, "run_id string, chain_id int, status string, completed_at string, version long")
    assert [r.run_id for r in ST.latest_completed(df, ["chain_id"]).collect()] == ["r3"]


def test_next_versions_is_idempotent(spark):
    cur = spark.createDataFrame([(1, "a", 4)], "k int, v string, version long")
    new = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert [tuple(r) for r in ST.next_versions(cur, new, ["k"], ["v"]).collect()] == [(2, None, 1)]


def test_edges(spark):
    txs = spark.createDataFrame([tx(1, 2), tx(1, 2, index=1, status=None), tx(1, 2, index=2, status=0), tx(1, 2, index=3, value=0), tx(1, 1, index=4),
                                 tx(1, None, index=5), tx(1, 0, index=6)], TX)
    moves = spark.createDataFrame([transfer(1, 2), transfer(1, 2, log=1, amount=0), transfer(2, 2, log=2)], TRANSFER)
    got = X.transfer_edges(txs, moves).collect()
    assert len(got) == 3 and len({r.edge_id for r in got}) == 3
    assert [r.asset_type for r in got].count("erc20") == 1


def test_first_funder_and_features(spark):
    txs = spark.createDataFrame([tx(1, 3, block=100, index=9), tx(2, 3, block=100, index=2), tx(1, 3, block=99, status=0), tx(3, 4, block=105, value=2**200)], TX)
    moves = spark.createDataFrame([transfer(4, 3, block=106)], TRANSFER)
    edges = X.transfer_edges(txs, moves)
    funding = X.first_funders(edges)
    assert {r.funded_address: r.funder_address for r in funding.collect()} == {address(3): address(2), address(4): address(3)}
    rows = {r.wallet_address: r for r in X.wallet_features(edges, funding).collect()}
    three = rows[address(3)]
    assert (three.incoming_native_tx_count, three.outgoing_native_tx_count, three.incoming_erc20_transfer_count, three.outgoing_erc20_transfer_count) == (2, 1, 1, 0)
    assert three.unique_counterparties == 3 and three.native_sent_wei == hex64(2**200) and three.native_received_wei == hex64(10)
    assert (three.first_seen_block, three.last_seen_block, three.first_funding_block) == (100, 106, 100)
    assert rows[address(1)].first_funder_address is None


def test_shared_funder(spark):
    f = spark.createDataFrame([funded(9, 1, 0), funded(9, 2, 10), funded(9, 3, 20)], FUNDING)
    pairs = R.shared_funder_pairs(f, 60, 10)
    evidence = R.resolution_evidence(pairs, 60, 10)
    assert pairs.count() == 3 and evidence.count() == 9
    total = evidence.groupBy("wallet_a", "wallet_b").agg(F.sum("score_contribution").alias("s"))
    assert all(r.s == pytest.approx(r.score) for r in pairs.join(total, ["wallet_a", "wallet_b"]).collect())
    assert {r.delta_seconds for r in pairs.collect()} == {10, 20}


@pytest.mark.parametrize("rows,limit,expected", [
    ([(9, 1, 0), (9, 2, 1), (9, 3, 2), (9, 4, 3)], 3, 0), ([(9, 1, 0), (9, 2, 61)], 10, 0), ([(9, 1, 0), (9, 2, 60)], 10, 1),
    ([(9, 1, 0)], 10, 0), ([(9, 1, 0), (9, 2, 1), (9, 3, 2)], 3, 3), ([(9, 1, 0), (9, 2, 1)], 2, 1)])
def test_guards(spark, rows, limit, expected):
    f = spark.createDataFrame([funded(*r) for r in rows], FUNDING)
    assert R.shared_funder_pairs(f, 60, limit).count() == expected


def test_components_agree(spark):
    rng = random.Random(3)
    rows = [funded(100 + rng.randrange(6), n, rng.randrange(400)) for n in range(1, 60)]
    f = spark.createDataFrame(rows, FUNDING)
    pairs = R.shared_funder_pairs(f, 20, 20)
    islands = {(r.wallet, r.root) for r in R.island_components(f, 20, 20).collect()}
    assert islands == {(r.wallet, r.root) for r in R.edge_components(pairs).collect()}
    members = R.clusters(R.island_components(f, 20, 20), pairs).collect()
    again = R.clusters(R.island_components(f.orderBy(F.desc("funded_address")), 20, 20), pairs).collect()
    assert sorted(map(tuple, members)) == sorted(map(tuple, again))
    assert all(m.cluster_size > 1 for m in members)


def test_connected_components_on_a_random_graph(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(230)] + [(n, n + 1) for n in range(1000, 1060)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    want = {n: root(n) for e in edges if e[0] != e[1] for n in e}
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


BLOCKS = "chain_id long, block_number long, block_hash string, parent_hash string, security_level string, version long"


def test_canonical_and_reorg(spark):
    cur = C.current_blocks(spark.createDataFrame([(1, 100, "AAA", "x", "unsafe", 1), (1, 100, "BBB", "x", "safe", 2)], BLOCKS))
    assert [(r.block_hash, r.security_level, r.version) for r in cur.collect()] == [("BBB", "safe", 2)]
    facts = spark.createDataFrame([(1, 100, "AAA", "t1"), (1, 100, "BBB", "t2")], "chain_id long, block_number long, block_hash string, tx string")
    assert [r.tx for r in C.canonical_facts(facts, cur).collect()] == ["t2"]
    stored = spark.createDataFrame([(1, n, f"a{n}", f"a{n - 1}", "unsafe", 1) for n in range(100, 104)], BLOCKS)
    remote = spark.createDataFrame([(1, 100, "A100", "a99")] + [(1, n, f"b{n}", "a100" if n == 101 else f"b{n - 1}") for n in (101, 102, 103)],
                                   "chain_id long, block_number long, block_hash string, parent_hash string")
    plan = C.reorg_plan(remote, stored)
    event = C.reorg_event(plan).first()
    assert (event.common_ancestor_block, event.orphaned_block_count, event.replacement_block_count) == (100, 3, 3)
    assert (event.old_head_hash, event.new_head_hash) == ("a103", "b103")
    assert C.reorg_conflicts(remote, stored).count() == 3
    with pytest.raises(Exception, match="ancestor"):
        C.reorg_plan(remote.where("block_number > 100"), stored).collect()
    assert C.set_canonical(stored, stored.drop("version")).count() == 0
    heads = spark.createDataFrame([(1, 102, 100)], "chain_id long, safe long, finalized long")
    up = C.finality_upgrades(stored.withColumn("security_level", F.when(F.col("block_number") == 101, "finalized").otherwise(F.col("security_level"))), heads)
    assert {r.block_number: r.security_level for r in up.collect()} == {100: "finalized", 102: "safe"}
    with pytest.raises(ValueError):
        C.check_heads(5, 6, 1)


def members(spark, *rows):
    return spark.createDataFrame([(1, c, address(n), conf, "run") for c, n, conf in rows], MEMBER)


def test_propagation(spark):
    s, m = S.to_frame(spark, [seed(1)]), members(spark, ("c", 1, 0.8), ("c", 2, 0.7), ("c", 3, 0.6))
    spread = {r.subject_id: r for r in L.assignments(s, m).where("assignment_method = 'cluster_propagation'").collect()}
    assert len(spread) == 3 and all(r.label_dimension == "entity_category" for r in spread.values())
    assert spread[address(2)].confidence == pytest.approx(0.9 * 0.7 * 0.95)
    evidence = L.label_evidence(s, m).where(F.col("subject_id") == address(2)).collect()
    assert {r.evidence_type: r.evidence_value for r in evidence} == {
        "labeled_cluster_member": address(1), "cluster_membership_confidence": format(0.7, ".17g"), "propagation_factor": "0.94999999999999996"}
    with pytest.raises(Exception, match="confidence"):
        L.assignments(s, members(spark, ("c", 1, 1.8), ("c", 2, 0.7))).collect()


def test_conflicts_stop_propagation(spark):
    s, m = S.to_frame(spark, [seed(1), seed(2, name="Beta")]), members(spark, ("c", 1, 0.8), ("c", 2, 0.7), ("c", 3, 0.6), ("d", 4, 0.5), ("d", 5, 0.5))
    found = L.conflicts(s, m).collect()
    assert [r.details for r in found] == [f'{{"addresses":["{address(1)}","{address(2)}"],"entity_names":["Acme","Beta"]}}']
    assert L.assignments(s, m).where("assignment_method = 'cluster_propagation'").count() == 0
    kinds = {r.entity_category for r in L.entities(s, m).where("created_from = 'cluster_membership'").collect()}
    assert kinds == {"unknown"} and L.entity_members(s, m).count() == 7
    with pytest.raises(Exception, match="conflicting categories"):
        L.entities(S.to_frame(spark, [seed(1), seed(2, category="bridge")]), m).collect()


def test_labels_are_deterministic(spark):
    rows = [seed(1), seed(2, name="ACME", confidence=0.95), seed(7, name="Beta", category="bridge", role=None)]
    m = [("c", 1, 0.8), ("c", 2, 0.7), ("c", 3, 0.6), ("d", 7, 0.9), ("d", 8, 0.9)]
    one = L.assignments(S.to_frame(spark, rows), members(spark, *m)).collect()
    two = L.assignments(S.to_frame(spark, rows[::-1]), members(spark, *m[::-1])).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, two))
    assert len({r.entity_id for r in one if r.assignment_method == "direct_seed"}) == 2


PRED = "subject string, dimension string, method string, value string"


def test_label_evaluation(spark):
    s = S.to_frame(spark, [seed(1), seed(2, name="B", category="protocol"), seed(3, name="C")])
    p = spark.createDataFrame([(address(n), "entity_category", "direct_seed", "dex") for n in (1, 2, 9)], PRED)
    rows = {(r.label_dimension, r.assignment_method, r.label_value): r for r in E.evaluate_labels(E.truth_labels(s), p).collect()}
    dex = rows["entity_category", "direct_seed", "dex"]
    assert (dex.tp, dex.fp, dex.fn, dex.support, dex.predicted_count) == (1, 1, 1, 2, 3) and dex.coverage == pytest.approx(2 / 3)
    none = rows["entity_category", "cluster_propagation", "dex"]
    assert (none.tp, none.fn, none.precision, none.coverage) == (0, 2, None, 0.0)


def brute_pairs(truth, cluster):
    tp = fp = fn = 0
    for a, b in itertools.combinations(sorted(truth), 2):
        same, together = truth[a] == truth[b], a in cluster and b in cluster and cluster[a] == cluster[b]
        tp, fp, fn = tp + (same and together), fp + (together and not same), fn + (same and not together)
    return tp, fp, fn


def test_pairwise_evaluation_matches_brute_force(spark):
    rng = random.Random(7)
    cases = [({1: "A", 2: "A", 3: "B", 4: "B"}, {1: "x", 2: "x", 3: "y", 4: "y"}), ({1: "A", 2: "B"}, {1: "x", 2: "x"}), ({1: "A", 2: "A"}, {1: "x"}), ({}, {})]
    truth = {n: f"e{rng.randrange(6)}" for n in range(60)}
    cases.append((truth, {n: f"c{rng.randrange(8)}" for n in truth if rng.random() < 0.7}))
    for truth, cluster in cases:
        t = spark.createDataFrame([(address(n + 1), e) for n, e in truth.items()], "address string, entity string")
        c = spark.createDataFrame([(address(n + 1), x) for n, x in cluster.items()], "address string, cluster_id string")
        row = E.evaluate_clustering(t, t.select("address"), c).first()
        assert (row.tp_pairs, row.fp_pairs, row.fn_pairs) == brute_pairs(truth, cluster)
    assert comb(4, 2) == 6


def test_size_statistics(spark):
    sizes = [1, 2, 3, 10]
    rows = [(str(i), float(i)) for i, n in enumerate(sizes) for _ in range(n)]
    got = E.size_statistics(spark.createDataFrame(rows, "cluster_id string, confidence double")).first()
    assert tuple(got) == (4.0, 10.0, 4.0, 2.5, 10.0, 1.5)
    empty = E.size_statistics(spark.createDataFrame([], "cluster_id string, confidence double")).first()
    assert set(empty) == {0.0}


def drift_rows(spark, rows):
    df = spark.createDataFrame([("g", n, "all", float(v)) for n, v, _ in rows], "metric_group string, metric_name string, scope_key string, value double")
    old = spark.createDataFrame([("g", n, "all", float(p)) for n, _, p in rows if p is not None], df.schema)
    return E.compare_drift(df, old)


@pytest.mark.parametrize("rows,alerts", [
    ([("largest_cluster_size", 25, 10)], [("largest_cluster_size", "warning")]), ([("largest_cluster_size", 30, 10)], [("largest_cluster_size", "critical")]),
    ([("cluster_count", 4, 10), ("wallet_count", 102, 100)], [("cluster_count", "warning")]), ([("cluster_count", 4, 10), ("wallet_count", 120, 100)], []),
    ([("cluster_count", 4, 10), ("wallet_count", 120, None)], [("cluster_count", "warning")]), ([("cluster_count", 4, 10)], []),
    ([("propagated_label_count", 1, 0)], [("propagated_label_count", "warning")]), ([("propagated_label_count", 1, None)], []),
    ([("conflict_count", 1, 0)], [("conflict_count", "warning")]), ([("conflict_count", 1, 1)], []),
    ([("seed_seen_count", 8, 10), ("seed_cluster_overlap_count", 9, 10)], [("seed_seen_count", "warning")])])
def test_alerts(spark, rows, alerts):
    assert sorted((r.metric_name, r.severity) for r in E.drift_alerts(drift_rows(spark, rows)).collect()) == sorted(alerts)


def test_changes(spark):
    rows = {r.metric_name: r for r in drift_rows(spark, [("a", 3, 0), ("b", -1, -2), ("c", 1, None)]).collect()}
    assert (rows["a"].absolute_change, rows["a"].relative_change) == (3.0, None)
    assert rows["b"].relative_change == 0.5 and rows["c"].absolute_change is None


def test_drift_metrics(spark):
    s = S.to_frame(spark, [seed(1), seed(2, name="B"), seed(3, name="C")])
    m = members(spark, ("c", 1, 0.8), ("c", 9, 0.7))
    seen = spark.createDataFrame([(address(1),), (address(2),)], "address string")
    got = {(r.metric_name, r.scope_key): r.value for r in E.drift_metrics({"wallet_count": 5, "resolution_edge_count": 2}, m, 4, L.assignments(s, m), 0, s, seen).collect()}
    assert got["seed_count", "all"] == 3 and got["seed_seen_count", "all"] == 2 and got["seed_cluster_overlap_count", "all"] == 1
    assert got["wallet_count", "all"] == 5 and got["largest_cluster_size", "all"] == 2 and got["label_count", "entity_category=dex"] == 8
    assert len([k for k in got if k[1] == "all"]) == 18
    assert digest(1).startswith("0x")


def test_a_cluster_of_two_runs_raises(spark):
    m = spark.createDataFrame([(1, "c", address(1), 0.8, "one"), (1, "c", address(2), 0.8, "two"), (1, "d", address(3), 0.8, "one")], MEMBER)
    with pytest.raises(Exception, match="more than one clustering run"):
        L.entities(S.to_frame(spark, [seed(1)]), m).collect()
    assert L.entities(S.to_frame(spark, [seed(1)]), m.where("cluster_run_id = 'one'")).count() == 3


def test_features_match_a_plain_loop(spark):
    rng = random.Random(4)
    txs = [tx(rng.randrange(1, 7), rng.randrange(1, 7), block=rng.randrange(1, 50), index=i, value=rng.choice([1, 2**200, 2**64 - 1]), h=i + 1) for i in range(200)]
    moved = [transfer(rng.randrange(1, 7), rng.randrange(1, 7), block=rng.randrange(1, 50), log=i, h=500 + i) for i in range(100)]
    edges = X.transfer_edges(spark.createDataFrame(txs, TX), spark.createDataFrame(moved, TRANSFER))
    want = {}
    for e in edges.collect():
        for me, other, out in ((e.from_address, e.to_address, True), (e.to_address, e.from_address, False)):
            w = want.setdefault(me, {"others": set(), "blocks": [], "n": [0, 0, 0, 0], "wei": [0, 0]})
            w["others"].add(other)
            w["blocks"].append(e.block_number)
            w["n"][(0 if e.asset_type == "native" else 2) + out] += 1
            if e.asset_type == "native":
                w["wei"][out] += int(e.amount_raw, 16)
    got = X.wallet_features(edges, X.first_funders(edges)).collect()
    assert len(got) == len(want) > 4
    for r in got:
        w = want[r.wallet_address]
        assert [r.incoming_native_tx_count, r.outgoing_native_tx_count, r.incoming_erc20_transfer_count, r.outgoing_erc20_transfer_count] == w["n"]
        assert (r.first_seen_block, r.last_seen_block, r.unique_counterparties) == (min(w["blocks"]), max(w["blocks"]), len(w["others"]))
        assert [int(r.native_received_wei, 16), int(r.native_sent_wei, 16)] == w["wei"]
