import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from walletweave.plans import api, runs
from walletweave.plans import schemas as S
from walletweave.plans.store import Warehouse
from walletweave.operators import labels as L
from walletweave.sources import decode, rpc
from walletweave.streaming import ingest

from .helpers import address, digest, seed

CAPTURE = "chain_id bigint, block string, receipts string, ingested_at timestamp"


def block(n, h, parent, sends=(), token=()):
    """A block's JSON: sends are (sender, recipient, value); token transfers are on the first transaction."""
    txs = [{"hash": digest(h * 100 + i), "transactionIndex": hex(i), "from": address(a), "to": address(b), "value": hex(v), "gas": "0x5208", "gasPrice": "0x1", "input": "0x"}
           for i, (a, b, v) in enumerate(sends)]
    pad = lambda x: "0x" + address(x)[2:].rjust(64, "0")
    logs = [{"address": address(77), "topics": [decode.TRANSFER_TOPIC, pad(a), pad(b)], "data": "0x" + f"{v:064x}", "logIndex": hex(7 + i)} for i, (a, b, v) in enumerate(token)]
    logs.append({"address": address(77), "topics": [digest(1)], "data": "0x", "logIndex": "0x63"})
    receipts = [{"transactionHash": t["hash"], "blockHash": digest(h), "status": "0x1", "logs": logs if i == 0 else []} for i, t in enumerate(txs)]
    return {"number": hex(n), "hash": digest(h), "parentHash": digest(parent), "timestamp": hex(1_700_000_000 + 12 * n), "transactions": txs}, receipts


class Node:
    def __init__(self, spark, blocks, safe=100, finalized=99):
        self.spark, self.blocks, self.safe, self.finalized = spark, dict(blocks), safe, finalized

    def capture(self, start, end):
        rows = [(1, json.dumps(self.blocks[n][0]), json.dumps(self.blocks[n][1]), datetime(2024, 1, 1)) for n in range(start, end + 1) if n in self.blocks]
        return self.spark.createDataFrame(rows, CAPTURE)

    def heads(self):
        return {"latest": max(self.blocks), "safe": self.safe, "finalized": self.finalized}


CHAIN = {100: block(100, 1100, 1099, [(9, 1, 5), (9, 2, 5)], [(1, 2, 123456)]), 101: block(101, 1101, 1100, [(9, 3, 2**255)]), 102: block(102, 1102, 1101), 103: block(103, 1103, 1102)}


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    store = Warehouse(spark, f"file://{tmp_path_factory.mktemp('warehouse')}")
    node = Node(spark, CHAIN)
    first = runs.Ingestion(store, 1, node.capture, node.heads).run(100, 103)
    return store, node, first


def test_backfill_reorg_and_replay(spark, world):
    store, node, first = world
    assert (first["blocks_processed"], first["reorgs_detected"]) == (4, 0)
    assert store.read("raw_transactions").count() == 3 and store.read("token_transfers").count() == 1
    t = store.read("token_transfers").first()
    assert (int(t.amount_raw, 16), t.log_index, t.token_address) == (123456, 7, address(77))
    levels = {r.block_number: r.security_level for r in store.current_canonical_blocks().collect()}
    assert levels == {100: "safe", 101: "unsafe", 102: "unsafe", 103: "unsafe"}
    node.blocks |= {101: block(101, 2101, 1100, [(9, 3, 7)]), 102: block(102, 2102, 2101), 103: block(103, 2103, 2102)}
    node.safe, node.finalized = 101, 100
    again = runs.Ingestion(store, 1, node.capture, node.heads).run(100, 103)
    assert again["reorgs_detected"] == 1 and again["blocks_processed"] == 0
    event = store.read("reorg_events").first()
    assert (event.common_ancestor_block, event.orphaned_block_count, event.replacement_block_count) == (100, 3, 3)
    current = {r.block_number: (r.block_hash, r.security_level) for r in store.current_canonical_blocks().collect()}
    assert current[101] == (digest(2101), "safe") and current[100] == (digest(1100), "finalized")
    assert store.canonical_transactions().where("block_number = 101").select("block_hash").distinct().count() == 1
    assert {r.reason for r in store.read("canonical_blocks_history").collect()} == {"observed", "reorg_orphaned", "reorg_replacement", "security_upgrade"}
    before = store.read("canonical_blocks").count()
    replay = runs.Ingestion(store, 1, node.capture, node.heads).run(100, 103)
    assert replay["blocks_processed"] == 0 and store.read("canonical_blocks").count() == before
    assert store.checkpoint(runs.JOB, 1)["last_processed_block_hash"] == digest(2103)
    node.finalized = 500
    with pytest.raises(ValueError, match="ordered"):
        runs.Ingestion(store, 1, node.capture, node.heads).run(100, 103)
    node.finalized = 100
    states = {r.status for r in store.read("pipeline_runs").collect()}
    assert states == {"pending", "running", "completed", "failed"}


def test_a_failed_backfill_resumes_behind_its_last_step(spark, tmp_path):
    """Steps are bounded and checkpointed each; what was done is not done again."""
    store, asked = Warehouse(spark, f"file://{tmp_path}/w"), []
    chain = {n: block(n, 1000 + n, 999 + n, [(9, n, 5)], [(n, 2, 6)]) for n in range(1, 8)}
    node = Node(spark, chain, safe=1, finalized=1)

    def capture(start, end):
        asked.append((start, end))
        if start <= 6 <= end and len(asked) < 4:
            raise ConnectionError("gone")
        return node.capture(start, end)

    backfill = runs.Ingestion(store, 1, capture, node.heads, step=2)
    with pytest.raises(ConnectionError):
        backfill.run(1, 7)
    assert asked == [(1, 2), (3, 4), (5, 6)] and store.checkpoint(runs.JOB, 1)["last_processed_block"] == 4
    assert store.current_canonical_blocks().count() == 4
    done = backfill.run(1, 7)
    assert asked[3:] == [(4, 4), (5, 6), (7, 7)] and store.current_canonical_blocks().count() == 7
    assert {k: v for k, v in done.items() if k != "run_id"} == {
        "chain_id": 1, "range": "1-7", "blocks_processed": 3, "transactions_inserted": 3, "transfers_decoded": 3, "reorgs_detected": 0, "final_checkpoint": f"7:{digest(1007)}"}
    assert runs.summary(done).splitlines()[1:3] == ["chain_id=1", "range=1-7"]
    assert store.canonical_transactions().count() == 7 and store.read("pipeline_runs").where("status = 'failed'").count() == 1
    node.blocks[8] = block(8, 3008, 3007)
    node.blocks |= {n: block(n, 3000 + n, 2999 + n if n > 6 else 1005, [(9, n, 8)]) for n in (6, 7)}
    node.blocks[8] = block(8, 3008, 3007, [(9, 8, 8)])
    fork = runs.Ingestion(store, 1, node.capture, node.heads, step=1).run(1, 8)
    assert (fork["reorgs_detected"], fork["blocks_processed"], fork["final_checkpoint"]) == (1, 1, f"8:{digest(3008)}")
    with pytest.raises(ValueError, match="was not captured"):
        runs.Ingestion(store, 1, node.capture, node.heads).run(9, 9)
    with pytest.raises(ValueError):
        runs.Ingestion(store, 1, node.capture, node.heads, step=0)


def test_tables_are_made_and_dropped(spark, tmp_path):
    store = Warehouse(spark, f"file://{tmp_path}/w")
    for _ in range(2):
        store.create("made")
    assert {t.name for t in spark.catalog.listTables("made")} == set(S.TABLES) and store.read("entities").count() == 0
    store.append_rows("entities", [{"chain_id": 1, "entity_id": "e", "run_id": "r"}])
    store.create("made")
    assert spark.sql("SELECT count(*) FROM made.entities WHERE chain_id = 1").first()[0] == 1
    for _ in range(2):
        store.drop("made")
    assert not spark.catalog.listTables("made") and not (tmp_path / "w" / "entities").exists()
    spark.sql("DROP DATABASE made")


def test_snapshots_and_reads(spark, world):
    store, _, _ = world
    with pytest.raises(ValueError):
        runs.cluster(store, 1, 5, 4)
    done = runs.cluster(store, 1, 100, 103)
    assert done["wallet_count"] == 4 and done["resolution_edge_count"] == 3 and done["cluster_count"] == 1
    with pytest.raises(ValueError, match="already completed"):
        runs.cluster(store, 1, 100, 103, resume=done["run_id"])
    store.seed_taxonomy(L.TAXONOMY_VERSION, L.TAXONOMY, datetime(2024, 1, 1))
    store.seed_taxonomy(L.TAXONOMY_VERSION, L.TAXONOMY, datetime(2024, 1, 1))
    assert store.read("label_taxonomy").count() == 16
    seeds = [seed(1)]
    labelled = runs.label(store, 1, seeds, done["run_id"])
    assert (labelled["entity_count"], labelled["direct_label_count"], labelled["propagated_label_count"], labelled["conflict_count"]) == (2, 3, 3, 0)
    one = runs.evaluate(store, 1, done["run_id"], labelled["run_id"], seeds)
    two = runs.evaluate(store, 1, done["run_id"], labelled["run_id"], seeds)
    assert store.current("drift_metrics").select("run_id").distinct().first()[0] == two["run_id"] != one["run_id"]
    drift = {r.metric_name: r for r in store.current("drift_metrics").where("scope_key = 'all'").collect()}
    assert drift["cluster_count"].previous_value == 1.0 and drift["cluster_count"].absolute_change == 0.0
    served = api.Api(store)
    row = served.wallet(address(2), 1).first()
    assert row.cluster.cluster_size == 3 and row.entity.membership_method == "cluster_membership" and len(row.labels) == 1 and len(row.labels[0].evidence) == 3
    assert row.features.native_received_wei == "5"
    assert served.wallet(address(50), 1).first().features is None
    assert served.entities(1, "dex").count() == 2 and served.entities(1, "bridge").count() == 0
    found = served.clusters(1, min_size=2).collect()
    assert len(found) == 1 and served.cluster_edges(found[0].cluster_id, 1).count() == 3 and served.cluster_evidence(found[0].cluster_id, 1).count() == 9
    assert served.cluster_members(found[0].cluster_id, 1, limit=2, offset=1).count() == 2
    summary = served.evaluation(1)
    assert summary["run"]["run_id"] == two["run_id"] and summary["coverage_metrics"].count() == 5 and summary["clustering_metrics"].first().pairwise_f1 is None
    assert served.drift_alerts(1).count() == 0 and served.readiness()[0] == 200
    for bad in (lambda: served.wallet("0x12", 1), lambda: served.entities(1, limit=501), lambda: served.entities(1, offset=-1), lambda: served.clusters(1, min_size=0),
                lambda: served.drift_alerts(1, "loud"), lambda: served.clusters(1, run="nope"), lambda: served.clusters(2, run=done["run_id"])):
        with pytest.raises(api.ApiError):
            bad()
    assert served.clusters(2).count() == 0
    assert len(store.views()) == 21 and len(S.TABLES) == 27
    store.register()
    assert spark.sql("SELECT count(*) FROM current_wallet_clusters").first()[0] == 3
    assert "wallet_count=4" in runs.summary(done) and "x=NULL" in runs.summary({"x": None})


def test_failed_run_leaves_no_output(spark, world, monkeypatch):
    store, _, _ = world
    before = store.read("wallet_clusters").count()

    def broken(*a, **k):
        raise RuntimeError("x" * 5000)

    monkeypatch.setattr(runs, "derive_snapshot", broken)
    with pytest.raises(RuntimeError):
        runs.cluster(store, 1, 100, 102)
    failed = store.read("cluster_runs").where("status = 'failed'").first()
    assert failed.version == 4 and len(failed.error) == runs.ERROR_LIMIT
    assert store.read("wallet_clusters").count() == before and store.latest_runs("cluster").where(F.col("run_id") == failed.run_id).count() == 0


def test_bad_receipts_raise(spark):
    b, r = CHAIN[100]
    bad = [{**r[0], "blockHash": digest(5)}, *r[1:]]
    df = spark.createDataFrame([(1, json.dumps(b), json.dumps(bad), datetime(2024, 1, 1))], CAPTURE)
    with pytest.raises(Exception, match="receipts do not fit"):
        decode.raw_blocks(decode.parsed(df)).collect()


class Server:
    """Answers requests from a table of methods; statuses come first."""

    def __init__(self, results, statuses=()):
        self.results, self.statuses, self.calls = results, list(statuses), []

    def __call__(self, url, body, timeout):
        request = json.loads(body)
        self.calls.append(request)
        if self.statuses and (status := self.statuses.pop(0)) != 200:
            return status, b"{}"
        answer = lambda r: {"id": r["id"], "result": self.results[r["method"]](*r["params"])}
        return 200, json.dumps([answer(r) for r in request][::-1] if isinstance(request, list) else answer(request)).encode()


def test_rpc_client():
    slept = []
    client = rpc.RpcClient("u", post=Server({"eth_chainId": lambda: "0x2105"}, [503, 429]), sleep=slept.append)
    assert client.chain_id() == 8453 and slept == [0.25, 0.5]
    with pytest.raises(rpc.RetryableRpcError):
        rpc.RpcClient("u", post=Server({}, [503] * 3), sleep=lambda s: None).chain_id()
    with pytest.raises(rpc.RpcError):
        rpc.RpcClient("u", post=Server({}, [404])).chain_id()
    batches = Server({"eth_getTransactionReceipt": lambda h: {"transactionHash": h}})
    got = rpc.RpcClient("u", post=batches, batch_size=2).receipts(["a", "b", "c"])
    assert [r["transactionHash"] for r in got] == ["a", "b", "c"] and [len(c) for c in batches.calls] == [2, 1]
    with pytest.raises(rpc.NotFoundError):
        rpc.RpcClient("u", post=Server({"eth_getBlockByNumber": lambda *a: None})).block("latest")
    assert rpc.block_tag(255) == "0xff" and rpc.block_tag("safe") == "safe"
    for bad in (-1, "newest", True):
        with pytest.raises(ValueError):
            rpc.block_tag(bad)
    parts = rpc.BlockReader({"url": "u", "start": "5", "end": "25", "blocksperpartition": "10"}).partitions()
    assert [(p.start, p.end) for p in parts] == [(5, 14), (15, 24), (25, 25)]


def test_stream_of_captured_blocks(spark, tmp_path):
    store = Warehouse(spark, f"file://{tmp_path}/w")
    (tmp_path / "in").mkdir()
    for n in (100, 101):
        b, r = CHAIN[n]
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps({"chain_id": 1, "block": json.dumps(b), "receipts": json.dumps(r), "ingested_at": "2024-01-01T00:00:00"}))
    for _ in range(2):
        ingest.stream_facts(ingest.captured_stream(spark, f"{tmp_path}/in", 1), store, f"{tmp_path}/c").awaitTermination()
    assert store.read("raw_blocks").count() == 2 and store.read("raw_transactions").count() == 3


def test_windowed_activity_leaves_late_rows_out(spark, tmp_path):
    """Counts per window; rows behind the watermark of earlier batches do not change them."""
    at = lambda m: f"2024-01-01T00:{m:02}:00"
    batches = [[(1, at(1)), (1, at(2)), (2, at(2)), (1, at(7))], [(1, at(40))], [(1, at(3)), (1, at(41))]]
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("chain_id bigint, block_timestamp timestamp").json(f"{tmp_path}/in")
    query = lambda: ingest.windowed_activity(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/c").outputMode("append").trigger(availableNow=True).start()
    for i, rows in enumerate(batches):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(json.dumps({"chain_id": c, "block_timestamp": t}) for c, t in rows))
        query().awaitTermination()
    got = {(r.chain_id, r.window.start.minute): r.transactions for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(1, 0): 2, (2, 0): 1, (1, 5): 1}
