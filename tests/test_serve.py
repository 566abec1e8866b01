import json
import threading
import urllib.error
import urllib.request
from datetime import datetime

import pytest

from walletweave.operators import labels as L
from walletweave.plans import api, runs, serve
from walletweave.plans.store import Warehouse

from .helpers import address, seed
from .test_plans import CHAIN, Node


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    store = Warehouse(spark, f"file://{tmp_path_factory.mktemp('served')}")
    node = Node(spark, CHAIN)
    runs.Ingestion(store, 1, node.capture, node.heads).run(100, 103)
    store.seed_taxonomy(L.TAXONOMY_VERSION, L.TAXONOMY, datetime(2024, 1, 1))
    done = runs.cluster(store, 1, 100, 103)
    labelled = runs.label(store, 1, [seed(1)], done["run_id"])
    runs.evaluate(store, 1, done["run_id"], labelled["run_id"], [seed(1)])
    s = serve.server(api.Api(store), port=0)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_address[1]}", done, labelled
    s.shutdown()


def ask(url, query, **more):
    request = urllib.request.Request(f"{url}/graphql", json.dumps({"query": query} | more).encode(), {"Content-Type": "application/json"})
    return json.load(urllib.request.urlopen(request))


def test_wallet_with_all_it_belongs_to(served):
    url, done, labelled = served
    query = """query W($who: String!, $run: String = null) {
      wallet(address: $who, chainId: 1, clusterRunId: $run) {
        address features { nativeReceivedWei incomingErc20TransferCount firstFunderAddress }
        cluster { id size members(limit: 2, offset: 1) { address confidence } resolutionEdges { walletA score evidenceCount } edges { heuristic } evidence(limit: 1) { evidenceType } snapshot { clusterRunId } }
        entity { category membershipMethod labels { value } members { address } ...E }
        labels { dimension value assignmentMethod evidence { type value weight confidenceContribution } }
        snapshot { clusterRunId labelRunId heuristicVersion taxonomyVersion } __typename } }
      fragment E on Entity { displayName evidence { type } }"""
    w = ask(url, query, variables={"who": address(2).replace("0x", "0x").upper().replace("0X", "0x")})["data"]["wallet"]
    assert w["address"] == address(2) and w["features"] == {"nativeReceivedWei": "5", "incomingErc20TransferCount": 1, "firstFunderAddress": address(9)}
    assert w["cluster"]["size"] == 3 and [m["address"] for m in w["cluster"]["members"]] == [address(2), address(3)]
    assert len(w["cluster"]["resolutionEdges"]) == len(w["cluster"]["edges"]) == 3 and len(w["cluster"]["evidence"]) == 1
    assert w["entity"]["category"] == "dex" and w["entity"]["membershipMethod"] == "cluster_membership" and w["entity"]["displayName"] == "Acme"
    assert {e["type"] for e in w["entity"]["evidence"]} == {"labeled_cluster_member", "cluster_membership_confidence", "propagation_factor"}
    assert w["labels"][0]["assignmentMethod"] == "cluster_propagation" and len(w["labels"][0]["evidence"]) == 3
    assert w["snapshot"] == {"clusterRunId": done["run_id"], "labelRunId": labelled["run_id"], "heuristicVersion": "shared_funder_v1", "taxonomyVersion": "taxonomy_v1"}
    assert w["__typename"] == "Wallet"
    chosen = ask(url, query, variables={"who": address(2), "run": done["run_id"]})["data"]["wallet"]
    assert chosen["snapshot"] == w["snapshot"]


def test_absent_values_are_null(served):
    url, *_ = served
    data = ask(url, f'{{ wallet(address: "{address(50)}", chainId: 1) {{ features {{ firstSeenBlock }} cluster {{ id }} entity {{ id }} labels {{ value }} }} '
                    'e: entity(id: "none", chainId: 1) { id } cluster(id: "none", chainId: 1) { id } evaluation(chainId: 2) { runId } }')["data"]
    assert data == {"wallet": {"features": None, "cluster": None, "entity": None, "labels": []}, "e": None, "cluster": None, "evaluation": None}


def test_lists_and_evaluation(served):
    url, *_ = served
    data = ask(url, """{ clusters(chainId: 1, minSize: 2) { id size members @skip(if: true) { address } } entities(chainId: 1, category: "dex", limit: 1) { id category }
      evaluation(chainId: 1) { runId labelMetrics { precision f1 tp } clusteringMetrics { pairwisePrecision pairwiseF1 } coverageMetrics { metricName } driftMetrics { value } alerts { severity }
        snapshot { evaluationRunId evaluationVersion } }
      driftAlerts(chainId: 1, severity: "warning") { severity message createdAt } }""")["data"]
    assert [c.keys() for c in data["clusters"]] == [{"id", "size"}] and len(data["entities"]) == 1
    assert data["evaluation"]["clusteringMetrics"] == [{"pairwisePrecision": None, "pairwiseF1": None}] and len(data["evaluation"]["coverageMetrics"]) == 5
    assert data["evaluation"]["snapshot"]["evaluationRunId"] == data["evaluation"]["runId"] and data["driftAlerts"] == []


@pytest.mark.parametrize("query,says", [
    ('{ wallet(address: "0x12") { address } }', "40 hex"), ("{ entities(limit: 501) { id } }", "limit has to lie in 1..500"), ("{ entities(offset: -1) { id } }", "offset"),
    ('{ clusters(clusterRunId: "nope") { id } }', "there is no cluster run nope"), ('{ driftAlerts(severity: "loud") { severity } }', "severity"), ("{ wallet { address } }", "needs the argument address"),
    ("{ clusters { colour } }", "no field colour"), ("{ clusters }", "needs selections"), ("{ clusters { id { x } } }", "has no selections"), ("{ clusters(minSize: \"2\") { id } }", "an integer"),
    ("{ clusters(size: 2) { id } }", "no argument size"), ("mutation { x }", "only queries"), ("{ clusters { id }", "syntax error"), ("", "no query"), ("{ clusters { ...X } }", "no fragment"), ("{ a(b: ?) }", "syntax error"),
])
def test_bad_requests_name_their_mistake(served, query, says):
    out = ask(served[0], query)
    assert out["data"] is None and says in out["errors"][0]["message"]


def test_health(served):
    url, *_ = served
    for path in ("health", "readiness"):
        assert json.load(urllib.request.urlopen(f"{url}/{path}")) == {"status": "ok"}
    with pytest.raises(urllib.error.HTTPError, match="404"):
        urllib.request.urlopen(f"{url}/other")
    with pytest.raises(urllib.error.HTTPError, match="400"):
        urllib.request.urlopen(urllib.request.Request(f"{url}/graphql", b"[]"))


class Offline:
    def healthy(self):
        return False


def test_not_ready():
    assert api.Api(Offline()).readiness()[0] == 503
