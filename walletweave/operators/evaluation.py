"""Evaluation of labels and clusters against curated truth, drift and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import normalize_name
from ..functions.scores import f1, precision, recall, relative_change
from .labels import DIRECT, PROPAGATED
from .state import first_in_group

#: Fixed values.
EVALUATION_VERSION = "evaluation_v1"
METRIC_SCOPE = "curated_entities_seen_in_cluster_scope"
DIMENSIONS, METHODS = ("entity_category", "contract_role"), (DIRECT, PROPAGATED)
THRESHOLDS = {"largest_cluster_relative_increase": 1.0, "cluster_count_drop": 0.5, "propagated_label_spike": 1.0,
              "conflict_count": 1, "seed_coverage_drop": 0.2}


def truth_labels(seeds: DataFrame) -> DataFrame:
    """(subject, dimension, truth): a row per address and dimension that has a value."""
    return seeds.select(F.lower("address").alias("subject"), F.explode(F.array(
        F.struct(F.lit("entity_category").alias("dimension"), F.col("entity_category").alias("truth")),
        F.struct(F.lit("contract_role").alias("dimension"), F.col("contract_role").alias("truth")))).alias("x")).select(
        "subject", "x.*").where("truth IS NOT NULL AND truth <> ''")


def evaluate_labels(truth: DataFrame, predictions: DataFrame, methods=METHODS) -> DataFrame:
    """One-vs-rest counts and metrics per dimension, method and value.

    truth: subject, dimension, truth; predictions: subject, dimension, method, value. A prediction
    for a subject without truth counts in ``predicted_count`` only. Of several predictions for a
    subject the highest value speaks. Values are those of the truth and those predicted for it.
    """
    spoken = first_in_group(predictions, ["dimension", "method", "subject"], [F.desc("value")])
    kinds = predictions.sparkSession.createDataFrame([(m,) for m in methods], "method string")
    rows = truth.join(F.broadcast(kinds)).join(  # a constant list
        spoken.select("dimension", "method", "subject", "value"), ["dimension", "method", "subject"], "left")
    hit = F.col("value").eqNullSafe(F.col("truth"))
    by_value = rows.select("dimension", "method", F.explode(F.filter(F.array(
        F.struct(F.col("truth").alias("label"), F.lit(1).alias("support"), hit.cast("int").alias("tp"), F.lit(0).alias("fp"), (~hit).cast("int").alias("fn")),
        F.when(F.col("value").isNotNull() & ~hit, F.struct(F.col("value").alias("label"), F.lit(0).alias("support"), F.lit(0).alias("tp"), F.lit(1).alias("fp"), F.lit(0).alias("fn"))),
    ), lambda x: x.isNotNull())).alias("x")).select("dimension", "method", "x.*").groupBy("dimension", "method", "label").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "support")])
    covered = rows.groupBy("dimension", "method").agg(F.avg(F.col("value").isNotNull().cast("double")).alias("coverage"))
    raw = predictions.groupBy("dimension", "method", F.col("value").alias("label")).agg(F.count("*").alias("predicted_count"))
    known = predictions.join(truth.select("dimension", "subject"), ["dimension", "subject"], "left_semi").select(
        "dimension", "method", F.col("value").alias("label")).distinct()
    values = by_value.select("dimension", "method", "label").union(known.select("dimension", "method", "label")).distinct()
    out = values.join(by_value, ["dimension", "method", "label"], "left").na.fill(0, ["tp", "fp", "fn", "support"]).join(
        covered, ["dimension", "method"], "left").join(raw, ["dimension", "method", "label"], "left")
    p, r = precision(F.col("tp"), F.col("fp")), recall(F.col("tp"), F.col("fn"))
    return out.select(
        F.col("dimension").alias("label_dimension"), F.col("label").alias("label_value"), F.col("method").alias("assignment_method"), "tp", "fp", "fn",
        p.alias("precision"), r.alias("recall"), f1(p, r).alias("f1"), "support",
        F.coalesce("predicted_count", F.lit(0)).alias("predicted_count"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def evaluate_clustering(truth: DataFrame, seen: DataFrame, predicted: DataFrame) -> DataFrame:
    """Pairwise metrics without pairs: truth (address, entity), seen (address), predicted (address, cluster_id).

    Pairs are counted from group sizes: same entity and cluster, same cluster, same entity. A wallet
    without a cluster shares one with nobody.
    """
    t = truth.select(F.lower("address").alias("address"), normalize_name(F.col("entity")).alias("entity")).distinct()
    rows = t.join(seen.select(F.lower("address").alias("address")).distinct(), "address", "left_semi").join(
        predicted.select(F.lower("address").alias("address"), "cluster_id").distinct(), "address", "left")
    pairs = lambda n: n * (n - 1) / F.lit(2)
    cell = rows.groupBy("entity", "cluster_id").agg(F.count("*").alias("n"))
    by = lambda keys, name: cell.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.sum("n").alias("n")).agg(
        F.coalesce(F.sum(pairs(F.col("n"))), F.lit(0)).cast("long").alias(name), F.count("*").alias(f"n_{name}"), F.coalesce(F.sum("n"), F.lit(0)).alias(f"rows_{name}"))
    one = reduce(lambda a, b: a.join(F.broadcast(b)), [  # one row each
        by(["entity", "cluster_id"], "tp"), by(["cluster_id"], "same_cluster"), by(["entity"], "same_entity"), t.agg(F.count("*").alias("n_truth"))])
    tp, fp, fn = F.col("tp"), F.col("same_cluster") - F.col("tp"), F.col("same_entity") - F.col("tp")
    p, r = precision(tp, fp), recall(tp, fn)
    return one.select(
        F.lit(METRIC_SCOPE).alias("metric_scope"), tp.alias("tp_pairs"), fp.alias("fp_pairs"), fn.alias("fn_pairs"),
        p.alias("pairwise_precision"), r.alias("pairwise_recall"), f1(p, r).alias("pairwise_f1"),
        F.col("n_same_entity").alias("ground_truth_entity_count"), F.col("n_truth").alias("ground_truth_address_count"),
        F.col("rows_same_entity").alias("evaluated_address_count"), F.col("n_same_cluster").alias("predicted_cluster_count"))


def size_statistics(members: DataFrame) -> DataFrame:
    """One row: clusters, largest, mean, median and nearest-rank 95th percentile of size, mean confidence."""
    per = members.groupBy("cluster_id").agg(F.count("*").alias("size"), F.first("confidence").alias("confidence"))
    zero = lambda c: F.coalesce(c, F.lit(0.0)).cast("double")
    return per.agg(
        F.count("*").cast("double").alias("cluster_count"), zero(F.max("size")).alias("largest_cluster_size"), zero(F.avg("size")).alias("average_cluster_size"),
        zero(F.median("size")).alias("median_cluster_size"), zero(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY size)")).alias("p95_cluster_size"),
        zero(F.avg("confidence")).alias("average_cluster_confidence"))


def drift_metrics(run: dict, members: DataFrame, entity_count: int, assignments: DataFrame, conflict_count: int,
                  seeds: DataFrame, seen: DataFrame) -> DataFrame:
    """The fixed metrics and a label count per dimension and value: metric_group, metric_name, scope_key, value.

    run has ``wallet_count`` and ``resolution_edge_count``, which come from the run row.
    """
    lit = lambda n: F.lit(float(n))
    sizes = size_statistics(members)
    direct, spread = F.col("assignment_method") == DIRECT, F.col("assignment_method") == PROPAGATED
    count = lambda c: F.coalesce(F.sum(F.when(c, 1.0)), F.lit(0.0))
    labels = assignments.agg(count(direct).alias("direct_label_count"), count(spread).alias("propagated_label_count"),
                             F.coalesce(F.avg(F.when(spread, F.col("confidence"))), F.lit(0.0)).alias("average_propagated_confidence"))
    s = seeds.select(F.lower("address").alias("address")).distinct()
    mark = lambda df, name: df.select(F.lower(F.col(df.columns[0])).alias("address")).distinct().withColumn(name, F.lit(1.0))
    of = lambda method: assignments.where((F.col("assignment_method") == method) & (F.col("subject_type") == "address")).select("subject_id")
    joined = s
    for df, name in ((seen.select("address"), "seed_seen_count"), (members.select("wallet_address"), "seed_cluster_overlap_count"),
                     (of(DIRECT), "ground_truth_addresses_directly_labeled"), (of(PROPAGATED), "ground_truth_addresses_with_inferred_labels")):
        joined = joined.join(mark(df, name), "address", "left")
    names = joined.columns[1:]
    coverage = joined.agg(F.count("*").cast("double").alias("seed_count"), *[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names])
    one = sizes.join(F.broadcast(labels)).join(F.broadcast(coverage)).select(  # one row each
        F.explode(F.array(*[F.struct(F.lit(g).alias("metric_group"), F.lit(n).alias("metric_name"), F.lit("all").alias("scope_key"), v.alias("value")) for g, n, v in (
            ("clustering", "wallet_count", lit(run["wallet_count"])), ("clustering", "resolution_edge_count", lit(run["resolution_edge_count"])),
            *[("clustering", n, F.col(n)) for n in sizes.columns],
            ("labels", "entity_count", lit(entity_count)), ("labels", "direct_label_count", F.col("direct_label_count")),
            ("labels", "propagated_label_count", F.col("propagated_label_count")), ("labels", "conflict_count", lit(conflict_count)),
            ("labels", "average_propagated_confidence", F.col("average_propagated_confidence")),
            *[("coverage", n, F.col(n)) for n in coverage.columns])])).alias("m")).select("m.*")
    spread_by = assignments.groupBy("label_dimension", "label_value").agg(F.count("*").cast("double").alias("value")).select(
        F.lit("labels").alias("metric_group"), F.lit("label_count").alias("metric_name"),
        F.concat_ws("=", "label_dimension", "label_value").alias("scope_key"), "value")
    return one.unionByName(spread_by)


def compare_drift(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Each metric with the previous value, the change and the relative change (null without, or at, 0)."""
    keys = ["metric_group", "metric_name", "scope_key"]
    out = current.select(*keys, "value").join(previous.select(*keys, F.col("value").alias("previous_value")), keys, "left")
    v, p = F.col("value"), F.col("previous_value")
    return out.withColumn("absolute_change", v - p).withColumn("relative_change", relative_change(v, p))


#: What alerts say.
MESSAGES = {
    "largest_cluster_size": "Largest cluster size increased beyond the configured guardrail.",
    "cluster_count": "Cluster count dropped sharply while wallet count remained similar.",
    "propagated_label_count": "Propagated label count increased beyond the configured guardrail.",
    "conflict_count": "Label conflicts increased to a non-trivial count.",
    "coverage": "{} dropped beyond the configured guardrail.",
}


def drift_alerts(compared: DataFrame, thresholds: dict = THRESHOLDS, by: list[str] | None = None) -> DataFrame:
    """The six alert rules over compared metrics; ``by`` names columns that hold separate runs apart."""
    by = by or []
    t = thresholds
    watched = ("largest_cluster_size", "cluster_count", "wallet_count", "propagated_label_count", "conflict_count", "seed_seen_count", "seed_cluster_overlap_count")
    # Conditional aggregates, not a pivot: the names are fixed, and one pass with partial sums does.
    get = lambda n: F.max(F.when(F.col("metric_name") == n, F.struct("value", "previous_value", "relative_change"))).alias(n)
    rows = compared.where((F.col("scope_key") == "all") & F.col("metric_name").isin(*watched))
    wide = rows.groupBy(*by).agg(*map(get, watched)) if by else rows.agg(*map(get, watched))

    def alert(name, when, severity, kind, threshold, message):
        return F.when(F.coalesce(when, F.lit(False)), F.struct(
            F.lit(name).alias("metric_name"), F.lit("all").alias("scope_key"), severity.alias("severity"), F.col(name)["value"].alias("current_value"),
            F.col(name)["previous_value"].alias("previous_value"), F.lit(kind).alias("threshold_type"), F.lit(float(threshold)).alias("threshold_value"), F.lit(message).alias("message")))

    warning = F.lit("warning")
    largest, clusters, wallets = (F.col(n)["relative_change"] for n in ("largest_cluster_size", "cluster_count", "wallet_count"))
    spread, found = F.col("propagated_label_count"), F.col("conflict_count")
    up, drop = t["largest_cluster_relative_increase"], t["cluster_count_drop"]
    rules = [
        alert("largest_cluster_size", largest >= up, F.when(largest >= 2 * up, "critical").otherwise("warning"), "relative_increase", up,
              MESSAGES["largest_cluster_size"]),
        alert("cluster_count", (clusters <= -drop) & F.col("wallet_count").isNotNull() & (wallets.isNull() | (F.abs(wallets) <= 0.1)), warning, "relative_drop", drop,
              MESSAGES["cluster_count"]),
        alert("propagated_label_count", (spread["relative_change"] >= t["propagated_label_spike"]) | ((spread["previous_value"] == 0) & (spread["value"] > 0)), warning,
              "relative_increase", t["propagated_label_spike"], MESSAGES["propagated_label_count"]),
        alert("conflict_count", (found["value"] >= t["conflict_count"]) & (found["value"] > found["previous_value"]), warning, "absolute_count", t["conflict_count"],
              MESSAGES["conflict_count"]),
        *[alert(n, F.col(n)["relative_change"] <= -t["seed_coverage_drop"], warning, "relative_drop", t["seed_coverage_drop"],
                MESSAGES["coverage"].format(n)) for n in ("seed_seen_count", "seed_cluster_overlap_count")],
    ]
    return wide.select(*by, F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("a")).select(*by, "a.*")
