"""Transfer edges, first funders and wallet features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import u256
from ..functions.ids import stable_id, valid_address
from .state import first_in_group

#: Fixed values of a first-funder edge.
FUNDING_HEURISTIC, FUNDING_CONFIDENCE = "first_native_funder", 0.7
EDGE_COLUMNS = ("chain_id", "edge_id", "block_number", "block_hash", "block_timestamp", "tx_hash", "tx_index",
                "from_address", "to_address", "asset_type", "token_address", "amount_raw")


def native_edges(transactions: DataFrame) -> DataFrame:
    """Native transfers: not failed (a null status passes), value above 0, two distinct valid ends."""
    sender, recipient = F.lower("from_address"), F.lower("to_address")
    return transactions.where(
        ~F.col("status").eqNullSafe(F.lit(0)) & (F.col("value_wei") != u256.ZERO) & F.col("to_address").isNotNull()
        & (sender != recipient) & valid_address(F.col("from_address")) & valid_address(F.col("to_address"))
    ).select(
        "chain_id", stable_id(F.col("chain_id"), F.lower("tx_hash"), "native").alias("edge_id"), "block_number", "block_hash",
        "block_timestamp", "tx_hash", "tx_index", sender.alias("from_address"), recipient.alias("to_address"),
        F.lit("native").alias("asset_type"), F.lit(None).cast("string").alias("token_address"), F.col("value_wei").alias("amount_raw"))


def token_edges(transfers: DataFrame) -> DataFrame:
    """Token transfers: amount above 0, two distinct valid ends; ``tx_index`` carries the log index."""
    sender, recipient = F.lower("from_address"), F.lower("to_address")
    return transfers.where(
        (F.col("amount_raw") != u256.ZERO) & (sender != recipient)
        & valid_address(F.col("from_address")) & valid_address(F.col("to_address"))
    ).select(
        "chain_id", stable_id(F.col("chain_id"), F.lower("tx_hash"), F.col("log_index")).alias("edge_id"), "block_number", "block_hash",
        "block_timestamp", "tx_hash", F.col("log_index").alias("tx_index"), sender.alias("from_address"), recipient.alias("to_address"),
        F.lit("erc20").alias("asset_type"), F.lower("token_address").alias("token_address"), "amount_raw")


def transfer_edges(transactions: DataFrame, transfers: DataFrame) -> DataFrame:
    return native_edges(transactions).unionByName(token_edges(transfers)).select(*EDGE_COLUMNS)


def first_funders(edges: DataFrame) -> DataFrame:
    """The earliest native inbound edge of each wallet, by (height, index, hash, id)."""
    first = first_in_group(edges.where("asset_type = 'native'"), ["chain_id", "to_address"],
                           [F.col(c) for c in ("block_number", "tx_index", "tx_hash", "edge_id")])
    return first.select(
        "chain_id", F.col("to_address").alias("funded_address"), F.col("from_address").alias("funder_address"),
        F.col("tx_hash").alias("funding_tx_hash"), F.col("block_number").alias("funding_block_number"),
        F.col("block_hash").alias("funding_block_hash"), F.col("block_timestamp").alias("funding_timestamp"),
        F.col("amount_raw").alias("amount_wei"),
        F.lit(FUNDING_HEURISTIC).alias("heuristic"), F.lit(FUNDING_CONFIDENCE).alias("confidence"))


def wallet_features(edges: DataFrame, funding: DataFrame) -> DataFrame:
    """Per wallet: range of heights, transfer counts of either asset, distinct counterparties,
    native sums, first funder.

    Edges are first added up per unordered pair of wallets, by direction and asset, with partial
    sums in each task; only then does each pair become a row for either end. So amounts are cut
    into limbs once an edge, the aggregate by wallet sees one row a counterparty, and a hub wallet
    is not one task's raw edges.
    """
    native, out = F.col("asset_type") == "native", F.col("from_address") < F.col("to_address")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    limbs = [(i, F.col(f"l{i}")) for i in range(8)]
    rows = edges.select("chain_id", "from_address", "to_address", "block_number", "asset_type", *[x.alias(f"l{i}") for i, x in enumerate(u256.limbs(F.col("amount_raw")))])
    pairs = rows.groupBy("chain_id", F.least("from_address", "to_address").alias("lo"), F.greatest("from_address", "to_address").alias("hi")).agg(
        F.min("block_number").alias("first"), F.max("block_number").alias("last"),
        count(native & out).alias("n_out"), count(native & ~out).alias("n_in"), count(~native & out).alias("t_out"), count(~native & ~out).alias("t_in"),
        *[F.sum(F.when(native & out, x)).alias(f"o{i}") for i, x in limbs], *[F.sum(F.when(native & ~out, x)).alias(f"i{i}") for i, x in limbs])

    def end(wallet, swap):
        """The pair as one end sees it; the upper end sees the directions swapped."""
        pick = lambda a, b: [F.col(b if swap else a).alias(a)]
        sides = [("n_out", "n_in"), ("n_in", "n_out"), ("t_out", "t_in"), ("t_in", "t_out")] + [(f"{x}{i}", f"{y}{i}") for x, y in ("oi", "io") for i in range(8)]
        return F.struct(F.col(wallet).alias("wallet"), *[c for a, b in sides for c in pick(a, b)])

    ends = pairs.select("chain_id", "first", "last", F.explode(F.array(end("lo", False), end("hi", True))).alias("e")).select("chain_id", "first", "last", "e.*")
    wallets = ends.groupBy("chain_id", "wallet").agg(
        F.min("first").alias("first_seen_block"), F.max("last").alias("last_seen_block"),
        F.sum("n_in").alias("incoming_native_tx_count"), F.sum("n_out").alias("outgoing_native_tx_count"),
        F.sum("t_in").alias("incoming_erc20_transfer_count"), F.sum("t_out").alias("outgoing_erc20_transfer_count"),
        F.count("*").alias("unique_counterparties"),
        u256.from_limb_sums([F.sum(f"i{i}") for i in range(8)]).alias("native_received_wei"),
        u256.from_limb_sums([F.sum(f"o{i}") for i in range(8)]).alias("native_sent_wei"))
    funder = funding.select("chain_id", F.col("funded_address").alias("wallet"), F.col("funder_address").alias("first_funder_address"),
                            F.col("funding_block_number").alias("first_funding_block"))
    return wallets.join(funder, ["chain_id", "wallet"], "left").withColumnRenamed("wallet", "wallet_address")
