"""Block and receipt JSON to typed facts; JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import u256

#: Fixed value: topic of Transfer(address,address,uint256).
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"

TX = "struct<hash: string, transactionIndex: string, `from`: string, `to`: string, value: string, gas: string, gasPrice: string, input: string>"
BLOCK = f"struct<number: string, hash: string, parentHash: string, timestamp: string, transactions: array<{TX}>>"
LOG = "struct<address: string, topics: array<string>, data: string, logIndex: string, removed: boolean>"
RECEIPT = f"struct<transactionHash: string, blockHash: string, status: string, logs: array<{LOG}>>"


def quantity(q: Column) -> Column:
    """Hex quantity up to 63 bits as a long; malformed text raises."""
    return F.when(q.rlike("^0[xX][0-9a-fA-F]{1,16}$"), F.conv(F.substring(q, 3, 16), 16, 10).cast("long")).when(
        q.isNotNull(), F.raise_error(F.concat(F.lit("not a hex quantity: "), q)).cast("long"))


def hex_data(x: Column) -> Column:
    """Lower-cased hex of whole bytes; malformed text raises."""
    return F.when(x.rlike("^0x([0-9a-fA-F]{2})*$"), F.lower(x)).when(x.isNotNull(), F.raise_error(F.concat(F.lit("not hex data: "), x)).cast("string"))


def address(x: Column) -> Column:
    """Lower-cased 20-byte address; malformed text raises."""
    return F.when(x.rlike("^0x[0-9a-fA-F]{40}$"), F.lower(x)).when(x.isNotNull(), F.raise_error(F.concat(F.lit("not an address: "), x)).cast("string"))


def parsed(captured: DataFrame) -> DataFrame:
    """captured: chain_id, block, receipts (JSON), ingested_at. A receipt list that does not fit its block raises."""
    rows = captured.select("chain_id", "ingested_at", F.from_json("block", BLOCK).alias("b"), F.from_json("receipts", f"array<{RECEIPT}>").alias("r"))
    sizes = F.size("b.transactions") == F.size("r")
    pairs = F.forall(F.arrays_zip(F.col("b.transactions").alias("t"), F.col("r").alias("q")), lambda x: (
        (F.lower(x["t"]["hash"]) == F.lower(x["q"]["transactionHash"])) & (F.lower(x["q"]["blockHash"]) == F.lower("b.hash")) & x["q"]["logs"].isNotNull()))
    fits = F.coalesce(sizes & pairs, F.lit(False))
    return rows.withColumn("b", F.when(fits, F.col("b")).otherwise(F.from_json(F.raise_error(F.lit("receipts do not fit the block")).cast("string"), BLOCK)))


def raw_blocks(rows: DataFrame) -> DataFrame:
    return rows.select(
        "chain_id", quantity(F.col("b.number")).alias("block_number"), hex_data(F.col("b.hash")).alias("block_hash"),
        hex_data(F.col("b.parentHash")).alias("parent_hash"), F.timestamp_seconds(quantity(F.col("b.timestamp"))).alias("block_timestamp"),
        F.size("b.transactions").alias("transaction_count"), "ingested_at")


def raw_transactions(rows: DataFrame) -> DataFrame:
    each = rows.select("chain_id", "ingested_at", "b", F.explode(F.arrays_zip(F.col("b.transactions").alias("t"), F.col("r").alias("q"))).alias("x"))
    t = F.col("x.t")
    return each.select(
        "chain_id", quantity(F.col("b.number")).alias("block_number"), hex_data(F.col("b.hash")).alias("block_hash"),
        F.timestamp_seconds(quantity(F.col("b.timestamp"))).alias("block_timestamp"), hex_data(t["hash"]).alias("tx_hash"),
        quantity(t["transactionIndex"]).alias("tx_index"), address(t["from"]).alias("from_address"), address(t["to"]).alias("to_address"),
        u256.from_quantity(t["value"]).alias("value_wei"), quantity(t["gas"]).alias("gas"), u256.from_quantity(t["gasPrice"]).alias("gas_price"),
        hex_data(t["input"]).alias("input"), quantity(F.col("x.q.status")).alias("status"), "ingested_at")


def is_transfer(log: Column) -> Column:
    """Three topics, the first the Transfer signature, all words of 32 bytes, not removed; never an error."""
    word = lambda x: x.rlike("^0x[0-9a-fA-F]{64}$")
    topic = lambda i: F.get(log["topics"], F.lit(i))
    return F.coalesce((F.size(log["topics"]) == 3) & (F.lower(topic(0)) == TRANSFER_TOPIC) & word(topic(1)) & word(topic(2)) & word(log["data"])
                      & ~F.coalesce(log["removed"], F.lit(False)) & log["address"].rlike("^0x[0-9a-fA-F]{40}$"), F.lit(False))


def decoded_transfer(log: Column) -> Column:
    """struct(token_address, from_address, to_address, amount_raw, log_index), or null if not a transfer."""
    end = lambda i: F.concat(F.lit("0x"), F.lower(F.substring(F.get(log["topics"], F.lit(i)), 27, 40)))
    return F.when(is_transfer(log), F.struct(
        F.lower(log["address"]).alias("token_address"), end(1).alias("from_address"), end(2).alias("to_address"),
        F.lower(F.substring(log["data"], 3, 64)).alias("amount_raw"), quantity(log["logIndex"]).alias("log_index")))


def token_transfers(rows: DataFrame) -> DataFrame:
    each = rows.select("chain_id", "ingested_at", "b", F.explode("r").alias("q")).select("chain_id", "ingested_at", "b", "q", F.explode("q.logs").alias("log"))
    return each.withColumn("x", decoded_transfer(F.col("log"))).where("x IS NOT NULL").select(
        "chain_id", quantity(F.col("b.number")).alias("block_number"), hex_data(F.col("b.hash")).alias("block_hash"),
        F.timestamp_seconds(quantity(F.col("b.timestamp"))).alias("block_timestamp"), hex_data(F.col("q.transactionHash")).alias("tx_hash"),
        "x.log_index", "x.token_address", "x.from_address", "x.to_address", "x.amount_raw", "ingested_at")
