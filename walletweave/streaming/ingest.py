"""Blocks captured as files, decoded and appended micro-batch by micro-batch.

Facts are deduplicated by identity when read, so a batch that runs twice after a failure adds
nothing to what readers see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.store import Warehouse
from ..sources import decode

CAPTURED = "chain_id bigint, block string, receipts string, ingested_at timestamp"


def captured_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """JSON lines of captured blocks; new files become new batches."""
    return spark.readStream.schema(CAPTURED).option("maxFilesPerTrigger", files_per_batch).json(path)


def stream_facts(stream: DataFrame, store: Warehouse, checkpoint: str) -> StreamingQuery:
    """Append the raw facts of each batch; stops when all files there are have been read."""

    def write(batch: DataFrame, _: int) -> None:
        rows = decode.parsed(batch.persist())
        store.append("raw_blocks", decode.raw_blocks(rows))
        store.append("raw_transactions", decode.raw_transactions(rows))
        store.append("token_transfers", decode.token_transfers(rows))
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_activity(transactions: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Transactions per chain and event-time window; rows later than the watermark are left out."""
    return transactions.withWatermark("block_timestamp", late).groupBy(F.window("block_timestamp", width), "chain_id").agg(
        F.count("*").alias("transactions"))
