"""Command line: ``python -m walletweave.cli --warehouse DIR COMMAND``; results are key=value lines."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import labels as L
from .operators import resolution as R
from .plans import runs, serve
from .plans.api import Api
from .plans.store import Warehouse
from .sources import rpc, seeds


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="walletweave", description="fork-aware wallet intelligence")
    p.add_argument("--warehouse", required=True)
    commands = p.add_subparsers(dest="command", required=True)

    def command(name, *required, **optional):
        c = commands.add_parser(name)
        for flag, kind in required:
            c.add_argument(f"--{flag}", type=kind, required=True)
        for flag, default in optional.items():
            c.add_argument(f"--{flag.replace('_', '-')}", type=type(default) if default is not None else str, default=default)

    span = (("chain-id", int), ("from-block", int), ("to-block", int))
    command("ingest", *span, ("rpc-url", str), blocks_per_partition=100, step=runs.STEP)
    command("cluster", *span, window_seconds=R.WINDOW_SECONDS, max_fanout=R.MAX_FANOUT, resume_run_id=None)
    command("label", ("chain-id", int), ("seeds", str), cluster_run_id=None, propagation_factor=L.PROPAGATION_FACTOR, resume_run_id=None)
    command("evaluate", ("chain-id", int), ("cluster-run-id", str), ("label-run-id", str), ("ground-truth", str))
    command("create", database=None)
    command("drop", database=None)
    command("serve", host="127.0.0.1", port=8000)
    command("health")
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    store = Warehouse(spark, args.warehouse)
    if args.command == "ingest":
        client = rpc.RpcClient(args.rpc_url)
        spark.dataSource.register(rpc.BlockSource)

        def capture(start: int, end: int):
            raw = spark.read.format("evm_blocks").options(url=args.rpc_url, start=start, end=end, blocksPerPartition=args.blocks_per_partition).load()
            return raw.select(F.lit(args.chain_id).cast("long").alias("chain_id"), "block", "receipts", F.current_timestamp().alias("ingested_at"))

        return runs.Ingestion(store, args.chain_id, capture, client.heads, client.chain_id, step=args.step).run(args.from_block, args.to_block)
    if args.command == "cluster":
        return runs.cluster(store, args.chain_id, args.from_block, args.to_block, args.window_seconds, args.max_fanout, args.resume_run_id)
    if args.command == "label":
        store.seed_taxonomy(L.TAXONOMY_VERSION, L.TAXONOMY, runs.now())
        return runs.label(store, args.chain_id, seeds.read(spark, args.seeds), args.cluster_run_id, factor=args.propagation_factor, resume=args.resume_run_id)
    if args.command == "evaluate":
        return runs.evaluate(store, args.chain_id, args.cluster_run_id, args.label_run_id, seeds.read(spark, args.ground_truth))
    if args.command in ("create", "drop"):
        getattr(store, args.command)(args.database)
        return {args.command: store.root}
    if args.command == "serve":
        serve.run(Api(store), args.host, args.port)
        return {}
    return {"healthy": store.healthy()}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("walletweave").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print(runs.summary(run(spark, args)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
