"""A warehouse of append-only Parquet tables, and its views."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.canonical import canonical_facts, current_blocks
from ..operators.state import latest_by_version, latest_completed
from . import schemas as S

RUN_TABLES = {"cluster": ("cluster_runs", S.CLUSTER_SCOPE, S.CLUSTER_TABLES), "label": ("label_runs", S.LABEL_SCOPE, S.LABEL_TABLES),
              "evaluation": ("evaluation_runs", S.EVALUATION_SCOPE, S.EVALUATION_TABLES)}


class Warehouse:
    """Tables below ``root``; facts by chain, snapshots by chain and run.

    There is no transaction over tables: readers trust only runs whose latest state is completed,
    and each chain has one writer.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    @cached_property
    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    @staticmethod
    def schema(name: str) -> T.StructType:
        return T.StructType.fromDDL(S.TABLES[name].columns)

    def create(self, database: str | None = None) -> list[str]:
        """Make the folders of all tables and, for a database name, its tables and views in the catalog.

        What is there stays as it is, so this may run any number of times. Returns the statements.
        """
        for name in S.TABLES:
            self._fs.mkdirs(self._path(name))
        if database is None:
            return []
        run = [f"CREATE DATABASE IF NOT EXISTS {database}", *(self.ddl(name, database) for name in S.TABLES)]
        for statement in run:
            self.spark.sql(statement)
        for name, table in S.TABLES.items():
            if table.partition:
                self.spark.catalog.recoverPartitions(f"{database}.{name}")
        return run

    def ddl(self, name: str, database: str) -> str:
        table = S.TABLES[name]
        split = f" PARTITIONED BY ({', '.join(table.partition)})" if table.partition else ""
        return f"CREATE TABLE IF NOT EXISTS {database}.{name} ({table.columns}) USING parquet{split} LOCATION '{self.root}/{name}'"

    def drop(self, database: str | None = None) -> None:
        """Delete the tables' folders and, for a database name, its tables; what is not there is no error."""
        for name in S.TABLES:
            if database is not None:
                self.spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            self._fs.delete(self._path(name), True)

    def read(self, name: str) -> DataFrame:
        schema = self.schema(name)
        if not self._fs.exists(self._path(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}").select(*schema.names)

    def append(self, name: str, df: DataFrame) -> None:
        """Columns in the declared order and type; times to milliseconds, as they are kept."""
        table, cols = S.TABLES[name], []
        for f in self.schema(name).fields:
            c = F.col(f.name).cast(f.dataType)
            cols.append((F.date_trunc("MILLISECOND", c) if isinstance(f.dataType, T.TimestampType) else c).alias(f.name))
        df.select(*cols).write.mode("append").option("compression", "zstd").partitionBy(*table.partition).parquet(f"{self.root}/{name}")

    def append_rows(self, name: str, rows: list[dict]) -> None:
        schema = self.schema(name)
        if rows:
            self.append(name, self.spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema).coalesce(1))

    def delete_run(self, name: str, run_id: str) -> None:
        """Drop one run's directories: partial output of a failed run, nothing else."""
        for status in self._fs.globStatus(self._path(f"{name}/chain_id=*/run_id={run_id}")) or []:
            self._fs.delete(status.getPath(), True)

    # Views -------------------------------------------------------------------------------------

    def current_canonical_blocks(self) -> DataFrame:
        return current_blocks(self.read("canonical_blocks"))

    def canonical_transactions(self) -> DataFrame:
        return canonical_facts(self.read("raw_transactions"), self.current_canonical_blocks())

    def canonical_token_transfers(self) -> DataFrame:
        return canonical_facts(self.read("token_transfers"), self.current_canonical_blocks())

    def latest_runs(self, kind: str) -> DataFrame:
        table, scope, _ = RUN_TABLES[kind]
        return latest_completed(self.read(table), scope)

    def current(self, name: str) -> DataFrame:
        """Rows of a snapshot table that belong to the latest completed run of its scope."""
        kind = next(k for k, (_, _, tables) in RUN_TABLES.items() if name in tables)
        return self.read(name).join(self.latest_runs(kind).select("chain_id", "run_id"), ["chain_id", "run_id"], "left_semi")

    def views(self) -> dict[str, DataFrame]:
        """All logical views by name."""
        out = {"current_canonical_blocks": self.current_canonical_blocks(), "canonical_transactions": self.canonical_transactions(),
               "canonical_token_transfers": self.canonical_token_transfers()}
        for kind, (table, _, tables) in RUN_TABLES.items():
            out[f"latest_{table}"] = self.latest_runs(kind)
            out |= {f"current_{t}": self.current(t) for t in tables}
        return out

    def register(self) -> None:
        """Tables and views as temporary views, for ``spark.sql``."""
        for name in S.TABLES:
            self.read(name).createOrReplaceTempView(name)
        for name, df in self.views().items():
            df.createOrReplaceTempView(name)

    # Run states --------------------------------------------------------------------------------

    def run_state(self, table: str, run_id: str) -> dict | None:
        row = latest_by_version(self.read(table).where(F.col("run_id") == run_id), ["run_id"]).first()
        return row.asDict() if row else None

    def checkpoint(self, job: str, chain_id: int) -> dict | None:
        rows = self.read("pipeline_checkpoints").where((F.col("job_name") == job) & (F.col("chain_id") == chain_id))
        row = latest_by_version(rows, ["job_name", "chain_id"]).first()
        return row.asDict() if row else None

    def healthy(self) -> bool:
        try:
            return self.spark.sql("SELECT 1").first()[0] == 1
        except Exception:
            return False

    def seed_taxonomy(self, version: str, taxonomy: dict[str, tuple[str, ...]], now) -> None:
        """Insert the taxonomy rows that are not there yet."""
        rows = [{"taxonomy_version": version, "label_dimension": d, "label_value": v, "description": f"{d} {v}", "active": 1, "created_at": now}
                for d, values in taxonomy.items() for v in values]
        schema = self.schema("label_taxonomy")
        wanted = self.spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)
        keys = ["taxonomy_version", "label_dimension", "label_value"]
        new = wanted.join(self.read("label_taxonomy"), keys, "left_anti").collect()  # a constant list
        schema_rows = [r.asDict() for r in new]
        if schema_rows:
            self.spark.createDataFrame([tuple(r[c] for c in schema.names) for r in schema_rows], schema).coalesce(1).write.mode("append").parquet(f"{self.root}/label_taxonomy")
