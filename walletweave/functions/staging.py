"""Tables written to shared storage in the middle of a plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` where it is set.

    Unset, a local master (tests) uses the temp folder, and a cluster its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return f"file://{tempfile.gettempdir()}/checkpoints/walletweave"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete a staged table that no later plan reads."""
    path = getattr(df, "_stage_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
