"""Shared helpers; staging and components come from the library."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import drop_stage, shared_dir, stage
from ..operators.components import connected_components

__all__ = ["SPACE_CLASS", "WORD_CLASS", "connected_components", "drop_stage", "free", "give_back", "join_hot", "let", "shared_dir", "stage", "table", "words_of"]

#: ASCII white space as the word rule names it: space and \x09-\x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(docs: DataFrame, name: str) -> str:
    """``name``, with underscores after it while the input has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value, body):
    """Bind a column once inside an expression: ``body`` gets a lambda variable.

    Without it the optimizer may inline ``value`` into each use, inside lambdas too.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text):
    """Words of a text as an array; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def give_back(batches: Iterator) -> Iterator:
    """The batches of a task; after the last, memory that is no longer used goes back to the system.

    A Python worker lives on for later tasks and stages, beside those of other queries.
    """
    import pyarrow as pa

    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim:
            trim(0)


#: A key with more than this share of all rows is hot; there are at most ``HOT`` of them.
HOT = 4096


def join_hot(left: DataFrame, right: DataFrame, key: str, rows: str, spread: str, total: int | None = None) -> DataFrame:
    """``left`` left-joined with ``right``, which has one row a key and, in ``rows``, how often ``left`` has it.

    Keys of more than 1 / ``HOT`` of the rows are at most ``HOT`` and are broadcast; the others meet in a
    shuffle, so no key has a larger share of a partition than that. Rows of hot or null keys are spread
    by ``spread``. ``total`` is the sum of ``rows`` where it is known; ``right`` is read twice, so it is
    a written table or ends in an aggregate whose shuffle the two readers share.
    """
    limit = (total if total is not None else right.agg(F.sum(rows)).first()[0] or 0) // HOT
    values = [c for c in right.columns if c not in (key, rows)]
    hot = F.broadcast(right.where(F.col(rows) > limit).select(  # at most HOT rows
        F.col(key).alias("__hot"), F.struct(*values).alias("__a")))
    cold = right.where(F.col(rows) <= limit).select(
        F.col(key).alias("__cold"), F.lit(0).cast("long").alias("__slot"), F.struct(*values).alias("__b"))
    one = left.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__at", F.when(
        F.col(key).isNull() | F.col("__hot").isNotNull(), F.pmod(F.xxhash64(spread), F.lit(1 << 20)) + 1).otherwise(0).cast("long"))
    both = one.join(cold, (F.col(key) == F.col("__cold")) & (F.col("__at") == F.col("__slot")), "left")
    return both.select(*[F.col(c) for c in left.columns], *[F.coalesce(F.col(f"__a.{v}"), F.col(f"__b.{v}")).alias(v) for v in values])
