"""Sharding over fixed virtual slots (DataFrame functions only).

Records hash into ``N_SLOTS`` virtual slots. Bytes are summed per slot, and a versioned table
(version, vslot, bytes, shard) maps every slot to a shard, those without a record too: version 1
is built by longest processing time first, each later version edits only the slots that must
move. Versions are stored side by side (``save_map``, ``load_map``), and rows that come later are
placed by a stored version. The law is ``bytes``: shard sizes are near equal.

Defined cases: a null text has no bytes (size 1); a null doc_id hashes as any other value; the
text's checksum also enters the hash, so rows that share an id still spread; fully repeated rows
share a slot and get places of their own; an empty table gives an empty result and a map of empty
slots, dealt evenly; other columns are not looked at.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let

N_SLOTS = 4096
#: Parts of a slot whose rows are numbered apart, so no window holds a whole slot.
PARTS = 16


def with_slots(docs: DataFrame, key: str = "doc_id", text: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """(key, size, text_crc32, vslot, part) of each row; ``part`` spreads the rows of a slot.

    To be written before it is used: ``part`` follows the task that made the row.
    """
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    return docs.select(
        F.col(key),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    ).withColumn("vslot", F.pmod(F.xxhash64(F.col(key), F.col("text_crc32")), F.lit(n_slots)).cast("int")).withColumn(
        "part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int"))


def slot_bytes(slotted: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """Bytes and rows of every slot, zeros where it has no record: partial sums per task, ``n_slots`` rows."""
    found = slotted.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    every = slotted.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(found, "vslot", "left").select(
        "vslot", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def build_map(slots: DataFrame, n_shards: int = 16, version: int = 1) -> DataFrame:
    """Version 1 of the map: the heaviest slot next goes to the lightest shard, of these to the one
    with fewest slots; a slot without bytes goes to the shard with fewest slots.

    One SQL fold over the slot table, whose size is fixed by ``N_SLOTS`` whatever the input.
    """
    return _fold(slots.withColumn("shard", F.lit(None).cast("int")), n_shards, version)


def rebalance(current: DataFrame, slots: DataFrame, n_shards: int, slack: float = 0.02) -> DataFrame:
    """The next version of the map for new byte counts: an edit, not a rebuild.

    A shard keeps its slots, heaviest first, while they fit in (1 + ``slack``) of the mean, and
    empty ones up to their mean number; only slots beyond that, slots without a shard and slots of
    a shard that is gone are placed again. ``moved`` marks the edits.
    """
    now = slots.join(current.select("vslot", "shard", "version"), "vslot", "left")
    old = F.when(F.col("shard") < n_shards, F.col("shard"))
    fill = Window.partitionBy("old").orderBy(F.desc("bytes"), "vslot").rowsBetween(Window.unboundedPreceding, 0)
    limit = now.agg((F.sum("bytes") / n_shards * (1 + slack)).alias("limit"), F.max("version").alias("last"),
                    F.ceil(F.count_if(F.col("bytes") == 0) / n_shards).alias("empties"))
    nth = F.row_number().over(Window.partitionBy("old", F.col("bytes") > 0).orderBy("vslot"))
    fits = F.when(F.col("bytes") > 0, F.sum("bytes").over(fill) <= F.col("limit")).otherwise(nth <= F.col("empties"))
    kept = (
        now.withColumn("old", old).join(F.broadcast(limit))  # one row
        .withColumn("shard", F.when(fits, F.col("old")))
    )
    out = _fold(kept, n_shards, F.coalesce(F.max("last"), F.lit(0)) + 1)
    before = current.select("vslot", F.col("shard").alias("was"))
    return out.join(before, "vslot", "left").withColumn("moved", ~F.col("shard").eqNullSafe(F.col("was"))).drop("was")


def _fold(slots: DataFrame, n_shards: int, version) -> DataFrame:
    """Place slots whose shard is null on the lightest shard, heaviest first; empty ones by the count of slots."""
    version = F.lit(version) if isinstance(version, int) else version
    state = F.struct(
        F.col("start").alias("load"), F.lit(0).alias("best"), F.array().cast("array<int>").alias("at")
    )

    def step(acc, x):
        by_count = F.transform(acc["load"], lambda v: F.struct(v["n"].alias("bytes"), v["bytes"].alias("n")))
        load = F.when(x["bytes"] > 0, F.transform(acc["load"], lambda v: F.struct(v["bytes"], v["n"].cast("long").alias("n")))).otherwise(
            F.transform(by_count, lambda v: F.struct(v["bytes"].cast("long").alias("bytes"), v["n"])))
        best = let(load, lambda v: F.array_position(v, F.array_min(v)).cast("int") - 1)
        return F.struct(
            F.transform(acc["load"], lambda v, i: F.when(i == best, F.struct(
                (v["bytes"] + x["bytes"]).alias("bytes"), (v["n"] + 1).alias("n"))).otherwise(v)).alias("load"),
            best.alias("best"),
            F.concat(acc["at"], F.array(best)).alias("at"),
        )

    packed = slots.agg(
        F.sort_array(F.collect_list(F.when(F.col("shard").isNull(), F.struct((-F.col("bytes")).alias("neg"), "vslot", "bytes")))).alias("open"),
        F.collect_list(F.when(F.col("shard").isNotNull(), F.struct("vslot", "bytes", "shard"))).alias("set"),
        version.cast("int").alias("version"),
    ).withColumn("start", F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.struct(
        F.aggregate(F.filter("set", lambda x: x["shard"] == s), F.lit(0).cast("long"), lambda a, x: a + x["bytes"]).alias("bytes"),
        F.size(F.filter("set", lambda x: x["shard"] == s)).alias("n"))))
    placed = packed.withColumn("at", F.aggregate("open", state, step)["at"]).select(
        "version",
        F.explode(F.concat(
            F.zip_with("open", "at", lambda o, s: F.struct(o["vslot"].alias("vslot"), o["bytes"].alias("bytes"), s.alias("shard"))),
            F.col("set"),
        )).alias("x"),
    )
    return placed.select("version", "x.vslot", "x.bytes", "x.shard")


def save_map(mapping: DataFrame, path: str) -> None:
    """Add a version of the map to the table at ``path``."""
    mapping.select("version", "vslot", "bytes", "shard").coalesce(1).write.mode("append").parquet(path)  # one row a slot


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the latest unless named."""
    stored = spark.read.schema("version int, vslot int, bytes long, shard int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def place(slotted: DataFrame, mapping: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each row's shard and its gapless place within the shard; ``slotted`` is a written table.

    Rows are numbered within a part of their virtual slot, tens of thousands of small windows, and
    shifted by the rows of the shard's earlier slots and parts, a running sum over the counts.
    """
    counts = slotted.groupBy("vslot", "part").agg(F.count("*").alias("rows")).join(F.broadcast(mapping.select("vslot", "shard")), "vslot")  # a row a slot
    before = Window.partitionBy("shard").orderBy("vslot", "part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("vslot", "part", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("vslot", "part").orderBy(key, "text_crc32", "size")
    return (
        slotted.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(base), ["vslot", "part"])  # at most N_SLOTS x PARTS rows
        .withColumn("slot", (F.col("base") + F.col("place")).cast("long")).drop("base", "place", "part")
    )


def op6_virtual_slots(spark, sf_dir):
    """Placed by version 1 of the stored map; ``next_shard`` is the shard by version 2, edited for a 17th."""
    from .common import shared_dir, stage, table

    slotted = stage(with_slots(table(spark, sf_dir, "documents").select("doc_id", "text")), "op6-rows")
    slots = stage(slot_bytes(slotted), "op6-slots")
    path = f"{shared_dir(spark)}/op6-map-{uuid.uuid4().hex}"
    save_map(build_map(slots), path)
    save_map(rebalance(load_map(spark, path, 1), slots, 17), path)
    later = load_map(spark, path, 2).select("vslot", F.col("shard").alias("next_shard"))
    return place(slotted, load_map(spark, path, 1)).join(F.broadcast(later), "vslot").select(  # a row a slot
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", "next_shard")
