"""Connected components of any edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import drop_stage, stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges: (node, root), root the least node.

    Alternating large-star and small-star rounds, each written to shared storage, until
    nothing changes. Minima are pre-aggregated before the shuffle and the join that deals
    them back is a plain equi-join that AQE splits where a hub is hot. Nodes without an
    edge other than to themselves do not appear. ``drop_stage`` deletes what the result reads.
    """
    cur = stage(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m"))
        .distinct(),
        "cc",
    )

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first())

    before = mark(cur)
    while before[0]:
        both = cur.select(F.col("v").alias("u"), F.col("m").alias("w")).unionAll(
            cur.select(F.col("m").alias("u"), F.col("v").alias("w"))
        )
        least = both.groupBy("u").agg(F.min("w").alias("lo"))
        large = (
            both.join(least, "u")
            .where("w > u")
            .select(F.col("w").alias("v"), F.least("lo", "u").alias("m"))
            .distinct()
        )
        least = large.groupBy("v").agg(F.min("m").alias("lo"))
        small = (
            large.join(least, "v")
            .select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("lo").alias("m")),
                                      F.struct(F.col("v"), F.col("lo").alias("m")))).alias("e"))
            .select("e.v", "e.m").where("v <> m").distinct()
        )
        nxt = stage(small, "cc")
        after = mark(nxt)
        drop_stage(cur)
        cur = nxt
        if after == before:
            break
        before = after
    roots = cur.select(F.col("m").alias("v"), "m").distinct()
    out = cur.unionAll(roots).select(F.col("v").alias("node"), F.col("m").alias("root"))
    out._stage_path = cur._stage_path
    return out
