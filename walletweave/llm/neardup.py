"""Near-duplicate groups with a MinHash LSH forest.

1. Every whole text becomes a set of word shingles; equal sets are one node from here on, so
   exact copies, however many, weigh as one row.
2. A node has ``TREES`` x ``DEPTH`` MinHash values of 16 bits. Tree t orders the nodes by the
   signature rotated to start at its own ``DEPTH`` values. In each sorted order a node meets
   its ``NEAR`` predecessors whose common prefix covers the tree's own values: where the region
   is sparse that is the whole prefix bucket, where it is dense the neighbours agree to a
   greater depth. Pairs whose signatures agree well enough link their nodes into regions; each
   task emits only a spanning forest of its part. The orders are range-partitioned, so a hot
   region spreads over tasks, and the rows at partition borders are stitched in a second pass.
3. Inside a region the full shingle sets decide, and at every size no pair above the threshold
   is left out. A region is dealt into blocks of about ``BLOCK`` nodes or ``BLOCK_SHINGLES``
   shingles; a unit is one block or a pair of blocks, and every pair of blocks has its unit. A
   node goes to as many units as its region has blocks, so regions of more than ``SPLIT`` + 1
   blocks are dealt in passes of at most that many units a node. Within a unit two sets are
   compared when they share one of their rarest shingles, which sets above the threshold must
   (prefix filter); units emit verified links of a spanning forest only.
4. Components of the verified links give each row its class.

Rows are told apart by ``row``, a 64-bit hash of id and text, so a null or repeated id is no
hindrance; keys travel as Arrow values and are never converted.

Defined cases: a null or blank text has no shingle and is linked with nothing; rows that share
an id keep a row each; a null id never becomes the smallest id of a group; repeated rows are one
node; an empty table gives an empty result; other columns of the input are not looked at, and the
filter returns them as they are, whatever their names. Of rows equal in id and text the filter
keeps one. Two different sets share a node key, and two different rows a row hash, with
probability 2**-64 a pair. The two narrow tables that the result reads stay in the shared folder.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_CLASS, connected_components, drop_stage, give_back, join_hot, stage
from .shingles import set_key, shingle_sets

TREES, DEPTH, NEAR = 16, 3, 4
N_HASH = TREES * DEPTH
BLOCK, BLOCK_SHINGLES, SPLIT = 2048, 1_500_000, 8
#: An agreement this far below the threshold is still a candidate: over 4.5 standard errors.
SLACK = 0.25
#: Rows a batch that goes back to the JVM.
ROWS = 2048
#: Rows that are equal in id and text are dealt over this many tasks.
SALTS = 8

_rng = np.random.default_rng(20240607)
MUL = _rng.integers(1, 2**63, N_HASH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2**63, N_HASH, dtype=np.uint64)


def minhash(s: np.ndarray) -> np.ndarray:
    """16 bits of each of N_HASH minima; the whole set is read, in blocks."""
    low = np.full(N_HASH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(s), 4096):
        low = np.minimum(low, (s[i:i + 4096, None] * MUL + ADD).min(axis=0))
    return ((low >> np.uint64(20)) & np.uint64(0xFFFF)).astype(">u2")


class Forest:
    """Union-find over hashable nodes; ``link`` tells whether two parts became one."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up, path = self.up, []
        while (p := up.setdefault(x, x)) != x:
            path.append(x)
            x = p
        for y in path:
            up[y] = x
        return x

    def link(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def row_hash(key: str, text: str):
    return F.xxhash64(F.col(key), F.col(text))


def signatures(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(k, row, n_shingles, node, sig): node and sig are null where there is no shingle."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["k", "row", "n_shingles", "node", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in give_back(batches):
            sets = shingle_sets(batch.column(2), shingle)
            for lo in range(0, batch.num_rows, ROWS):
                part, sizes, nodes, sigs = batch.slice(lo, ROWS), [], [], []
                known: dict = {}
                for s in itertools.islice(sets, part.num_rows):
                    node = set_key(s) if len(s) else None
                    if node is not None and node not in known:
                        known[node] = minhash(s).tobytes()
                    sizes.append(len(s))
                    nodes.append(node)
                    sigs.append(known.get(node))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary())], names=names)

    return docs.select(F.col(key).alias("k"), row_hash(key, text).alias("row"), F.col(text).cast("string").alias("t")).mapInArrow(
        run, f"k {kind}, row long, n_shingles long, node long, sig binary")


def _neighbours(rows: DataFrame, agree: int, stitch: bool) -> DataFrame:
    """(kind, a, b, row): kind 0 a forest edge a-b, kind 1 a row at the border of its partition."""

    names = ["kind", "a", "b", "tree", "skey"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, edges, borders, last = Forest(), [], [], None
        for batch in give_back(batches):
            if not batch.num_rows:
                continue
            if stitch and last is None:
                borders.append(batch.slice(0, NEAR))
            if last is not None:
                batch = pa.concat_batches([last, batch])
            tree, skey, node = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_numpy()
            sig = np.frombuffer(b"".join(skey.to_pylist()), dtype=">u2").reshape(batch.num_rows, N_HASH)
            for o in range(1, min(NEAR, batch.num_rows - 1) + 1):
                same = (sig[o:, :DEPTH] == sig[:-o, :DEPTH]).all(axis=1) & (tree[o:] == tree[:-o])
                at = np.flatnonzero(same)
                at = at[(sig[at + o] == sig[at]).sum(axis=1) >= agree]
                for a, b in zip(node[at].tolist(), node[at + o].tolist(), strict=True):
                    if a != b and forest.link(a, b):
                        edges.append((a, b))
            last = batch.slice(max(0, batch.num_rows - NEAR))
        if stitch and last is not None:
            borders.append(last)
        n = len(edges)
        a, b = zip(*edges, strict=True) if edges else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                          pa.array([0] * n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        for part in borders:
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), part.column(2).cast(pa.int64()), pa.array([0] * n, pa.int64()),
                                              part.column(0).cast(pa.int32()), part.column(1)], names=names)

    return rows.select("tree", "skey", "node").mapInArrow(run, "kind int, a long, b long, tree int, skey binary")


def candidate_regions(nodes: DataFrame, agree: int) -> DataFrame:
    """(node, root) of nodes linked by forest neighbours whose signatures agree in ``agree`` values."""
    trees = F.sequence(F.lit(0), F.lit(TREES - 1))
    width = 2 * DEPTH
    rows = nodes.select("node", "sig", F.explode(trees).alias("tree")).select(
        "tree", F.expr(f"concat(substring(sig, tree * {width} + 1), substring(sig, 1, tree * {width}))").alias("skey"), "node")
    order = ("tree", "skey", "node")
    found = stage(_neighbours(rows.repartitionByRange(*order).sortWithinPartitions(*order), agree, stitch=True), "forest")
    border = found.where("kind = 1").select("tree", "skey", F.col("a").alias("node")).distinct()
    used, edges = [found], found.where("kind = 0").select("a", "b")
    # A partition leaves 2 * NEAR border rows; where those are many they are stitched in parts first.
    while (parts := border.count() // (1 << 16)) > 0:
        part = stage(_neighbours(border.repartitionByRange(parts, *order).sortWithinPartitions(*order), agree, stitch=True), "forest")
        used.append(part)
        edges = edges.unionAll(part.where("kind = 0").select("a", "b"))
        border = part.where("kind = 1").select("tree", "skey", F.col("a").alias("node")).distinct()
    last = _neighbours(border.coalesce(1).sortWithinPartitions(*order), agree, stitch=False)
    out = connected_components(edges.unionAll(last.select("a", "b")))
    for df in used:
        drop_stage(df)
    return out


def _links(sets: list[np.ndarray], nodes: list[int], percent: int, split: int) -> list:
    """Verified links that join parts of the forest.

    Shingles are ranked from rare to frequent. Two sets above the threshold share a shingle among
    the first ``size - least common size + 1`` of each, so only such pairs are compared; pairs
    that are in one part already are not. With ``split``, rows from there on are compared with
    the rows before it and no others.
    """
    n, forest = len(sets), Forest()
    sizes = np.array([len(s) for s in sets])
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(times), dtype=np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    lone = int((times < 2).sum())  # ranks below are of one set only
    row = np.repeat(np.arange(n), sizes)
    token = np.sort(row * len(times) + rank[col]) - row * len(times)
    ends = np.cumsum(sizes)
    first = ends - sizes
    reach = sizes - -(-percent * sizes // 100) + 1
    head = (np.arange(len(token)) - first[row] < reach[row]) & (token >= lone)
    by_token = np.flatnonzero(head)[np.argsort(token[head], kind="stable")]
    holders, place = row[by_token], np.searchsorted(token[by_token], np.arange(lone, len(times) + 1))
    mark = np.zeros(len(times), dtype=bool)
    out, part = [], np.array([forest.root(x) for x in nodes])
    for i in range(split or 1, n):
        own = token[first[i]:ends[i]]
        lead = own[:reach[i]]
        lead = lead[lead >= lone] - lone
        if not len(lead):
            continue
        near, shared = np.unique(np.concatenate([holders[place[x]:place[x + 1]] for x in lead.tolist()]), return_counts=True)
        ok = (near < (split or i)) & (part[near] != part[i])
        ok &= 100 * np.minimum(sizes[near], sizes[i]) >= percent * np.maximum(sizes[near], sizes[i])
        near = near[ok][np.argsort(-shared[ok], kind="stable")]
        mark[own] = True
        step = 4
        while len(near):
            some, near = near[:step], near[step:]
            step = min(4 * step, 256)
            size = sizes[some]
            at = np.cumsum(size) - size
            common = np.add.reduceat(mark[token[np.arange(int(size.sum())) + np.repeat(first[some] - at, size)]], at, dtype=np.int64)
            good = some[100 * common >= percent * (size + sizes[i] - common)]
            if len(good):
                joined = np.append(part[good], part[i])
                out += [(nodes[i], nodes[j]) for j in good.tolist() if forest.link(nodes[i], nodes[j])]
                part[np.isin(part, joined)] = forest.root(nodes[i])
                near = near[part[near] != part[i]]
        mark[own] = False
    return out


def verified_links(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b) links that hold on full sets, spanning each unit; texts: (unit, side, t).

    A unit is compared whole, whatever its size: rows of one side with those of the other, or,
    where there is one side, all with all.
    """

    def unit_links(rows: Iterator[tuple[int, int, np.ndarray]]) -> list:
        sides: tuple[dict, dict] = {}, {}
        for side, s in rows:
            if len(s):
                sides[side].setdefault(set_key(s), s)
        both = sides[0].keys() & sides[1].keys()
        nodes = [x for side in sides for x in side if not (side is sides[1] and x in both)]
        sets = [sides[0].get(x, sides[1].get(x)) for x in nodes]
        return _links(sets, nodes, percent, len(sides[0]) if sides[1] else 0) if len(nodes) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in give_back(batches):
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2), shingle), strict=True)

        for _, rows in itertools.groupby(stream(), key=lambda x: x[0]):
            if links := unit_links(row[1:] for row in rows):
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return texts.repartition("unit").sortWithinPartitions("unit").select("unit", "side", "t").mapInArrow(run, "a long, b long")


def _deal(members: DataFrame, first: int, stop: int) -> DataFrame:
    """Members with ``unit`` and ``side`` for the block pairs ``first`` to ``stop`` - 1 blocks apart, around the ring of blocks."""
    units = F.expr(f"""flatten(transform(sequence({first}, cast(least({stop - 1}, n_blocks div 2) AS int)), d -> CASE
      WHEN d = 0 THEN array(struct(xxhash64(root, d, block) AS unit, 0 AS side))
      WHEN 2 * d = n_blocks THEN array(struct(xxhash64(root, d, block % d) AS unit, CASE WHEN block >= d THEN 1 ELSE 0 END AS side))
      ELSE array(struct(xxhash64(root, d, block) AS unit, 0 AS side),
                 struct(xxhash64(root, d, pmod(block - d, n_blocks)) AS unit, 1 AS side)) END))""")
    return members.where(f"n_blocks div 2 >= {first}").withColumn("at", F.explode(units)).select("*", "at.unit", "at.side")


def _classes(docs: DataFrame, key: str, text: str, shingle: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(signatures, (node, rows, component_id, best)), both staged; ``best`` is the least (id is null, id, row) of the class."""
    percent = round(100 * threshold)
    sig = stage(signatures(docs, key, text, shingle), "minhash")
    nodes = stage(sig.where("node is not null").groupBy("node").agg(
        F.min("k").alias("k"), F.min(F.struct(F.col("k").isNull().alias("no"), "k", "row")).alias("best"),
        F.count("*").alias("rows"), F.min("n_shingles").alias("n"), F.any_value("sig").alias("sig")), "nodes")
    regions = candidate_regions(nodes.select("node", "sig"), math.floor(N_HASH * (threshold - SLACK)))
    members = stage(regions.join(nodes.select("node", "best.row", "n"), "node"), "regions")
    drop_stage(regions)
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("total")).select("root", "m", blocks.alias("n_blocks"))
    most, total = (x or 0 for x in sizes.agg(F.max("n_blocks"), F.sum(F.when(F.col("n_blocks") > 1, F.col("m")))).first())
    # Regions of one block need no size: only larger ones are looked up.
    dealt = join_hot(members, sizes.where("n_blocks > 1"), "root", "m", "node", total).select(
        F.col("row"), "root", F.coalesce("n_blocks", F.lit(1)).alias("n_blocks"), "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")).drop("node")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    whole = docs.select(row_hash(key, text).alias("row"), F.col(text).cast("string").alias("t"),
                        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"))
    # A merge join at every size: a broadcast of few members would hide what the shuffle costs beyond.
    texts = dealt.withColumn("salt", salts).hint("merge").join(whole, ["row", "salt"]).groupBy("row", "salt").agg(
        F.first(F.struct("root", "n_blocks", "block")).alias("at"), F.first("t").alias("t")).select("at.*", "t")
    step, links = SPLIT // 2 + 1, []
    for first in range(0, most // 2 + 1, step):
        if first == step:  # texts of the large regions only
            texts = large = stage(texts.where(f"n_blocks div 2 >= {step}"), "large")
        units = _deal(texts, first, first + step)
        links.append(stage(verified_links(units.select("unit", "side", "t"), shingle, percent), "links"))
    parts = connected_components(functools.reduce(DataFrame.unionAll, links))
    ids = parts.join(nodes.select("node", "k", "best"), "node").groupBy("root").agg(
        F.min("k").alias("component_id"), F.min("best").alias("least"), F.count("*").alias("m"))
    named = join_hot(parts, ids, "root", "m", "node", parts.count()).select("node", "component_id", "least")
    classes = stage(nodes.join(named, "node", "left").select(
        "node", "rows", F.coalesce("component_id", "k").alias("component_id"), F.coalesce("least", "best").alias("best")), "classes")
    for df in (nodes, members, parts, *links, *([large] if most // 2 >= step else [])):
        drop_stage(df)
    return sig, classes


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row; see the module's text."""
    sig, classes = _classes(docs, key, text, shingle, threshold)
    out = join_hot(sig.select("k", "row", "n_shingles", "node"), classes.drop("best"), "node", "rows", spread="row")
    component = F.coalesce("component_id", "k")
    return out.select(F.col("k").alias(key), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("k") == component, component.isNull()).alias("kept"))


def keep_representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", **rule) -> DataFrame:
    """Documents with one of each near-duplicate group, and those without a word; every column stays."""
    sig, classes = _classes(docs, key, text, **{"shingle": 5, "threshold": 0.8} | rule)
    packed = docs.select(F.struct("*").alias("all"), row_hash(key, text).alias("row"),
                         F.coalesce(F.col(text).cast("string").rlike(WORD_CLASS), F.lit(False)).alias("worded"))
    chosen = classes.select("best.row").distinct()
    again = sig.where("node is not null").groupBy("row").count().where("count > 1").select("row")
    out = packed.where("NOT worded").select("all")
    if again.isEmpty():
        kept = packed.where("worded").join(chosen.hint("merge"), "row", "left_semi")
    else:  # rows equal in id and text: spread by salt, then one of each
        salted = packed.where("worded").withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        marked = chosen.join(again.withColumn("twice", F.lit(True)), "row", "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = salted.join(marked, ["row", "salt"])
        one = found.where("twice").groupBy("row").agg(F.first("all").alias("all"))
        kept = found.where("twice IS NULL").select("row", "all").unionByName(one)
    return out.unionByName(kept.select("all")).select("all.*")


def op1_minhash_forest(spark, sf_dir):
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, threshold=0.85)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, m.component_id, (n.doc_id = m.component_id) AS kept FROM n JOIN m USING (doc_id)
"""
