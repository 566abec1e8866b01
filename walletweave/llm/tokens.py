"""Token counts by a separator scan over flat, unindexed token files.

Documents are encoded and laid end to end in flat files of 16-bit ids, an end-of-document id
after each; files are held as blocks of ``BLOCK`` ids cut without regard to documents, or read in
byte ranges from where they lie (``read_files``). The scan knows only the ids: each block is
searched for separators in one vectorised pass, which gives the tokens before its first, between
its separators and after its last. A prefix scan in two levels (running sums, and the last block
with a separator, within groups of ``GROUP`` blocks and then over the groups of a file) carries
open documents across block boundaries, however many blocks they span.

Defined cases: null and empty text are documents of 0 tokens; a file without a final separator
ends in a document of the tokens left, if any; a last byte that is no whole id is left out; the
text of a special token is ordinary text; repeated rows are counted each; keys of any type and
size come back as they are; other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import give_back, stage

BLOCK = 1 << 16
GROUP = 1024
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
#: Fixed value: the public pre-tokenisation pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS, end: int = END) -> tuple[DataFrame, DataFrame]:
    """(blocks, manifest): (file, block, ids) and (file, ordinal, key); a file per input partition.

    Both come from one pass and are written to shared storage; a task holds one block.
    """
    with open(ranks, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, fixed size
    kind = docs.schema[key].dataType.simpleString()
    names = ["file", "at", "ids", "k"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, file = encoder(held.value), TaskContext.get().partitionId()
        tail, block, ordinal, key_type = np.empty(0, dtype=np.uint16), 0, 0, None

        def rows(start: int, data, keys) -> pa.RecordBatch:
            n = len(keys)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, file), pa.int64()), pa.array(np.arange(start, start + n), pa.int64()), data, keys], names=names)

        def blocks(parts: list[np.ndarray], last: bool) -> pa.RecordBatch:
            nonlocal tail, block
            flat = np.concatenate([tail, *parts])
            n = len(flat) if last else len(flat) // BLOCK * BLOCK
            data = [flat[i:min(n, i + BLOCK)].tobytes() for i in range(0, n, BLOCK)]
            tail, block = flat[n:], block + len(data)
            return rows(block - len(data), pa.array(data, pa.binary()), pa.nulls(len(data), key_type))

        for batch in give_back(batches):
            key_type = batch.column(0).type
            parts, size = [], 0
            for t in batch.column(1):
                t = t.as_py()
                parts.append(np.array([*(enc.encode_ordinary(t) if t else ()), end], dtype=np.uint16))
                size += len(parts[-1])
                if size >= 16 * BLOCK:
                    yield blocks(parts, False)
                    parts, size = [], 0
            yield blocks(parts, False)
            yield rows(ordinal, pa.nulls(batch.num_rows, pa.binary()), batch.column(0))
            ordinal += batch.num_rows
        if key_type is not None:
            yield blocks([], True)

    whole = stage(docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(
        run, f"file long, at long, ids binary, k {kind}"), "flat")
    blocks = whole.where("ids is not null").select("file", F.col("at").alias("block"), "ids")
    return blocks, whole.where("ids is null").select("file", F.col("at").alias("ordinal"), F.col("k").alias(key))


class TokenFiles(DataSource):
    """Flat files of ids as (file, block, ids): ``path`` a file or folder, ``id_bytes`` 2 or 4.

    A file of any size is dealt as byte ranges of whole blocks; nothing but sizes is read to plan.
    """

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return "file string, block long, ids binary"

    def reader(self, schema) -> DataSourceReader:
        return RangeReader(self.options["path"], int(self.options.get("id_bytes", 2)), int(self.options["block"]), int(self.options["range_blocks"]))


class RangeReader(DataSourceReader):
    def __init__(self, path: str, id_bytes: int, block: int, range_blocks: int):
        self.path, self.id_bytes, self.size, self.range = path, id_bytes, block * id_bytes, block * id_bytes * range_blocks

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        files, root = self._open()
        info = files.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root, recursive=True))
        sizes = sorted((x.path, x.size - x.size % self.id_bytes) for x in found if x.type == fs.FileType.File)
        return [InputPartition((path, at, min(size, at + self.range))) for path, size in sizes for at in range(0, size, self.range)] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        path, at, stop = partition.value
        with self._open()[0].open_input_file(path) as f:
            for i in range(at, stop, self.size):
                yield path, i // self.size, f.read_at(min(self.size, stop - i), i)


def read_files(spark: SparkSession, path: str, id_bytes: int = 2, range_blocks: int = 256) -> DataFrame:
    """Blocks of flat token files of any size, read in ranges of ``range_blocks`` blocks; file is the path."""
    spark.dataSource.register(TokenFiles)
    if "://" not in path:
        path = f"file://{path}"
    return spark.read.format("token_files").option("id_bytes", id_bytes).option("block", BLOCK).option("range_blocks", range_blocks).load(path)


def scan(blocks: DataFrame, end: int = END, id_bytes: int = 2) -> DataFrame:
    """(file, ordinal, n_tokens) of each document in the flat files."""
    kind = blocks.schema["file"].dataType.simpleString()
    names = ["file", "block", "seps", "head", "tail", "size", "inner"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in give_back(batches):
            out = []
            for ids in batch.column(2):
                x = np.frombuffer(ids.as_buffer(), dtype=f"<u{id_bytes}")
                at = np.flatnonzero(x == end)
                if len(at):
                    out.append((len(at), int(at[0]), len(x) - 1 - int(at[-1]), len(x) - len(at), np.diff(at) - 1))
                else:
                    out.append((0, len(x), 0, len(x), at))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.list_(pa.int64()))], names=names)

    # Written, a number a document and a row a block, so that the ids are read once.
    found = stage(blocks.select("file", "block", "ids").mapInArrow(
        run, f"file {kind}, block long, seps long, head long, tail long, size long, inner array<long>"), "scanned")
    # Within a group of blocks: sums from the group's start, and the place of the last cut (end of its last document).
    grouped = found.withColumn("g", F.floor(F.col("block") / GROUP))
    order = Window.partitionBy("file", "g").orderBy("block")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.withColumn("so_far", F.sum("size").over(upto)).withColumn(
        "cut", F.when(F.col("seps") > 0, F.col("so_far") - F.col("tail"))).select(
        "file", "g", "seps", "head", "size", "inner", "so_far",
        F.coalesce(F.sum("seps").over(before), F.lit(0)).alias("first"),
        F.last("cut", True).over(before).alias("cut_before"), F.last("cut", True).over(upto).alias("cut_upto"),
        F.lead("block").over(order).isNull().alias("ends_group"))
    # Over the groups of a file: what lies before each, and the last cut there.
    groups = inside.where("ends_group").select("file", "g", "so_far", (F.col("first") + F.col("seps")).alias("seps"), "cut_upto")
    chain = Window.partitionBy("file").orderBy("g")
    past = chain.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("base", F.coalesce(F.sum("so_far").over(past), F.lit(0))).select(
        F.col("file").alias("f2"), F.col("g").alias("g2"), "base", F.coalesce(F.sum("seps").over(past), F.lit(0)).alias("seps_base"),
        F.coalesce(F.last(F.col("base") + F.col("cut_upto"), True).over(past), F.lit(0)).alias("cut_base"),
        F.lead("g").over(chain).isNull().alias("ends_file"))
    placed = inside.join(groups, (F.col("file") == F.col("f2")) & (F.col("g") == F.col("g2")))
    at = F.col("base") + F.col("so_far")
    scanned = placed.select(
        "file", "seps", "inner", (F.col("seps_base") + F.col("first")).alias("first"),
        (at - F.col("size") + F.col("head") - F.coalesce(F.col("base") + F.col("cut_before"), "cut_base")).alias("closed"),
        (at - F.coalesce(F.col("base") + F.col("cut_upto"), "cut_base")).alias("left"),
        (F.col("ends_group") & F.col("ends_file")).alias("is_last"))
    documents = F.concat(
        F.when(F.col("seps") > 0, F.concat(F.array("closed"), "inner")).otherwise(F.array().cast("array<bigint>")),
        F.when(F.col("is_last") & (F.col("left") > 0), F.array("left")).otherwise(F.array().cast("array<bigint>")))
    return scanned.select("file", "first", F.posexplode(documents).alias("i", "n_tokens")).select(
        "file", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens")


def op9_separator_scan(spark, sf_dir):
    from .common import table

    blocks, manifest = pack(table(spark, sf_dir, "documents"))
    return manifest.join(scan(blocks), ["file", "ordinal"], "left").select("doc_id", "n_tokens", "file", "ordinal")
