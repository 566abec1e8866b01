"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification.

Texts are sequences of lower-cased words. The CGK random walk maps a sequence to a longer one
such that few word edits give few differing positions. Items and item-sized document windows
are embedded with the same ``WALKS`` random walks; ``TABLES`` hash tables a walk sample ``BITS``
positions each. Window-item pairs that share a bucket are verified by exact edit distance of the
item to its best-fitting passage. The tables of a walk fail together, and dropped or inserted words
drive the walks further apart the longer the item is, so the tables serve items of fewer than
``LONG`` words only, where they reach ``TARGET_RECALL``; every longer item is verified wherever
the document shares enough of its word runs, which misses nothing.

Windows are admitted where they can match at all. An item of n words and a passage at most k edits
from it share at least n - q + 1 - k q places of equal runs of q words (and one run where that is
less than one), so places with fewer of the item's runs near them are skipped without loss.

The benchmark is used in blocks of ``BLOCK_ITEMS`` items; one block's size is bounded and it is
all that the driver and the tasks hold at a time, so a larger benchmark means more passes.

Defined cases: null, empty or wordless documents and items match nothing; repeated items with one
id give one row a document; every row is judged by its own text, whatever its id (null, repeated
or beyond 2**53); an empty benchmark matches nothing; the filter returns the input's columns.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import give_back, stage
from .shingles import BYTES, M1, mix, rolling, slices, utf8, word_hashes

WORD = re.compile(r"\w+")
WALKS, TABLES, BITS = 8, 4, 2
TARGET_RECALL = 0.99
#: Items of so many words are verified without the tables.
LONG = 40
BLOCK_ITEMS = 20_000
#: Word edits allowed, as a share of the item's words.
MAX_EDITS = 0.2
RUN = 3
#: Documents whose windows are embedded together.
SLICE = 1000
#: Byte values of words of letters, digits and underscores; other ASCII characters part words.
WORD_BYTES = np.where([i > 127 or chr(i).isalnum() or i == ord("_") for i in range(256)], BYTES, np.uint64(0))


def text_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order. Texts beyond ASCII are parted by ``WORD`` first."""
    data, bounds = utf8(texts)
    for lo, hi in slices(bounds):
        part, ends = data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]
        if len(part) and part.max() > 127:
            raw = part.tobytes()
            plain = [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            plain = [t if t.isascii() else " ".join(WORD.findall(t.decode().lower())).encode() for t in plain]
            part, ends = np.frombuffer(b"".join(plain), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in plain])])
        h, before = word_hashes(part, ends, WORD_BYTES)
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            yield h[a:b]


def allowed(n: int) -> int:
    return int(MAX_EDITS * n)


def run_length(n: int) -> int:
    """Length of a word run that survives ``allowed(n)`` edits, at most RUN."""
    return max(1, min(RUN, n // (allowed(n) + 1)))


def shared_runs(n: int) -> int:
    """Places of equal word runs that ``allowed(n)`` edits must leave."""
    q = run_length(n)
    return max(1, n - q + 1 - allowed(n) * q)


def embed_keys(seq: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Bucket keys [windows, WALKS * TABLES] of the windows of n words at ``starts``; texts end at ``ends``."""
    rng = np.random.default_rng(n)
    out = np.empty((len(starts), WALKS * TABLES), dtype=np.uint64)
    for walk in range(WALKS):
        seeds = rng.integers(1, 2**63, 3 * n, dtype=np.uint64)
        picks = rng.integers(0, 2 * n, (TABLES, BITS))
        at, stop = starts.copy(), np.minimum(starts + n, ends)
        steps = int(picks.max()) + 1
        y = np.empty((steps, len(starts)), dtype=np.uint64)
        for j in range(steps):
            inside = at < stop
            y[j] = np.where(inside, seq[np.minimum(at, stop - 1)], np.uint64(0))
            at += ((mix(y[j] ^ seeds[j]) >> np.uint64(63)).astype(np.int64)) & inside
        for t in range(TABLES):
            key = np.full(len(starts), np.uint64(walk * TABLES + t + 1))
            for p in picks[t]:
                key = mix(key * M1 + y[p])
            out[:, walk * TABLES + t] = key
    return out


def best_fit(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the passage of ``text`` nearest to ``item``: exact word edit distance."""

    def last_row(a, b):
        idx = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, dtype=np.int64)
        for i, x in enumerate(a, 1):
            new = np.minimum(row[1:] + 1, row[:-1] + (b != x))
            new = np.append(i, new)
            row = np.minimum.accumulate(new - idx) + idx
        return row

    row = last_row(item, text)
    end = int(row.argmin())
    back = last_row(item[::-1], text[:end][::-1])
    return int(row[end]), end - int(back.argmin()), end


def _flat(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end, and where each begins (and the last ends)."""
    bounds = np.concatenate([[0], np.cumsum([len(h) for h in texts])]).astype(np.int64)
    return (np.concatenate(texts) if texts else np.empty(0, dtype=np.uint64)), bounds


class Index:
    """The hash tables of one block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        hashes = text_hashes(pa.array([t for _, t in items], pa.string()))
        self.items = [(i, h) for (i, _), h in zip(items, hashes, strict=True) if len(h)]
        by_size: dict[int, list[int]] = defaultdict(list)
        runs: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        # A run leads to a size of tabled items, as -n, or to a long item, as its number.
        for k, (_, h) in enumerate(self.items):
            if len(h) < LONG:
                by_size[len(h)].append(k)
            for key in rolling(h, run_length(len(h))).tolist():
                runs[run_length(len(h))][key].add(-len(h) if len(h) < LONG else k)
        self.tables: dict[int, dict[int, list[int]]] = {}
        for n, who in by_size.items():
            seq, bounds = _flat([self.items[k][1] for k in who])
            table = self.tables[n] = defaultdict(list)
            for k, keys in zip(who, embed_keys(seq, bounds[:-1], bounds[1:], n).tolist(), strict=True):
                for key in keys:
                    table[key].append(k)
        self.runs = {q: (np.array(sorted(x), dtype=np.uint64), x) for q, x in runs.items()}

    def admitted(self, h: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(-n, starts) of the windows that can match an item of n words; (k, starts) of those that can match long item k."""
        spans: dict[int, list[int]] = defaultdict(list)
        for q, (keys, targets) in self.runs.items():
            if len(h) < q:
                continue
            r = rolling(h, q)
            hit = keys[np.minimum(np.searchsorted(keys, r), len(keys) - 1)] == r
            for p in np.flatnonzero(hit).tolist():
                for target in targets[int(r[p])]:
                    spans[target].append(p)
        for target, hits in spans.items():
            n = -target if target < 0 else len(self.items[target][1])
            k, q, least, top = allowed(n), run_length(n), shared_runs(n), max(0, len(h) - n)
            if len(h) < n - k:
                continue
            starts: set[int] = set()
            for first, last in zip(hits, hits[least - 1:], strict=False):
                if last - first <= n + k - q:
                    starts.update(range(min(top, max(0, last + q - n - k)), min(top, first) + 1))
            if starts:
                yield target, sorted(starts)

    def matches(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item number, edits, start, end): the best passage of every item found."""
        seq, bounds = _flat(texts)
        windows: dict[int, list[tuple[int, int]]] = defaultdict(list)
        found: dict[tuple[int, int], set[int]] = defaultdict(set)
        for d, h in enumerate(texts):
            if len(h):
                for target, starts in self.admitted(h):
                    if target < 0:
                        windows[-target] += [(d, s) for s in starts]
                    else:
                        found[d, target].update(starts)
        for n, rows in windows.items():
            table = self.tables[n]
            for j in range(0, len(rows), 8192):
                who, at = np.array(rows[j:j + 8192], dtype=np.int64).T
                for d, s, keys in zip(who.tolist(), at.tolist(), embed_keys(seq, bounds[who] + at, bounds[who + 1], n).tolist(), strict=True):
                    for key in keys:
                        if key in table:
                            for item in table[key]:
                                found[d, item].add(s)
        for (d, item), starts in sorted(found.items()):
            own, h = self.items[item][1], texts[d]
            n, k, seen, best = len(own), allowed(len(own)), -1, None
            for s in sorted(starts):
                if s <= seen:
                    continue  # inside the passage that was compared last
                lo, hi = max(0, s - k), min(len(h), s + 2 * n + 2 * k)
                seen = hi - n - 2 * k
                edits, a, b = best_fit(own, h[lo:hi])
                if edits <= k and (best is None or edits < best[0]):
                    best = edits, lo + a, lo + b
            if best:
                yield d, item, *best


def _blocks(benchmark: DataFrame, item: str, item_text: str) -> Iterator[list[tuple]]:
    """The distinct (id, text) items, ``BLOCK_ITEMS`` at a time."""
    rows = benchmark.select(F.col(item), F.col(item_text).cast("string")).where(F.col(item_text).isNotNull()).distinct()
    pending = map(tuple, rows.toLocalIterator())
    while block := list(itertools.islice(pending, BLOCK_ITEMS)):
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, n_words, edits, similarity, start_word, end_word): a row for each item in a document."""
    spark = docs.sparkSession
    kind, of = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType
    names = ["k", "item_id", "n_words", "edits", "similarity", "start_word", "end_word"]
    schema = f"k {kind}, item_id {of.simpleString()}, n_words int, edits int, similarity double, start_word int, end_word int"
    ids = to_arrow_type(of)
    narrow = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    blocks = _blocks(benchmark, item, item_text)
    block, out = next(blocks, []), None
    while block or out is None:
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Index(held.value)
            for batch in give_back(batches):
                texts = text_hashes(batch.column(1))
                for lo in range(0, batch.num_rows, SLICE):
                    part = batch.slice(lo, SLICE)
                    rows = np.array(list(index.matches(list(itertools.islice(texts, part.num_rows)))), dtype=np.int64).reshape(-1, 5)
                    size = np.array([len(index.items[i][1]) for i in rows[:, 1]], dtype=np.int64)
                    cols = [size, rows[:, 2], 1 - rows[:, 2] / np.maximum(1, size), rows[:, 3], rows[:, 4]]
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(rows[:, 0], pa.int64())), pa.array([index.items[i][0] for i in rows[:, 1]], ids),
                        *(pa.array(c, pa.float64() if c.dtype == float else pa.int32(), safe=False) for c in cols)], names=names)

        part = narrow.mapInArrow(run, schema).withColumnRenamed("k", key)
        block = next(blocks, [])
        if block or out is not None:  # several passes: one at a time
            part = stage(part, "leaks")
            held.unpersist()
        out = part if out is None else out.unionAll(part)
    return out


def _leaks(held):
    """Whether a text holds an item of the block."""

    @F.arrow_udf("boolean")
    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(held.value)
        for batch in give_back(batches):
            texts, bad = text_hashes(batch), np.zeros(len(batch), dtype=bool)
            for lo in range(0, len(batch), SLICE):
                for d, *_ in index.matches(list(itertools.islice(texts, min(SLICE, len(batch) - lo)))):
                    bad[lo + d] = True
            yield pa.array(bad)

    return leaks


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in which no benchmark item was found; every column stays. Rows are judged where they are, without a join."""
    out = docs.select(F.struct("*").alias("all"), F.col(text).cast("string").alias("t"))
    blocks = _blocks(benchmark, "item_id", "text")
    block = next(blocks, [])
    while block:
        held = docs.sparkSession.sparkContext.broadcast(block)
        out = out.where(~_leaks(held)("t"))
        block = next(blocks, [])
        if block:  # several passes: one at a time
            out = stage(out, "clean")
            held.unpersist()
    return out.select("all.*")


def op10_cgk_edit_lsh(spark, sf_dir):
    from .common import table

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.min_by(F.struct("n_words", "edits", "similarity", "start_word", "end_word"),
                 F.struct("edits", "start_word")).alias("x")).select("doc_id", "item_id", "x.*")
